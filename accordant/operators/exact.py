"""Exact-equal names: one representative stands for records of the same raw key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.functions.text import raw_exact_key


def exact_groups(records: DataFrame, min_size: int = 2, trim: bool = True) -> DataFrame:
    """raw_exact_key, representative_id, representative_name, group_size, all_account_ids, all_names; the least id represents."""
    keyed = records.select(raw_exact_key("account_name", trim).alias("raw_exact_key"), "account_id", "account_name").where("raw_exact_key <> ''")
    members = F.array_sort(F.collect_list(F.struct("account_id", "account_name")))
    out = keyed.groupBy("raw_exact_key").agg(members.alias("m"), F.count("*").alias("group_size")).where(F.col("group_size") >= min_size)
    return out.select("raw_exact_key", F.col("m")[0]["account_id"].alias("representative_id"), F.col("m")[0]["account_name"].alias("representative_name"), "group_size", F.col("m.account_id").alias("all_account_ids"), F.col("m.account_name").alias("all_names"))


def exact_map(records: DataFrame, min_size: int = 2, trim: bool = True) -> DataFrame:
    """Each member of an exact group with its representative: aggregated without the member lists, so a common name is no large row."""
    keyed = records.select("account_id", "account_name", raw_exact_key("account_name", trim).alias("raw_exact_key")).where("raw_exact_key <> ''")
    first = F.min(F.struct("account_id", "account_name"))
    heads = keyed.groupBy("raw_exact_key").agg(first.alias("first"), F.count("*").alias("group_size")).where(F.col("group_size") >= min_size)
    heads = heads.select("raw_exact_key", F.col("first.account_id").alias("representative_id"), F.col("first.account_name").alias("representative_name"), "group_size")
    return keyed.join(heads, "raw_exact_key").select("account_id", "account_name", "raw_exact_key", "representative_id", "representative_name", "group_size")


def exact_star(mapped: DataFrame) -> DataFrame:
    """Edges of score 100 from the representative to each other member: they connect the group like all its pairs do."""
    return mapped.where("account_id <> representative_id").select(F.col("representative_id").alias("id_a"), F.col("account_id").alias("id_b"), F.lit(100.0).alias("score"), F.lit("exact_equal_raw").alias("group_join_reason"), "raw_exact_key")


def exact_pairs(mapped: DataFrame, largest: int | None = 1000) -> DataFrame:
    """All pairs of each group of up to `largest` members, for the audit table; beyond that the star stands for them. None: all pairs of every group."""
    largest = (1 << 62) if largest is None else largest
    small = mapped.where(F.col("group_size") <= largest)
    a = small.select("raw_exact_key", F.col("account_id").alias("id_a"))
    b = small.select("raw_exact_key", F.col("account_id").alias("id_b"))
    pairs = a.join(b, "raw_exact_key").where("id_a < id_b").select("id_a", "id_b", F.lit(100.0).alias("score"), F.lit("exact_equal_raw").alias("group_join_reason"), "raw_exact_key")
    return pairs.unionByName(exact_star(mapped.where(F.col("group_size") > largest)))


def unique_records(records: DataFrame, mapped: DataFrame) -> DataFrame:
    """Representatives and records without an equal: a member that another represents goes."""
    others = mapped.where("account_id <> representative_id").select("account_id")
    return records.join(others, "account_id", "left_anti")
