"""Row and group filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant.config import NOISE


def is_noise(core: Column) -> Column:
    c = F.lower(F.trim(core))
    out = F.lit(False)
    for pattern in NOISE:
        out = out | c.rlike(pattern)
    return out


def split_noise(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, filtered_out): records with an empty or noisy core go to the audit table with a reason."""
    empty = F.coalesce(F.trim("name_core") == "", F.lit(True))
    reason = F.when(empty, F.lit("empty_name_core")).when(is_noise(F.col("name_core")), F.lit("noise_string"))
    marked = records.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null").select("account_id", "account_name", "reason")


def reject_reasons(filtered_out: DataFrame) -> DataFrame:
    return filtered_out.groupBy("reason").agg(F.count("*").alias("records"))


def by_disposition(rows: DataFrame, wanted: list[str] | None) -> DataFrame:
    """An empty list filters nothing, as callers expect."""
    return rows.where(F.col("disposition").isin(list(wanted))) if wanted else rows


def by_edge_strength(rows: DataFrame, least: float | None, column: str) -> DataFrame:
    return rows.where(F.col(column) >= least) if least else rows


def groups_where(rows: DataFrame, condition: Column) -> DataFrame:
    """Rows of the groups for which an aggregate condition holds."""
    wanted = rows.groupBy("group_id").agg(condition.alias("ok")).where("ok").select("group_id")
    return rows.join(wanted, "group_id", "left_semi")


def min_group_size(rows: DataFrame, n: int) -> DataFrame:
    return groups_where(rows, F.count("*") >= n)


def suffix_mismatch_only(rows: DataFrame) -> DataFrame:
    return groups_where(rows, F.min("suffix_class") != F.max("suffix_class"))


def with_aliases_only(rows: DataFrame) -> DataFrame:
    return groups_where(rows, F.bool_or(F.coalesce(F.size("alias_cross_refs") > 0, F.lit(False))))
