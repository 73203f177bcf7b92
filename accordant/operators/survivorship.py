"""Survivors of groups and previews of their merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accordant.config import DEFAULT_RANK, DEFAULTS, Settings


def with_ranks(groups: DataFrame, ranks: DataFrame, relationship: str = "relationship") -> DataFrame:
    """relationship_rank by lookup. Spark broadcasts the rank table where it is small enough, as the settings' own is."""
    table = ranks.select(F.col("relationship").alias(relationship), F.col("rank").alias("relationship_rank"))
    out = groups.drop("relationship_rank").join(table, relationship, "left")
    return out.withColumn("relationship_rank", F.coalesce("relationship_rank", F.lit(DEFAULT_RANK)))


def rank_table(spark, settings: Settings = DEFAULTS) -> DataFrame:
    return spark.createDataFrame(list(settings.ranks.items()), "relationship string, rank int")


def elect_primary(groups: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """is_primary: in each group the least rank, then the tie-breakers that exist, nulls last. Unassigned rows (null group) have none."""
    order = [F.col("relationship_rank").asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in settings.tie_breakers if c in groups.columns]]
    nth = F.row_number().over(Window.partitionBy("group_id").orderBy(*order))
    return groups.withColumn("nth", nth).withColumn("is_primary", F.col("group_id").isNotNull() & (F.col("nth") == 1)).drop("nth")


def group_conflicts(groups: DataFrame, fields: list[str]) -> DataFrame:
    """group_id, group_size, values of each field (nulls left out), has_conflict."""
    counts = [F.count_distinct(F.col(c)).alias(f"n_{c}") for c in fields]
    out = groups.groupBy("group_id").agg(F.count("*").alias("group_size"), *counts)
    return out.withColumn("has_conflict", F.greatest(F.lit(0), *[F.col(f"n_{c}") for c in fields]) > 1)


def merge_preview(groups: DataFrame, fields: list[str]) -> DataFrame:
    """group_id, merge_preview_json for groups of several records with a conflict in some field."""
    own = groups.withColumn("group_size", F.count("*").over(Window.partitionBy("group_id")))
    wanted = group_conflicts(groups, fields).where("group_size > 1 and has_conflict").select("group_id")
    rows = own.join(wanted, "group_id", "left_semi")

    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    summary = F.struct(*[text(c).alias(c) for c in ("account_id", "account_name", "relationship")], F.col("relationship_rank"), F.col("weakest_edge_to_primary"))
    values = [F.sort_array(F.collect_set(F.col(c).cast("string"))).alias(f"v_{c}") for c in fields]
    firsts = [F.max(F.when(F.col("is_primary"), text(c))).alias(f"p_{c}") for c in fields]
    gathered = rows.groupBy("group_id").agg(
        F.count("*").alias("group_size"), F.max(F.when(F.col("is_primary"), summary)).alias("primary"),
        F.sort_array(F.collect_list(F.when(~F.col("is_primary"), summary))).alias("others"), *values, *firsts,
    )

    def comparison(c):
        p, v = F.coalesce(f"p_{c}", F.lit("")), F.col(f"v_{c}")
        several = F.size(v) > 1
        rest = F.when(several, F.filter(v, lambda x: x != p)).otherwise(F.array().cast("array<string>"))
        return F.struct(p.alias("primary_value"), rest.alias("alternative_values"), several.alias("has_conflict")).alias(c)

    preview = F.struct(F.col("primary").dropFields("weakest_edge_to_primary").alias("primary_record"), "group_size", F.struct(*[comparison(c) for c in fields]).alias("field_comparisons"), F.col("others").alias("non_primary_records"))
    return gathered.select("group_id", F.when(F.col("primary").isNull(), F.lit('{"error": "No primary record found"}')).otherwise(F.to_json(preview)).alias("merge_preview_json"))


def preview_summary(groups: DataFrame, fields: list[str]) -> DataFrame:
    multi = group_conflicts(groups, fields).where("group_size > 1")
    n = F.count_if("has_conflict")
    return multi.agg(n.alias("conflicted"), F.count_if(~F.col("has_conflict")).alias("clean"), F.count("*").alias("total"), F.when(F.count("*") > 0, n / F.count("*")).otherwise(F.lit(0.0)).alias("rate"))


def group_size_quantiles(groups: DataFrame) -> DataFrame:
    """Over groups of several: how many, mean, and the sizes at n // 2 and int(.9 n) in order: ranked from size counts, not from a list of groups."""
    sizes = groups.groupBy("group_id").agg(F.count("*").alias("size")).where("size > 1").groupBy("size").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy("size"))  # as many rows as there are different sizes
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    ranked = sizes.withColumn("upto", upto).withColumn("total", total)
    return ranked.agg(
        F.max("total").alias("groups"), (F.sum(F.col("size") * F.col("n")) / F.max("total")).alias("avg_size"),
        F.min(F.when(F.col("upto") > F.expr("total div 2"), F.col("size"))).alias("p50"),
        F.min(F.when(F.col("upto") > F.floor(F.col("total") * 0.9), F.col("size"))).alias("p90"),
    )
