"""Group statistics and the summaries that reports show."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def group_stats(rows: DataFrame) -> DataFrame:
    """group_id, group_size, max_score, primary_name, disposition: the primary's name and disposition, else the least name and Update."""
    first = F.col("is_primary")
    return rows.groupBy("group_id").agg(
        F.count("*").alias("group_size"), F.max(F.coalesce("weakest_edge_to_primary", F.lit(0.0))).alias("max_score"),
        F.coalesce(F.max(F.when(first, F.col("account_name"))), F.min("account_name")).alias("primary_name"),
        F.coalesce(F.max(F.when(first, F.col("disposition"))), F.lit("Update")).alias("disposition"),
    )


def group_stats_first(rows: DataFrame) -> DataFrame:
    """The variant without fallbacks: nulls where a group has no primary; the least primary stands for "first"."""
    lead = F.min(F.when(F.col("is_primary"), F.struct("account_id", "account_name", "disposition")))
    out = rows.groupBy("group_id").agg(F.count("*").alias("group_size"), F.max("weakest_edge_to_primary").alias("max_score"), lead.alias("lead"))
    return out.select("group_id", "group_size", "max_score", F.col("lead.account_name").alias("primary_name"), F.col("lead.disposition").alias("disposition"))


def refresh_dispositions(stats: DataFrame, rows: DataFrame) -> DataFrame:
    """Stats with the final disposition of each group's primary."""
    final = rows.where("is_primary").groupBy("group_id").agg(F.max("disposition").alias("final"))
    return stats.join(final, "group_id", "left").withColumn("disposition", F.coalesce("final", "disposition")).drop("final")


def size_histogram(rows: DataFrame, per: str = "rows") -> DataFrame:
    """bucket (1, 2, 3, 4_plus) and count, over rows or over groups."""
    size = F.count("*").over(Window.partitionBy("group_id")) if "group_size" not in rows.columns else F.col("group_size")
    sized = rows.select("group_id", size.alias("s"))
    sized = sized if per == "rows" else sized.distinct()
    bucket = F.when(F.col("s") >= 4, F.lit("4_plus")).otherwise(F.col("s").cast("string"))
    return sized.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def in_group_scores(candidates: DataFrame, rows: DataFrame, group_id) -> DataFrame:
    """Scores of the edges inside one group: least, mean, largest and counts by threshold."""
    own = rows.where(F.col("group_id") == group_id).select("account_id")
    inside = candidates
    for end in ("id_a", "id_b"):
        inside = inside.join(own.withColumnRenamed("account_id", end), end, "left_semi")
    s = F.col("score")
    return inside.agg(F.count("*").alias("edges"), F.min(s).alias("min_score"), F.avg(s).alias("mean_score"), F.max(s).alias("max_score"), F.count_if(s >= 92).alias("high"), F.count_if((s >= 84) & (s < 92)).alias("medium"), F.count_if(s < 84).alias("low"))


def edges_inside_groups(candidates: DataFrame, rows: DataFrame) -> DataFrame:
    """Every candidate pair whose ends are in one group, with the group."""
    a = rows.select(F.col("account_id").alias("id_a"), "group_id")
    b = rows.select(F.col("account_id").alias("id_b"), F.col("group_id").alias("other"))
    return candidates.join(a, "id_a").join(b, "id_b").where("group_id = other").drop("other")


def newest_runs(runs: DataFrame) -> DataFrame:
    """The newest run of each pair of input and config hash."""
    nth = F.row_number().over(Window.partitionBy("input_hash", "config_hash").orderBy(F.desc("timestamp"), "run_id"))
    return runs.withColumn("nth", nth).where("nth = 1").drop("nth")


def latest(runs: DataFrame, n: int) -> DataFrame:
    return runs.orderBy(F.desc("timestamp"), "run_id").limit(n)


def keep_first(rows: DataFrame, key: str = "account_id", order: str = "row_seq") -> DataFrame:
    """The first row of each key in input order."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.withColumn("nth", nth).where("nth = 1").drop("nth")


def performance_summary(rows: DataFrame, candidates: DataFrame, stats: DataFrame) -> DataFrame:
    """One row: counts of records, groups, candidates and blocks."""
    a = rows.agg(F.count("*").alias("records"), F.count_distinct("group_id").alias("groups"), F.count_if("is_primary").alias("primaries")).withColumn("k", F.lit(1))
    b = candidates.agg(F.count("*").alias("candidates"), F.count_if(F.col("score") >= 92).alias("high_candidates")).withColumn("k", F.lit(1))
    c = stats.agg(F.count("*").alias("blocks"), F.sum("pairs_generated").alias("pairs")).withColumn("k", F.lit(1))
    return a.join(b, "k").join(c, "k").drop("k")
