"""Similarity clusters of a scored pair graph: single and complete linkage."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accordant.operators.graph import components
from accordant.plans.materialise import materialise


def _check(threshold: float, policy: str, min_size: int) -> None:
    if not 0 <= threshold <= 1:
        raise ValueError("threshold is between 0 and 1")
    if policy not in ("single", "complete"):
        raise ValueError(f"unknown policy {policy!r}")
    if min_size < 1:
        raise ValueError("a cluster has one member at least")


def greedy_complete(members: list, edges: set, min_size: int) -> list[list]:
    """From the least member on, each cluster takes every later one that is near all its members."""
    left, out = sorted(members), []
    while left:
        cluster = [left[0]]
        for x in left[1:]:
            if all((min(x, y), max(x, y)) in edges for y in cluster):
                cluster.append(x)
        taken = set(cluster) if len(cluster) >= min_size else {left[0]}
        if len(cluster) >= min_size:
            out.append(cluster)
        left = [x for x in left if x not in taken]
    return out


def build_clusters(ids: DataFrame, pairs: DataFrame, threshold: float, policy: str = "complete", min_size: int = 2) -> DataFrame:
    """id, cluster_id: dense ids in order of the least member. `pairs` has id_a, id_b, sim; unknown ids are ignored.

    Complete linkage is greedy inside a connected component and so runs there as one group; the
    components themselves are found distributed.
    """
    _check(threshold, policy, min_size)
    known = ids.select(F.col("id").alias("id")).distinct()
    near = pairs.where((F.col("sim") >= threshold) & (F.col("id_a") != F.col("id_b"))).select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()
    near = near.join(known.withColumnRenamed("id", "a"), "a", "left_semi").join(known.withColumnRenamed("id", "b"), "b", "left_semi")
    label = components(near)
    everyone = known.join(label.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    kind = dict(known.dtypes)["id"]
    if policy == "single":
        rows = everyone.withColumn("size", F.count("*").over(Window.partitionBy("label"))).where(F.col("size") >= min_size).select("id", F.col("label").alias("root"))
    else:

        def run(part: pd.DataFrame) -> pd.DataFrame:
            a, b = part["a"].tolist(), part["b"].tolist()
            edges = {(x, y) for x, y in zip(a, b) if y == y and y is not None and x != y}
            rows_ = [(x, c[0]) for c in greedy_complete(sorted(set(a) | {y for _, y in edges}), edges, min_size) for x in c]
            return pd.DataFrame(rows_, columns=["id", "root"])

        # Every member once as a pair with itself, so that lone ones are there too.
        inside = near.join(label.withColumnRenamed("node", "a"), "a").select("label", "a", "b")
        alone = everyone.select("label", F.col("id").alias("a"), F.col("id").alias("b"))
        rows = inside.unionByName(alone).groupBy("label").applyInPandas(run, f"id {kind}, root {kind}")
    return rows.join(_numbered(rows.select("root").distinct()), "root").select("id", "cluster_id")


def _numbered(roots: DataFrame) -> DataFrame:
    """`roots` with dense ids in their order: numbered within ranges of roots, from where the ranges before end."""
    ranged = materialise(roots.repartitionByRange("root").withColumn("range", F.spark_partition_id()))
    ends = ranged.groupBy("range").agg(F.count("*").alias("n"))  # a row a partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy("range").orderBy("root")) - 1
    return ranged.withColumn("own", own).join(ends.select("range", before.alias("before")), "range").select("root", (F.col("before") + F.col("own")).cast("int").alias("cluster_id"))


def outliers(ids: DataFrame, clusters: DataFrame) -> DataFrame:
    return ids.select("id").distinct().join(clusters.select("id"), "id", "left_anti")


def min_similarity(clusters: DataFrame, pairs: DataFrame) -> DataFrame:
    """cluster_id, size, min_similarity over all pairs of members: an absent pair counts 0, a lone member 1."""
    sizes = clusters.groupBy("cluster_id").agg(F.count("*").alias("size"))
    a = clusters.select(F.col("id").alias("id_a"), "cluster_id")
    b = clusters.select(F.col("id").alias("id_b"), F.col("cluster_id").alias("other"))
    held = pairs.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "sim").groupBy("id_a", "id_b").agg(F.max("sim").alias("sim"))
    inside = held.join(a, "id_a").join(b, "id_b").where("cluster_id = other").groupBy("cluster_id").agg(F.min("sim").alias("least"), F.count("*").alias("held"))
    # Counting the pairs held tells whether one is absent; they need not be listed.
    least = F.when(F.col("size") == 1, F.lit(1.0)).when(F.coalesce("held", F.lit(0)) < F.expr("size * (size - 1) div 2"), F.lit(0.0)).otherwise(F.col("least"))
    return sizes.join(inside, "cluster_id", "left").select("cluster_id", "size", least.alias("min_similarity"))


def cluster_stats(clusters: DataFrame) -> DataFrame:
    sizes = clusters.groupBy("cluster_id").agg(F.count("*").alias("size"))
    return sizes.agg(F.count("*").alias("clusters"), F.sum("size").alias("members"), F.avg("size").alias("avg_size"), F.max("size").alias("max_size"), F.min("size").alias("min_size"))


def clusters_of_run(candidates: DataFrame, threshold: float, policy: str = "complete", min_size: int = 2, account_ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(clusters, outliers) of candidate pairs with scores of 0 to 100, by threshold, optionally among some accounts only."""
    _check(threshold, policy, min_size)
    rows = candidates.where(F.col("score") >= threshold * 100)
    if account_ids is not None:
        for end in ("id_a", "id_b"):
            rows = rows.join(account_ids.select(F.col("account_id").alias(end)), end, "left_semi")
    pairs = rows.select("id_a", "id_b", (F.col("score") / 100).alias("sim"))
    universe = candidates.select(F.explode(F.array("id_a", "id_b")).alias("id")).distinct() if account_ids is None else account_ids.select(F.col("account_id").alias("id"))
    made = build_clusters(universe, pairs, threshold, policy, min_size)
    return made, outliers(universe, made)


def cluster_page(clusters: DataFrame, mins: DataFrame, names: DataFrame, lone: DataFrame, order: str = "size", page: int = 1, size: int = 50) -> DataFrame:
    """A page of clusters with their names, the outliers as a last pseudo row of the list. `names`: id, name; an id without one shows itself."""
    shown = clusters.join(names, "id", "left").groupBy("cluster_id").agg(F.min(F.coalesce("name", F.col("id").cast("string"))).alias("name"))
    rows = mins.join(shown, "cluster_id").select(F.col("cluster_id").cast("string").alias("cluster"), "size", "min_similarity", "name")
    extra = lone.agg(F.count("*").alias("size")).select(F.lit("outliers").alias("cluster"), "size", F.lit(0.0).alias("min_similarity"), F.lit("outliers").alias("name"))
    by = {"size": [F.desc("size")], "similarity": [F.desc("min_similarity")], "name": [F.asc("name")]}[order]
    both = rows.withColumn("last", F.lit(0)).unionByName(extra.where("size > 0").withColumn("last", F.lit(1)))
    return both.orderBy("last", *by, "cluster").offset((max(page, 1) - 1) * size).limit(size).drop("last")
