"""Connected components of an edge table by contraction, with nothing on the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.plans.materialise import materialise, release


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node of each component, for every node of `edges` (columns a, b).

    Each round hooks every root to its least neighbour, shortens the hooks by pointer jumping, and
    contracts the edges to those between different roots, so rounds grow with the logarithm of the
    longest chain. Lineage is cut by checkpoints each round, and
    those of the rounds before are deleted.
    """
    edges = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    labels = materialise(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("label")))
    while not edges.isEmpty():
        held = materialise(edges.groupBy(F.col("a").alias("root")).agg(F.min("b").alias("to")))
        hooks = held
        while True:
            onward = hooks.select(F.col("root").alias("to"), F.col("to").alias("next"))
            jumped = materialise(hooks.join(onward, "to", "left").select("root", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")))
            release(held)
            held, hooks = jumped, jumped.select("root", "to")
            if jumped.where("moved").isEmpty():
                break
        relabelled = materialise(labels.join(hooks.withColumnRenamed("root", "label"), "label", "left").select("node", F.coalesce("to", "label").alias("label")))
        ends = edges.join(hooks.select(F.col("root").alias("a"), F.col("to").alias("ra")), "a", "left").join(hooks.select(F.col("root").alias("b"), F.col("to").alias("rb")), "b", "left")
        ends = ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b")
        contracted = materialise(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        release(labels, edges, held)
        labels, edges = relabelled, contracted
    release(edges)
    return labels
