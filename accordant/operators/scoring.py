"""Pair scores: a weighted mix of token ratios and Jaccard less penalties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.config import DEFAULTS, Settings
from accordant.functions.fuzzy import jaccard, numbers, punctuation, token_ratios


def score_components(pairs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """`pairs` (name_core_a/b, suffix_class_a/b) with ratio_name, ratio_set, jaccard, the style flags, base_score and score.

    Ratios are computed once for each distinct pair of cores and joined back, since most pairs of a
    block repeat others' names.
    """
    s = settings
    names = pairs.select("name_core_a", "name_core_b").distinct()
    rated = names.withColumn("ratios", token_ratios("name_core_a", "name_core_b")).select("name_core_a", "name_core_b", "ratios.ratio_name", "ratios.ratio_set")
    out = pairs.join(rated, ["name_core_a", "name_core_b"])
    if s.gate_cutoff is not None:
        out = out.where(F.col("ratio_set") >= s.gate_cutoff)
    out = out.withColumns({
        "jaccard": jaccard("name_core_a", "name_core_b", s.enhance),
        "num_style_match": numbers("name_core_a") == numbers("name_core_b"),
        "suffix_match": F.col("suffix_class_a") == F.col("suffix_class_b"),
        "punctuation_mismatch": punctuation("name_core_a") != punctuation("name_core_b"),
    })
    base = 0.45 * F.col("ratio_name") + 0.35 * F.col("ratio_set") + 20.0 * F.col("jaccard")
    for flag, penalty in ((~F.col("num_style_match"), s.numeric_penalty), (~F.col("suffix_match"), s.suffix_penalty), (F.col("punctuation_mismatch"), s.punctuation_penalty)):
        base = base - F.when(flag, F.lit(float(penalty))).otherwise(F.lit(0.0))
    out = out.withColumn("base_score", base)
    score = F.least(F.lit(100), F.greatest(F.lit(0), F.bround("base_score", 0).cast("int")))
    return out.withColumns({"score": score, "ratio_name": F.floor("ratio_name").cast("int"), "ratio_set": F.floor("ratio_set").cast("int")})


def within_reach(settings: Settings = DEFAULTS):
    """Whether a pair's score can reach the medium threshold if both its ratios were 100: told from tokens and flags alone."""
    s = settings
    best = 80.0 + 20.0 * jaccard("name_core_a", "name_core_b", s.enhance)
    flags = (
        (numbers("name_core_a") != numbers("name_core_b"), s.numeric_penalty), (F.col("suffix_class_a") != F.col("suffix_class_b"), s.suffix_penalty),
        (punctuation("name_core_a") != punctuation("name_core_b"), s.punctuation_penalty),
    )
    for flag, penalty in flags:
        best = best - F.when(flag, F.lit(float(penalty))).otherwise(F.lit(0.0))
    return best >= s.medium - 0.5 - 1e-6  # scores are rounded


def scored_candidates(pairs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Pairs at the medium threshold or above: id_a, id_b and the score's components."""
    kept = score_components(pairs, settings).where(F.col("score") >= settings.medium)
    return kept.select(F.col("account_id_a").alias("id_a"), F.col("account_id_b").alias("id_b"), "score", "ratio_name", "ratio_set", "jaccard", "num_style_match", "suffix_match", "punctuation_mismatch", "base_score")


#: Fixed value: the set ratio below which the bulk path drops a pair before it is scored.
BULK_GATE = 72


def bulk_candidates(pairs: DataFrame, settings: Settings = DEFAULTS, cutoff: int = BULK_GATE) -> DataFrame:
    """Scored candidates by the bulk path: pairs whose set ratio is below the cutoff leave first."""
    return scored_candidates(pairs, settings.but(gate_cutoff=cutoff))


def in_order(candidates: DataFrame) -> DataFrame:
    """Candidates by their ids, the best score of a pair first."""
    return candidates.orderBy("id_a", "id_b", F.desc("score"))


def candidate_stats(candidates: DataFrame) -> DataFrame:
    return candidates.agg(F.count("*").alias("total"), F.count_if(F.col("score") >= 84).alias("medium_or_more"), F.count_if(F.col("score") >= 92).alias("high"))


def check_references(candidates: DataFrame, accounts: DataFrame) -> DataFrame:
    """Pair ends that name no account (none if the table is sound)."""
    ends = candidates.select(F.explode(F.array("id_a", "id_b")).alias("account_id"))
    return ends.distinct().join(accounts.select("account_id"), "account_id", "left_anti")


def trace(a: str, b: str, spark, settings: Settings = DEFAULTS) -> DataFrame:
    """Every step of one pair's score."""
    from accordant.functions.text import normalise

    named = normalise(spark.createDataFrame([(0, a), (1, b)], "n int, account_name string"))
    left = named.where("n = 0").select(F.lit(1).alias("k"), F.col("name_core").alias("name_core_a"), F.col("suffix_class").alias("suffix_class_a"))
    right = named.where("n = 1").select(F.lit(1).alias("k"), F.col("name_core").alias("name_core_b"), F.col("suffix_class").alias("suffix_class_b"))
    scored = score_components(left.join(right, "k").drop("k"), settings)
    decision = F.when(F.col("score") >= settings.high, "edge>=high").when(F.col("score") >= settings.medium, "edge>=medium").otherwise("insufficient_edge")
    return scored.withColumn("decision", decision)
