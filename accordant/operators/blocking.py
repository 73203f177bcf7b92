"""Candidate pairs: blocking self-joins with sharding of large blocks, and block statistics.

Blocks, shards and their sizes are window counts on the record table; the pairs come from one
equi self-join on the final shard key, so a block that is too large for all its pairs is split
before the join, not after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accordant.config import DEFAULTS, Settings
from accordant.functions.fuzzy import bigram_overlap
from accordant.functions.text import bigram_key, first_token_key, tokens


def _count(*keys):
    return F.count("*").over(Window.partitionBy(*keys))


def _shards(rows: DataFrame, strategy: str, fallback: str, cap) -> DataFrame:
    """`rows` with a shard key: by the strategy, again by its finer key where the shard exceeds `cap`, then by the fallback."""

    def keys(kind: str):
        own = tokens("name_core")
        if kind == "second_token":
            return F.coalesce(F.get(own, F.lit(1)), F.lit("")), F.coalesce(F.get(own, F.lit(2)), F.lit(""))
        if kind == "char_trigram":
            return F.substring("name_core", 1, 3), F.substring("name_core", 1, 4)
        if kind == "none":
            return F.lit(""), F.lit("")
        raise ValueError(f"unknown shard strategy {kind!r}")

    big = F.col("strategy").endswith("sharded")
    out = rows.withColumn("shard", F.lit(""))
    for kind in dict.fromkeys((strategy, fallback)):
        coarse, fine = keys(kind)
        # The fallback is only for what the first strategy left too large.
        over = F.lit(True) if kind == strategy else _count("block_key", "pass", "shard") > cap
        out = out.withColumn("over", big & over)
        out = out.withColumn("shard", F.when(F.col("over"), F.concat_ws("\x1f", "shard", coarse)).otherwise(F.col("shard")))
        out = out.withColumn("over", F.col("over") & (_count("block_key", "pass", "shard") > cap))
        out = out.withColumn("shard", F.when(F.col("over"), F.concat_ws("\x1f", "shard", fine)).otherwise(F.col("shard")))
    return out.drop("over")


def blocks(records: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """row_seq, account_id, name_core, suffix_class with block_key, block_size, pass, strategy and shard; blocks of one are left out."""
    s = settings
    slim = records.select("row_seq", "account_id", "name_core", "suffix_class")
    by_token = slim.withColumn("block_key", first_token_key("name_core", s.stop_tokens)).withColumn("pass", F.lit("token"))
    by_bigram = slim.withColumn("block_key", bigram_key("name_core", s.allow_bigrams)).withColumn("pass", F.lit("bigram"))
    rows = by_token.unionByName(by_bigram).where("block_key <> ''")
    rows = rows.withColumn("block_size", _count("block_key", "pass")).where("block_size > 1")
    large = F.lit(False) if s.block_cap is None else F.col("block_size") > s.block_cap
    strategy = (
        F.when(F.col("pass") == "bigram", F.when(large, "allowlisted_bigram_sharded").otherwise("allowlisted_bigram"))
        .when(F.col("block_key").isin(list(s.allow_tokens)), F.when(large, "allowlisted_sharded").otherwise("allowlisted"))
        .when(F.col("block_key").isin(list(s.deny_tokens)) & large, F.lit("soft_ban_sharded"))
        .when(large, F.lit("standard_sharded"))
        .otherwise(F.lit("full_pairs"))
    )
    rows = rows.withColumn("strategy", strategy)
    cap = F.when(F.col("strategy") == "soft_ban_sharded", F.lit(s.max_shard_size)).otherwise(F.lit(s.block_cap or 0))
    return _shards(rows, s.shard_strategy, s.fallback_shard, cap)


def _soft_filters(settings: Settings):
    """What a pair of a soft-banned shard has to pass, told from its names alone; both ways round it is the same."""
    s = settings
    near = F.abs(F.length("name_core_a") - F.length("name_core_b")) <= s.length_window
    shared = F.size(F.array_intersect(tokens("name_core_a"), tokens("name_core_b"))) >= s.min_token_overlap
    alike = bigram_overlap(F.col("name_core_a"), F.col("name_core_b")) >= s.char_bigram_gate
    return near & shared & alike


def _pairs_with_blocks(blocked: DataFrame, settings: Settings) -> DataFrame:
    s, keys = settings, ["block_key", "pass", "shard"]
    a = blocked.select(*keys, "strategy", *[F.col(c).alias(f"{c}_a") for c in ("row_seq", "account_id", "name_core", "suffix_class")])
    b = blocked.select(*keys, *[F.col(c).alias(f"{c}_b") for c in ("row_seq", "account_id", "name_core", "suffix_class")])
    pairs = a.join(b, keys).where("row_seq_a < row_seq_b")
    soft = F.col("strategy") == "soft_ban_sharded"
    passed = pairs.where(~soft)
    # Only soft-banned blocks rank their candidates: what passed the filters, in row order, up to the setting's number.
    rank = F.row_number().over(Window.partitionBy("block_key", "pass", "shard", "row_seq_a").orderBy("row_seq_b"))
    capped = pairs.where(soft & _soft_filters(s))
    if s.max_candidates is not None:
        capped = capped.withColumn("nth", rank).where(F.col("nth") <= s.max_candidates).drop("nth")
    return passed.unionByName(capped)


PAIR_COLUMNS = ["account_id_a", "account_id_b", "name_core_a", "name_core_b", "suffix_class_a", "suffix_class_b"]


def candidate_pairs(records: DataFrame, settings: Settings = DEFAULTS, only=None) -> DataFrame:
    """Distinct pairs of records that share a shard, the earlier row first, with what the scorer needs.

    `only`, a condition on a pair's names and suffix classes, drops pairs where they are made, before any is shuffled.
    """
    pairs = _pairs_with_blocks(blocks(records, settings), settings)
    if only is not None:
        pairs = pairs.where(only)
    return pairs.dropDuplicates(["row_seq_a", "row_seq_b"]).select("row_seq_a", "row_seq_b", *PAIR_COLUMNS)


def _soft_pair_counts(soft: DataFrame, settings: Settings) -> DataFrame:
    """block_key, pass, pairs: how many pairs `_pairs_with_blocks` makes of soft-banned shards, a row for each of some parts.

    Distinct names of a shard meet instead of its rows. Of a row then count the later rows of the names that its own passes
    with, which a window tells from the end of the shard on, up to the candidates that a row may have.
    """
    s, keys = settings, ["block_key", "pass", "shard"]
    names = soft.select(*keys, "name_core").distinct()
    a, b = (names.select(*keys, F.col("name_core").alias(f"name_core_{x}")) for x in "ab")
    meet = a.join(b, keys).where(_soft_filters(s))
    rows = soft.select(*keys, "name_core", "row_seq")
    others = meet.select(*keys, "name_core_a", F.col("name_core_b").alias("name_core")).join(rows, [*keys, "name_core"])
    others = others.groupBy(*keys, "name_core_a", "row_seq").agg(F.count("*").alias("counted"))
    own = rows.withColumnRenamed("name_core", "name_core_a").groupBy(*keys, "name_core_a", "row_seq").agg(F.count("*").alias("own"))
    both = others.withColumn("own", F.lit(0).cast("long")).unionByName(own.withColumn("counted", F.lit(0).cast("long")))
    both = both.groupBy(*keys, "name_core_a", "row_seq").agg(F.sum("counted").alias("counted"), F.sum("own").alias("own"))
    # One row for each place of a name's sequence, so that rows before it are later ones alone.
    later = F.sum("counted").over(Window.partitionBy(*keys, "name_core_a").orderBy(F.desc("row_seq")).rowsBetween(Window.unboundedPreceding, -1))
    each = both.withColumn("later", F.coalesce(later, F.lit(0)))
    # Rows that share a place in the row order share their candidates' number, too.
    at = each.where("own > 0").groupBy(*keys, "row_seq").agg(F.sum(F.col("own") * F.col("later")).alias("made"))
    made = F.col("made") if s.max_candidates is None else F.least("made", F.lit(s.max_candidates))
    return at.select("block_key", "pass", made.alias("pairs"))


def block_stats(records: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """token, count, strategy, pairs_generated, pairs_capped of each block."""
    blocked = blocks(records, settings)
    sizes = blocked.groupBy("block_key", "pass", "strategy").agg(F.count("*").alias("count"))
    # All pairs of a shard are its size's; of soft-banned ones the names have to be joined.
    soft = F.col("strategy") == "soft_ban_sharded"
    whole = blocked.where(~soft).groupBy("block_key", "pass", "shard").agg(F.count("*").alias("n")).select("block_key", "pass", F.expr("n * (n - 1) div 2").alias("pairs"))
    some = _soft_pair_counts(blocked.where(soft), settings)
    made = whole.unionByName(some).groupBy("block_key", "pass").agg(F.sum("pairs").alias("pairs_generated"))
    out = sizes.join(made, ["block_key", "pass"], "left").withColumn("pairs_generated", F.coalesce("pairs_generated", F.lit(0)))
    capped = F.when(F.col("strategy") == "soft_ban_sharded", F.greatest(F.lit(0), F.expr("count * (count - 1) div 2") - F.col("pairs_generated"))).otherwise(F.lit(0))
    return out.select(F.col("block_key").alias("token"), "count", "strategy", "pairs_generated", capped.cast("long").alias("pairs_capped"))


def top_blocks(stats: DataFrame, n: int = 10) -> DataFrame:
    return stats.orderBy(F.desc("count"), "token").limit(n)


def strategy_summary(stats: DataFrame) -> DataFrame:
    return stats.groupBy("strategy").agg(F.count("*").alias("blocks"), F.sum("count").alias("records"), F.sum("pairs_generated").alias("pairs"))


def size_distribution(stats: DataFrame, cap: int = 800) -> DataFrame:
    over = F.col("count") > cap
    return stats.agg(
        F.count("*").alias("blocks"), F.sum("count").alias("records"), F.max("count").alias("largest"), F.avg("count").alias("mean"),
        F.median("count").alias("median"), F.count_if(over).alias("over_cap"), F.coalesce(F.sum(F.when(over, F.col("count"))), F.lit(0)).alias("records_over_cap"),
    )


def explain_token(records: DataFrame, token: str, settings: Settings = DEFAULTS) -> DataFrame:
    """The shards of one block with their sizes."""
    own = blocks(records, settings).where(F.col("block_key") == token)
    return own.groupBy("block_key", "pass", "strategy", "shard").agg(F.count("*").alias("count"))


def brand_suggestions(stats: DataFrame, min_count: int = 10, min_rate: float = 0.6, sure_rate: int = 100, sure_count: int = 50) -> DataFrame:
    """Tokens frequent enough to allow-list, by confidence."""
    rate = F.least(F.lit(1.0), F.col("count") / sure_rate)
    confidence = 0.5 * F.least(F.lit(1.0), F.col("count") / sure_count) + 0.5 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), (rate - 0.5) / 0.5))
    return stats.select("token", "count", rate.alias("singleton_rate"), confidence.alias("confidence")).where((F.col("count") >= min_count) & (F.col("singleton_rate") >= min_rate)).orderBy(F.desc("confidence"), "token")


def allowlist_suggestions(stats: DataFrame, n: int = 20) -> DataFrame:
    """The n tokens of most count times one plus the singleton rate."""
    rate = F.least(F.lit(1.0), F.col("count") / 100)
    return stats.select("token", "count", (F.col("count") * (1 + rate)).alias("score")).orderBy(F.desc("score"), "token").limit(n)
