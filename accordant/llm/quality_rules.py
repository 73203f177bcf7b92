"""Quality rules: document statistics and a hashed n-gram log-likelihood ratio.

Base rules count words, symbols, repeated lines and repeated 3-word windows. The method scores
each document by how much likelier its hashed word n-grams are under the multinomial of a trusted
target than under that of the raw corpus, divided by their number, and keeps the documents above a
fixed threshold. A bucket's ratio is shrunk towards 1, the more so the fewer n-grams the target is
expected to hold there. Counts cover every document; the two multinomials live in a table of fixed
size. DataFrame operations only: no Python on the executors.

Defined results: a null or empty text has no words, so it fails the base rules and scores 0; a
text of one word has one n-gram; repeated rows are scored each; an empty table gives no rows; without any
trusted row every document scores 0 and only the base rules decide. Other columns pass through
kept_documents untouched, whatever their names, and are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
#: Hash buckets of the n-gram multinomials: the bound of all that is sent to executors.
BUCKETS = 1 << 16
#: Trusted rows that fit the target multinomial, at most: the documented sample bound.
TRUSTED_ROWS = 20_000
#: A document is dropped below this mean log-likelihood ratio (nats an n-gram).
THRESHOLD = -0.2
#: n-grams added to what a bucket of the target holds and to what the raw corpus lets expect there. A bucket
#: where fewer are expected says little, so unlabelled documents don't lose by a small target's gaps.
SHRINKAGE = 5.0


def words_of(text):
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def grams_of(words: str, buckets: int = BUCKETS) -> str:
    """SQL for the buckets of a document's words and word pairs."""
    one = f"transform({words}, w -> cast(pmod(xxhash64(w), {buckets}) as int))"
    two = f"transform(sequence(0, size({words}) - 2), i -> cast(pmod(xxhash64({words}[i], {words}[i + 1]), {buckets}) as int))"
    return f"case when size({words}) < 2 then {one} else concat({one}, {two}) end"


def base_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumn("words", words_of(F.col(text))).withColumn("lines", lines)
    out = out.withColumn("windows", F.expr("case when size(words) < 3 then cast(array() as array<bigint>) else transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])) end"))
    # Most texts repeat no window, which a hash set tells; only the others are sorted.
    out = out.withColumn("ordered", F.expr("case when size(array_distinct(windows)) = size(windows) then null else sort_array(transform(windows, (h, i) -> struct(h, i))) end"))
    covered = """case when ordered is null then 0 else size(array_distinct(flatten(transform(
        filter(ordered, (x, k) -> (k > 0 and ordered[greatest(k - 1, 0)].h = x.h) or (k < size(ordered) - 1 and ordered[least(k + 1, size(ordered) - 1)].h = x.h)),
        x -> array(x.i, x.i + 1, x.i + 2))))) end"""
    out = out.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(covered).cast("long").alias("n_repeat_words"),
    )
    return out.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")).drop("lines", "windows", "ordered")


def bucket_weights(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, trusted_rows: int = TRUSTED_ROWS) -> DataFrame:
    """One row: `weights`, the log-likelihood ratio of each bucket in order.

    Raw counts cover all of `docs`; the target's are those of at most `trusted_rows` documents
    named by the key column of `trusted`, the least by hash. The rows that leave the map side are
    buckets, not n-grams.
    """
    named = trusted.select(F.col(key).alias("trusted_key")).where("trusted_key is not null").distinct().orderBy(F.xxhash64("trusted_key"), "trusted_key").limit(trusted_rows)
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    rows = rows.join(F.broadcast(named), F.col("k") == F.col("trusted_key"), "left").select(F.col("trusted_key").isNotNull().cast("long").alias("target"), words_of(F.col("t")).alias("words"))
    counted = rows.select("target", F.explode(F.expr(grams_of("words", buckets))).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("target").alias("target"))
    frame = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    whole = frame.join(counted, "bucket", "left").na.fill(0, ["raw", "target"])
    whole = whole.groupBy(F.lit(1).alias("one")).agg(F.sum("raw").alias("raw_all"), F.sum("target").alias("target_all"), F.collect_list(F.struct("bucket", "raw", "target")).alias("each"))
    whole = whole.select("raw_all", "target_all", F.sort_array("each").alias("each"))
    weight = f"case when target_all = 0 or raw_all = 0 then 0D else ln((x.target + {SHRINKAGE}D) / (x.raw / raw_all * target_all + {SHRINKAGE}D)) end"
    return whole.select(F.expr(f"transform(each, x -> cast({weight} as double))").alias("weights"))


STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _scored(docs: DataFrame, trusted: DataFrame, key: str, text: str, own: list[str], threshold: float, buckets: int, trusted_rows: int) -> DataFrame:
    """`own` columns as one struct, the statistics, score and kept."""
    weights = bucket_weights(docs, trusted, key, text, buckets, trusted_rows)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("own"), F.col(f"`{text}`").alias("t"))
    rows = base_statistics(rows, "t").withColumn("grams", F.expr(grams_of("words", buckets))).withColumn("weights", weights.scalar())
    rows = rows.withColumn("score", F.expr("case when size(grams) = 0 then 0D else aggregate(grams, 0D, (a, b) -> a + weights[b]) / size(grams) end"))
    kept = ~F.col("base_failed") & (F.col("score") >= threshold)
    # A generator of one row: the optimizer keeps a caller's filter on these columns above it. Below, the filter would
    # repeat the projections' arrays once for every reference.
    judged = F.struct(*STATISTICS, F.round("score", 6).alias("score"), kept.alias("kept"))
    return rows.select("own", F.inline(F.array(judged)))


def score_documents(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, buckets: int = BUCKETS, trusted_rows: int = TRUSTED_ROWS) -> DataFrame:
    """The key, the base statistics, base_failed, score and kept of every row."""
    rows = _scored(docs, trusted, key, text, [key], threshold, buckets, trusted_rows)
    return rows.select(F.col(f"own.`{key}`").alias(key), *STATISTICS, "score", "kept")


def kept_documents(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, buckets: int = BUCKETS, trusted_rows: int = TRUSTED_ROWS) -> DataFrame:
    """The rows of `docs` that score_documents keeps, as they are."""
    return _scored(docs, trusted, key, text, docs.columns, threshold, buckets, trusted_rows).where("kept").select("own.*")
