"""URL filters: host-suffix and path-prefix expressions against a rule table.

Every URL is expanded into the host suffixes and path prefixes that some rule could name. The
expressions are equi-joined with the rules on a short prefix of their SHA-256 digest, as URL
block lists are published; full digests then confirm, and the longest rule wins. DataFrame
operations only.

Defined results: a null URL or one without ``://`` has an empty host and path and gets the
default verdict; repeated rows are judged each on their own; of two equal rules the blocking one
holds; an empty rule table leaves every URL to the default; other columns of the input are not
looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

#: Rules up to this number are broadcast; a larger table is shuffled on the digest prefix.
BROADCAST_RULES = 100_000


def split_url(url):
    """(host, path) columns of a URL column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + F.lit(1), F.length(rest)), "^[^?#]*", 0)
    return ascii_lower(raw), path


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow", prefix_hex: int = 8) -> DataFrame:
    """One row per row of `pages`: key, host, path, rule, verdict.

    `rules` has columns host, path, verdict (allow or block). A rule fits its host and all its
    subdomains where the URL's path starts with the rule's path.
    """
    table = (
        rules.select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
        .where("r_host is not null and r_path is not null and r_verdict is not null")
        .select("*", F.size(F.split("r_host", r"\.", -1)).alias("labels"), F.length("r_path").alias("path_length"), F.sha2(F.concat_ws("\n", "r_host", "r_path"), 256).alias("r_digest"))
    )
    # The shapes a rule can have bound the expansion of a URL, however long its host or path is.
    shape = table.agg(F.count("*").alias("n"), F.sort_array(F.collect_set("labels")).alias("labels"), F.sort_array(F.collect_set("path_length")).alias("lengths")).first()

    host, path = split_url(F.col("u"))
    urls = pages.select(F.col(f"`{key}`").alias("k"), F.col(f"`{url}`").alias("u")).select("k", host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row"))
    parts = F.split("host", r"\.", -1)
    suffixes = F.filter(F.array(*[F.when(F.size(parts) >= n, F.array_join(F.slice(parts, -n, n), ".")) for n in shape["labels"]]).cast("array<string>"), lambda x: x.isNotNull())
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in shape["lengths"]]).cast("array<string>"), lambda x: x.isNotNull())
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.sha2(F.concat_ws("\n", s, p), 256))))
    expanded = urls.select("row", "k", "host", "path", F.explode_outer(expressions).alias("digest")).withColumn("short", F.substring("digest", 1, prefix_hex))

    short_rules = table.withColumn("short", F.substring("r_digest", 1, prefix_hex))
    if shape["n"] <= BROADCAST_RULES:
        short_rules = F.broadcast(short_rules)
    joined = expanded.join(short_rules, "short", "left")
    hit = F.when(
        F.col("digest") == F.col("r_digest"),
        F.struct((F.length("r_host") + F.col("path_length")).alias("length"), (F.col("r_verdict") == "block").cast("int").alias("blocks"), F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")),
    )
    best = joined.groupBy("row").agg(F.first("k").alias("k"), F.first("host").alias("host"), F.first("path").alias("path"), F.max(hit).alias("best"))
    return best.select(F.col("k").alias(key), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
