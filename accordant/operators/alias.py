"""Alias matches: aliases of one record that name another.

Names are matched as distinct strings, and records meet only where their names did. Most records of a
large table repeat others' names, so what grows with the square of a name's records is the result alone;
`alias_match_counts` holds that, too, as a count for each group that an alias names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.config import DEFAULTS, Settings
from accordant.functions.fuzzy import token_ratios
from accordant.functions.text import name_base, tokens


def _sides(records: DataFrame, groups: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Each record's aliases with the cores that they match and the score; and the records of each core with their groups."""
    s = settings
    told = records.select(F.col("account_id").alias("record_id"), "suffix_class", F.explode("aliases").alias("x"))
    told = told.select("record_id", "suffix_class", F.col("x.alias").alias("alias_text"), F.col("x.source").alias("alias_source"), name_base("x.alias").alias("alias_base"))
    told = told.withColumn("first_token", F.get(tokens("alias_base"), F.lit(0))).where("first_token is not null")
    others = records.select(F.col("account_id").alias("match_record_id"), "suffix_class", "name_core", F.get(tokens("name_core"), F.lit(0)).alias("first_token")).where("first_token is not null")
    # Each distinct pair of strings is scored once, where their lengths alone don't rule the threshold out.
    names = told.select("first_token", "suffix_class", "alias_base").distinct().join(others.select("first_token", "suffix_class", "name_core").distinct(), ["first_token", "suffix_class"])
    x, y = (F.length(F.array_join(tokens(c), " ")) for c in ("alias_base", "name_core"))
    near = names.where(200 * F.least(x, y) >= (s.high - 1e-6) * (x + y))
    rated = near.withColumn("score", token_ratios("alias_base", "name_core")["ratio_name"]).where(F.col("score") >= s.high)
    told = told.join(rated.select("alias_base", "suffix_class", "name_core", "score"), ["alias_base", "suffix_class"])
    ids = groups.select(F.col("account_id").alias("match_record_id"), "group_id")
    others = others.join(rated.select("suffix_class", "name_core").distinct(), ["suffix_class", "name_core"], "left_semi")
    others = others.join(ids, "match_record_id", "left").select("match_record_id", "suffix_class", "name_core", F.coalesce("group_id", F.lit("")).alias("match_group_id"))
    return told.select("record_id", "suffix_class", "alias_text", "alias_source", "name_core", "score"), others


def alias_matches(records: DataFrame, groups: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """record_id, alias_text, alias_source, match_record_id, match_group_id, score, suffix_match.

    Candidates share the alias's first token and the record's suffix class; the score is the token sort
    ratio of the normalised alias and the other's core, kept from the high threshold on; where the
    settings say how many, the best of all.
    """
    s = settings
    told, others = _sides(records, groups, s)
    found = told.join(others, ["suffix_class", "name_core"]).where("record_id <> match_record_id")
    out = found.select("record_id", "alias_text", "alias_source", "match_record_id", "match_group_id", "score", F.lit(True).alias("suffix_match"))
    if s.max_alias_pairs is not None:
        out = out.orderBy(F.desc("score"), "record_id", "match_record_id", "alias_text", "match_group_id").limit(s.max_alias_pairs)
    return out.orderBy("record_id", "match_record_id", "alias_text", "match_group_id")


def alias_match_counts(records: DataFrame, groups: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """record_id, alias_text, alias_source, match_group_id, score and n, the number of rows that `alias_matches` has with these values: all of them, none expanded."""
    keys = ["record_id", "alias_text", "alias_source", "match_group_id", "score"]
    if settings.max_alias_pairs is not None:
        return alias_matches(records, groups, settings).groupBy(*keys).agg(F.count("*").alias("n"))
    told, others = _sides(records, groups, settings)
    of_name = ["suffix_class", "name_core", "match_group_id"]
    found = told.join(others.groupBy(of_name).agg(F.count("*").alias("rows")), ["suffix_class", "name_core"])
    # A record doesn't match itself.
    own = others.groupBy(F.col("match_record_id").alias("record_id"), *of_name).agg(F.count("*").alias("own"))
    found = found.join(own, ["record_id", *of_name], "left").withColumn("n", F.col("rows") - F.coalesce("own", F.lit(0)))
    return found.where("n > 0").groupBy(*keys).agg(F.sum("n").alias("n"))


def _counted(matches: DataFrame) -> DataFrame:
    """account_id and `refs`: each different cross reference of a record and how often it has it."""
    n = F.col("n") if "n" in matches.columns else F.lit(1)
    ref = F.struct(F.col("alias_text").alias("alias"), F.col("match_group_id").alias("group_id"), "score", F.col("alias_source").alias("source"), n.cast("int").alias("n"))
    return matches.groupBy(F.col("record_id").alias("account_id")).agg(F.array_sort(F.collect_list(ref)).alias("refs"))


def _expanded(refs):
    return F.flatten(F.transform(refs, lambda x: F.array_repeat(F.struct(x["alias"].alias("alias"), x["group_id"].alias("group_id"), x["score"].alias("score"), x["source"].alias("source")), x["n"])))


def cross_references(matches: DataFrame) -> DataFrame:
    """account_id, alias_cross_refs: sorted array of alias, group_id, score, source. `matches`: of `alias_matches`, or the same counted."""
    return _counted(matches).select("account_id", _expanded(F.col("refs")).alias("alias_cross_refs"))


def with_cross_references(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """`rows` with alias_cross_refs; arrays are written out behind the join, which moves counts."""
    none = F.array().cast("array<struct<alias:string,group_id:string,score:double,source:string>>")
    out = rows.drop("alias_cross_refs").join(_counted(matches), "account_id", "left")
    return out.withColumn("alias_cross_refs", F.coalesce(_expanded(F.col("refs")), none)).drop("refs")
