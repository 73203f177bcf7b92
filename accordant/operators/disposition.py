"""Dispositions: whether a record is kept, updated, deleted or looked at, and why."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accordant.config import DEFAULTS, NAME_STOPWORDS, Settings


def _any_of(parts) -> str:
    return "|".join(re.escape(p).replace("/", "/") for p in parts)


def blacklisted(name: Column, settings: Settings = DEFAULTS) -> Column:
    """Terms without a blank match as whole words, those with one anywhere; case doesn't count."""
    terms = [*settings.blacklist_tokens, *settings.blacklist_phrases]
    words, phrases = [t for t in terms if " " not in t], [t for t in terms if " " in t]
    c = F.coalesce(name, F.lit(""))
    return c.rlike(rf"(?iU)\b(?:{_any_of(words)})\b") | F.lower(c).rlike(_any_of(phrases) if phrases else "(?!)")


def mostly_empty_words(name: Column) -> Column:
    """Hardly any letters or digits, or hardly anything but stop words."""
    c = F.coalesce(name, F.lit(""))
    total, alnum = F.length(F.trim(c)), F.length(F.regexp_replace(c, "[^a-zA-Z0-9]", ""))
    words = F.regexp_extract_all(F.lower(c), F.lit(r"(?U)\b[a-zA-Z]+\b"), F.lit(0))
    stops = F.size(F.filter(words, lambda w: w.isin(NAME_STOPWORDS)))
    return (total == 0) | (alnum / F.greatest(total, F.lit(1)) < 0.3) | ((F.size(words) > 0) & (stops / F.greatest(F.size(words), F.lit(1)) > 0.8))


def blacklisted_strictly(name: Column, manual_terms: list[str] = (), settings: Settings = DEFAULTS) -> Column:
    """The row-wise rule set: the lists, manual terms anywhere, and names too short, too long or without content."""
    c = F.coalesce(name, F.lit(""))
    out = blacklisted(c, settings) | (F.length(F.trim(c)) < 3) | (F.length(F.trim(c)) > 100) | mostly_empty_words(c)
    for term in manual_terms:
        out = out | F.contains(F.lower(c), F.lit(term.lower()))
    return (c != "") & out


def group_metadata(groups: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return groups.groupBy("group_id").agg(
        F.count("*").alias("group_size"), F.sort_array(F.collect_set("suffix_class")).alias("suffix_classes"), (F.count_distinct("suffix_class") > 1).alias("has_suffix_mismatch"),
        F.count_if(blacklisted(F.col("account_name"), settings)).alias("blacklist_hits"), F.bool_or("is_primary").alias("has_primary"),
    )


def classify(groups: DataFrame, settings: Settings = DEFAULTS, overrides: DataFrame | None = None, strict: bool = False, manual_terms: list[str] = (), last_reason_wins: bool = False, alias_details: bool = False) -> DataFrame:
    """`groups` with disposition and disposition_reason.

    Needs account_id, account_name, group_id, suffix_class, is_primary and has_multiple_names;
    alias_cross_refs where it exists. `overrides` (account_id, override) comes before every rule. The reason is the
    first rule's that holds; `last_reason_wins` gives the compatible order in which later rules overwrite, and
    `alias_details` a reason that counts the aliases' groups and lists their sources.
    """
    name = F.col("account_name")
    whole = Window.partitionBy("group_id")
    low, high = F.min("suffix_class").over(whole), F.max("suffix_class").over(whole)
    black = blacklisted_strictly(name, manual_terms, settings) if strict else blacklisted(name, settings)
    aliased = F.coalesce(F.size("alias_cross_refs") > 0, F.lit(False)) if "alias_cross_refs" in groups.columns else F.lit(False)
    rows = groups
    if alias_details and "alias_cross_refs" in groups.columns:  # told before the rows move, so that the arrays need not
        sources = F.sort_array(F.array_distinct(F.transform("alias_cross_refs", lambda x: F.concat(F.lit("'"), F.coalesce(x["source"], F.lit("")), F.lit("'")))))
        told = F.concat(F.lit("alias_matches_"), F.size("alias_cross_refs").cast("string"), F.lit("_groups_via_["), F.array_join(sources, ", "), F.lit("]"))
        rows = rows.withColumn("_told", told)
    rows = rows.withColumn("_aliased", aliased).withColumns({
        "_size": F.when(F.col("group_id").isNull(), F.lit(1)).otherwise(F.count("*").over(whole)), "_mismatch": F.coalesce(F.col("group_id").isNotNull() & (low != high), F.lit(False)),
        "_black": black, "_many": F.coalesce("has_multiple_names", F.lit(False)), "_first": F.coalesce("is_primary", F.lit(False)), "_odd": F.coalesce(F.lower(name), F.lit("")).rlike(settings.suspicious),
    })
    single = F.col("_size") == 1
    rules = [
        (F.col("_black"), "Delete", "blacklisted_name"),
        (F.col("_many"), "Verify", "multi_name_string_requires_split"),
        (F.col("_aliased"), "Verify", "alias_matches_detected"),
        (F.col("_mismatch"), "Verify", "suffix_mismatch"),
        (single & ~F.col("_black") & F.col("_odd"), "Verify", "suspicious_singleton"),
        (single & ~F.col("_black") & ~F.col("_odd"), "Keep", "clean_singleton"),
        (~single & F.col("_first"), "Keep", "primary_record"),
        (~single & ~F.col("_first"), "Update", "duplicate_record"),
    ]
    disposition = _chain([(c, F.lit(d)) for c, d, _ in rules], "Keep")
    reason = _chain([(c, F.lit(r)) for c, _, r in (reversed(rules) if last_reason_wins else rules)], "unknown")
    if alias_details and "alias_cross_refs" in groups.columns:
        reason = F.when(reason == "alias_matches_detected", F.col("_told")).otherwise(reason)
    if overrides is not None:
        rows = rows.join(overrides.select("account_id", F.col("override").alias("_override")), "account_id", "left")
        forced = F.col("_override").isNotNull()
        disposition = F.coalesce("_override", disposition)
        if not last_reason_wins:
            reason = F.when(forced, F.concat(F.lit("manual_override:"), F.col("_override"))).otherwise(reason)
    out = rows.withColumns({"disposition": disposition, "disposition_reason": reason})
    return out.drop("_size", "_mismatch", "_black", "_aliased", "_many", "_first", "_odd", "_override", "_told")


def _chain(rules, default: str) -> Column:
    out = None
    for condition, value in rules:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(F.lit(default))


def disposition_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("disposition").agg(F.count("*").alias("records"))
