"""The whole resolution: ingest to review table, each stage a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.config import DEFAULTS, Settings
from accordant.functions.text import id_15_to_18, normalise, parse_date
from accordant.operators import alias, blocking, disposition, exact, filters, grouping, scoring, stats, survivorship
from accordant.plans.materialise import materialise
from accordant.sources.schema import enforce_types, explain_defaults, require_columns

FIELDS = ["account_name", "relationship", "created_date"]


@dataclass
class Stages:
    """What each stage leaves; lazy but for the tables that several stages read."""

    normalised: DataFrame
    filtered_out: DataFrame
    exact_map: DataFrame
    unique: DataFrame
    block_stats: DataFrame
    candidates: DataFrame
    groups: DataFrame
    survivors: DataFrame
    previews: DataFrame
    dispositions: DataFrame
    group_stats: DataFrame
    alias_matches: DataFrame
    review: DataFrame


def ingest(raw: DataFrame, order: str = "row_seq") -> DataFrame:
    """Required columns, an audit copy of the id, its 18-character form, first row of each id, dates parsed."""
    rows = require_columns(raw).withColumn("account_id_src", F.trim(F.coalesce(F.col("account_id").cast("string"), F.lit(""))))
    rows = rows.withColumn("account_id", id_15_to_18("account_id_src")).withColumn("created_date", parse_date("created_date"))
    return stats.keep_first(rows, "account_id", order)


def resolve(accounts: DataFrame, settings: Settings = DEFAULTS, reps_only: bool = False, mode: str | None = None, overrides: DataFrame | None = None) -> Stages:
    """All stages of `accounts` (account_id, account_name, created_date, row_seq, relationship).

    Exact duplicates join their representative's group by edges of score 100; with `reps_only` they leave
    the tables after the exact pass instead.
    """
    s = settings
    normalised = normalise(accounts)
    kept, filtered_out = filters.split_noise(normalised)
    kept = materialise(kept)
    mapped = exact.exact_map(kept)
    unique = materialise(exact.unique_records(kept, mapped))
    pairs = blocking.candidate_pairs(unique, s, only=scoring.within_reach(s))
    candidates = materialise(scoring.scored_candidates(pairs, s))
    star = None if reps_only else exact.exact_star(mapped)
    groups = grouping.create_groups(unique if reps_only else kept, candidates, s, mode, star)
    ranked = survivorship.with_ranks(groups, survivorship.rank_table(accounts.sparkSession, s))
    survivors = materialise(survivorship.elect_primary(ranked, s))
    placed = disposition.classify(survivors, s, overrides)
    matches = alias.alias_matches(kept, groups, s)
    review = explain_defaults(enforce_types(alias.with_cross_references(placed, alias.alias_match_counts(kept, groups, s))))
    return Stages(normalised, filtered_out, mapped, unique, blocking.block_stats(unique, s), candidates, groups, survivors, survivorship.merge_preview(survivors, FIELDS), placed, stats.group_stats(placed), matches, review)
