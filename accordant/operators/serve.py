"""Sorted, filtered pages of groups and of their records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant.config import DEFAULTS, Settings
from accordant.operators.disposition import blacklisted
from accordant.operators.filters import by_disposition, by_edge_strength
from accordant.operators.stats import group_stats

#: What a caller may sort by, as field and direction.
SORT_KEYS = {
    "Group Size (Desc)": ("group_size", "desc"), "Group Size (Asc)": ("group_size", "asc"),
    "Max Score (Desc)": ("max_score", "desc"), "Max Score (Asc)": ("max_score", "asc"),
    "Similarity Score (Desc)": ("max_score", "desc"), "Similarity Score (Asc)": ("max_score", "asc"),
    "Account Name (Asc)": ("primary_name", "asc"), "Account Name (Desc)": ("primary_name", "desc"),
}
DEFAULT_SORT = "Group Size (Desc)"
MAX_PAGE = 250


def order_by(key: str, available: list[str], context: str = "groups") -> list[Column]:
    """Columns to sort by, nulls last; an unknown key is the default, and a field that isn't there falls back to the tie-breaker."""
    name, direction = SORT_KEYS.get(key, SORT_KEYS[DEFAULT_SORT])
    if context == "details":
        name = "account_name" if name == "primary_name" else name
    tie = "account_name" if context == "details" else "group_id"
    if name not in available:
        return [F.col(tie).asc_nulls_last()]
    first = F.col(name).desc_nulls_last() if direction == "desc" else F.col(name).asc_nulls_last()
    return [first] if name == tie else [first, F.col(tie).asc_nulls_last()]


def page_of(rows: DataFrame, page: int, size: int) -> DataFrame:
    size = min(max(size, 1), MAX_PAGE)
    return rows.offset((max(page, 1) - 1) * size).limit(size)


def filtered_stats(stats: DataFrame, dispositions: list[str] | None = None, min_edge: float | None = None) -> DataFrame:
    return by_edge_strength(by_disposition(stats, dispositions), min_edge, "max_score")


def groups_page_from_stats(stats: DataFrame, sort: str = DEFAULT_SORT, page: int = 1, size: int = 50, dispositions: list[str] | None = None, min_edge: float | None = None) -> DataFrame:
    """Whole groups are filtered, by their largest score and their primary's disposition."""
    rows = filtered_stats(stats, dispositions, min_edge)
    return page_of(rows.orderBy(*order_by(sort, rows.columns), F.col("group_id").asc()), page, size)


def filtered_rows(rows: DataFrame, dispositions: list[str] | None = None, min_edge: float | None = None) -> DataFrame:
    return by_edge_strength(by_disposition(rows, dispositions), min_edge, "weakest_edge_to_primary")


def groups_page_from_rows(rows: DataFrame, sort: str = DEFAULT_SORT, page: int = 1, size: int = 50, dispositions: list[str] | None = None, min_edge: float | None = None) -> DataFrame:
    """Member rows are filtered first, so sizes and scores are those of the members left."""
    kept = filtered_rows(rows, dispositions, min_edge)
    names = kept.groupBy("group_id").agg(F.count("*").alias("group_size"), F.max(F.coalesce("weakest_edge_to_primary", F.lit(0.0))).alias("max_score"), F.coalesce(F.max(F.when(F.col("is_primary"), F.col("account_name"))), F.lit("")).alias("primary_name"))
    return page_of(names.orderBy(*order_by(sort, names.columns), F.col("group_id").asc()), page, size)


def count_groups(table: DataFrame, dispositions: list[str] | None = None, min_edge: float | None = None) -> DataFrame:
    """One row: groups that pass the filters, of a stats table or of member rows."""
    if "max_score" in table.columns:
        return filtered_stats(table, dispositions, min_edge).agg(F.count("*").alias("groups"))
    return filtered_rows(table, dispositions, min_edge).agg(F.count_distinct("group_id").alias("groups"))


DETAIL_COLUMNS = ["group_id", "account_id", "account_name", "suffix_class", "created_date", "disposition"]


def group_details(rows: DataFrame) -> DataFrame:
    """The columns that details show, as far as they exist."""
    return rows.select(*[c for c in DETAIL_COLUMNS if c in rows.columns])


def details_page(rows: DataFrame, group_id, sort: str = "Account Name (Asc)", page: int = 1, size: int = 50, dispositions: list[str] | None = None, min_edge: float | None = None) -> DataFrame:
    own = rows.where(F.col("group_id") == group_id)
    own = by_disposition(own, dispositions)
    if "weakest_edge_to_primary" in own.columns:
        own = by_edge_strength(own, min_edge, "weakest_edge_to_primary")
    ties = [F.col("account_id").asc()] if "account_id" in own.columns else []
    return page_of(own.orderBy(*order_by(sort, own.columns, "details"), *ties), page, size)


def badges(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """What a group's header shows: its suffix classes, primaries and blacklisted names."""
    hits = F.count_if(blacklisted(F.col("account_name"), settings)).alias("blacklist_hits")
    return rows.groupBy("group_id").agg(F.count_distinct("suffix_class").alias("suffixes"), F.count_if(F.col("is_primary")).alias("primaries"), hits, F.count("*").alias("group_size"))


def stats_of(rows: DataFrame) -> DataFrame:
    return group_stats(rows)
