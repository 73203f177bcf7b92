"""Headers to canonical columns, and the stage tables' types."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.config import SYNONYMS
from accordant.functions.fuzzy import ratio, token_set_ratio, token_sort_ratio

CANONICAL = ["account_name", "account_id", "parent_account_id", "created_date", "suffix_class"]
REQUIRED = ["account_id", "account_name", "created_date"]
#: Stage types.
STAGE_TYPES = {
    "account_id": "string", "account_name": "string", "name_raw": "string", "name_base": "string", "name_core": "string", "suffix_class": "string",
    "has_parentheses": "boolean", "has_semicolon": "boolean", "has_multiple_names": "boolean", "group_id": "string", "group_size": "int", "group_rank": "int",
    "is_primary": "boolean", "group_join_reason": "string", "weakest_edge_to_primary": "double", "shared_tokens_count": "int", "disposition": "string",
    "relationship_rank": "int", "score": "double", "id_a": "string", "id_b": "string",
}
INTERMEDIATE = ["row_seq", "name_base_tokens", "block_key", "bigram_key", "shard"]


def title(column: str) -> str:
    return " ".join("ID" if w == "id" else w.capitalize() for w in column.split("_"))


def resolve_schema(df: DataFrame, overrides: dict[str, str] | None = None, filename: str | None = None, synonyms: dict = SYNONYMS, templates=()) -> dict[str, str]:
    """Canonical name to header: overrides, else a file template, else synonyms, else heuristics on names and 100 values.

    Runs on the driver over the headers; values are sampled only for columns that names leave open.
    """
    headers, found = df.columns, {}
    for name, header in (overrides or {}).items():
        if header not in headers:
            raise ValueError(f"no column {header!r}")
        found[name] = header
    if filename:
        for pattern, names in templates:
            if re.match(pattern, filename):
                for name, wanted in names.items():
                    if name not in found and (hit := next((w for w in wanted if w in headers), None)):
                        found[name] = hit
                if "account_name" in found:
                    return found
    low = {}
    for h in headers:
        low.setdefault(h.lower(), h)
    for name, wanted in synonyms.items():
        if name not in found:
            hit = next((w for w in wanted if w in headers), None) or next((low[w.lower()] for w in wanted if w.lower() in low), None)
            if hit:
                found[name] = hit
    if "account_name" not in found:
        best, top = None, 80.0
        for h in headers:
            score = max(f(h.lower(), w) for w in ("name", "company", "customer") for f in (ratio, token_sort_ratio, token_set_ratio))
            if score > top or (best is None and score >= top):
                best, top = h, score
        if best:
            found["account_name"] = best
    shares: dict[str, tuple[float, float]] = {}
    if "account_id" not in found or "created_date" not in found:  # one row over the whole table
        values = [F.col(f"`{h}`").cast("string") for h in headers]
        each = [F.struct(*[F.avg(v.rlike(p).cast("int")) for p in (r"^[A-Za-z0-9]{10,}$", r"\d{1,4}[-/]\d{1,2}[-/]\d{1,4}")]) for v in values]
        row = df.agg(*[x.alias(f"h{n}") for n, x in enumerate(each)]).first()
        shares = {h: (row[n][0] or 0.0, row[n][1] or 0.0) for n, h in enumerate(headers)}
    if "account_id" not in found:
        hits = sorted(h for h in headers if h.lower() in ("id", "id_", "_id") or shares[h][0] > 0.8)
        if hits:
            found["account_id"] = hits[0]
    if "created_date" not in found:
        hits = sorted(h for h in headers if re.search("date|created|modified|updated", h.lower()) or shares[h][1] > 0.3)
        if hits:
            found["created_date"] = hits[0]
    if "account_name" not in found:
        raise ValueError(f"no column can be the account name: {headers}")
    return found


def apply_mapping(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Headers become canonical names."""
    if "account_name" not in mapping:
        raise ValueError("account_name isn't mapped")
    return df.withColumnsRenamed({header: name for name, header in mapping.items()})


def require_columns(df: DataFrame) -> DataFrame:
    if missing := [c for c in REQUIRED if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df


def to_display(df: DataFrame) -> DataFrame:
    """Title-case labels, for people."""
    return df.withColumnsRenamed({c: title(c) for c in df.columns})


def from_display(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: re.sub(r"\W+", "_", c.strip().lower()) for c in df.columns})


def enforce_types(df: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Known columns cast to their stage's types; helper columns dropped; others as they are."""
    wanted = STAGE_TYPES | (extra or {})
    return df.select(*[F.col(f"`{c}`").cast(wanted[c]).alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns if c not in INTERMEDIATE])


def explain_defaults(df: DataFrame) -> DataFrame:
    """Explain fields that are missing, as empty text or zero."""
    texts, zeros = ["applied_penalties", "survivorship_reason"], ["ratio_name", "ratio_set", "jaccard"]
    return df.withColumns({c: F.lit("") for c in texts if c not in df.columns} | {c: F.lit(0.0) for c in zeros if c not in df.columns})
