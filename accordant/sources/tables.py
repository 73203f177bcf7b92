"""Reading: CSV with stable types, Parquet with projection, lookups, JSON and YAML settings, files."""

from __future__ import annotations

import json
import re
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accordant.config import DEFAULTS, Settings

#: Texts that mean null in a CSV cell.
NULLS = ["", "NA", "NaN", "null", "None"]


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, null tokens as null: ids keep their leading zeros."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=False, escape='"', mode="PERMISSIVE")
    return df.select(*[F.when(F.col(f"`{c}`").isin(NULLS), None).otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])


def likely_id(name: str, texts: list[str]) -> bool:
    if re.search(r"(^|[\s_])id($|[\s_])", name.lower()):
        return True
    return bool(texts) and (any(re.match(r"0\d", t) for t in texts) or sum(len(t) in (15, 18) and t.isalnum() for t in texts) > 0.8 * len(texts))


def infer_csv_types(df: DataFrame, force_string: tuple = ("account_id", "parent_account_id")) -> dict[str, str]:
    """Types of an all-text frame: text, bigint or double. Every cell is looked at, so none breaks its column's type."""
    whole, real = r"^[+-]?\d+$", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
    tests = []
    for n, c in enumerate(df.columns):
        v = F.col(f"`{c}`")
        tests += [F.count(v).alias(f"n{n}"), F.count_if(v.rlike(whole)).alias(f"w{n}"), F.count_if(v.rlike(real)).alias(f"r{n}"), F.count_if(v.contains(".")).alias(f"d{n}"), F.count_if(v.rlike(r"^0\d")).alias(f"z{n}"), F.count_if(v.rlike("^(?:[A-Za-z0-9]{15}|[A-Za-z0-9]{18})$")).alias(f"i{n}")]
    row = df.agg(*tests).first()  # one row comes back
    out = {}
    for n, c in enumerate(df.columns):
        total = row[f"n{n}"]
        is_id = c in force_string or likely_id(c, []) or row[f"z{n}"] > 0 or (total and row[f"i{n}"] > 0.8 * total)
        if not total or is_id or row[f"r{n}"] < total:
            out[c] = "string"
        else:
            out[c] = "double" if row[f"d{n}"] or row[f"w{n}"] < total else "bigint"
    return typed_as_they_fit(df, out)


def typed_as_they_fit(df: DataFrame, types: dict[str, str]) -> dict[str, str]:
    """`types`, with text for every column that holds a cell they can't take (a number too large, say)."""
    cast = {c: t for c, t in types.items() if t != "string" and c in df.columns}
    if not cast:
        return types
    broken = df.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(t).isNull()).alias(f"b{n}") for n, (c, t) in enumerate(cast.items())]).first()
    return types | {c: "string" for n, c in enumerate(cast) if broken[n]}


def read_csv_stable(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """Text, then casts; a column that holds a cell which its type can't take stays text, so no cell is lost."""
    df = read_csv_text(spark, path)
    kinds = infer_csv_types(df) if types is None else typed_as_they_fit(df, types)
    return df.select(*[F.col(f"`{c}`").cast(kinds.get(c, "string")).alias(c) for c in df.columns])


def valid_csv(spark: SparkSession, path: str) -> bool:
    """Whether a header can be read."""
    try:
        return bool(spark.read.csv(path, header=True).limit(0).columns)
    except Exception:  # noqa: BLE001  any failure of the reader is the answer
        return False


def read_columns(spark: SparkSession, path: str, wanted: list[str] | None = None) -> DataFrame:
    """Of a Parquet table the wanted columns that exist, in the wanted order."""
    df = spark.read.parquet(path)
    return df if wanted is None else df.select(*[c for c in wanted if c in df.columns])


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True).select(F.col("Relationship").alias("relationship"), F.col("Rank").cast("int").alias("rank"))


def read_blacklist(spark: SparkSession, path: str) -> list[str]:
    """Manual terms, a list kept by hand."""
    rows = spark.read.json(path, multiLine=True, schema="terms array<string>").collect()
    return sorted({t.strip() for r in rows for t in (r["terms"] or []) if t and t.strip()})


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """account_id, override from a JSON list, or an object keyed by record id."""
    text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())  # a file kept by hand
    data = json.loads(text) if text.strip() else []
    rows = [v | {"record_id": k} for k, v in data.items()] if isinstance(data, dict) else data
    return spark.createDataFrame([(str(r.get("account_id") or r.get("record_id")), r["override"]) for r in rows if r.get("override")], "account_id string, override string")


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """path, length, modified of matching files, without their content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length", F.col("modificationTime").alias("modified"))


def merge(base: dict, own: dict) -> dict:
    return base | {k: merge(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in own.items()}


def load_settings(text: str, base: Settings = DEFAULTS) -> Settings:
    """Settings with the values of a YAML text merged over them, mappings key by key; unknown keys raise."""
    import yaml

    merged = merge(base.__dict__, yaml.safe_load(text) or {})
    return replace(base, **{k: tuple(v) if isinstance(v, list) else v for k, v in merged.items()})


def synthetic_names(spark: SparkSession) -> DataFrame:
    """Clusters of names by intent: alike, reordered, alike but for a suffix or a number, alike but for one word, unlike."""
    names = []
    for stem, trade in (("Juniper Quay", "Ferry"), ("Marrow Lane", "Bakers"), ("Tallow Bridge", "Glass"), ("Oxbow", "Instrument")):
        names += [f"{stem} {trade} Inc", f"{stem} {trade}, Inc.", f"{stem} {trade}s Inc", f"{trade} {stem} Inc", f"{stem} {trade} GmbH", f"{stem} {trade} 7 Inc", f"{stem} Holdings Inc"]
    names += ["Violet Harbour Hotel", "Violet Harbour Hotel & Spa", "Violet Harbour Hotel and Spa", "Cobalt Kiln"]
    return spark.createDataFrame([(f"001{i:012d}", n, "2024-01-01") for i, n in enumerate(names)], "account_id string, account_name string, created_date string")
