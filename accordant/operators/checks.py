"""Parity, determinism and differences of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parity(a: DataFrame, b: DataFrame, key: str = "group_id", tolerance: float = 1e-9) -> DataFrame:
    """A row per compared column: rows that match, that differ, and keys that only one side has."""
    columns = [c for c in a.columns if c in b.columns and c != key]
    kinds = dict(a.dtypes)
    left = a.select(F.col(key).alias("_ka"), *[F.col(c).alias(f"_a_{c}") for c in columns])
    right = b.select(F.col(key).alias("_kb"), *[F.col(c).alias(f"_b_{c}") for c in columns])
    both = left.join(right, F.col("_ka") == F.col("_kb"), "full")

    def same(c):
        x, y = F.col(f"_a_{c}"), F.col(f"_b_{c}")
        if kinds[c] in ("double", "float", "int", "bigint", "smallint"):
            return x.eqNullSafe(y) | F.coalesce(F.abs(x - y) <= tolerance, F.lit(False))
        return x.eqNullSafe(y)

    here = F.col("_ka").isNotNull() & F.col("_kb").isNotNull()
    counts = [x for c in columns for x in (F.count_if(here & same(c)).alias(f"{c}_same"), F.count_if(here & ~same(c)).alias(f"{c}_differ"))]
    one = both.agg(F.count_if(F.col("_kb").isNull()).alias("only_a"), F.count_if(F.col("_ka").isNull()).alias("only_b"), *counts)
    listed = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}_same").alias("same"), F.col(f"{c}_differ").alias("differ")) for c in columns])
    return one.select("only_a", "only_b", F.explode(listed).alias("x")).select("x.column", "x.same", "x.differ", "only_a", "only_b")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks, with the side; repeated rows count."""
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))


def checksum(df: DataFrame) -> DataFrame:
    """One row: count and a sum of row hashes, the same in whatever order the rows come."""
    columns = sorted(df.columns)
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("checksum"))


def schema_families(df: DataFrame) -> dict[str, str]:
    """Column to text, number, flag, time or other."""
    def family(kind: str) -> str:
        if kind in ("string",):
            return "text"
        if kind in ("int", "bigint", "double", "float", "smallint") or kind.startswith("decimal"):
            return "number"
        return {"boolean": "flag"}.get(kind, "time" if kind.startswith(("timestamp", "date")) else "other")

    return {c: family(k) for c, k in df.dtypes}
