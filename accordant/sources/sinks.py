"""Writing: stage tables, tuned Parquet, review and audit files."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accordant.config import Settings
from accordant.sources.schema import to_display


def write_stage(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_tuned(df: DataFrame, path: str, max_records: int = 2_000_000, group_bytes: int = 128 << 20) -> None:
    """zstd, files of bounded rows, row groups of bounded bytes."""
    df.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", group_bytes).option("maxRecordsPerFile", max_records).parquet(path)


def flat(df: DataFrame) -> DataFrame:
    """Arrays, structs and maps as JSON, so that a text format can hold them."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema.fields])


def write_review(df: DataFrame, path: str) -> None:
    """CSV with a header. As many files as partitions: one file is the caller's coalesce."""
    flat(df).write.mode("overwrite").csv(path, header=True)


def write_export(df: DataFrame, path: str) -> None:
    """CSV with display labels."""
    write_review(to_display(flat(df)), path)


def write_audit(df: DataFrame, path: str, stamp: str | None = None) -> str:
    """Never overwrites: an existing folder gives one with a time suffix. Returns where it wrote."""
    try:
        df.write.mode("errorifexists").parquet(path)
        return path
    except Exception as error:  # noqa: BLE001
        if "ALREADY_EXISTS" not in str(error).upper():
            raise
        other = f"{path}-{stamp or time.strftime('%Y%m%d%H%M%S')}"
        df.write.mode("errorifexists").parquet(other)
        return other


def write_document(spark, document: dict, path: str) -> None:
    """A small JSON document, such as a run's audit snapshot, through Spark's own file systems."""
    spark.createDataFrame([(json.dumps(document, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_alias_matches(matches: DataFrame, path: str) -> None:
    matches.select("record_id", "alias_text", "alias_source", "match_record_id", "match_group_id", F.col("score").cast("double").alias("score")).write.mode("overwrite").parquet(path)


def write_suggestions(suggestions: DataFrame, path: str, least: float = 0.7) -> None:
    suggestions.where(F.col("confidence") >= least).write.mode("overwrite").csv(path, header=True)


def table_sizes(spark, path: str) -> DataFrame:
    """One row: files and bytes of a written table."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


FOOTER = "path string, bytes long, rows long, row_groups long, compressed long, uncompressed long, codecs string"


def parquet_report(spark, path: str) -> DataFrame:
    """A row per file of a written table: rows, row groups, column bytes before and after compression, codecs. Executors read footers, of a file at a time."""

    def run(batches):
        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            out = []
            for name, length, content in zip(batch["path"], batch["length"], batch["content"]):
                meta = pq.ParquetFile(pa.BufferReader(content)).metadata
                chunks = [meta.row_group(g).column(c) for g in range(meta.num_row_groups) for c in range(meta.num_columns)]
                out.append((name, length, meta.num_rows, meta.num_row_groups, sum(c.total_compressed_size for c in chunks), sum(c.total_uncompressed_size for c in chunks), ",".join(sorted({c.compression for c in chunks}))))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in FOOTER.split(", ")])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", "length", "content").mapInPandas(run, FOOTER)


def compare_tables(spark, a: str, b: str) -> DataFrame:
    """One row: files, rows and bytes of two written tables, and the second's bytes as a share of the first's."""

    def total(path: str, name: str) -> DataFrame:
        own = parquet_report(spark, path).agg(F.count("*").alias(f"files_{name}"), F.sum("rows").alias(f"rows_{name}"), F.sum("bytes").alias(f"bytes_{name}"))
        return own.withColumn("k", F.lit(1))

    return total(a, "a").join(total(b, "b"), "k").drop("k").withColumn("share", F.col("bytes_b") / F.col("bytes_a"))


def audit_snapshot(settings: Settings, matches: DataFrame, commit: str | None = None) -> dict:
    """What a run was made with: thresholds, sizes of the effective lists, alias matches by source."""
    by_source = {r["alias_source"]: r["n"] for r in matches.groupBy("alias_source").agg(F.count("*").alias("n")).collect()}  # two sources
    thresholds = {k: getattr(settings, k) for k in ("high", "medium", "suffix_penalty", "numeric_penalty", "punctuation_penalty", "canopy_enabled", "canopy_bound")}
    lists = {"blacklist_tokens": len(settings.blacklist_tokens), "blacklist_phrases": len(settings.blacklist_phrases)}
    return {"config_hash": settings.config_hash(), "thresholds": thresholds, "lists": lists, "alias_matches": by_source, "commit": commit}


def performance_document(summary: DataFrame, seconds: dict[str, float]) -> dict:
    """The performance summary's one row with the stages' seconds."""
    return {**summary.first().asDict(), "seconds": {k: round(v, 3) for k, v in seconds.items()}, "seconds_total": round(sum(seconds.values()), 3)}
