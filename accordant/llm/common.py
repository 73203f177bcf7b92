"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accordant.plans.materialise import materialise, shared_folder  # noqa: F401  the operators take them from here
from accordant.plans.shipping import ship

#: Characters of text that a Python worker expands into word objects at once.
CHUNK_CHARS = 2_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_columns(key: str, name: str = "doc") -> list:
    """An id as two columns without nulls: beside a null, pandas would hold longs as floats and round those above 2^53."""
    own = F.col(f"`{key}`").cast("long")
    return [F.coalesce(own, F.lit(0).cast("long")).alias(name), own.isNull().alias(f"{name}_null")]


def ids_of(batch: pd.DataFrame, name: str = "doc") -> pd.arrays.IntegerArray:
    """The ids that `id_columns` made, whole, nulls included."""
    return pd.arrays.IntegerArray(batch[name].to_numpy(dtype=np.int64), batch[f"{name}_null"].to_numpy(dtype=bool))


def ascii_lower(column):
    """Lower-case A-Z alone; lower() would touch other alphabets too."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: For bytes.translate in Python workers: A-Z to a-z.
LOWER_TABLE = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def chunks(texts: list, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of a list of texts of about `limit` characters each; one longer text is a range of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text) if text is not None else 0
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)
