"""Make this package importable in Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from hashlib import sha256
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Once a context: hand the package's source to the driver's file server, from which executors fetch it."""
    context = spark.sparkContext
    if getattr(context, "_accordant_shipped", False):
        return
    top = Path(__file__).resolve().parent.parent
    sources = sorted(p for p in top.rglob("*.py"))
    name = sha256(b"".join(p.read_bytes() for p in sources)).hexdigest()[:16]
    path = Path(tempfile.mkdtemp(prefix="accordant-source-")) / f"accordant-{name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for p in sources:
            out.write(p, p.relative_to(top.parent))
    context.addPyFile(str(path))
    context._accordant_shipped = True
