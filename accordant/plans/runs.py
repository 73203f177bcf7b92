"""Runs: ids, an index with a latest pointer, pruning, and stages that a later run resumes.

A run is a folder under a root that all machines share. Its stages are Parquet tables, complete where the
writer left its mark of success; its entry in the index is written last.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

from accordant.config import Settings
from accordant.plans.materialise import delete

DONE = "_SUCCESS"


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _path(spark, path)
    return system.exists(where)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all: written beside its place and moved there."""
    where, system = _path(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    out = system.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    system.delete(where, False)
    system.rename(beside, where)


def read_text(spark: SparkSession, path: str) -> str:
    where, system = _path(spark, path)
    size = system.getFileStatus(where).getLen()
    source = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8") if size else ""
    finally:
        source.close()


def run_id(inputs: str, settings: Settings, stamp: str | None = None) -> str:
    """Eight hex digits of what was read, eight of the settings, and the time."""
    return f"{sha256(inputs.encode()).hexdigest()[:8]}_{settings.config_hash()}_{stamp or time.strftime('%Y%m%d%H%M%S')}"


class Runs:
    """The runs of a root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def index(self) -> list[dict]:
        """Entries of complete runs, newest first."""
        path = f"{self.root}/index.json"
        entries = json.loads(read_text(self.spark, path)) if exists(self.spark, path) else []
        return sorted(entries, key=lambda e: (e["timestamp"], e["run_id"]), reverse=True)

    def _write(self, entries: list[dict]) -> None:
        write_text(self.spark, f"{self.root}/index.json", json.dumps(entries, sort_keys=True))

    def finish(self, name: str, **facts) -> None:
        """Enter a complete run."""
        stamp = facts.pop("timestamp", None) or name.rsplit("_", 1)[-1]
        self._write([e for e in self.index() if e["run_id"] != name] + [{"run_id": name, "timestamp": stamp, **facts}])

    def latest(self) -> str | None:
        entries = self.index()
        return entries[0]["run_id"] if entries else None

    def size(self, name: str) -> int:
        """Bytes that deleting a run would free."""
        where, system = _path(self.spark, f"{self.root}/{name}")
        return system.getContentSummary(where).getLength() if system.exists(where) else 0

    def drop(self, *names: str) -> None:
        self._write([e for e in self.index() if e["run_id"] not in names])
        for name in names:
            delete(self.spark, f"{self.root}/{name}")

    def prune(self, keep: int) -> list[str]:
        """Drop all but the newest complete runs; which those were."""
        old = [e["run_id"] for e in self.index()[keep:]]
        if old:
            self.drop(*old)
        return old

    def orphans(self) -> list[str]:
        """Folders of runs that aren't in the index: still running, or interrupted."""
        where, system = _path(self.spark, self.root)
        known = {e["run_id"] for e in self.index()}
        found = [s.getPath().getName() for s in system.listStatus(where) if s.isDirectory()] if system.exists(where) else []
        return sorted(n for n in found if n not in known)

    def stage(self, name: str, stage: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A run's stage: read where it is complete, else made, written and read."""
        path = f"{self.root}/{name}/{stage}"
        if not exists(self.spark, f"{path}/{DONE}"):
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def pipeline(self, name: str, stages: list[tuple[str, Callable]], first: DataFrame) -> DataFrame:
        """Stages in a row, each given what the one before left. An interrupted run goes on behind its last complete stage;
        a stage that is made anew has all later ones made anew."""
        df, fresh = first, False
        for stage, f in stages:
            fresh = fresh or not exists(self.spark, f"{self.root}/{name}/{stage}/{DONE}")
            if fresh:
                delete(self.spark, f"{self.root}/{name}/{stage}")
            df = self.stage(name, stage, lambda f=f, df=df: f(df))
        return df
