"""Cutting lineage in the folder that a cluster's machines share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where that is unset, a temporary one on a single machine, as in tests; a cluster is refused."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that the cluster's machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="accordant-checkpoints-"))
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder of a file system that Spark reads; whether it was there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(*frames: DataFrame) -> None:
    """Delete the checkpoints of frames that `materialise` returned and that nothing reads any more."""
    for df in frames:
        plan = df._jdf.queryExecution().analyzed()
        if plan.getClass().getSimpleName() == "LogicalRDD" and plan.rdd().getCheckpointFile().isDefined():
            delete(df.sparkSession, plan.rdd().getCheckpointFile().get())
