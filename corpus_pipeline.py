"""The corpus pipeline: five operators in a row, from documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last
return the columns of documents; a stage that changes a text sets n_chars anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accordant.llm import best_fit_packing, ngram_jaccard, quality_rules, secret_scans, substring_dedup
from accordant.llm.common import read, shared_folder
from accordant.llm.queries import tokenizer_file
from accordant.plans.materialise import delete
from accordant.plans.shipping import ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the likelihood ratio's threshold go."""
    trusted = read(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    return quality_rules.kept_documents(docs.select(*COLUMNS), trusted)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the least id stays, once; a row without an id stays."""
    ship(spark)
    docs = docs.select(*COLUMNS)
    later = ngram_jaccard.join(docs).where("component_id < doc_id").select("doc_id").distinct()
    kept = docs.where("doc_id is not null").join(later, "doc_id", "left_anti")
    once = kept.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id").orderBy("text", "source", "lang", "n_chars"))).where("nth = 1")
    return once.select(*COLUMNS).unionByName(docs.where("doc_id is null"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document holds go; a document left without words goes, one that loses none stays as it was."""
    ship(spark)
    docs = docs.select(*COLUMNS)
    # Texts move alone, so that one exchange serves both of the operator's joins; the other columns are small and
    # joined by id (repeated rows take the least ones). Rows without an id lose nothing.
    small = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("lang", "source", "n_chars")).alias("x"))
    done = substring_dedup.dedup(docs.where("doc_id is not null").select("doc_id", "text"), keep_untouched=True)
    left = done.where("n_removed = 0 or n_removed < n_words").join(small.select("doc_id", "x.*"), "doc_id")
    left = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)
    return left.unionByName(docs.where("doc_id is null"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    ship(spark)
    done = secret_scans.redact_documents(docs.select(*COLUMNS, F.col("n_chars").alias("before")))
    changed = done.withColumn("n_chars", F.when(F.col("text").contains(secret_scans.MARK), F.length("text").cast("long")).otherwise(F.col("before")))
    return changed.select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document and their places in training sequences."""
    ship(spark)
    return best_fit_packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

#: SQL expresses neither the likelihood ratio, the components, nor the packing; tests/llm holds run() against plain
#: Python counterparts of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written as a table in the cluster's shared folder and read again.

    The last stage checkpoints its pieces before it returns, so the stages' tables aren't read after that and go.
    """
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    try:
        for n, (_, stage) in enumerate(STAGES[:-1]):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
            docs = spark.read.parquet(f"{folder}/{n}")
        return STAGES[-1][1](spark, docs, sf_dir)
    finally:
        delete(spark, folder)
