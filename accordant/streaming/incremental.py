"""Each micro-batch is normalised and blocked against the records that came before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from accordant.config import DEFAULTS, Settings
from accordant.functions.text import first_token_key, normalise
from accordant.operators.scoring import scored_candidates


def match_batch(batch: DataFrame, known: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Scored pairs of a normalised batch with known records, and among its own rows. Both have account_id, name_core, suffix_class."""
    key = first_token_key("name_core", settings.stop_tokens)
    new = batch.select("account_id", "name_core", "suffix_class", key.alias("block_key")).where("block_key <> ''")
    old = known.select("account_id", "name_core", "suffix_class", key.alias("block_key")).join(new.select("account_id"), "account_id", "left_anti")
    left = new.select("block_key", *[F.col(c).alias(f"{c}_a") for c in ("account_id", "name_core", "suffix_class")])

    def against(other: DataFrame) -> DataFrame:
        return left.join(other.select("block_key", *[F.col(c).alias(f"{c}_b") for c in ("account_id", "name_core", "suffix_class")]), "block_key")

    pairs = against(old).unionByName(against(new).where("account_id_a < account_id_b"))
    return scored_candidates(pairs.drop("block_key"), settings)


def deduplicate_stream(stream: DataFrame, table: str, matches: str, checkpoint: str, settings: Settings = DEFAULTS) -> StreamingQuery:
    """Write normalised records to `table` and scored pairs to `matches`, both Parquet folders; a batch that is repeated after a failure rewrites its own part."""

    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = normalise(batch).select("account_id", "account_name", "name_core", "suffix_class", F.lit(number).alias("batch"))
        rows.write.mode("overwrite").parquet(f"{table}/batch={number}")
        seen = spark.read.parquet(table)
        match_batch(seen.where(F.col("batch") == number), seen.where(F.col("batch") < number), settings).write.mode("overwrite").parquet(f"{matches}/batch={number}")

    return stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
