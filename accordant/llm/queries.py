"""The contract's queries: each applies its operator to a whole table and derives digests from its outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import best_fit_packing, chat_formatting, hash_forest, license_scans, ngram_jaccard, piece_encoding, quality_rules, secret_scans, substring_dedup, url_filters
from .common import read

#: The rules the query judges by (host, path, verdict).
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


#: The conversation that the query adds, two rows of control strings.
SPOKEN = "</s>[INST] ok [/INST]"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.join(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scans.scan(read(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", SPOKEN), (-7, 1, "assistant", SPOKEN)], "conv_id long, turn long, role string, text string")
    return chat_formatting.read_windows(chat_formatting.format_conversations(turns.unionByName(added), tokens=chat_formatting.tokens_of(tokenizer_file("byte_bpe_50k.json"))))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    trusted = read(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    return quality_rules.score_documents(docs, trusted)


def op5_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    found = hash_forest.nearest(vectors, vectors.where("vec_id % 100 = 0"))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join("('{}', '{}', '{}')".format(*rule) for rule in URL_RULES)
    rules = spark.sql(f"select * from values {values} as rules(host, path, verdict)")
    return url_filters.judge_urls(read(spark, sf_dir, "pages"), rules)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scans.find_secrets(read(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = F.filter("spans", lambda x: x["kind"] != "random")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op9_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file("piece_bpe_32k.model")
    done = piece_encoding.encode(read(spark, sf_dir, "documents"), path, decoded=True)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = best_fit_packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard, op2_license_scans, op3_chat_formatting, op4_quality_rules, op5_hash_forest, op6_url_filters, op7_substring_dedup, op8_secret_scans, op9_piece_encoding, op10_best_fit_packing)}
