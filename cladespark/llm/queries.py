"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, hnsw, licences, media, ngram_join, packing, secret_scan, textbatch, token_counts, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    textbatch.small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.scan(_table(spark, sf_dir, "documents")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), limit=512)


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = media.media_of_documents(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_pages(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), capacity=2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(_table(spark, sf_dir, "documents"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"), width=4, percent=85)


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.95)


QUERIES = {
    f.__name__: f
    for f in (op1_secret_scan, op2_toxicity, op3_license_scan, op4_token_counts, op5_media_columns, op6_warc, op7_best_fit_packing, op8_bpe, op9_ngram_jaccard, op10_embedding_near_dedup)
}

ORACLE_SQL: dict[str, str] = {"op3_license_scan": licences.sql()}
