"""A corpus pipeline over ``documents``: toxic rows go, near copies go, secrets are masked, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``.  Stages keep the columns of ``documents``; the last returns token
pieces with their places.  Each stage works on all rows that the one before it kept.

Defined results of every stage: an empty table gives an empty table; columns of any name and null values are kept
as they are; a null text counts as empty, has no toxic passage, is no near copy and is packed as one end id; a null
doc_id is kept; repeated rows are near copies of one another, of rows with equal keys any one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladespark.cluster import ship_package
from cladespark.llm import ngram_join, packing, secret_scan, textbatch, toxicity
from cladespark.storage import dropped, stored


def _prepared(spark: SparkSession) -> None:
    """The package is with the workers, and they are handed few texts at once."""
    ship_package(spark)
    textbatch.small_batches(spark)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows predicted to be toxic go; the model is learned from ``labels`` and the rows of ``docs``."""
    _prepared(spark)
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that 5-word shingles of similarity 0.8 or more connect, the least doc_id stays."""
    _prepared(spark)
    return ngram_join.without_near_copies(docs, width=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark, and n_chars follows where a text changes; no row goes."""
    masked = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    length = F.when(F.col("text").contains(secret_scan.MARK), F.length("text")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of at most 2048 ids and their places in sequences."""
    _prepared(spark)
    packed = packing.pack_documents(docs, capacity=2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", reject_toxic), ("ngram_jaccard", drop_near_copies), ("secret_scan", mask_secrets), ("packing", pack)]

#: SQL can't learn the model or pack; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
            dropped(before)
    return docs
