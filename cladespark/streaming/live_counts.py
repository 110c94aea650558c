"""Counts that are kept up while alignment files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import alignment as al
from ..operators.counting import filtered
from ..sources.sam import parsed_sam


def sam_stream(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    """Alignments of SAM files as they appear in a folder."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    return parsed_sam(lines).withColumn("sample", al.sample_tag(F.col("rg")))


def live_counts(alignments: DataFrame, min_mapq: int = 5) -> DataFrame:
    """(sample, cluster, raw_count) by gene; for output in update or complete mode. State has a row a sample and gene."""
    return filtered(alignments, min_mapq).groupBy("sample", F.col("rname").alias("cluster")).agg(F.count("*").alias("raw_count"))


def windowed_counts(events: DataFrame, time: str = "ts", key: str = "event_type", window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """(start, key, n) of events in windows of time; later ones than the watermark are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")
