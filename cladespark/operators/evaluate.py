"""A profile against a known truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compared(profile: DataFrame, truth: DataFrame) -> DataFrame:
    """(sample, cluster, observed, expected): all clusters of either, 0 where one lacks it."""
    observed = profile.select("sample", "cluster", F.col("abundance").alias("observed"))
    expected = truth.select("sample", "cluster", F.col("abundance").alias("expected"))
    joined = observed.join(expected, ["sample", "cluster"], "full_outer")
    return joined.select("sample", "cluster", F.coalesce("observed", F.lit(0.0)).alias("observed"), F.coalesce("expected", F.lit(0.0)).alias("expected"))


def scores(pairs: DataFrame) -> DataFrame:
    """(sample, l1, proximity, precision, recall) of profiles in percent."""
    hit = (F.col("observed") > 0) & (F.col("expected") > 0)
    sums = pairs.groupBy("sample").agg(F.sum(F.abs(F.col("observed") - F.col("expected"))).alias("l1"), F.count_if(hit).alias("tp"), F.count_if(F.col("observed") > 0).alias("p"), F.count_if(F.col("expected") > 0).alias("t"))
    ratio = lambda n: F.when(F.col(n) > 0, F.col("tp") / F.col(n)).otherwise(F.lit(0.0))
    return sums.select("sample", "l1", (1 - F.col("l1") / 200).alias("proximity"), ratio("p").alias("precision"), ratio("t").alias("recall"))


def truth_distance(profile: DataFrame, truth: DataFrame) -> DataFrame:
    """(sample, l1): distance over the truth's clusters only, as a fraction; truth is in fractions, the profile in percent."""
    joined = truth.select("sample", "cluster", (F.col("abundance") * 100).alias("expected")).join(profile.select("sample", "cluster", "abundance"), ["sample", "cluster"], "left")
    return joined.groupBy("sample").agg((F.sum(F.abs(F.col("expected") - F.coalesce("abundance", F.lit(0.0)))) / 100).alias("l1"))


def common_clusters(pairs: DataFrame) -> DataFrame:
    """(sample, cluster, kind, log_observed, log_expected): kind is common, observed or expected."""
    kind = F.when((F.col("observed") > 0) & (F.col("expected") > 0), "common").when(F.col("observed") > 0, "observed").otherwise("expected")
    log = lambda c: F.when(F.col(c) > 0, F.log10(F.col(c)))
    return pairs.where("observed > 0 or expected > 0").select("sample", "cluster", kind.alias("kind"), log("observed").alias("log_observed"), log("expected").alias("log_expected"))


def common_distance(pairs: DataFrame) -> DataFrame:
    """(sample, l1_all, l1_common)."""
    gap = F.abs(F.col("observed") - F.col("expected"))
    return pairs.groupBy("sample").agg(F.sum(gap).alias("l1_all"), F.sum(F.when((F.col("observed") > 0) & (F.col("expected") > 0), gap).otherwise(F.lit(0.0))).alias("l1_common"))


def regression_line(pairs: DataFrame) -> DataFrame:
    """(sample, slope, intercept) of observed over expected."""
    return pairs.groupBy("sample").agg(F.regr_slope("observed", "expected").alias("slope"), F.regr_intercept("observed", "expected").alias("intercept"))


def truth_species(rows: DataFrame, truth: DataFrame) -> DataFrame:
    """Adds truth_id: by taxid, else by a member of the taxid path, else by a member of the name path."""
    by_id = truth.select(F.col("taxid").alias("_taxid"), F.col("taxid").alias("_by_id"))
    members = lambda column, key, name: (
        rows.select("row_id", F.explode(F.split(column, r"\|")).alias("_member")).join(truth.select(F.col(key).alias("_member"), F.col("taxid").alias(name)), "_member").groupBy("row_id").agg(F.min(name).alias(name))
    )
    out = rows.join(by_id, rows["taxid"] == by_id["_taxid"], "left").drop("_taxid")
    out = out.join(members("taxpath", "taxid", "_by_path"), "row_id", "left").join(members("taxpathsn", "species", "_by_name"), "row_id", "left")
    return out.withColumn("truth_id", F.coalesce("_by_id", "_by_path", "_by_name")).drop("_by_id", "_by_path", "_by_name")
