"""Tables of reads and markers beside the clade profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reads_of_clades(cells: DataFrame, hits: DataFrame) -> DataFrame:
    """(sample, qname, clade): each read with the clade of its marker."""
    return hits.select("sample", "qname", F.col("rname").alias("marker")).join(cells.select("sample", "marker", "clade"), ["sample", "marker"]).select("sample", "qname", "clade")


def marker_counts(cells: DataFrame, normalised: bool = False) -> DataFrame:
    """(sample, marker, value): reads, or reads per thousand bases, of markers with any."""
    value = F.col("reads") * 1000 / F.col("len") if normalised else F.col("reads").cast("double")
    return cells.where("reads > 0").select("sample", "marker", value.alias("value"))


def marker_presence(cells: DataFrame, threshold: float = 1.0) -> DataFrame:
    """(sample, marker, present = 1) for markers whose reads per thousand bases exceed a threshold."""
    return marker_counts(cells, True).where(F.col("value") > threshold).select("sample", "marker", F.lit(1).alias("present"))


def clade_profiles(cells: DataFrame) -> DataFrame:
    """(sample, clade, marker, value): normalised counts of all markers of clades that have any reads."""
    seen = cells.groupBy("sample", "clade").agg(F.sum("reads").alias("_reads")).where("_reads > 0").drop("_reads")
    return cells.join(seen, ["sample", "clade"], "left_semi").select("sample", "clade", "marker", (F.col("reads") * 1000 / F.col("len")).alias("value"))


def strain_tracker(cells: DataFrame, profile: DataFrame, clade: str, threshold: float = 1.0, least: float = 0.1) -> DataFrame:
    """(sample, marker, present): 1 or 0 for each marker of clades whose name holds ``clade``.

    Samples in which a clade whose name ends so has less than ``least`` percent (profile: sample, clade, rel_abun) give no rows.
    """
    scarce = profile.where(F.col("clade").endswith(clade) & (F.col("rel_abun") < least)).select("sample").distinct()
    own = cells.where(F.col("clade").contains(clade)).join(scarce, "sample", "left_anti")
    return own.select("sample", "marker", (F.col("reads") * 1000 / F.col("len") > threshold).cast("int").alias("present"))


def with_read_stats(rolled: DataFrame, lengths: DataFrame) -> DataFrame:
    """(sample, clade, abundance, geno_len, est_reads): coverage, mean genome length and the reads they make."""
    joined = rolled.join(lengths, "clade", "left").withColumn("geno_len", F.coalesce("geno_len", F.lit(0.0)))
    return joined.select("sample", "clade", "abundance", "geno_len", F.floor(F.col("abundance") * F.col("geno_len")).cast("long").alias("est_reads"))


def sorted_report(profile: DataFrame) -> DataFrame:
    """Rows by depth of the path, then by falling relative abundance."""
    return profile.orderBy(F.size(F.split("cluster", r"\|")), F.desc("rel_abun"), "cluster")


def without_kingdoms(markers: DataFrame, clades: DataFrame, ignored: list[str]) -> DataFrame:
    """Markers of clades outside the ignored kingdoms."""
    return markers.join(clades.where(~F.col("kingdom").isin(ignored)).select("clade"), "clade", "left_semi")


def biom_tips(profile: DataFrame) -> DataFrame:
    """Rows of tips: strains and what is unclassified."""
    last = F.element_at(F.split("cluster", r"\|"), -1)
    return profile.where(last.startswith("t__") | last.endswith("_unclassified"))
