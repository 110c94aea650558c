"""From alignments to counts and abundances of genes, species or markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import alignment as al
from ..functions.gc import BUILTIN, gc_weight
from ..schemas import UNCLASSED, UNKNOWN
from ..sizes import small


def filtered(alignments: DataFrame, min_mapq: int = 5, min_identity: float | None = None, min_align_len: int | None = None) -> DataFrame:
    """Mapped primary records of good quality, identity and aligned length."""
    out = alignments.where(al.is_mapped(F.col("flag")) & al.is_primary(F.col("flag")) & al.passes_mapq(F.col("mapq"), min_mapq))
    if min_identity is not None:
        out = out.where(al.identity(F.col("cigar"), F.col("md")) >= min_identity)
    if min_align_len is not None:
        out = out.where(al.align_len(F.col("cigar")) >= min_align_len)
    return out


def without_markers(alignments: DataFrame, excluded: DataFrame) -> DataFrame:
    """Records on markers that aren't excluded."""
    return alignments.join(excluded.select(F.col("marker").alias("rname")), "rname", "left_anti")


def with_gene(alignments: DataFrame, genes: DataFrame) -> DataFrame:
    """Adds species, gene length and gene GC; genes that aren't known have a name for that and 0."""
    table = small(genes.select(F.col("gene").alias("rname"), F.coalesce("species", F.lit(UNKNOWN)).alias("species"), F.col("length").alias("gene_len"), F.col("gc").alias("gene_gc")))
    joined = alignments.join(table, "rname", "left")
    return joined.withColumns({"species": F.coalesce("species", F.lit(UNCLASSED)), "gene_len": F.coalesce("gene_len", F.lit(0)), "gene_gc": F.coalesce("gene_gc", F.lit(0.0))})


def with_genome(frame: DataFrame, genomes: DataFrame) -> DataFrame:
    """Adds length and GC of the species' genome, 0 where they aren't known."""
    joined = frame.join(small(genomes.select("species", "genome_len", "genome_gc")), "species", "left")
    return joined.withColumns({"genome_len": F.coalesce("genome_len", F.lit(0)), "genome_gc": F.coalesce("genome_gc", F.lit(0.0))})


def counted(frame: DataFrame, cluster: str, weight: Column | None = None) -> DataFrame:
    """(sample, cluster, raw_count, recal_count): records and the sum of their weights, with partial sums before the shuffle."""
    weight = F.lit(1.0) if weight is None else weight
    return frame.groupBy("sample", F.col(cluster).alias("cluster")).agg(F.count("*").alias("raw_count"), F.sum(weight).alias("recal_count"))


def gc_counted(frame: DataFrame, cluster: str, p: tuple[float, ...] = BUILTIN) -> DataFrame:
    """Counts with each record weighted by its read's and the genome's GC."""
    return counted(frame, cluster, gc_weight(F.col("read_gc"), F.col("genome_gc"), p))


def with_abundance(counts: DataFrame, lengths: DataFrame) -> DataFrame:
    """Weighted count by length (columns cluster, length); 0 where there is no length."""
    joined = counts.join(small(lengths.select("cluster", "length")), "cluster", "left")
    return joined.withColumn("abundance", F.when(F.col("length") > 0, F.col("recal_count") / F.col("length")).otherwise(F.lit(0.0))).drop("length")


def with_relative(counts: DataFrame, value: str = "abundance") -> DataFrame:
    """Share of a sample's total in percent, 0 where the total is.

    Totals are one row a sample, summed before they are joined, so no sample's rows are gathered in one task.
    """
    totals = counts.groupBy("sample").agg(F.sum(value).alias("_total"))
    joined = counts.join(totals, "sample")
    return joined.withColumn("rel_abun", F.when(F.col("_total") > 0, F.col(value) / F.col("_total") * 100).otherwise(F.lit(0.0))).drop("_total")


def read_names(frame: DataFrame, cluster: str, parts: int = 1) -> DataFrame:
    """(sample, cluster, part, names): names of the reads counted for a cluster, in order, comma-separated.

    With ``parts`` a cluster's names are dealt to so many lists by a digest of the name, so that a cluster with a large
    share of all reads is no one row.
    """
    part = F.pmod(F.conv(F.substring(F.md5("qname"), 1, 6), 16, 10).cast("int"), F.lit(parts))
    return frame.groupBy("sample", F.col(cluster).alias("cluster"), part.alias("part")).agg(F.array_join(F.sort_array(F.collect_list("qname")), ",").alias("names"))


def sample_ids(frame: DataFrame, order: str) -> DataFrame:
    """(sample, sample_id): dense numbers from 0 by first appearance in ``order``."""
    first = frame.groupBy("sample").agg(F.min(order).alias("_first"))
    return first.select("sample", F.expr("cast(dense_rank() over (order by _first, sample) - 1 as int)").alias("sample_id"))


def deduplicated(frame: DataFrame) -> DataFrame:
    """The last record of each read name (by column ``line``) and sample."""
    return frame.groupBy("sample", "qname").agg(F.max_by("rname", "line").alias("rname"))
