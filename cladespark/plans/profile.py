"""From alignments to profiles, for each pipeline."""

from __future__ import annotations

from dataclasses import replace
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import alignment as al
from ..functions.gc import gc_percent, model
from ..operators import align, counting, pairs, taxonomy
from ..schemas import RANKS
from ..sinks import reports
from ..sources import fastq, references, sam
from .options import Layout, Level, Options, Pipeline, SequencingMode


class Profiler(Protocol):
    """Anything that makes a profile of alignments."""

    def __call__(self, alignments: DataFrame, options: Options) -> DataFrame: ...


def profile_genes(alignments: DataFrame, genes: DataFrame, genomes: DataFrame | None, options: Options) -> DataFrame:
    """(sample, cluster, raw_count, recal_count, abundance, rel_abun) by species or gene, single reads."""
    kept = counting.filtered(alignments, options.min_mapq, options.min_identity, options.min_align_len)
    named = counting.with_gene(kept, genes)
    by_species = options.level is Level.SPECIES
    cluster = "species" if by_species else "rname"
    if options.gc_recalibration and genomes is not None:
        weighted = counting.with_genome(named, genomes).withColumn("read_gc", gc_percent(F.col("seq")))
        counts = counting.gc_counted(weighted, cluster, model(options.gc_model).coefficients)
    else:
        counts = counting.counted(named, cluster)
    return counting.with_relative(counting.with_abundance(counts, _lengths(genes, genomes, by_species)))


def profile_pairs(alignments: DataFrame, genes: DataFrame, genomes: DataFrame | None, options: Options) -> DataFrame:
    """The same with pairs counted as one."""
    recalibrated = options.gc_recalibration and genomes is not None
    columns = ["rname", "flag", "pos", "cigar", "md", "tlen", "species", "gene_len", "read_len"] + (["read_gc", "genome_gc"] if recalibrated else [])
    kept = alignments.where(al.is_mapped(F.col("flag")) & al.is_primary(F.col("flag")) & al.passes_mapq(F.col("mapq"), options.min_mapq))
    named = counting.with_gene(kept, genes).withColumn("read_len", F.length("seq")).withColumn("qname", al.without_mate_suffix(F.col("qname")))
    if recalibrated:
        named = counting.with_genome(named, genomes).withColumn("read_gc", gc_percent(F.col("seq")))
    merged = pairs.with_good_ends(pairs.merged(named, columns), options.min_identity, options.min_align_len)
    if recalibrated:
        counts = pairs.weighted_counts(merged, options.level.value, options.insert_size, p=model(options.gc_model).coefficients)
    else:
        counts = counting.counted(pairs.pair_clusters(merged, options.level.value, options.insert_size), "cluster")
    return counting.with_relative(counting.with_abundance(counts, _lengths(genes, genomes, options.level is Level.SPECIES)))


def _lengths(genes: DataFrame, genomes: DataFrame | None, by_species: bool) -> DataFrame:
    if by_species and genomes is not None:
        return genomes.select(F.col("species").alias("cluster"), F.col("genome_len").alias("length"))
    return genes.select(F.col("gene").alias("cluster"), "length")


def marker_cells(alignments: DataFrame, markers: DataFrame, clades: DataFrame, options: Options) -> DataFrame:
    """Markers with their reads in each sample, quasi-markers resolved."""
    kept = counting.filtered(alignments, options.min_mapq)
    kept = kept.where(al.max_match_run(F.col("cigar"), options.xeq) >= options.min_align_len)
    if options.dedup_reads:
        kept = counting.deduplicated(kept.withColumn("line", F.monotonically_increasing_id()))
    counts = kept.groupBy("sample", F.col("rname").alias("marker")).agg(F.count("*").alias("reads"))
    placed = taxonomy.terminals(clades)
    cells = taxonomy.seeded(counts, markers, placed)
    if options.disambiguate:
        return taxonomy.refilled(taxonomy.with_discards(cells, clades, placed), clades)
    return cells


def profile_clades(alignments: DataFrame, markers: DataFrame, lineages: DataFrame, options: Options) -> DataFrame:
    """(sample, cluster, read_sum, abundance, rel_abun) of clades at all or one rank."""
    clades = taxonomy.clade_tree(lineages)
    used = marker_cells(alignments, markers, clades, options)
    rolled = taxonomy.rolled_up(taxonomy.local_abundance(used, clades, options.statistic), clades, options.min_marker_len)
    profile = taxonomy.emitted(rolled, clades, options.taxa_level)
    if options.unknown:
        return with_unknown(profile, rolled, options.total_reads, options.taxa_level, options.layout is not Layout.CAMI)
    return profile


def with_unknown(profile: DataFrame, rolled: DataFrame, total_reads: int, level: str = "a", named: bool = True) -> DataFrame:
    """The profile with relative abundances as shares of all ``total_reads`` reads of a sample, not of the mapped ones alone.

    Mapped reads are those of all species; a share beyond 1 is 1. With all ranks an UNKNOWN row takes the remainder
    if ``named``; at one rank the row for the remainder grows instead.
    """
    mapped = rolled.where(F.col("clade").startswith("s")).groupBy("sample").agg(F.sum("read_sum").alias("mapped"))
    share = F.least(F.lit(1.0), F.coalesce("mapped", F.lit(0.0)) / F.lit(total_reads))
    joined = profile.join(mapped, "sample", "left").withColumn("share", share)
    rel = F.col("rel_abun") * F.col("share")
    if level != "a":
        rel = F.when(F.col("cluster") == f"{level}__unclassified", 100 - F.col("share") * (100 - F.col("rel_abun"))).otherwise(rel)
    scaled = joined.withColumn("rel_abun", rel).select(*profile.columns)
    if level != "a" or not named:
        return scaled
    rest = profile.select("sample").distinct().join(mapped, "sample", "left").select("sample", F.lit("UNKNOWN").alias("cluster"), (F.lit(total_reads) - F.coalesce("mapped", F.lit(0.0))).alias("read_sum"), F.lit(0.0).alias("abundance"), ((1 - share) * 100).alias("rel_abun"))
    return scaled.unionByName(rest)


def with_taxids(profile: DataFrame, lineages: DataFrame, total_reads: DataFrame | None = None) -> DataFrame:
    """CAMI columns of a clade profile; strains go, and a row for reads that no clade explains comes with ``total_reads`` (sample, total)."""
    ids = lineages.select(F.split("lineage", r"\|").alias("p"), F.split(F.coalesce("taxid", F.lit("")), r"\|").alias("i"))
    nodes = ids.select(F.explode(F.sequence(F.lit(1), F.size("p"))).alias("k"), "p", "i")
    table = nodes.select(F.array_join(F.expr("slice(p, 1, k)"), "|").alias("cluster"), F.array_join(F.expr("slice(i, 1, k)"), "|").alias("taxpath"), F.expr("try_element_at(i, k)").alias("taxid")).groupBy("cluster").agg(F.min("taxpath").alias("taxpath"), F.min("taxid").alias("taxid"))
    depth = F.size(F.split("cluster", r"\|"))
    joined = profile.join(table, "cluster", "left").where(~F.element_at(F.split("cluster", r"\|"), -1).startswith("t__"))
    out = joined.select("sample", F.coalesce("taxid", F.lit("")).alias("taxid"), F.element_at(F.array(*map(F.lit, RANKS)), depth).alias("rank"), F.coalesce("taxpath", F.lit("")).alias("taxpath"), F.regexp_replace("cluster", "[kpcofgs]__", "").alias("taxpathsn"), F.col("rel_abun").alias("percentage"), "cluster", "read_sum")
    if total_reads is None:
        return out
    known = out.where(depth == 1).groupBy("sample").agg(F.sum("read_sum").alias("known"))
    missing = total_reads.join(known, "sample", "left").withColumn("share", (F.col("total") - F.coalesce("known", F.lit(0.0))) / F.col("total") * 100).where("total > 0 and share > 0")
    rows = missing.select("sample", F.lit("-1").alias("taxid"), F.lit(None).cast("string").alias("rank"), F.lit("-1").alias("taxpath"), F.lit("UNKNOWN").alias("taxpathsn"), F.col("share").alias("percentage"), F.lit("UNKNOWN").alias("cluster"), F.lit(0.0).alias("read_sum"))
    return out.unionByName(rows)


def align_reads(spark: SparkSession, options: Options, aligner: align.Aligner) -> DataFrame:
    """Aligns the reads of a FASTQ list and keeps the SAM lines under ``output/sam``; returns the alignments.

    Beside them, ``output/sam_list`` names the samples' folders. Files are whole rows each, compressed ones included.
    """
    samples = fastq.fastq_samples(spark, options.fastq_list)
    paired = options.mode is SequencingMode.PAIRED
    paths = [p for r in samples.select("fastq1", "fastq2").collect() for p in r if p]  # as short as the list given
    reads = fastq.with_samples(fastq.read_fastq(spark, paths, paired), samples)
    if paired:
        mated = pairs.mated_reads(reads)
    else:
        mated = reads.select("sample_id", "rg", "sm", "read_name", F.col("seq").alias("seq1"), F.col("qual").alias("qual1"), F.lit(None).cast("string").alias("seq2"), F.lit(None).cast("string").alias("qual2"))
    lines = align.aligned(mated, aligner, options.parts_per_sample)
    lines.write.mode("overwrite").partitionBy("rg", "sm").text(f"{options.output}/sam")
    folders = samples.select("rg", "sm", F.concat(F.lit(f"{options.output}/sam/rg="), "rg", F.lit("/sm="), "sm").alias("path"))
    reports.write_sam_list(folders.distinct(), f"{options.output}/sam_list")
    kept = spark.read.schema("value string, rg string, sm string").text(f"{options.output}/sam")
    return sam.parsed_sam(kept.select("value", F.col("sm").alias("sample")))


def run(spark: SparkSession, options: Options, aligner: align.Aligner | None = None) -> str:
    """Profiles the files of a SAM list, or aligns those of a FASTQ list first, and writes the reports; returns where.

    Without an aligner, the program bowtie2 on every machine's path is used.
    """
    options = options.resolved()
    if options.fastq_list:
        alignments = align_reads(spark, options, aligner or align.process_aligner("bowtie2", options.aligner_index or ""))
        if options.skip_profiling:
            return options.output
        return _profiled(spark, alignments, replace(options, output=f"{options.output}/profile"))
    samples = sam.sam_samples(spark, options.sam_list)
    paths = [r["path"] for r in samples.select("path").distinct().collect()]  # a list of files, as short as the list given
    return _profiled(spark, sam.with_listed_sample(sam.read_sam(spark, paths), samples), options)


def _profiled(spark: SparkSession, alignments: DataFrame, options: Options) -> str:
    if options.pipeline is Pipeline.COMG:
        genes = references.read_genes(spark, options.reference_matrix)
        genomes = references.read_species_genomes(spark, options.species_genomes) if options.species_genomes else None
        make = profile_pairs if options.mode is SequencingMode.PAIRED else profile_genes
        return reports.write_profiles(make(alignments, genes, genomes, options), options.output, options.layout.value if options.layout is not Layout.CAMI else "detailed")
    excluded = references.read_excluded(spark, options.excluded_markers) if options.excluded_markers else None
    markers, lineages = references.read_markers(spark, options.marker_json, excluded), references.read_taxonomy(spark, options.taxonomy_json)
    profile = profile_clades(alignments, markers, lineages, options)
    if options.layout is Layout.CAMI:
        return reports.write_profiles(with_taxids(profile, lineages).withColumn("rel_abun", F.col("percentage")), options.output, "cami")
    profile = profile.withColumns({"raw_count": F.col("read_sum").cast("long"), "recal_count": F.col("read_sum")})
    return reports.write_profiles(profile, options.output, options.layout.value)
