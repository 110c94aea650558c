"""Reference tables: genes, genomes, markers, taxonomy, sequences, assemblies, profiles."""

from __future__ import annotations

import bz2
import json
import pickle
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MARKER = "map<string, struct<clade:string, len:int, ext:array<string>, score:double, taxon:string>>"
_TAXON = "map<string, struct<genoLen:bigint, taxid:string>>"


def _fields(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select(F.split("value", "\t").alias("_f"))


def read_genes(spark: SparkSession, path: str) -> DataFrame:
    """(gene_id, gene, length, species, gc) of four or more columns; rows of other widths go."""
    f = _fields(spark, path).where(F.size("_f") >= 4)
    return f.select(F.expr("try_cast(_f[0] as int)").alias("gene_id"), F.col("_f")[1].alias("gene"), F.expr("try_cast(_f[2] as int)").alias("length"), F.nullif(F.col("_f")[3], F.lit("")).alias("species"), F.expr("try_cast(try_element_at(_f, 5) as double)").alias("gc"))


def read_species_genomes(spark: SparkSession, path: str, gc_unit: str = "fraction") -> DataFrame:
    """(species, genome_len, genome_gc as a fraction)."""
    f = _fields(spark, path).where(F.size("_f") >= 3)
    gc = F.expr("try_cast(_f[2] as double)") / (100 if gc_unit == "percent" else 1)
    return f.select(F.col("_f")[0].alias("species"), F.expr("try_cast(_f[1] as bigint)").alias("genome_len"), gc.alias("genome_gc"))


def parsed_markers(text: DataFrame) -> DataFrame:
    """(marker, clade, len, ext, score, taxon) of JSON objects by marker; entries without clade or length go, ext names are strains."""
    rows = text.select(F.explode(F.from_json("value", _MARKER)).alias("marker", "m")).where("m.clade is not null and m.len is not null")
    ext = F.transform(F.coalesce("m.ext", F.array().cast("array<string>")), lambda x: F.concat(F.lit("t__"), x))
    return rows.select("marker", "m.clade", "m.len", ext.alias("ext"), "m.score", "m.taxon")


def read_markers(spark: SparkSession, path: str, excluded: DataFrame | None = None) -> DataFrame:
    markers = parsed_markers(spark.read.text(path, wholetext=True))
    return markers if excluded is None else markers.join(excluded, "marker", "left_anti")


def parsed_taxonomy(text: DataFrame) -> DataFrame:
    """(lineage, geno_len, taxid) of JSON objects by lineage; null where an entry has none."""
    return text.select(F.explode(F.from_json("value", _TAXON)).alias("lineage", "t")).select("lineage", F.col("t.genoLen").alias("geno_len"), F.col("t.taxid").alias("taxid"))


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    return parsed_taxonomy(spark.read.text(path, wholetext=True))


def read_excluded(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.trim("value") != "").select(F.trim("value").alias("marker")).distinct()


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(name, header, seq): name is the header's first word."""
    # a record ends where a line begins with >, so one inside a header doesn't end it
    rows = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", "^>", "").alias("value")).where(F.trim("value") != "")
    header = F.regexp_replace(F.split("value", "\n", 2)[0], "\r", "")
    body = F.regexp_replace(F.coalesce(F.expr("try_element_at(split(value, '\\n', 2), 2)"), F.lit("")), r"\s", "")
    return rows.select(F.split(header, r"\s")[0].alias("name"), header.alias("header"), body.alias("seq"))


def read_assemblies(spark: SparkSession, path: str) -> DataFrame:
    """(accession, category, taxid, species_taxid, organism, strain, paired_accession, ftp_path) of an assembly summary."""
    f = spark.read.text(path).where(~F.col("value").startswith("#")).select(F.split("value", "\t").alias("_f")).where(F.size("_f") >= 20)
    names = {0: "accession", 4: "category", 5: "taxid", 6: "species_taxid", 7: "organism", 8: "strain", 17: "paired_accession", 19: "ftp_path"}
    return f.select(*[F.col("_f")[i].alias(n) for i, n in names.items()])


def _dump(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.split(F.regexp_replace("value", r"\s*\|\s*$", ""), r"\s*\|\s*").alias("_f"))


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    return _dump(spark, path).select(F.col("_f")[0].cast("long").alias("taxid"), F.col("_f")[1].cast("long").alias("parent"), F.col("_f")[2].alias("rank"))


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """Scientific names alone."""
    f = _dump(spark, path).where(F.col("_f")[3] == "scientific name")
    return f.select(F.col("_f")[0].cast("long").alias("taxid"), F.col("_f")[1].alias("name"))


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return _dump(spark, path).select(F.col("_f")[0].cast("long").alias("old"), F.col("_f")[1].cast("long").alias("new"))


def read_cami(spark: SparkSession, path: str, rank: str | None = None) -> DataFrame:
    """(taxid, rank, taxpath, taxpathsn, percentage) without header lines, of one rank if given."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & ~F.col("value").startswith("@") & (F.trim("value") != ""))
    f = lines.select(F.split("value", "\t").alias("_f")).where(F.size("_f") >= 5)
    out = f.select(F.col("_f")[0].alias("taxid"), F.col("_f")[1].alias("rank"), F.col("_f")[2].alias("taxpath"), F.col("_f")[3].alias("taxpathsn"), F.expr("try_cast(_f[4] as double)").alias("percentage"))
    return out if rank is None else out.where(F.col("rank") == rank)


def read_abundances(spark: SparkSession, path: str) -> DataFrame:
    """(cluster, abundance) of a profile with the abundance in its last column."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & ~F.col("value").startswith("@"))
    f = lines.select(F.split("value", "\t").alias("_f")).where(F.size("_f") >= 2)
    return f.select(F.col("_f")[0].alias("cluster"), F.expr("try_cast(element_at(_f, -1) as double)").alias("abundance"))


def read_marker_hits(spark: SparkSession, path: str) -> DataFrame:
    """(marker, n_reads) of read-to-marker lines: the last line of a read counts."""
    lines = spark.read.text(path).where(~F.col("value").startswith("@")).withColumn("line", F.monotonically_increasing_id())
    f = lines.select("line", F.split("value", "\t").alias("_f")).where(F.size("_f") >= 2)
    last = f.groupBy(F.col("_f")[0].alias("read")).agg(F.max_by(F.col("_f")[1], F.col("line")).alias("marker"))
    return last.groupBy("marker").agg(F.count("*").alias("n_reads"))


def parsed_accessions(text: DataFrame) -> DataFrame:
    """(accession, taxid) of XML batches of document summaries (column value)."""
    pairs = F.arrays_zip(F.expr("xpath(value, '//DocSum/Item[@Name=\"AccessionVersion\"]/text()')").alias("accession"), F.expr("xpath(value, '//DocSum/Item[@Name=\"TaxId\"]/text()')").alias("taxid"))
    return text.select(F.explode(pairs).alias("p")).select("p.accession", F.col("p.taxid").cast("long").alias("taxid"))


def database_tables(content: bytes, version: str = "2018", names: dict[str, str] | None = None) -> tuple[str, str]:
    """(markers, taxonomy) as JSON texts of a marker database: a bzip2-packed pickle of trusted origin.

    Version 2018 renames markers by ``names`` (a marker without a new name is an error) and has genome lengths as taxonomy
    values; 0000 is the same without renaming; 2019 has pairs of taxids and lengths.
    """
    found = pickle.loads(bz2.decompress(content))
    markers, taxonomy = found["markers"], found["taxonomy"]
    if version == "2018" and names is not None:
        markers = {names[k]: v for k, v in markers.items()}
    elif version not in ("2018", "0000", "2019"):
        raise ValueError(f"no such database version: {version}")
    if version == "2019":
        entries = {k: {"taxid": v[0], "genoLen": v[1]} for k, v in taxonomy.items()}
    else:
        entries = {k: {"genoLen": v} for k, v in taxonomy.items()}
    return marker_json(markers), marker_json(entries)


def marker_json(database: dict) -> str:
    """JSON of a marker database as scripts hold it (sets become sorted lists); for converting one once."""

    def plain(value):
        if isinstance(value, dict):
            return {k: plain(v) for k, v in value.items()}
        if isinstance(value, (set, frozenset)):
            return sorted(value)
        if isinstance(value, Iterable) and not isinstance(value, str):
            return [plain(v) for v in value]
        return value

    return json.dumps(plain(database), sort_keys=True)
