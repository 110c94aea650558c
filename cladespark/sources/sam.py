"""SAM text and tables of samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import alignment as al
from ..sizes import small

_FIELDS = {"qname": "string", "flag": "int", "rname": "string", "pos": "int", "mapq": "int", "cigar": "string", "rnext": "string", "pnext": "int", "tlen": "int", "seq": "string", "qual": "string"}


def split_paths(text: str) -> list[str]:
    """Comma-separated paths; commas inside braces belong to a pattern."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "{") - (c == "}")
        if c == "," and not depth:
            out.append(text[start:i])
            start = i + 1
    return [p for p in [*out, text[start:]] if p]


def parsed_sam(lines: DataFrame, keep_unmapped: bool = False) -> DataFrame:
    """Alignments from a column ``value`` of SAM lines; header lines and (by default) unmapped records go.

    Lines with fewer than the eleven fields or with numbers that can't be read are left out.
    """
    kept = lines.where(~al.is_header(F.col("value"))).withColumn("_f", F.split("value", "\t")).where(F.size("_f") >= 11)
    tags = F.expr("""map_from_entries(transform(array_distinct(transform(filter(slice(_f, 12, greatest(size(_f) - 11, 0)), t -> length(t) >= 5), t -> substring(t, 1, 2))),
        k -> named_struct('key', k, 'value', filter(transform(filter(slice(_f, 12, greatest(size(_f) - 11, 0)), t -> startswith(t, concat(k, ':'))), t -> substring(t, 6)), v -> true)[0])))""")
    fields = [(F.expr(f"try_cast(_f[{i}] as int)") if kind == "int" else F.col("_f")[i]).alias(name) for i, (name, kind) in enumerate(_FIELDS.items())]
    rest = [c for c in lines.columns if c != "value"]
    out = kept.select(*rest, *fields, tags.alias("tags")).where("flag is not null and pos is not null and mapq is not null")
    out = out.withColumns({"md": F.col("tags")["MD"], "rg": F.col("tags")["RG"]})
    return out if keep_unmapped else out.where(al.is_mapped(F.col("flag")))


def read_sam(spark: SparkSession, paths: str | list[str], keep_unmapped: bool = False) -> DataFrame:
    """Alignments of SAM files, with their file and the sample of their read group; files are split as Spark likes."""
    paths = split_paths(paths) if isinstance(paths, str) else paths
    lines = spark.read.text(paths).withColumn("file", F.col("_metadata.file_path"))
    return parsed_sam(lines, keep_unmapped).withColumn("sample", al.sample_tag(F.col("rg")))


def sam_samples(spark: SparkSession, path: str) -> DataFrame:
    """(rg, sm, path, sample_id) of a list with exactly three columns; ids are dense by first appearance."""
    rows = spark.read.text(path).withColumn("line", F.monotonically_increasing_id()).withColumn("_f", F.split("value", "\t")).where(F.size("_f") == 3)
    named = rows.select(F.col("_f")[0].alias("rg"), F.col("_f")[1].alias("sm"), F.col("_f")[2].alias("path"), "line")
    first = named.groupBy("sm").agg(F.min("line").alias("first"))
    ids = first.select("sm", F.expr("cast(row_number() over (order by first) - 1 as int)").alias("sample_id"))
    return named.drop("line").join(small(ids), "sm").select("rg", "sm", "path", "sample_id")


def with_listed_sample(alignments: DataFrame, samples: DataFrame) -> DataFrame:
    """Samples by file name (its last part, exactly) instead of read group; files that aren't listed go."""
    base = lambda c: F.element_at(F.split(c, "/"), -1)
    table = samples.select(base(F.col("path")).alias("_base"), F.col("sm").alias("_sm"), "sample_id")
    return alignments.withColumn("_base", base(F.col("file"))).join(small(table), "_base").withColumn("sample", F.col("_sm")).drop("_base", "_sm")


def dictionary(genes: DataFrame) -> DataFrame:
    """Header lines of a reference dictionary: one @SQ line for each gene."""
    return genes.select(F.concat(F.lit("@SQ\tSN:"), "gene", F.lit("\tLN:"), F.col("length").cast("string")).alias("value"))
