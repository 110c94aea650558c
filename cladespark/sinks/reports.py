"""Profiles as files: one folder a sample, in the layouts that readers expect."""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.gc import FORMULA, GcModel
from ..functions.lineage import rank_level

#: Columns of each layout.
LAYOUTS = {
    "default": ["cluster", "rel_abun"],
    "detailed": ["cluster", "raw_count", "recal_count", "abundance", "rel_abun"],
    "cami": ["taxid", "rank", "taxpath", "cluster", "rel_abun"],
    "evaluation": ["cluster", "raw_count", "recal_count", "abundance", "rel_abun", "names"],
}


def formatted(profile: DataFrame, layout: str = "default") -> DataFrame:
    """(sample, line): tab-separated columns of a layout."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in LAYOUTS[layout]]
    return profile.select("sample", F.concat_ws("\t", *columns).alias("line"))


def write_profiles(profile: DataFrame, path: str, layout: str = "default", header: bool = False, parts: int = 4) -> str:
    """Writes text under ``path/sample=<name>``, anew; returns the path that was written.

    A sample's rows are dealt to at most ``parts`` tasks and files, so a sample with most rows doesn't hang on one.
    """
    lines = formatted(profile, layout)
    if header:
        names = profile.select("sample").distinct().select("sample", F.lit("#" + "\t".join(LAYOUTS[layout])).alias("line"))
        lines = names.unionByName(lines)
    lines.repartition("sample", F.pmod(F.xxhash64("line"), F.lit(parts))).write.mode("overwrite").partitionBy("sample").text(path)
    return path


def named_files(spark: SparkSession, path: str, application: str) -> list[str]:
    """Renames what ``write_profiles`` wrote to one file a sample and part, as readers of such reports look for them.

    ``path/<application>-Profiling-SAMPLE_<sample>.abundance``, with the part's number behind it where there are several.
    Only names are handled here, one for each file.
    """
    place = lambda *parts: spark._jvm.org.apache.hadoop.fs.Path(*parts)
    files, out = place(path).getFileSystem(spark._jsc.hadoopConfiguration()), []
    for folder in sorted((s.getPath() for s in files.listStatus(place(path)) if s.isDirectory()), key=lambda p: p.getName()):
        sample = unquote(folder.getName().partition("=")[2])
        parts = sorted(p.getPath().getName() for p in files.listStatus(folder) if p.getPath().getName().startswith("part-"))
        for k, name in enumerate(parts):
            target = f"{application}-Profiling-SAMPLE_{sample}.abundance" + (f".{k}" if len(parts) > 1 else "")
            if not files.rename(place(folder, name), place(path, target)):
                raise OSError(f"{target} can't be written")
            out.append(f"{path}/{target}")
        files.delete(folder, True)
    return out


def cami_rows(profile: DataFrame) -> DataFrame:
    """(sample, level, taxpathsn, line) of a CAMI report: six decimals, a # before taxids under 1."""
    sign = F.when(F.expr("try_cast(taxid as double) < 1"), F.lit("#")).otherwise(F.lit(""))
    line = F.concat(sign, F.concat_ws("\t", "taxid", "rank", "taxpath", "taxpathsn", F.format_string("%.6f", "percentage")))
    return profile.select("sample", rank_level(F.col("rank")).alias("level"), "taxpathsn", line.alias("line"))


def cami_header(sample: str, ranks: list[str]) -> list[str]:
    return [f"@SampleID:{sample}", "@Version:0.9.1", f"@Ranks:{'|'.join(ranks)}", "", "@@TAXID\tRANK\tTAXPATH\tTAXPATHSN\tPERCENTAGE"]


def write_cami(profile: DataFrame, path: str, sample: str, ranks: list[str]) -> str:
    """One sample's report, sorted by rank and name path under its header; a report has as many rows as taxa."""
    head = profile.sparkSession.createDataFrame([(k - 10, "", line) for k, line in enumerate(cami_header(sample, ranks))], "level int, taxpathsn string, line string")
    rows = cami_rows(profile.where(F.col("sample") == sample)).select("level", "taxpathsn", "line")
    head.unionByName(rows).orderBy("level", "taxpathsn").coalesce(1).select("line").write.mode("overwrite").text(path)
    return path


def write_taxid_abundances(profile: DataFrame, path: str) -> str:
    profile.select("taxid", "abundance").write.mode("overwrite").csv(path, sep="\t")
    return path


def write_sam_list(samples: DataFrame, path: str) -> str:
    """rg, sm and path, a line each; the list has a line a file."""
    samples.select(F.concat_ws("\t", "rg", "sm", "path").alias("line")).coalesce(1).write.mode("overwrite").text(path)
    return path


def write_table(frame: DataFrame, path: str) -> str:
    """Tab-separated rows (points for fitting, reference tables)."""
    frame.write.mode("overwrite").csv(path, sep="\t")
    return path


def model_json(model: GcModel) -> str:
    start = ",".join(f"p{k + 1}={v!r}" for k, v in enumerate(model.start))
    return json.dumps({"function": FORMULA, "coefficients": list(model.coefficients), "control": model.control, "startvalue": start}, indent=1)


def model_from_json(text: str) -> GcModel:
    found = json.loads(text)
    coefficients = tuple(float(x) for x in found["coefficients"])
    if len(coefficients) != 8:
        raise ValueError("a GC model has 8 coefficients")
    return GcModel(coefficients, found.get("control", GcModel().control))


def biom_json(tips: DataFrame) -> str:
    """A sparse BIOM-like JSON of tips by sample; the table has a row a tip and a column a sample."""
    rows = tips.select("sample", "cluster", "rel_abun").orderBy("cluster", "sample").collect()
    clusters, samples = sorted({r["cluster"] for r in rows}), sorted({r["sample"] for r in rows})
    data = [[clusters.index(r["cluster"]), samples.index(r["sample"]), r["rel_abun"]] for r in rows]
    return json.dumps({"format": "Biological Observation Matrix 1.0.0", "type": "OTU table", "matrix_type": "sparse", "shape": [len(clusters), len(samples)], "rows": [{"id": c, "metadata": None} for c in clusters], "columns": [{"id": s, "metadata": None} for s in samples], "data": data})


def percent(value: Column) -> Column:
    return F.format_string("%.6f", value)
