"""Roll-ups over taxonomies that are given as parent links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import RANKS
from ..storage import dropped, stored


def current_taxids(frame: DataFrame, merged: DataFrame) -> DataFrame:
    """Replaces taxids that were merged into others."""
    table = merged.select(F.col("old").alias("taxid"), F.col("new").alias("_new"))
    return frame.join(table, "taxid", "left").withColumn("taxid", F.coalesce("_new", "taxid")).drop("_new")


def lineages(taxids: DataFrame, nodes: DataFrame) -> DataFrame:
    """(taxid, step, ancestor, rank) from each taxid (step 0) to the root, the root excluded.

    Steps are joined until no ancestor is left, however deep the taxonomy; each is stored, so none is computed again.
    Parent links that lead round in a circle are an error.
    """
    links = nodes.select(F.col("taxid").alias("ancestor"), "parent", "rank")
    current = taxids.select("taxid", F.col("taxid").alias("ancestor")).distinct()
    most, out, step = None, None, 0
    while True:
        level = stored(current.join(links, "ancestor").where("ancestor != parent"), "lineage")
        if out is not None and not level.take(1):
            dropped(level)
            return out
        rows = level.select("taxid", F.lit(step).alias("step"), "ancestor", "rank")
        out = rows if out is None else out.unionByName(rows)
        current, step = level.select("taxid", F.col("parent").alias("ancestor")), step + 1
        if step % 64 == 0:
            most = nodes.count() if most is None else most
            if step > most:
                raise ValueError("parent links lead round in a circle")


def ranked_lineages(paths: DataFrame, ranks: list[str] | None = None) -> DataFrame:
    """Only ancestors at wanted ranks; what hung on others hangs on the next wanted one."""
    return paths.where(F.col("rank").isin(ranks or RANKS))


def rolled_by_rank(profile: DataFrame, paths: DataFrame, ranks: list[str] | None = None) -> DataFrame:
    """(sample, taxid, rank, abundance): each taxid's abundance in all its ancestors at wanted ranks."""
    own = profile.join(ranked_lineages(paths, ranks), "taxid")
    return own.groupBy("sample", F.col("ancestor").alias("taxid"), "rank").agg(F.sum("abundance").alias("abundance"))


def common_lineage(paths: DataFrame, group: str) -> DataFrame:
    """(group, level, taxid): the longest common beginning of the lineages (columns group, member, level, taxid) of a group."""
    members = paths.groupBy(group).agg(F.count_distinct("member").alias("members"))
    levels = paths.groupBy(group, "level").agg(F.count_distinct("member").alias("n"), F.min("taxid").alias("taxid"), F.max("taxid").alias("other"))
    joined = levels.join(members, group)
    broken = joined.where("n < members or taxid != other").groupBy(group).agg(F.min("level").alias("stop"))
    return joined.join(broken, group, "left").where(F.col("stop").isNull() | (F.col("level") < F.col("stop"))).select(group, "level", "taxid")


def guessed_taxids(clades: DataFrame, names: DataFrame) -> DataFrame:
    """(name, rank, taxid) of names (columns name, rank) that one taxid has at their rank; others give no row."""
    found = clades.join(names, ["name", "rank"]).groupBy("name", "rank").agg(F.count_distinct("taxid").alias("n"), F.min("taxid").alias("taxid"))
    return found.where("n = 1").drop("n")


def ambiguous_names(clades: DataFrame, names: DataFrame) -> DataFrame:
    """(name, rank, n) of names that several taxids have."""
    return clades.join(names, ["name", "rank"]).groupBy("name", "rank").agg(F.count_distinct("taxid").alias("n")).where("n > 1")


def summed_by_taxid(profile: DataFrame, ids: DataFrame) -> DataFrame:
    """(sample, taxid, abundance) by the taxid of each cluster, "-1" where none is known."""
    joined = profile.join(ids.select("cluster", "taxid"), "cluster", "left")
    return joined.groupBy("sample", F.coalesce("taxid", F.lit("-1")).alias("taxid")).agg(F.sum("abundance").alias("abundance"))


def rolled_by_annotation(profile: DataFrame, annotation: DataFrame, level: str) -> DataFrame:
    """(sample, taxon, abundance) of genes' abundances by a column of their annotation (phylum, genus or species)."""
    return profile.join(annotation.select("cluster", F.col(level).alias("taxon")), "cluster").groupBy("sample", "taxon").agg(F.sum("abundance").alias("abundance"))


def repaired(profile: DataFrame, lengths: DataFrame) -> DataFrame:
    """Abundances of 0 are computed again from count and length; relative ones then add up to 100 over all rows."""
    joined = profile.join(lengths, "cluster", "left")
    own = F.when((F.col("abundance") == 0) & (F.col("length") > 0), F.col("recal_count") / F.col("length")).otherwise(F.col("abundance"))
    fixed = joined.withColumn("abundance", own).drop("length", "rel_abun")
    total = fixed.groupBy("sample").agg(F.sum("abundance").alias("_total"))
    return fixed.join(total, "sample").withColumn("rel_abun", F.when(F.col("_total") > 0, F.col("abundance") / F.col("_total") * 100).otherwise(F.lit(0.0))).drop("_total")
