"""Clade abundance over a taxonomy, set by set instead of node by node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import next_letter
from ..schemas import KINGDOMS
from ..storage import stored
from .statistics import clade_statistics

#: Markers kept at least, share of non-zero markers from which a marker of another clade is discarded, and that a strain needs.
LEAST_KEPT, DISCARD_SHARE, STRAIN_SHARE = 10, 0.33, 0.7
#: Bases of markers from which a clade's own statistic counts.
MIN_MARKER_LEN = 2000


def levels_of(clades: DataFrame) -> int:
    """Depth of the deepest clade: one number."""
    return clades.agg(F.max("depth")).first()[0] or 0


def clade_tree(taxonomy: DataFrame) -> DataFrame:
    """(clade, parent, depth, kingdom, path, n_children, has_sp) from lineages: one node a name."""
    parts = taxonomy.select(F.split("lineage", r"\|").alias("parts"))
    nodes = parts.select(F.posexplode("parts").alias("at", "clade"), "parts")
    nodes = nodes.select("clade", F.when(F.col("at") > 0, F.expr("parts[at - 1]")).alias("parent"), (F.col("at") + 1).alias("depth"), F.expr("parts[0]").alias("kingdom"), F.expr("array_join(slice(parts, 1, at + 1), '|')").alias("path"))
    nodes = nodes.groupBy("clade").agg(F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("kingdom").alias("kingdom"), F.min("path").alias("path"))
    children = nodes.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "clade")
    return nodes.join(children, "clade", "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0).cast("long")), "has_sp": F.col("clade").contains("_sp")})


def terminals(clades: DataFrame) -> DataFrame:
    """(clade, terminal): where chains of only children lead.

    Each round doubles the steps that are taken, so chains as long as the deepest lineage take its logarithm in rounds.
    """
    child = clades.where("parent is not null").groupBy("parent").agg(F.min("clade").alias("next"), F.count("*").alias("n")).where("n = 1")
    hops = clades.select("clade").join(child.select(F.col("parent").alias("clade"), "next"), "clade", "left").select("clade", F.coalesce("next", "clade").alias("terminal"))
    for _ in range(max(0, levels_of(clades) - 2).bit_length()):
        on = hops.select(F.col("clade").alias("terminal"), F.col("terminal").alias("next"))
        hops = stored(hops.join(on, "terminal").select("clade", F.col("next").alias("terminal")), "hops")
    return hops


def seeded(counts: DataFrame, markers: DataFrame, placed: DataFrame) -> DataFrame:
    """(sample, clade, marker, len, ext, reads): markers with their counts, zeros for those not seen.

    Markers are put at their clade's terminal.  Only clades that a sample has reads in are seeded: a clade without
    any has abundance 0 and never causes a discard.
    """
    own = markers.join(placed, "clade").select("marker", F.col("terminal").alias("clade"), "len", "ext")
    hit = counts.where("reads > 0").join(own.select("marker", "clade"), "marker")
    cells = hit.select("sample", "clade").distinct()
    return cells.join(own, "clade").join(counts.select("sample", "marker", "reads"), ["sample", "marker"], "left").withColumn("reads", F.coalesce("reads", F.lit(0)))


def nonzero_ratio(cells: DataFrame) -> DataFrame:
    """(sample, clade, n_markers, n_nonzero, ratio) over all of a clade's markers."""
    return cells.groupBy("sample", "clade").agg(F.count("*").alias("n_markers"), F.count_if(F.col("reads") > 0).alias("n_nonzero"), (F.count_if(F.col("reads") > 0) / F.count("*")).alias("ratio"))


def with_discards(cells: DataFrame, clades: DataFrame, placed: DataFrame, share: float = DISCARD_SHARE) -> DataFrame:
    """Adds ``discard``: whether another clade that the marker also occurs in is likely to be present.

    For each strain in ``ext`` its parent's terminal is looked at; more than ``share`` of non-zero markers there discards.
    """
    present = nonzero_ratio(cells).where(F.col("ratio") > share).select("sample", F.col("clade").alias("other"))
    looked = clades.where("parent is not null").select(F.col("clade").alias("strain"), F.col("parent").alias("clade")).join(placed, "clade").select("strain", F.col("terminal").alias("other"))
    hits = cells.select("sample", "marker", F.explode("ext").alias("strain")).join(looked, "strain").join(present, ["sample", "other"])
    flagged = hits.select("sample", "marker").distinct().withColumn("discard", F.lit(True))
    return cells.join(flagged, ["sample", "marker"], "left").withColumn("discard", F.coalesce("discard", F.lit(False)))


def refilled(cells: DataFrame, clades: DataFrame, least: int = LEAST_KEPT) -> DataFrame:
    """The markers that count: kept ones, and discarded ones by name up to ``least`` (none for single terminals and viruses)."""
    single = clades.select("clade", "kingdom", "n_children")
    joined = cells.join(single, "clade", "left")
    ranked = joined.selectExpr(
        "*",
        "count_if(not discard) over (partition by sample, clade) as n_kept",
        "row_number() over (partition by sample, clade, discard order by marker) as rn",
    )
    # markers stand at terminals, which have no child or several; the former are single terminals
    need = F.when((F.col("n_children") == 0) | (F.col("kingdom") == "k__Viruses"), 0).otherwise(least)
    kept = ranked.where(~F.col("discard") | (F.col("rn") <= need - F.col("n_kept")))
    return kept.select("sample", "clade", "marker", "len", "reads", "discard")


def local_abundance(used: DataFrame, clades: DataFrame, statistic: str = "tavg_g", share: float = STRAIN_SHARE) -> DataFrame:
    """(sample, clade, local, len_sum, read_sum): the statistic, 0 for strains with too few non-zero markers."""
    stats = clade_statistics(used, ["sample", "clade"])
    parents = clades.select(F.col("clade").alias("parent"), F.col("n_children").alias("n_siblings"), F.col("has_sp").alias("parent_sp"))
    about = clades.select("clade", "parent", "kingdom").join(parents, "parent", "left")
    joined = stats.join(about, "clade")
    gated = F.col("clade").startswith("t") & (F.coalesce(F.col("n_siblings") > 1, F.lit(False)) | F.coalesce("parent_sp", F.lit(False)) | (F.col("kingdom") == "k__Viruses")) & (F.col("nonzero") / F.col("n") < share)
    return joined.select("sample", "clade", F.when(gated, 0.0).otherwise(F.col(statistic)).alias("local"), "len_sum", "read_sum")


def rolled_up(local: DataFrame, clades: DataFrame, min_len: int = MIN_MARKER_LEN) -> DataFrame:
    """(sample, clade, depth, abundance, child_sum, unclassified, read_sum) from the leaves up, a level at a time.

    Each level is stored, so that no level is computed again for those above it.
    A clade with children has the greater of its own statistic and its children's sum, or that sum alone if
    its markers have fewer than ``min_len`` bases. What it has beyond its children is unclassified.
    """
    clades, local = stored(clades, "clades"), stored(local, "local")
    about = clades.select("clade", "parent", "depth", "n_children")
    done: list[DataFrame] = []
    below: DataFrame | None = None
    for depth in range(max(1, levels_of(clades)), 0, -1):
        level = about.where(F.col("depth") == depth)
        own = local.join(level, "clade")
        if below is None:
            frame = own.withColumn("child_sum", F.lit(0.0))
        else:
            sums = below.groupBy("sample", F.col("parent").alias("clade")).agg(F.sum("abundance").alias("child_sum"))
            only = sums.join(level, "clade")
            frame = own.select("sample", "clade", "local", "len_sum", "read_sum").join(only.select("sample", "clade", "child_sum"), ["sample", "clade"], "full_outer").join(level, "clade")
        frame = frame.withColumns({"local": F.coalesce("local", F.lit(0.0)), "len_sum": F.coalesce("len_sum", F.lit(0.0)), "read_sum": F.coalesce("read_sum", F.lit(0.0)), "child_sum": F.coalesce("child_sum", F.lit(0.0))})
        abundance = F.when(F.col("n_children") == 0, F.col("local")).when(F.col("len_sum") < min_len, F.col("child_sum")).otherwise(F.greatest("local", "child_sum"))
        frame = stored(frame.withColumn("abundance", abundance), "level")
        below = frame
        excess = F.when((F.col("n_children") > 0) & (F.col("abundance") > F.col("child_sum")), F.col("abundance") - F.col("child_sum")).otherwise(F.lit(0.0))
        done.append(frame.select("sample", "clade", "depth", "n_children", "abundance", "child_sum", excess.alias("unclassified"), "read_sum"))
    out = done[0]
    for frame in done[1:]:
        out = out.unionByName(frame)
    return out


def emitted(rolled: DataFrame, clades: DataFrame, level: str = "a", kingdoms: list[str] | None = None) -> DataFrame:
    """(sample, cluster, read_sum, abundance, rel_abun): rows of all ranks with those for what is unclassified.

    ``level`` is "a" for all ranks, or a rank's letter for this rank and one row for the remainder.
    """
    kingdoms = KINGDOMS if kingdoms is None else kingdoms
    totals = rolled.where(F.col("clade").isin(kingdoms)).groupBy("sample").agg(F.sum("abundance").alias("total")).where("total > 0")
    child = clades.where("parent is not null").groupBy("parent").agg(F.min(F.substring("clade", 1, 3)).alias("child_prefix")).withColumnRenamed("parent", "clade")
    rows = rolled.join(totals, "sample").join(clades.select("clade", "path"), "clade").join(child, "clade", "left")
    if level != "a":
        rows = rows.where(F.col("clade").startswith(f"{level}__"))
    rel = lambda value: (F.col(value) / F.col("total") * 100).alias("rel_abun")
    named = rows.where("abundance > 0").select("sample", F.col("path").alias("cluster"), "read_sum", "abundance", rel("abundance"))
    rest_name = F.concat("path", F.lit("|"), "child_prefix", F.expr("substring(clade, 4)"), F.lit("_unclassified"))
    rest = rows.where("unclassified > 0").select("sample", rest_name.alias("cluster"), F.lit(0.0).alias("read_sum"), F.col("unclassified").alias("abundance"), rel("unclassified"))
    out = named.unionByName(rest)
    if level == "a":
        leaf = rows.where("n_children = 0 and abundance > 0").where(~F.substring("clade", 1, 1).isin("s", "t"))
        name = F.concat("path", F.lit("|"), next_letter(F.substring("clade", 1, 1)), F.expr("substring(clade, 2)"), F.lit("_unclassified"))
        return out.unionByName(leaf.select("sample", name.alias("cluster"), "read_sum", "abundance", rel("abundance")))
    known = out.groupBy("sample").agg(F.sum("rel_abun").alias("known"))
    left = totals.select("sample").join(known, "sample", "left").select("sample", F.lit(f"{level}__unclassified").alias("cluster"), F.lit(0.0).alias("read_sum"), F.lit(0.0).alias("abundance"), (100 - F.coalesce("known", F.lit(0.0))).alias("rel_abun"))
    return out.unionByName(left)


def genome_lengths(taxonomy: DataFrame, clades: DataFrame) -> DataFrame:
    """(clade, geno_len): given for leaves, the mean of the children above them. Each level is stored."""
    given = taxonomy.select(F.element_at(F.split("lineage", r"\|"), -1).alias("clade"), F.col("geno_len").cast("double").alias("given")).groupBy("clade").agg(F.max("given").alias("given"))
    about = stored(clades.select("clade", "parent", "depth").join(given, "clade", "left"), "lengths")
    out, below = None, None
    for depth in range(max(1, levels_of(about)), 0, -1):
        frame = about.where(F.col("depth") == depth).select("clade", "parent", F.col("given").alias("geno_len"))
        if below is not None:
            means = below.groupBy(F.col("parent").alias("clade")).agg(F.avg("geno_len").alias("mean"))
            frame = frame.join(means, "clade", "left").select("clade", "parent", F.coalesce("mean", "geno_len").alias("geno_len"))
        below = stored(frame, "lengths")
        out = below if out is None else out.unionByName(below)
    return out.select("clade", "geno_len")


def estimated_reads(rolled: DataFrame, clades: DataFrame, lengths: DataFrame) -> DataFrame:
    """(sample, clade, est_reads): floor(abundance * genome length) for species, the sum of the species below above them.

    Sums go up by each species' ancestors, which are the parts of its path, so one shuffle does for all levels.
    """
    species = rolled.where(F.col("clade").startswith("s__")).select("sample", "clade", "abundance")
    own = species.join(lengths, "clade", "left").select("sample", "clade", F.floor(F.col("abundance") * F.coalesce("geno_len", F.lit(0.0))).cast("long").alias("est_reads"))
    above = clades.where(F.col("clade").startswith("s__")).select("clade", F.explode(F.split("path", r"\|")).alias("ancestor"))
    return own.join(above, "clade").groupBy("sample", F.col("ancestor").alias("clade")).agg(F.sum("est_reads").alias("est_reads"))
