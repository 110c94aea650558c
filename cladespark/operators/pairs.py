"""Read pairs: putting mates together and counting them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import alignment as al
from ..functions.gc import BUILTIN, gc_weight, pair_weight


def _end(flag_test, columns: list[str]):
    return F.max(F.when(flag_test, F.struct(*columns)))


def merged(alignments: DataFrame, columns: list[str]) -> DataFrame:
    """(sample, qname, r1, r2, paired, proper): records of one name as a pair, or as a single in r1.

    One first and one second record make a pair; one record alone is a single; any other number of
    records of a name drops it.
    """
    flag = F.col("flag")
    first, second = al.has(flag, al.FIRST), al.has(flag, al.SECOND)
    groups = alignments.groupBy("sample", "qname").agg(
        F.count("*").alias("n"),
        F.count_if(first).alias("n1"),
        F.count_if(second).alias("n2"),
        _end(first, columns).alias("e1"),
        _end(second, columns).alias("e2"),
        F.max(F.struct(*columns)).alias("only"),
        F.bool_and(al.has(flag, al.PROPER)).alias("all_proper"),
    )
    pair = (F.col("n") == 2) & (F.col("n1") == 1) & (F.col("n2") == 1)
    kept = groups.where(pair | (F.col("n") == 1))
    r1 = F.when(pair, F.col("e1")).otherwise(F.col("only"))
    r2 = F.when(pair, F.col("e2"))
    return kept.select("sample", "qname", r1.alias("r1"), r2.alias("r2"), pair.alias("paired"), (pair & F.col("all_proper")).alias("proper"))


def singles(alignments: DataFrame) -> DataFrame:
    """Records whose name occurs once in its sample."""
    names = alignments.groupBy("sample", "qname").agg(F.count("*").alias("n")).where("n = 1").drop("n")
    return alignments.join(names, ["sample", "qname"], "left_semi")


def mated_reads(reads: DataFrame) -> DataFrame:
    """FASTQ mates by sample and name: seq1, qual1, seq2, qual2; a name with a mate twice goes, orphans stay."""
    by = reads.groupBy("sample_id", "rg", "sm", "read_name").agg(
        F.count_if(F.col("mate") == 1).alias("n1"),
        F.count_if(F.col("mate") == 2).alias("n2"),
        F.max(F.when(F.col("mate") == 1, F.struct("seq", "qual"))).alias("a"),
        F.max(F.when(F.col("mate") == 2, F.struct("seq", "qual"))).alias("b"),
    )
    ok = by.where("n1 <= 1 and n2 <= 1")
    return ok.select("sample_id", "rg", "sm", "read_name", F.col("a.seq").alias("seq1"), F.col("a.qual").alias("qual1"), F.col("b.seq").alias("seq2"), F.col("b.qual").alias("qual2"))


def with_good_ends(pairs: DataFrame, min_identity: float = 0.8, min_align_len: int = 30) -> DataFrame:
    """Ends of low identity or length become null and their pair isn't proper; rows without ends go."""
    good = lambda e: (al.identity(F.col(f"{e}.cigar"), F.col(f"{e}.md")) >= min_identity) & (al.align_len(F.col(f"{e}.cigar")) >= min_align_len)
    kept = pairs.withColumns({"r1": F.when(good("r1"), F.col("r1")), "r2": F.when(good("r2"), F.col("r2"))})
    both = F.col("r1").isNotNull() & F.col("r2").isNotNull()
    return kept.where("r1 is not null or r2 is not null").withColumns({"proper": F.col("proper") & both, "paired": F.col("paired") & both})


def pair_clusters(pairs: DataFrame, level: str = "species", mean: float = 300, tolerance: float = 100) -> DataFrame:
    """(sample, cluster) for each count of a pair, whose ends have species, rname, flag, pos, read_len and gene_len.

    A proper pair counts once; so does another pair within one species at the level of species; else
    each end counts that lies near its gene's end. Ends that are alone count nothing.
    """
    return _counts_of_pairs(pairs, level, mean, tolerance).select("sample", "cluster")


def weighted_counts(pairs: DataFrame, level: str = "species", mean: float = 300, tolerance: float = 100, p: tuple[float, ...] = BUILTIN) -> DataFrame:
    """(sample, cluster, raw_count, recal_count) with GC weights; ends also have read_gc (percent) and genome_gc.

    A pair that counts once is weighted by the mean of its ends' GC, an end that counts by itself by its own.
    """
    weights = F.when(F.col("once"), pair_weight(F.col("r1.read_gc"), F.col("r2.read_gc"), F.col("r1.genome_gc"), p))
    for k in ("r1", "r2"):
        weights = weights.when(F.col("end") == k, gc_weight(F.col(f"{k}.read_gc"), F.col(f"{k}.genome_gc"), p))
    counted = _counts_of_pairs(pairs, level, mean, tolerance).withColumn("weight", weights)
    return counted.groupBy("sample", "cluster").agg(F.count("*").alias("raw_count"), F.sum(F.coalesce("weight", F.lit(0.0))).alias("recal_count"))


def _counts_of_pairs(pairs: DataFrame, level: str, mean: float, tolerance: float) -> DataFrame:
    """The pairs' rows once for each count, with cluster, once (whether the pair counts as one) and end (r1 or r2)."""
    name = "species" if level == "species" else "rname"
    end = lambda e: F.when(al.near_gene_end(F.col(f"{e}.flag"), F.col(f"{e}.pos"), F.col(f"{e}.read_len"), F.col(f"{e}.gene_len"), mean, tolerance), F.col(f"{e}.{name}"))
    once = F.col("proper")
    if level == "species":
        once = once | (F.col("paired") & (F.col("r1.species") == F.col("r2.species")))
    one = lambda e, cluster: F.struct(F.lit(e).alias("end"), cluster.alias("cluster"))
    counts = F.when(once, F.array(one("r1", F.col(f"r1.{name}")))).when(F.col("paired"), F.filter(F.array(one("r1", end("r1")), one("r2", end("r2"))), lambda x: x["cluster"].isNotNull()))
    return pairs.select("*", once.alias("once"), F.explode(counts).alias("c")).select(*pairs.columns, "once", "c.end", "c.cluster")


def insert_sizes(pairs: DataFrame) -> DataFrame:
    """(insert_size, n) over proper pairs."""
    return pairs.where("proper").groupBy(F.abs(F.col("r1.tlen")).cast("int").alias("insert_size")).agg(F.count("*").alias("n"))


def fitted_insert_size(histogram: DataFrame) -> tuple[int, int]:
    """(mean, tolerance) of a Gauss curve guessed from a histogram: its mode, and twice the spread of its half height.

    The histogram stays where it is; four numbers come to the driver.
    """
    top = histogram.agg(F.max(F.struct("n", (-F.col("insert_size")).alias("less"))).alias("m")).first()["m"]
    if top is None:
        return 300, 100
    high = histogram.where(F.col("n") >= top["n"] / 2).agg(F.min("insert_size").alias("low"), F.max("insert_size").alias("high")).first()
    sigma = max(1.0, (high["high"] - high["low"]) / (2 * math.sqrt(2 * math.log(2))))
    return int(-top["less"]), 2 * int(sigma)
