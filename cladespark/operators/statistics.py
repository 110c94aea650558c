"""The seven robust statistics of a clade's markers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATISTICS = ("avg_g", "avg_l", "tavg_g", "tavg_l", "wavg_g", "wavg_l", "med")
#: Share of markers that is trimmed at either end.
QUANTILE = 0.1


def gene_trimmed_average(genes: DataFrame, quantile: float = QUANTILE, least_nonzero: float = 0.7) -> DataFrame:
    """(sample, cluster, raw_count, recal_count, abundance) of a gene catalogue's clusters.

    Rows are genes (sample, cluster, gene, len, reads, weight).  Genes are trimmed at both ends by weight per base (ties by name);
    what is left gives the counts, and their weight by their bases the abundance.  A cluster whose name begins with t or holds _sp
    has nothing where fewer than ``least_nonzero`` of its genes have reads. Genes without a length come first.
    """
    ranked = genes.selectExpr(
        "sample", "cluster", "len", "reads", "weight",
        "count(*) over (partition by sample, cluster) as n",
        "row_number() over (partition by sample, cluster order by if(len > 0, weight / len, -1D), gene) - 1 as at",
    )
    kept = F.expr(f"at >= floor({quantile}D * n) and at < n - floor({quantile}D * n)")
    sums = ranked.groupBy("sample", "cluster").agg(
        F.max("n").alias("n"), F.count_if(F.col("reads") > 0).alias("nonzero"),
        *[F.sum(F.when(kept, F.col(c)).otherwise(F.lit(0))).alias(c) for c in ("len", "reads", "weight")],
    )
    strict = F.col("cluster").startswith("t") | F.col("cluster").contains("_sp")
    nothing = strict & (F.col("nonzero") < F.lit(least_nonzero) * F.col("n"))
    return sums.select(
        "sample", "cluster",
        F.when(nothing, 0).otherwise(F.col("reads")).cast("long").alias("raw_count"),
        F.when(nothing, 0.0).otherwise(F.col("weight")).cast("double").alias("recal_count"),
        F.when(nothing | (F.col("len") <= 0), 0.0).otherwise(F.col("weight") / F.col("len")).alias("abundance"),
    )


def clade_statistics(markers: DataFrame, keys: list[str], quantile: float = QUANTILE) -> DataFrame:
    """Adds up the markers (columns marker, len, reads) of each group: n, len_sum, read_sum, nonzero and all statistics.

    Trimming takes markers by reads per base, winsorising of ``wavg_g`` by reads; ties go by marker.
    Where nothing would be trimmed, trimmed and winsorised statistics are the plain ones.
    """
    by = ", ".join(keys)
    ranked = markers.selectExpr(
        *keys, "marker", "cast(len as double) as len", "cast(reads as double) as reads", "cast(reads as double) / len as ratio",
        f"cast(count(*) over (partition by {by}) as int) as n",
        f"cast(row_number() over (partition by {by} order by cast(reads as double) / len, marker) - 1 as int) as by_ratio",
        f"cast(row_number() over (partition by {by} order by reads, marker) - 1 as int) as by_reads",
    )
    cut = ranked.withColumn("l", F.floor(F.lit(quantile) * F.col("n")).cast("int")).withColumn("r", F.expr("n - l - 1"))
    kept, kept_reads = "by_ratio between l and r", "by_reads between l and r"
    sums = cut.groupBy(*keys).agg(
        F.max("n").alias("n"), F.max("l").alias("l"),
        F.sum("len").alias("len_sum"), F.sum("reads").alias("read_sum"), F.sum("ratio").alias("ratio_sum"),
        F.count_if(F.col("reads") > 0).alias("nonzero"),
        F.sum(F.expr(f"if({kept}, len, 0D)")).alias("t_len"), F.sum(F.expr(f"if({kept}, reads, 0D)")).alias("t_reads"), F.sum(F.expr(f"if({kept}, ratio, 0D)")).alias("t_ratio"),
        F.sum(F.expr(f"if({kept_reads}, reads, 0D)")).alias("w_reads"),
        F.max(F.expr("if(by_reads = l, reads, null)")).alias("low_reads"), F.max(F.expr("if(by_reads = r, reads, null)")).alias("high_reads"),
        F.max(F.expr("if(by_ratio = l, ratio, null)")).alias("low_ratio"), F.max(F.expr("if(by_ratio = r, ratio, null)")).alias("high_ratio"),
        F.avg(F.expr("if(by_ratio = l + (n - 2 * l) div 2 or ((n - 2 * l) % 2 = 0 and by_ratio = l + (n - 2 * l) div 2 - 1), ratio, null)")).alias("med"),
    )
    return sums.selectExpr(
        *keys, "n", "len_sum", "read_sum", "nonzero",
        "if(len_sum > 0, read_sum / len_sum, 0D) as avg_g",
        "if(len_sum > 0, ratio_sum / n, 0D) as avg_l",
        "if(len_sum > 0, if(l = 0, read_sum / len_sum, if(t_len > 0, t_reads / t_len, 0D)), 0D) as tavg_g",
        "if(len_sum > 0, if(l = 0, ratio_sum / n, t_ratio / (n - 2 * l)), 0D) as tavg_l",
        "if(len_sum > 0, if(l = 0, read_sum / len_sum, (low_reads * l + high_reads * l + w_reads) / len_sum), 0D) as wavg_g",
        "if(len_sum > 0, if(l = 0, ratio_sum / n, (low_ratio * l + high_ratio * l + t_ratio) / n), 0D) as wavg_l",
        "if(len_sum > 0, med, 0D) as med",
    )
