"""Gaps between hits along a reference, and what they say of a genome.

References are cut into ranges of ``RANGE`` positions, each of which is sorted by itself; what a range needs of those
before it is one row a range.  So a reference with a large share of all hits is spread over many tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Fixed: limits of the island filter.
LEAST_HITS, ISLAND_SHARE, CLOSE_GAP, CLOSE_SHARE, FEW_HITS, P_LIMIT, MANY_HITS = 5, 0.1, 10, 0.75, 200, 0.01, 5000
#: Positions of a range.
RANGE = 1 << 16


def position_gaps(hits: DataFrame, group: str, position: str) -> DataFrame:
    """Adds gap: distance to the hit before it in its group, null for the first.

    Hits with a null group or position have a null gap and are no others' hit before.
    """
    ranged = hits.withColumn("_range", F.floor(F.col(position) / RANGE))
    lasts = ranged.where(f"{position} is not null and {group} is not null").groupBy(group, "_range").agg(F.max(position).alias("_last"))
    before = lasts.selectExpr(group, "_range", f"lag(_last) over (partition by {group} order by _range) as _before")
    own = ranged.selectExpr("*", f"if({group} is null, null, lag({position}) over (partition by {group}, _range order by {position})) as _own")
    joined = own.join(before, [group, "_range"], "left")
    return joined.select(*hits.columns, (F.col(position) - F.coalesce("_own", "_before")).alias("gap"))


def gap_statistics(gaps: DataFrame, group: str) -> DataFrame:
    """(group, hits, mean_gap, var_gap, close_share, span): close_share are gaps under ``CLOSE_GAP`` by hits."""
    return gaps.groupBy(group).agg(F.count("*").alias("hits"), F.avg("gap").alias("mean_gap"), F.var_samp("gap").alias("var_gap"), (F.count_if(F.col("gap") < CLOSE_GAP) / F.count("*")).alias("close_share"), F.sum("gap").alias("span"))


def genome_sizes(statistics: DataFrame, group: str, mean_distance: str = "mean_distance") -> DataFrame:
    """(group, size, low, high): four times the mean pairwise circular distance, with the counting error of n hits."""
    n, d = F.col("hits").cast("double"), F.col(mean_distance)
    low = n / (n + 2 * F.sqrt(n)) * 4 * d
    high = F.when(n > 4, n / (n - 2 * F.sqrt(n)) * 4 * d)
    return statistics.select(group, (4 * d).alias("size"), low.alias("low"), high.alias("high"))


def mean_circular_distance(hits: DataFrame, group: str, position: str, length: str) -> DataFrame:
    """(group, hits, mean_distance) over pairs of hits on a circle, without forming pairs.

    Positions are folded on the circle and laid out twice.  For each hit of the second round the hits within half a
    circle behind it are what stands up to it less what stands before the edge half a circle back, so running sums at the hit and
    at its edge give their number and places.  Running sums are had by ranges; a group with one hit has a null mean.
    """
    by = hits.select(group, F.pmod(F.col(position).cast("double"), F.col(length).cast("double")).alias("x"), F.col(length).cast("double").alias("size")).where("x is not null and size > 0")
    # a hit's first round, its second round, and the edge half a circle behind the latter
    points = by.select(group, "size", F.explode(F.expr("array(named_struct('at', x, 'kind', 0), named_struct('at', x + size, 'kind', 1), named_struct('at', x + size / 2, 'kind', 2))")).alias("p")).select(group, "size", "p.at", "p.kind")
    points = points.withColumns({"w": F.when(F.col("kind") < 2, 1).otherwise(0), "_range": F.floor(F.col("at") / RANGE)})
    points = points.withColumn("v", F.col("at") * F.col("w"))
    whole = points.groupBy(group, "_range").agg(F.sum("w").alias("n"), F.sum("v").alias("s"))
    before = whole.selectExpr(group, "_range", *[f"coalesce(sum({c}) over (partition by {group} order by _range rows between unbounded preceding and 1 preceding), 0) as {c}0" for c in ("n", "s")])
    running = points.where("at is not null").selectExpr(
        "*",
        *[f"sum({c}) over (partition by {group}, _range order by at range between unbounded preceding and current row) as {c}1" for c in ("w", "v")],
        f"sum(w) over (partition by {group}, _range order by at range between current row and current row) as here",
    ).join(before, [group, "_range"])
    n, total = F.col("n0") + F.col("w1"), F.col("s0") + F.col("v1")
    # up to the hit; before the edge, where those at the edge itself are within half a circle
    hit = running.where("kind = 1").groupBy(group).agg(F.count("*").alias("hits"), F.max("size").alias("size"), F.sum(n * F.col("at") - total).alias("up"))
    half = F.col("at") + F.col("size") / 2
    edge = running.where("kind = 2").groupBy(group).agg(F.sum((n - F.col("here")) * half - (total - F.col("here") * F.col("at"))).alias("low"), F.sum("here").alias("opposite"))
    sums = hit.join(edge, group)
    # pairs exactly half a circle apart are seen from both ends; hits at one place see each other's way as 0
    way = F.col("up") - F.col("low") - F.col("opposite") * F.col("size") / 4
    return sums.select(group, "hits", (way / F.nullif(F.col("hits") * (F.col("hits") - 1) / 2, F.lit(0.0))).alias("mean_distance"))


def gc_normalised(hits: DataFrame, genomes: DataFrame, least: int = LEAST_HITS) -> DataFrame:
    """(species, reads, normalised, per_mb) by falling reads per million bases; species with fewer reads go. ``hits`` has species and coverage."""
    sums = hits.groupBy("species").agg(F.count("*").alias("reads"), F.sum(1 / F.col("coverage")).alias("normalised")).where(F.col("reads") >= least)
    per_mb = F.round(F.col("normalised") * 1e6 / F.col("genome_len"))
    return sums.join(genomes.select("species", "genome_len"), "species").withColumn("per_mb", per_mb).drop("genome_len").orderBy(F.desc("per_mb"), "species")


def _incomplete_beta(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The regularised incomplete beta function for x < (a + 1) / (a + b + 2), by its continued fraction."""
    from math import lgamma

    tiny = 1e-300
    front = np.exp([lgamma(p + q) - lgamma(p) - lgamma(q) for p, q in zip(a, b, strict=True)] + a * np.log(x) + b * np.log1p(-x)) / a
    c, d = np.ones_like(x), 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    out = d.copy()
    for m in range(1, 400):
        for part in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + part * d, 1 + part / c
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = np.where(np.abs(c) < tiny, tiny, c)
            out = out * d * c
        if np.all(np.abs(d * c - 1) < 1e-14):
            break
    return front * out


def t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| >= |t|) of Student's law with df degrees of freedom."""
    x, a, b = df / (df + t * t), df / 2, np.full(len(df), 0.5)
    x = np.clip(x, 1e-300, 1.0)
    near = x < (a + 1) / (a + b + 2)
    out = np.ones(len(x))
    out[near] = _incomplete_beta(x[near], a[near], b[near])
    far = ~near & (x < 1)
    out[far] = 1 - _incomplete_beta(1 - x[far], b[far], a[far])
    return out


def t_test(mean: Column, variance: Column, n: Column, expected: Column) -> Column:
    """p-value of a two-sided t-test that n values with this mean and variance come from ``expected``; null without variance."""

    @pandas_udf("double")
    def run(t: pd.Series, df: pd.Series) -> pd.Series:
        known = t.notna() & df.notna() & (df > 0)
        out = pd.Series(np.nan, index=t.index)
        out[known] = t_two_sided(t[known].to_numpy(float), df[known].to_numpy(float))
        return out.where(known, None)

    t = F.when((variance > 0) & (n > 1), (mean - expected) / F.sqrt(variance / n))
    return run(t, (n - 1).cast("double"))


def island_filter(statistics: DataFrame, genomes: DataFrame, group: str = "reference") -> DataFrame:
    """Adds p_value and verdict: few (hits), keep (very many hits, which aren't tested), uneven, island, clustered, questionable or keep.

    The gaps are compared with hits spread evenly over the genome by a two-sided t-test; gaps that are all equal can't be tested
    and pass.  ``genomes`` has the group and genome_len, ``statistics`` also high, the genome size's upper bound.
    References with few hits, uneven, island or clustered ones are to be dropped.
    """
    joined = statistics.join(genomes, group)
    p_value = t_test(F.col("mean_gap"), F.col("var_gap"), F.col("hits") - 1, F.col("genome_len") / F.col("hits"))
    share = F.col("high") / F.col("genome_len")
    verdict = (
        F.when(F.col("hits") < LEAST_HITS, "few")
        .when(F.col("hits") > MANY_HITS, "keep")
        .when(F.col("p_value") < P_LIMIT, "uneven")
        .when(share < ISLAND_SHARE, "island")
        .when((F.col("hits") <= FEW_HITS) & (F.col("close_share") > CLOSE_SHARE), "clustered")
        .when(share < 0.5, "questionable")
        .otherwise("keep")
    )
    return joined.withColumn("p_value", p_value).withColumn("verdict", verdict)
