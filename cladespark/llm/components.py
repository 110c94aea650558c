"""Connected components: chunks of links contracted one by one, and large and small stars between them.

A round deals the links to chunks of about ``CHUNK`` and replaces each chunk's links by a star from the least
node of each of its components (the same connections with at most one link a node).  When one chunk holds all that
is left, its stars are the answer; until then a large-star and a small-star step joins the chunks' stars.
Every round's links are stored in the shared folder, so lineage stays short and a lost executor costs no more
than its tasks; those of the round before are deleted.  Neither links nor components come to the driver, only two numbers a round.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import dropped, stored
from .skew import with_group

#: Links of a chunk, on average: two numbers each.
CHUNK = 1 << 20


def least_connected(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links (u, v), and for each the least node that it is connected with."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b):
            np.minimum.at(new, label[side], low)  # the root of either end takes the lower root
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _contracted(edges: DataFrame, chunks: int) -> DataFrame:
    """Stars of each chunk's components. A chunk gets links by both ends, so that no node's links must meet in one."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        nodes, least = least_connected(rows["u"].to_numpy(), rows["v"].to_numpy())
        below = nodes != least
        return pd.DataFrame({"u": nodes[below], "v": least[below]})

    chunk = F.pmod(F.xxhash64("u", "v"), F.lit(chunks)).alias("chunk")
    return edges.select("u", "v", chunk).groupBy("chunk").applyInPandas(run, "u long, v long")


def _minimum(frame: DataFrame) -> DataFrame:
    """Adds m, the least v of each u."""
    return with_group(frame, ["u"], "v", {"m": (F.min("v"), "min")})


def _large_star(edges: DataFrame) -> DataFrame:
    """Greater neighbours of each node go to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _minimum(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours go to the least of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = _minimum(down)
    beside = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = joined.select("u", F.col("m").alias("v"))
    return own.unionByName(beside).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(links: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(id, component) for every node of ``links`` (columns a, b); the component is its least node.

    Loops and repeated links don't matter, rows with a null end are no links; no links give an empty table.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    chunks = max(1, -(-edges.count() // chunk))
    state: tuple = ()
    while True:
        stars = stored(_contracted(edges, chunks), "edges")
        dropped(edges)
        edges = stars
        if chunks == 1:
            break
        edges = stored(_small_star(_large_star(stars)), "edges")
        dropped(stars)
        before, state = state, _state(edges)
        if state == before:
            break
        chunks = -(-state[0] // chunk)
    roots = edges.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    out = stored(edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots), "components")
    dropped(edges)
    return out
