"""Near-duplicate vectors by a hierarchical navigable small-world graph over a sample, whose nodes' cells hold all vectors.

The graph is fitted on a sample chosen by a hash, at most ``MOST_PIVOTS`` nodes, of which no two would
link.  A graph has layers; a layer is built from above, its nodes inserted in growing batches, and every
node keeps its nearest, mutually diverse and some far neighbours.  Every vector is searched in it and goes
to the cells of its few nearest nodes, so its work doesn't grow with the number of cells.  Vectors that
share a cell are compared by exact scans, in blocks; a cell that the sample shows to be large is dealt to
several blocks, which meet in pairs.  A pair counts in the least cell that both are in, alone, for both its ends.

How many cells a vector goes to, and the beam, are audited: vectors of the sample get partners at
just the threshold's cosine, in random directions, and the narrowest choice by which ``RECALL`` of these pairs meet is taken;
if none does, the graph gets fewer nodes, and at last there is one cell, which holds all pairs.  Equal vectors are one node with a count.
Cosines near the threshold are decided in double precision; others are further from it than single precision errs.

Links are joined into components on DataFrames (see ``components``).  A task holds the graph and a pair of
blocks, whatever the input's size.  ``link_slice`` and ``link_counts`` serve shards that have a graph of their own.

Defined results: null, zero, empty or non-finite vectors link with nothing and are their own component;
vectors of different lengths don't link; rows that share a vec_id are one vector (the first by its
values) and get equal results; an empty table gives an empty table.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import dropped, stored
from .components import components, least_connected
from .skew import with_group

#: Vectors whose nearest node is the same, on average; nodes of the graph, at most, and at least (else there is one cell); sampled vectors a node.
CELL_ROWS, MOST_PIVOTS, LEAST_PIVOTS, SAMPLED = 4096, 32_768, 8, 4
#: Nearest nodes to whose cells a vector may go, beams by which they may be found, and partners of an audit.
CELLS, BEAMS, PARTNERS = (3, 4, 6, 8), (16, 32, 64), 512
#: Rows of a block, in rows of a cell; blocks of a lone cell, at least; rows of a tile of an exact scan, and its columns.
BLOCK_CELLS_ROWS, LEAST_BLOCKS, TILE = 16, 3, (256, 8192)
#: Vectors of a length up to which they are one block.
SMALL = 2000
#: Groups of equal vectors up to which they are broadcast, and pairs that a task holds before it contracts them.
MOST_BROADCAST, MOST_PAIRS = 100_000, 1 << 20
#: Neighbours of a node in a layer, beams for building and (at first, and at most) for searching.
NEIGHBOURS, BUILD_BEAM, BEAM, MOST_BEAM = 24, 40, 32, 64
#: Cells of a block of an exact scan.
BLOCK_CELLS = 1 << 23
#: Nodes of a layer for each of the next one up.
LAYER_RATIO = 24
#: Audited queries in each slice and shard, the nearest others of each, the recall they must show, and neighbours audited at least.
AUDITS, AUDIT_NEAREST, RECALL, LEAST_AUDITED = 64, 10, 0.97, 100
#: Nodes expanded at once in a beam.
EXPAND = 3
#: Kinds of rows that a slice gives.
LISTED, SPANNING, NUMBER = 0, 1, 2
FOUND = "kind long, a long, b long, n long, m long, shard long"


# -- graphs ---------------------------------------------------------------------------------------


def _beam(neighbours: np.ndarray, vectors: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``width`` nodes that a beam from ``entries`` (a row of nodes for each query) finds, best first.

    All queries go forward together: each step expands the best nodes that are not expanded yet.
    """
    n, count = len(vectors), len(queries)
    rows = np.arange(count)[:, None]
    seen = np.zeros((count, n + 1), bool)
    seen[:, n] = True  # stands for no neighbour
    width = min(width, n)
    ids = np.full((count, width), n, np.int64)
    sims = np.full((count, width), -np.inf, np.float32)
    done = np.ones((count, width), bool)
    take = min(width, entries.shape[1])
    ids[:, :take] = entries[:, :take]
    sims[:, :take] = np.einsum("qd,qed->qe", queries, vectors[entries[:, :take]])
    done[:, :take] = False
    seen[rows, entries[:, :take]] = True
    active = np.arange(count)
    expand = min(EXPAND, width)
    while len(active):
        own_ids, own_sims, own_done = ids[active], sims[active], done[active]
        waiting = np.where(own_done, -np.inf, own_sims)
        best = np.argpartition(-waiting, expand - 1, axis=1)[:, :expand] if expand < width else np.broadcast_to(np.arange(width), (len(active), width))
        at = np.arange(len(active))[:, None]
        fresh = waiting[at, best] > -np.inf
        own_done[at, best] = True
        near = np.where(fresh[:, :, None], neighbours[np.where(fresh, own_ids[at, best], 0)], n).reshape(len(active), -1)
        near.sort(axis=1)
        new = ~seen[active[:, None], near]
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[active[:, None], near] = True
        q, k = np.nonzero(new)
        found = np.full(near.shape, -np.inf, np.float32)
        found[q, k] = np.einsum("ad,ad->a", queries[active[q]], vectors[near[q, k]])
        all_sims = np.concatenate([own_sims, found], axis=1)
        keep = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        sims[active] = all_sims[at, keep]
        ids[active] = np.concatenate([own_ids, near], axis=1)[at, keep]
        done[active] = np.concatenate([own_done, ~new], axis=1)[at, keep]
        active = active[(~done[active] & (sims[active] > -np.inf)).any(axis=1)]
    order = np.argsort(-sims, axis=1, kind="stable")
    return ids[rows, order], sims[rows, order]


def _diverse(vectors: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (best first, n for none) those nearer to the node than to any chosen one, filled up with the nearest."""
    n, (count, width) = len(vectors), ids.shape
    real = sims > -np.inf
    own = vectors[np.where(real, ids, 0)]
    between = np.einsum("acd,aed->ace", own, own)
    chosen = np.zeros((count, width), bool)
    for c in range(width):
        rival = np.where(chosen, between[:, c, :], -np.inf).max(axis=1)
        chosen[:, c] = real[:, c] & (sims[:, c] > rival) & (chosen.sum(axis=1) < most - most // 3)
    order = np.argsort(np.where(chosen, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :most]
    picked = np.take_along_axis(np.where(real, ids, n), order, axis=1)
    if picked.shape[1] < most:
        picked = np.pad(picked, ((0, 0), (0, most - picked.shape[1])), constant_values=n)
    return picked


def _add_reverse(neighbours: np.ndarray, vectors: np.ndarray, nodes: np.ndarray, picked: np.ndarray, rng: np.random.Generator) -> None:
    """Links chosen neighbours back; a full list keeps its nearest half and a random choice of the others."""
    n, most = len(vectors), neighbours.shape[1]
    source = np.repeat(nodes, picked.shape[1])
    target = picked.ravel()
    source, target = source[target < n], target[target < n]
    touched = np.unique(target)
    old = neighbours[touched]
    owner = np.concatenate([np.repeat(touched, most)[old.ravel() < n], target])
    other = np.concatenate([old.ravel()[old.ravel() < n], source])
    key = np.unique(owner * (n + 1) + other)
    owner, other = key // (n + 1), key % (n + 1)
    sims = np.einsum("ad,ad->a", vectors[owner], vectors[other])
    order = np.lexsort((-sims, owner))
    owner, other = owner[order], other[order]
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    rank = np.arange(len(owner)) - np.repeat(heads, np.diff(np.append(heads, len(owner))))
    order = np.lexsort((np.where(rank < most // 2, rank, most + rng.random(len(rank)) * len(rank)), owner))
    owner, other = owner[order], other[order]
    keep = rank < most  # ranks by place within each owner, which are the same after sorting
    neighbours[touched] = n
    neighbours[owner[keep], rank[keep]] = other[keep]


def build(vectors: np.ndarray, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers from the top: (node numbers, neighbours by place in the layer). Unit vectors, float32."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    order = rng.permutation(n)
    sizes = [n]
    while sizes[-1] > 4 * LAYER_RATIO:
        sizes.append(sizes[-1] // LAYER_RATIO)
    layers: list[tuple[np.ndarray, np.ndarray]] = []
    for size in reversed(sizes):
        nodes = order[:size]  # the nodes of the layer above come first
        own = vectors[nodes]
        neighbours = np.full((size, NEIGHBOURS), size, np.int64)
        done = min(size, 256)
        sims = own[:done] @ own[:done].T
        np.fill_diagonal(sims, -np.inf)
        width = min(BUILD_BEAM, done)
        near = np.argsort(-sims, axis=1, kind="stable")[:, :width]
        picked = _diverse(own, near, np.take_along_axis(sims, near, axis=1), NEIGHBOURS)
        neighbours[:done] = picked
        _add_reverse(neighbours, own, np.arange(done), picked, rng)
        while done < size:
            stop = min(size, done + max(64, min(done, 1024)))
            for a in range(done, stop, 256):
                batch = np.arange(a, min(stop, a + 256))
                entries = _descend(layers, vectors, own[batch], nodes) if layers else np.zeros((len(batch), 1), np.int64)
                entries = np.where(entries < a, entries, 0)
                ids, sims = _beam(neighbours, own, own[batch], entries, BUILD_BEAM)
                picked = _diverse(own, ids, sims, NEIGHBOURS)
                neighbours[batch] = picked
                _add_reverse(neighbours, own, batch, picked, rng)
            done = stop
        layers.append((nodes, neighbours))
    return layers


def _descend(layers: list[tuple[np.ndarray, np.ndarray]], vectors: np.ndarray, queries: np.ndarray, below: np.ndarray) -> np.ndarray:
    """For each query an entry into the layer below ``layers``: a place there.

    Layers hold the first nodes of one order, so a node has the same place in all of them.
    """
    entries = np.zeros((len(queries), 1), np.int64)
    for nodes, neighbours in layers:
        entries = _beam(neighbours, vectors[nodes], queries, entries, 4)[0]
    return np.minimum(entries, len(below) - 1)


def search(layers: list[tuple[np.ndarray, np.ndarray]], vectors: np.ndarray, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(node numbers, cosines) of the best ``width`` nodes for each query."""
    nodes, neighbours = layers[-1]
    own = vectors[nodes]
    out = []
    step = max(16, min(256, (16 << 20) // max(1, len(own))))
    for a in range(0, len(queries), step):
        part = queries[a : a + step]
        entries = _descend(layers[:-1], vectors, part, nodes)
        ids, sims = _beam(neighbours, own, part, entries, width)
        out.append((nodes[np.minimum(ids, len(own) - 1)], sims))
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


# -- linking --------------------------------------------------------------------------------------


def _cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    return np.einsum("ad,ad->a", x, y) / np.sqrt(np.einsum("ad,ad->a", x, x) * np.einsum("ad,ad->a", y, y))


def _audited_width(layers: list, ids: np.ndarray, unit: np.ndarray, query_ids: np.ndarray, query_unit: np.ndarray) -> int | None:
    """The narrowest beam by which the sampled queries find their nearest other vectors, if any."""
    n = len(ids)
    sample = np.linspace(0, len(query_ids) - 1, min(AUDITS, len(query_ids))).astype(np.int64)
    own = query_ids[sample][:, None]
    others = np.where(own == ids[None, :], -np.inf, query_unit[sample] @ unit.T)
    k = min(AUDIT_NEAREST, n - 1)
    if len(sample) * k < LEAST_AUDITED:
        return None
    least = np.partition(others, n - k, axis=1)[:, n - k] - 1e-6  # of equally near ones any will do
    width = BEAM
    while width <= min(MOST_BEAM, n):
        near, sims = search(layers, unit, query_unit[sample], width)
        found = ((sims >= least[:, None]) & (ids[near] != own)).sum(axis=1)
        if np.minimum(found / k, 1).mean() >= RECALL:
            return width
        width *= 2
    return None


def link_slice(layers: list, ids: np.ndarray, full: np.ndarray, unit: np.ndarray, query_ids: np.ndarray, query_full: np.ndarray, query_unit: np.ndarray, threshold: float, copies: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], dict[int, int]]:
    """(q, node) of listed links by place, spanning links by id, and the number of links of each query that has more than are listed.

    A link with a node of several ``copies`` counts as many.
    """
    n, margin = len(ids), 1e-4
    copies = np.ones(n, np.int64) if copies is None else copies
    width = _audited_width(layers, ids, unit, query_ids, query_unit)
    exact = np.ones(len(query_ids), bool)
    listed = [np.zeros((2, 0), np.int64)]
    spanning: list[np.ndarray] = []
    many: dict[int, int] = {}
    if width is not None:
        near, sims = search(layers, unit, query_unit, width)
        exact = sims[:, -1] >= threshold - margin
        # queries with room in their beam: every link is in it
        q, k = np.nonzero((sims >= threshold - margin) & ~exact[:, None])
        other = near[q, k]
        linked = (_cosine(query_full[q], full[other]) >= threshold) & (query_ids[q] != ids[other])
        listed.append(np.stack([q[linked], other[linked]]))
    scanned = np.flatnonzero(exact)
    step = max(16, min(1024, BLOCK_CELLS // n))
    for a in range(0, len(scanned), step):
        own = scanned[a : a + step]
        links = np.zeros((len(own), n), bool)
        for b in range(0, n, 4096):
            rough = query_unit[own] @ unit[b : b + 4096].T
            block = rough >= threshold
            i, j = np.nonzero(np.abs(rough - threshold) < margin)  # only these need double precision to decide
            block[i, j] = _cosine(query_full[own[i]], full[b + j]) >= threshold
            links[:, b : b + 4096] = block & (query_ids[own][:, None] != ids[None, b : b + 4096])
        full_rows = links.sum(axis=1) >= BEAM
        i, j = np.nonzero(links & ~full_rows[:, None])
        listed.append(np.stack([own[i], j]))
        rest = np.flatnonzero(full_rows)
        many |= {int(own[r]): int(copies[links[r]].sum()) for r in rest}
        columns = np.flatnonzero(links[rest].any(axis=0))
        spanning.append(_spanning(links[np.ix_(rest, columns)], query_ids[own[rest]], ids[columns]))
    q, other = np.concatenate(listed, axis=1)
    return q, other, spanning, many


def _spanning(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs that connect what a table of links connects, at most one for each row and column."""
    big = np.iinfo(np.int64).max
    of_left, of_right = left.copy(), np.where(links.any(axis=0), right, big)
    while True:
        new_left = np.minimum(of_left, np.where(links, of_right[None, :], big).min(axis=1, initial=big))
        new_right = np.minimum(of_right, np.where(links, new_left[:, None], big).min(axis=0, initial=big))
        if (new_left == of_left).all() and (new_right == of_right).all():
            break
        of_left, of_right = new_left, new_right
    used = of_right < big
    return np.concatenate([np.column_stack([left, of_left]), np.column_stack([right[used], of_right[used]])])


def _shard(column: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(shards))


def link_counts(found: DataFrame, shards: int) -> DataFrame:
    """(vec_id, n_links): listed links from either end, each once, and the numbers of those that aren't listed.

    Where a vector has a number for a shard, what that shard's vectors list of it is in the number.
    """
    listed = found.where(F.col("kind") == LISTED)
    both = listed.select("a", "b", "n").unionByName(listed.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("m").alias("n")))
    numbers = found.where(F.col("kind") == NUMBER).select("a", "shard", "n")
    each = both.groupBy("a", "b").agg(F.max("n").alias("n")).withColumn("shard", _shard("b", shards))
    each = each.join(numbers.select("a", "shard"), ["a", "shard"], "left_anti").select("a", "n")
    return each.unionByName(numbers.select("a", "n")).groupBy(F.col("a").alias("vec_id")).agg(F.sum("n").alias("n_links"))


# -- cells ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Cells:
    """A graph over chosen vectors, each the centre of a cell, and the blocks that each cell is dealt to."""

    pivots: np.ndarray
    layers: list[tuple[np.ndarray, np.ndarray]]
    beam: int
    most: int
    threshold: float
    blocks: np.ndarray

    def of(self, unit: np.ndarray) -> np.ndarray:
        """The cells of each vector, the nearest first, -1 for none.

        A farther cell is left out if nothing that links with the vector can be nearer to its centre than to the nearest one.
        """
        ids, sims = search(self.layers, self.pivots, unit, self.beam)
        ids, sims = ids[:, : self.most], sims[:, : self.most]
        apart = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ad,acd->ac", self.pivots[ids[:, 0]], self.pivots[ids])))
        near = (sims > -np.inf) & (sims[:, :1] - sims < (1 - self.threshold**2) ** 0.5 * apart + 1e-5)
        near[:, 0] = True
        return np.where(near, ids, -1)


def _apart(unit: np.ndarray, most: int, threshold: float) -> np.ndarray:
    """The first vectors of which no two have the threshold's cosine."""
    kept = np.zeros(0, np.int64)
    for a in range(0, len(unit), 512):
        part = unit[a : a + 512]
        alive = (part @ unit[kept].T < threshold).all(axis=1)
        among = part @ part.T >= threshold
        for k in np.flatnonzero(alive):
            if alive[k]:
                alive[k + 1 :] &= ~among[k, k + 1 :]
        kept = np.concatenate([kept, a + np.flatnonzero(alive)])
        if len(kept) >= most:
            break
    return kept[:most]


def _meet(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which rows of two tables of cells have one in common, and the least: a large number for none."""
    common = (left[:, :, None] == right[:, None, :]) & (left[:, :, None] >= 0)
    return np.where(common, left[:, :, None], np.iinfo(np.int32).max).min(axis=(1, 2))


def fit_cells(sample: np.ndarray, rows: int, threshold: float, cell_rows: int = CELL_ROWS) -> Cells | None:
    """Cells of about ``cell_rows`` of ``rows`` vectors, fitted on unit vectors in single precision; none if pairs would be lost."""
    wanted = min(MOST_PIVOTS, rows // cell_rows) if threshold >= 0.5 else 0
    while wanted >= LEAST_PIVOTS:
        chosen = _apart(sample, wanted, threshold)
        if len(chosen) < LEAST_PIVOTS:
            break
        pivots = sample[chosen]
        layers = build(pivots, 0)
        rest = np.setdiff1d(np.arange(len(sample)), chosen)
        rest = rest if len(rest) else chosen
        own = sample[rest[np.linspace(0, len(rest) - 1, min(PARTNERS, len(rest))).astype(np.int64)]]
        away = np.random.default_rng(wanted).normal(size=(PARTNERS, own.shape[1])).astype(np.float32)
        own = own[np.arange(PARTNERS) % len(own)]
        away -= np.einsum("ad,ad->a", away, own)[:, None] * own
        away /= np.maximum(np.linalg.norm(away, axis=1), 1e-30)[:, None]
        partners = (threshold * own + (1 - threshold**2) ** 0.5 * away).astype(np.float32)
        for most in CELLS:
            for beam in BEAMS:
                cells = Cells(pivots, layers, beam, most, threshold, np.ones(len(pivots), np.int64))
                if (_meet(cells.of(own), cells.of(partners)) < len(pivots)).mean() >= RECALL:
                    found = cells.of(sample)
                    here = np.bincount(found[found >= 0], minlength=len(pivots)) * (rows / len(sample))
                    return Cells(pivots, layers, beam, most, threshold, np.maximum(1, np.ceil(here / (BLOCK_CELLS_ROWS * cell_rows))).astype(np.int64))
        wanted //= 4
    return None


def _vectors(blobs: list[bytes], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in double precision, and of length one in single precision."""
    kind = np.float32 if len(blobs[0]) == 4 * dim else np.float64
    full = np.frombuffer(b"".join(blobs), kind).reshape(-1, dim).astype(np.float64)
    return full, (full / np.linalg.norm(full, axis=1)[:, None]).astype(np.float32)


DEALT = "vec_id long, dim int, blob binary, copies long, cells binary, cell int, i int, j int, block int"


def dealt(own: DataFrame, cells: dict[int, Cells], lone: dict[int, int]) -> DataFrame:
    """A row for each cell of a vector and each block of the cell that its own meets; ``lone`` has the blocks of lone cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims = batch.column("vec_id").to_numpy(), batch.column("dim").to_numpy()
            mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                if dim in cells:
                    of = cells[dim].of(_vectors(batch.column("blob").take(pa.array(at)).to_pylist(), dim)[1]).astype(np.int32)
                    blocks = cells[dim].blocks
                else:
                    of, blocks = np.zeros((len(at), 1), np.int32), np.array([lone.get(dim, 1)])
                lists = [x.tobytes() for x in of]
                k, slot = np.nonzero(of >= 0)
                times = blocks[of[k, slot]]
                other = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                k, cell = np.repeat(k, times), np.repeat(of[k, slot], times)
                block = (mixed[at[k]] % np.repeat(times, times).astype(np.uint64)).astype(np.int64)
                for a in range(0, len(k), 8192):
                    part = slice(a, a + 8192)
                    rows = pa.array(at[k[part]])
                    ends = np.sort(np.column_stack([block[part], other[part]]), axis=1).astype(np.int32)
                    columns = [batch.column(c).take(rows) for c in ("vec_id", "dim", "blob", "copies")]
                    columns += [pa.array([lists[x] for x in k[part]], pa.binary()), pa.array(cell[part]), pa.array(ends[:, 0]), pa.array(ends[:, 1]), pa.array(block[part].astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in DEALT.split(", ")])

    return own.select("vec_id", "dim", "blob", "copies").mapInArrow(run, DEALT)


def linked_in_cell(cell: int, left: np.ndarray, right: np.ndarray | None, ids: np.ndarray, full: np.ndarray, unit: np.ndarray, copies: np.ndarray, cells: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of links of each row, ends of links that connect the same rows) between two blocks of a cell, or within one.

    Only pairs whose least common cell this is count; a link with a row of several ``copies`` counts as many.
    """
    margin, numbers = 1e-4, np.zeros(len(ids))
    several = (cells >= 0).sum(axis=1) > 1
    within, right = right is None, left if right is None else right
    pairs, held = [np.zeros((2, 0), np.int64)], 0
    own_unit, other_unit = unit[left], unit[right]
    for a in range(0, len(left), TILE[0]):
        for b in range(a if within else 0, len(right), TILE[1]):
            rough = own_unit[a : a + TILE[0]] @ other_unit[b : b + TILE[1]].T
            linked = rough >= threshold - margin
            some = np.flatnonzero(linked.any(axis=1))
            x, y = np.nonzero(linked[some])
            x = some[x]
            sims, x, y = rough[x, y], a + x, b + y
            if within:
                sims, x, y = sims[x < y], x[x < y], y[x < y]
            x, y = left[x], right[y]
            kept = ids[x] != ids[y]
            edge = np.flatnonzero(sims < threshold + margin)  # only these need double precision to decide
            kept[edge] &= _cosine(full[x[edge]], full[y[edge]]) >= threshold
            for c in range(0, len(x), 1 << 17):
                both = c + np.flatnonzero(several[x[c : c + (1 << 17)]] & several[y[c : c + (1 << 17)]])
                kept[both] &= _meet(cells[x[both]], cells[y[both]]) == cell
            x, y = x[kept], y[kept]
            if len(x):
                numbers += np.bincount(x, copies[y], len(ids)) + np.bincount(y, copies[x], len(ids))
                pairs.append(np.stack([x, y]))
                held += len(x)
            if held > MOST_PAIRS:
                pairs, held = [np.stack(least_connected(*np.concatenate(pairs, axis=1)))], 0
    x, y = least_connected(*np.concatenate(pairs, axis=1))
    return numbers.astype(np.int64), x[x != y], y[x != y]


def packed(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, dim, blob) of the vectors that can link: their numbers one after another, floats as such and others as doubles."""
    kind = pa.float32() if vectors.schema[vector_column].dataType.simpleString() == "array<float>" else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = pc.fill_null(pc.cast(column.flatten(), kind), float("nan")).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            within = lambda test: np.diff(np.concatenate([[0], np.cumsum(test)])[np.concatenate([[0], ends])])  # noqa: B023, E731
            kept = np.flatnonzero((sizes > 0) & (within(~np.isfinite(values)) == 0) & (within(values != 0) > 0))
            blobs = [(values[ends[k] - sizes[k] : ends[k]] + 0.0).tobytes() for k in kept]  # one zero, whatever its sign
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(kept)), pa.array(sizes[kept].astype(np.int32)), pa.array(blobs, pa.binary())], names=["vec_id", "dim", "blob"])

    own = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector")).where("vec_id is not null and vector is not null")
    return own.mapInArrow(run, "vec_id long, dim int, blob binary")


def _digest() -> Column:
    return F.expr("substring(unhex(sha2(blob, 256)), 1, 16) as digest")


def _keys(rows: DataFrame) -> DataFrame:
    return stored(rows.select("vec_id", "dim", _digest()), "vector-keys")


def _with_rep(rows: DataFrame, equal: DataFrame, few: bool) -> DataFrame:
    """Adds rep, the least vec_id of the equal vectors, and copies, their number."""
    if not few:
        return with_group(rows, ["digest"], "vec_id", {"rep": (F.min("vec_id"), "min"), "copies": (F.count("*"), "sum")})
    joined = rows.join(F.broadcast(equal.select("digest", "rep", "copies")), "digest", "left")
    return joined.withColumn("rep", F.coalesce("rep", "vec_id")).withColumn("copies", F.coalesce("copies", F.lit(1)))


def _fitted(own: DataFrame, rows: dict[int, int], threshold: float, cell_rows: int) -> dict[int, Cells]:
    """Cells of each length of vectors that has enough rows, fitted on a sample chosen by a hash."""
    wanted = {dim: max(4 * PARTNERS, SAMPLED * min(MOST_PIVOTS, n // cell_rows)) / n for dim, n in rows.items() if n >= LEAST_PIVOTS * cell_rows}
    if not wanted:
        return {}
    scale = 1 << 30
    share = own.sparkSession.createDataFrame([(dim, int(min(1, x) * scale)) for dim, x in wanted.items()], "dim int, share long")
    place = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(scale))
    sample = own.where(place < int(min(1, max(wanted.values())) * scale)).join(F.broadcast(share), "dim").where(place < F.col("share"))

    def fit(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place", ignore_index=True)
        found = fit_cells(_vectors(frame["blob"].tolist(), key[0])[1], rows[key[0]], threshold, cell_rows)
        return pd.DataFrame({"dim": [key[0]], "cells": [pickle.dumps(found, protocol=5)]})

    fitted = sample.select("dim", "blob", F.xxhash64("vec_id", F.lit(8)).alias("place")).groupBy("dim").applyInPandas(fit, "dim int, cells binary")
    found = {r["dim"]: pickle.loads(r["cells"]) for r in fitted.collect()}  # bounded by MOST_PIVOTS
    return {dim: cells for dim, cells in found.items() if cells is not None}


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding", shard_rows: int = CELL_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``; a cell has about ``shard_rows`` nearest vectors."""
    rows = packed(vectors, id_column, vector_column)
    keys, once = _keys(rows), None
    if not keys.groupBy("vec_id").count().where("count > 1").isEmpty():
        once = rows = stored(rows.groupBy("vec_id").agg(F.min(F.struct("dim", "blob")).alias("x")).select("vec_id", "x.dim", "x.blob"), "vectors")
        dropped(keys)
        keys = _keys(rows)
    equal = stored(keys.groupBy("dim", "digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")).where("copies > 1"), "equal-vectors")
    few = equal.count() <= MOST_BROADCAST
    own = _with_rep(rows.select("*", _digest()), equal, few).where("vec_id = rep").select("vec_id", "dim", "blob", "copies")
    if not few:
        own = stored(own, "vectors")
    fewer = equal.groupBy("dim").agg(F.sum(F.col("copies") - 1).alias("fewer"))
    counts = keys.groupBy("dim").count().join(fewer, "dim", "left").selectExpr("dim", "count - coalesce(fewer, 0) as n").where(F.col("n") > SMALL)
    sizes = {r["dim"]: r["n"] for r in counts.collect()}
    cells = _fitted(own, sizes, threshold, shard_rows)
    lone = {dim: max(LEAST_BLOCKS, -(-n // (BLOCK_CELLS_ROWS * shard_rows))) for dim, n in sizes.items()}

    def link(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        dim, cell, i, j = (int(x) for x in key)
        frame = frame.sort_values("vec_id", ignore_index=True)
        ids, block = frame["vec_id"].to_numpy(), frame["block"].to_numpy()
        full, unit = _vectors(frame["blob"].tolist(), dim)
        lists = np.frombuffer(b"".join(frame["cells"]), np.int32).reshape(len(ids), -1)
        left, right = np.flatnonzero(block == i), None if i == j else np.flatnonzero(block == j)
        numbers, x, y = linked_in_cell(cell, left, right, ids, full, unit, frame["copies"].to_numpy(), lists, threshold)
        some = np.flatnonzero(numbers)
        kind = np.repeat([NUMBER, SPANNING], [len(some), len(x)])
        return pd.DataFrame({"kind": kind, "a": np.concatenate([ids[some], ids[x]]), "b": np.concatenate([0 * some, ids[y]]), "n": np.concatenate([numbers[some], 0 * x])})

    spread = dealt(own, cells, lone).groupBy("dim", "cell", "i", "j").applyInPandas(link, "kind long, a long, b long, n long")
    found = stored(spread, "vector-links")
    dropped(once, own)

    labels = components(found.where(F.col("kind") == SPANNING).select("a", "b"))
    numbers = found.where(F.col("kind") == NUMBER).groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n_links"))
    reps = numbers.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    named = _with_rep(keys.drop("dim"), equal, few).select("vec_id", "rep", "copies").join(reps, "rep", "left")
    named = named.select("vec_id", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    out = vectors.select(F.col(id_column).cast("long").alias("vec_id")).join(named, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
