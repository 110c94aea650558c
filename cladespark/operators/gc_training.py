"""Training of the GC model: windows of genomes, reads on them, points, and the least-squares fit."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import alignment as al
from ..functions.gc import BUILTIN, GcModel
from ..storage import dropped, stored

#: Bases of a window, and N's in it from which it is masked.
WINDOW, MOST_N = 100, 4
MIN_IDENTITY = 0.97
#: Windows of a piece of a sequence, and letters of pieces that a task holds.
BLOCK, MOST_LETTERS = 1 << 18, 16 << 20


def _shares(seq: str | None, window: int) -> np.ndarray:
    """Percent of G and C of each window, -1 for masked ones."""
    return _letter_shares(np.frombuffer((seq or "").upper().encode(), np.uint8), window)


def _letter_shares(letters: np.ndarray, window: int) -> np.ndarray:
    n = max(0, len(letters) - window - 1)
    at = np.arange(n)
    gc = np.concatenate([[0], np.cumsum((letters == ord("G")) | (letters == ord("C")))])
    unknown = np.concatenate([[0], np.cumsum(letters == ord("N"))])
    share = (100 * (gc[at + window] - gc[at])) // window
    share[unknown[at + window] - unknown[at] > MOST_N] = -1
    return share


def window_gc(genomes: DataFrame, window: int = WINDOW) -> DataFrame:
    """(species, start, gc): percent of G and C, as a whole number, of each window from the 1-based start; masked windows have -1.

    Genomes (species, seq) are one row each; running sums give all windows of one in one pass.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for species, seq in zip(frame["species"], frame["seq"], strict=True):
                share = _shares(seq, window)
                for a in range(0, len(share), 1 << 18):
                    part = share[a : a + (1 << 18)]
                    yield pd.DataFrame({"species": species, "start": np.arange(a + 1, a + 1 + len(part)), "gc": part})

    return genomes.select("species", "seq").mapInPandas(run, "species string, start long, gc int")


def window_histogram(genomes: DataFrame, window: int = WINDOW) -> DataFrame:
    """(species, gc, n) of a genome's windows that aren't masked, counted sequence by sequence: no window is a row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sums: dict[str, np.ndarray] = {}
            for species, seq in zip(frame["species"], frame["seq"], strict=True):
                share = _shares(seq, window)
                sums[species] = sums.get(species, 0) + np.bincount(share[share >= 0], minlength=101)
            found = [(species, np.flatnonzero(n), n[n > 0]) for species, n in sums.items()]
            yield pd.DataFrame({"species": np.repeat([x[0] for x in found], [len(x[1]) for x in found]), "gc": np.concatenate([np.zeros(0, np.int64), *(x[1] for x in found)]), "n": np.concatenate([np.zeros(0, np.int64), *(x[2] for x in found)])})

    counted = genomes.select("species", "seq").mapInPandas(run, "species string, gc int, n long")
    return counted.groupBy("species", "gc").agg(F.sum("n").alias("n"))


def gc_histogram(windows: DataFrame) -> DataFrame:
    """(species, gc, n) of windows that aren't masked."""
    return windows.where("gc >= 0").groupBy("species", "gc").agg(F.count("*").alias("n"))


def read_start(flag: Column, pos: Column, cigar: Column, window: int = WINDOW) -> Column:
    """Start of the window that a read stands for: its start, or on the reverse strand its end less the window."""
    return F.when(al.has(flag, al.REVERSE), pos + al.reference_span(cigar) - 1 - window).otherwise(pos)


def training_reads(alignments: DataFrame, min_identity: float = MIN_IDENTITY) -> DataFrame:
    return alignments.where(al.is_mapped(F.col("flag")) & (al.identity(F.col("cigar"), F.col("md")) >= min_identity))


def _pieces(genomes: DataFrame, window: int) -> DataFrame:
    """(species, block, piece): the letters of each ``BLOCK`` windows of a sequence, with those that the last of them reach."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found, held = [], 0
            for species, seq in zip(frame["species"], frame["seq"], strict=True):
                letters = (seq or "").upper().encode()
                n = max(0, len(letters) - window - 1)
                found += [(species, a // BLOCK, letters[a : min(a + BLOCK, n) + window + 1]) for a in range(0, n, BLOCK)]
                held += len(letters)
                if held > MOST_LETTERS:
                    yield pd.DataFrame(found, columns=["species", "block", "piece"])
                    found, held = [], 0
            yield pd.DataFrame(found, columns=["species", "block", "piece"])

    return genomes.select("species", "seq").mapInPandas(run, "species string, block long, piece binary")


def window_cells(reads: DataFrame, genomes: DataFrame, window: int = WINDOW) -> DataFrame:
    """(species, gc, n, reads): windows that aren't masked by their GC, and reads that stand for them. No window is a row.

    Reads are summed by start, and the sums of a block of starts meet the letters of its windows; neither is broadcast,
    since the planner takes sequences for as small as their compressed files.
    """
    starts = reads.select("species", read_start(F.col("flag"), F.col("pos"), F.col("cigar"), window).cast("long").alias("start")).where("start > 0")
    sums = starts.groupBy("species", "start").agg(F.count("*").alias("reads"))
    block = F.floor((F.col("start") - 1) / BLOCK).cast("long")
    hits = sums.groupBy("species", block.alias("block")).agg(F.collect_list(((F.col("start") - 1) % BLOCK).cast("int")).alias("at"), F.collect_list("reads").alias("reads"))
    joined = _pieces(genomes, window).join(hits.hint("merge"), ["species", "block"], "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cells: dict[str, np.ndarray] = {}
            for species, piece, at, hit in zip(frame["species"], frame["piece"], frame["at"], frame["reads"], strict=True):
                share = _letter_shares(np.frombuffer(piece, np.uint8), window)
                counts = np.zeros((2, 101), np.int64)
                counts[0] = np.bincount(share[share >= 0], minlength=101)
                if at is not None:
                    at, hit = np.asarray(at, np.int64), np.asarray(hit, np.int64)
                    at, hit = at[at < len(share)], hit[at < len(share)]
                    known = share[at] >= 0
                    np.add.at(counts[1], share[at[known]], hit[known])
                cells[species] = cells.get(species, 0) + counts
            for some in batched(cells.items(), 4096):
                found = [(species, np.flatnonzero(c[0]), c[:, c[0] > 0]) for species, c in some]
                yield pd.DataFrame({"species": np.repeat([x[0] for x in found], [len(x[1]) for x in found]), "gc": np.concatenate([x[1] for x in found]), "n": np.concatenate([x[2][0] for x in found]), "reads": np.concatenate([x[2][1] for x in found])})

    counted = joined.select("species", "piece", "at", "reads").mapInPandas(run, "species string, gc int, n long, reads long")
    return counted.groupBy("species", "gc").agg(F.sum("n").alias("n"), F.sum("reads").alias("reads"))


def training_points(reads: DataFrame, sequences: DataFrame, genomes: DataFrame, window: int = WINDOW) -> DataFrame:
    """(species, gc, genome_gc, coverage): reads per window of each GC value over the mean of all species' reads per window."""
    cells = stored(window_cells(reads, sequences, window), "cells")
    species = cells.groupBy("species").agg(F.sum("n").alias("windows"), F.sum("reads").alias("own"))
    overall = species.agg((F.sum("own") / F.count("*")).alias("per_species"))
    mean = F.col("per_species") / F.col("windows")
    joined = cells.join(species.hint("merge"), "species").join(F.broadcast(overall)).join(genomes.select("species", "genome_gc").hint("merge"), "species")
    return joined.where(mean > 0).select("species", "gc", "genome_gc", (F.col("reads") / F.col("n") / mean).alias("coverage"))


#: Names of the model's coefficients in SQL.
_P = tuple(f"p{k}" for k in range(8))
#: The model's slopes by coefficient; gc is the read GC in percent, z its place under the bell, e the bell.
_SLOPES = ("e", "{p0} * e * z / {p2}", "{p0} * e * z * z / {p2}", "1D", "r", "r * r", "r * r * r", "ln(genome_gc)")


def _modelled(points: DataFrame, p: np.ndarray) -> DataFrame:
    """Adds r, z, e and what the model leaves of the coverage."""
    z = points.withColumn("r", F.col("gc").cast("double")).withColumn("z", (F.col("r") - float(p[1])) / float(p[2])).withColumn("e", F.exp(-0.5 * F.col("z") * F.col("z")))
    value = F.lit(float(p[0])) * F.col("e") + float(p[3]) + float(p[4]) * F.col("r") + float(p[5]) * F.col("r") ** 2 + float(p[6]) * F.col("r") ** 3 + float(p[7]) * F.ln("genome_gc")
    return z.withColumn("rest", F.col("coverage") - value)


def _normal_equations(points: DataFrame, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """J'J and J'y of one step, summed where the points are: 44 numbers."""
    names = {name: repr(float(x)) + "D" for name, x in zip(_P, p, strict=True)}
    slopes = [s.format(**names) for s in _SLOPES]
    pairs = [(i, j) for i in range(8) for j in range(i, 8)]
    sums = [F.expr(f"sum(({slopes[i]}) * ({slopes[j]}))").alias(f"a{i}{j}") for i, j in pairs] + [F.expr(f"sum(({slopes[i]}) * rest)").alias(f"b{i}") for i in range(8)]
    row = _modelled(points, p).agg(*sums).first()
    square = np.zeros((8, 8))
    for i, j in pairs:
        square[i, j] = square[j, i] = row[f"a{i}{j}"]
    return square, np.array([row[f"b{i}"] for i in range(8)], float)


def _losses(points: DataFrame, trials: list[np.ndarray]) -> list[float]:
    """Sums of squares that are left by several sets of coefficients, in one pass."""
    rests = points
    for k, p in enumerate(trials):
        rests = _modelled(rests, p).withColumnRenamed("rest", f"rest{k}").drop("r", "z", "e")
    row = rests.agg(*[F.sum(F.col(f"rest{k}") ** 2).alias(f"l{k}") for k in range(len(trials))]).first()
    return [float("inf") if row[k] is None or row[k] != row[k] else row[k] for k in range(len(trials))]


def fit(points: DataFrame, start: tuple[float, ...] = BUILTIN, steps: int = 50, tolerance: float = 1e-5) -> GcModel:
    """Gauss-Newton with step halving from ``start``; the built-in model if there are too few points.

    Points stay where they are: a step sums the normal equations and then what each halving would leave.
    """
    table = stored(points.where("genome_gc > 0 and coverage is not null").select("gc", "genome_gc", "coverage"), "points")
    if table.count() < len(start):
        return GcModel()
    p = np.array(start, float)
    loss = _losses(table, [p])[0]
    for _ in range(steps):
        square, right = _normal_equations(table, p)
        scale = np.sqrt(np.maximum(np.diag(square), 1e-300))  # cubes of percents beside ones
        step = np.linalg.lstsq(square / np.outer(scale, scale), right / scale, rcond=1e-13)[0] / scale
        factors = [0.5**k for k in range(11)]
        trials = [p + f * step for f in factors]
        for first in (slice(0, 2), slice(2, 11)):  # whole steps mostly do
            tried = [t for t in trials[first] if t[2]]
            better = [(new, t) for new, t in zip(_losses(table, tried), tried, strict=True) if new <= loss]
            if better:
                break
        if not better:
            break
        new, p = better[0]
        done = loss - new <= tolerance * max(loss, 1e-12)
        loss = new
        if done:
            break
    dropped(table)
    return GcModel(tuple(float(x) for x in p))


def train(alignments: DataFrame, sequences: DataFrame, genomes: DataFrame, window: int = WINDOW, min_identity: float = MIN_IDENTITY) -> tuple[DataFrame, GcModel]:
    """(points, model) of one training run: windows of the sequences (species, seq), reads on them (rname is the species), points, fit.

    The points can be written (``sinks.reports.write_table``) instead of being fitted elsewhere.
    """
    reads = training_reads(alignments, min_identity).withColumn("species", F.col("rname"))
    points = stored(training_points(reads, sequences, genomes, window), "points")
    return points, fit(points)
