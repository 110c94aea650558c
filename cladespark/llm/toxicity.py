"""Toxic passages as maximal scoring segments of token log-odds.

Learning: each word and its prefixes of 4, 5 and 6 letters are features; how many toxic and clean
training documents have a feature gives its toxic share under a Beta (two-class Dirichlet) prior that is
the posterior of the next shorter prefix, so rare and unseen words take the log-odds of their stem.

Scoring: one linear scan over a text's token scores (log-odds less a drift) finds every maximal
scoring segment (Ruzzo and Tompa).  Under an extreme-value law, whose rate and constant are fitted on
the tail of clean training documents, a segment of score S in n tokens has the expected count
``K n exp(-rate S)``.  A document's score is a logistic function of the log significance of its best
segment and of the sum of those of all significant ones.  For fitting both, each half of the
training rows is scored with the log-odds of the other half.

The training rows are bounded (``MAX_TRAINING`` rows, those with the least hash of doc_id), so the model is;
each text is scored whole, in one narrow pass.  Labels, lang, source and doc_id are no inputs of a score.

Defined results: null and empty texts have no segments and get the score of such texts; with no
training rows of one class the score is the smoothed toxic share for every text and nothing is predicted by
it; repeated rows give equal rows; an empty table gives an empty table; labels other than 0 and 1 and
null labels are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import dropped, stored
from .textbatch import flat_bytes, mix, release, slices, span_hashes, words

#: Labelled rows that a model is learned from, at most.
MAX_TRAINING = 20_000
#: Folds by crc32 of doc_id; rows of fold 0 are held out.
FOLDS = 5
#: Letters of the prefixes, shortest first; whole words come last.
PREFIXES = (4, 5, 6)
#: Weight of the prior in documents, documents a feature must be in, and the drift of each token.
PRIOR, LEAST_DOCUMENTS, DRIFT = 8.0, 3, 0.5

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[ord("a") : ord("z") + 1] = False
_SEPARATOR[128:] = False

SCORED = "doc_id long, held_out boolean, score double, predicted int, passages array<struct<begin:int,end:int,score:double>>"


def held_out(id_column: Column) -> Column:
    return F.crc32(id_column.cast("string")) % FOLDS == 0


def features(array: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens by level (0 where the word is shorter), tokens' begins and ends in bytes, and offsets by text."""
    data, offsets = flat_bytes(pc.utf8_lower(pc.fill_null(array, "")))
    starts, ends = words(data, offsets, _SEPARATOR)
    first = (data & 0xC0) != 0x80
    letters = np.append(np.flatnonzero(first), np.full(max(PREFIXES) + 1, len(data)))
    before = np.cumsum(first) - first
    levels = []
    for k in PREFIXES:
        stop = letters[before[starts] + k]
        levels.append(np.where(stop <= ends, mix(span_hashes(data, starts, np.minimum(stop, ends)) ^ np.uint64(k)), np.uint64(0)))
    levels.append(mix(span_hashes(data, starts, ends) ^ np.uint64(99)))
    at = np.searchsorted(starts, offsets)
    base = np.repeat(offsets[:-1], np.diff(at))
    return levels, starts - base, ends - base, at


@dataclass
class Weights:
    """Log-odds of features, by level: sorted hashes and their values."""

    keys: list[np.ndarray]
    values: list[np.ndarray]

    def of(self, levels: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """Score of each token: its deepest known feature's log-odds less the drift. ``at`` are the texts' offsets in tokens."""
        out = np.zeros(len(levels[0]), np.float64)
        for hashes, keys, values in zip(levels, self.keys, self.values, strict=True):
            if len(keys) and len(hashes):
                near = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                known = keys[near] == hashes
                out[known] = values[near[known]]
        whole = levels[-1]
        again = np.zeros(len(whole), bool)
        again[1:] = whole[1:] == whole[:-1]
        again[at[:-1][at[:-1] < len(whole)]] = False  # a text's first word follows no other
        out[again] = 0.0  # a word said again at once is no new evidence
        return out - DRIFT


@dataclass
class Model:
    weights: Weights
    rate: float
    constant: float
    logistic: np.ndarray  # bias, best, sum

    def document(self, segments: list[tuple[int, int, float]], n: int) -> tuple[float, float]:
        return evidence(segments, n, self.rate, self.constant)

    def score(self, best: float, total: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logistic @ (1.0, best, total), -30, 30))))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, past the last, score), in linear time.

    Between positive tokens only running sums matter, so the scan visits positive tokens.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[list] = []  # first, past the last, sum before, sum after
    for i in positive.tolist():
        new = [i, i + 1, sums[i], sums[i + 1]]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j -= 1
            if j < 0 or found[j][3] >= new[3]:
                found.append(new)
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
    return [(a, b, float(y - x)) for a, b, x, y in found]


def evidence(segments: list[tuple[int, int, float]], n: int, rate: float, constant: float) -> tuple[float, float]:
    """Log significance of the best segment, and the sum over all significant ones."""
    base = np.log(constant * max(n, 1))
    each = [rate * s - base for _, _, s in segments]
    return max([0.0, *each]), sum(x for x in each if x > 0)


def _share(toxic: np.ndarray, clean: np.ndarray, scale: float, prior: np.ndarray) -> np.ndarray:
    clean = clean * scale
    return (toxic + PRIOR * prior) / (toxic + clean + PRIOR)


def _weights(table: dict[str, np.ndarray], folds: tuple[int, ...], n_toxic: float, n_clean: float) -> Weights:
    """Posterior log-odds by level, parents first. ``table`` has level, hash, parent and counts by fold."""
    toxic = sum(table[f"toxic{f}"] for f in folds).astype(float)
    clean = sum(table[f"clean{f}"] for f in folds).astype(float)
    scale = (n_toxic + 1) / (n_clean + 1)
    keys, values, shares = [], [], []
    for level in range(len(PREFIXES) + 1):
        mine = (table["level"] == level) & (toxic + clean >= LEAST_DOCUMENTS)
        order = np.argsort(table["hash"][mine])
        hashes, parents = table["hash"][mine][order], table["parent"][mine][order]
        prior = np.full(len(hashes), 0.5)
        for above in range(level):  # the deepest known prefix decides
            if len(keys[above]):
                near = np.minimum(np.searchsorted(keys[above], parents[:, above]), len(keys[above]) - 1)
                known = keys[above][near] == parents[:, above]
                prior[known] = shares[above][near[known]]
        share = _share(toxic[mine][order], clean[mine][order], scale, prior)
        keys.append(hashes)
        shares.append(share)
        values.append(np.log(share / (1 - share)))
    return Weights(keys, values)


def _feature_counts(training: DataFrame) -> dict[str, np.ndarray]:
    """Documents with each feature, by class and half; bounded by the training rows. Counted by slice before the shuffle."""
    above = [f"above{k}" for k in range(len(PREFIXES))]
    cells = ["toxic0", "clean0", "toxic1", "clean1"]
    schema = "level int, hash long, " + ", ".join(f"{c} long" for c in above) + ", " + ", ".join(f"{c} int" for c in cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                levels, _, _, at = features(part.column("text"))
                # 0 for toxic and 1 for clean rows of the first half, 2 and 3 for those of the second
                cell = 2 * part.column("half").to_numpy(zero_copy_only=False) + 1 - part.column("toxic").to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(part.num_rows), np.diff(at))
                for level, hashes in enumerate(levels):
                    order = np.lexsort((row, hashes))
                    own, of = hashes[order], row[order]
                    new = np.append(True, (own[1:] != own[:-1]) | (of[1:] != of[:-1])) & (own != 0) if len(own) else np.zeros(0, bool)
                    order, own, of = order[new], own[new], of[new]
                    heads = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
                    if not len(heads):
                        continue
                    counts = [np.add.reduceat(cell[of] == c, heads, dtype=np.int32) for c in range(4)]
                    parents = [levels[k][order[heads]].view(np.int64) for k in range(len(PREFIXES))]
                    columns = [np.full(len(heads), level, np.int32), own[heads].view(np.int64), *parents, *counts]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["level", "hash", *above, *cells])
        release()

    sums = training.mapInArrow(run, schema).groupBy("level", "hash").agg(*[F.max(c).alias(c) for c in above], *[F.sum(c).alias(c) for c in cells])
    kept = sums.where(f"{' + '.join(cells)} >= {LEAST_DOCUMENTS}").toArrow()
    out = {c: kept.column(c).to_numpy() for c in ("level", *cells)}
    out["hash"] = kept.column("hash").to_numpy().view(np.uint64)
    out["parent"] = np.stack([kept.column(c).to_numpy().view(np.uint64) for c in above], axis=1)
    return out


def _segments_of_training(training: DataFrame, halves: tuple[Weights, Weights]) -> list[tuple[int, int, list[float]]]:
    """(toxic, tokens, segment scores) of each training row, scored with the other half's weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                levels, _, _, at = features(part.column("text"))
                scores = [w.of(levels, at) for w in halves]
                half = part.column("half").to_numpy(zero_copy_only=False)
                found = [[s for _, _, s in maximal_segments(scores[1 - half[i]][at[i] : at[i + 1]])] for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(np.diff(at).astype(np.int64)), pa.array(found, pa.list_(pa.float64()))], names=["toxic", "n", "scores"])
        release()

    rows = training.mapInArrow(run, "toxic int, n long, scores array<double>").toArrow()
    return list(zip(*(rows.column(c).to_pylist() for c in ("toxic", "n", "scores")), strict=True))


def _tail(clean: list[tuple[int, list[float]]]) -> tuple[float, float]:
    """Rate and constant of the extreme-value law from the tail of clean documents' best segments."""
    best = np.array([max(s, default=0.0) for _, s in clean])
    n = np.array([max(1, k) for k, _ in clean], float)
    over = best[best > 0]
    if len(over) < 20:
        return 1.0, 1e-3
    edge = np.quantile(over, 0.5)
    above = over[over > edge]
    rate = 1 / max(1e-3, float((above - edge).mean())) if len(above) else 1.0
    rate = min(rate, 5.0)
    constant = float((best > edge).sum()) / (n.sum() * np.exp(-rate * edge))
    return rate, max(constant, 1e-12)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression by Newton steps, lightly shrunk."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", max_training: int = MAX_TRAINING) -> Model:
    """Learns from at most ``max_training`` labelled rows that are not held out."""
    key = F.col(id_column).cast("long")
    chosen = labels.where(F.col(label_column).isin(0, 1)).where(~held_out(key)).groupBy(key.alias("_id")).agg(F.max(label_column).cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(max_training)
    own = docs.select(key.alias("_id"), F.col(text_column).alias("text")).join(F.broadcast(chosen), "_id")
    # repeated rows of a document are one training row
    own = own.groupBy("_id", "toxic").agg(F.min("text").alias("text"))
    training = stored(own.select("toxic", F.pmod(F.xxhash64("_id"), F.lit(2)).cast("int").alias("half"), "text"), "toxic-training")
    sizes = {(r["toxic"], r["half"]): r["n"] for r in training.groupBy("toxic", "half").agg(F.count("*").alias("n")).collect()}
    n = lambda t, h: sizes.get((t, h), 0)
    toxic, clean = n(1, 0) + n(1, 1), n(0, 0) + n(0, 1)
    if not toxic or not clean:
        empty = [np.zeros(0, np.uint64)] * (len(PREFIXES) + 1)
        share = (toxic + 1) / (toxic + clean + 2)
        share = min(share, 0.49)
        return Model(Weights(empty, [np.zeros(0)] * len(empty)), 1.0, 1.0, np.array([np.log(share / (1 - share)), 0.0, 0.0]))
    table = _feature_counts(training)
    halves = tuple(_weights(table, (h,), n(1, h), n(0, h)) for h in (0, 1))
    rows = _segments_of_training(training, halves)
    rate, constant = _tail([(k, s) for t, k, s in rows if t == 0])
    x = np.array([evidence([(0, 0, v) for v in s], k, rate, constant) for _, k, s in rows])
    logistic = _logistic(np.minimum(x, 200.0), np.array([t for t, _, _ in rows], float))
    model = Model(_weights(table, (0, 1), toxic, clean), rate, constant, logistic)
    del table, rows, halves, x
    release()
    dropped(training)
    return model


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, passages) of whole texts.

    ``passages`` are the significant segments: begin and end in bytes of the lower-cased text's UTF-8 and
    the log significance. The model (bounded with its training rows) is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                levels, begins, ends, at = features(part.column("text"))
                values = own.weights.of(levels, at)
                scores, passages = [], []
                for i in range(part.num_rows):
                    a, b = at[i], at[i + 1]
                    segments = maximal_segments(values[a:b])
                    best, total = own.document(segments, b - a)
                    scores.append(own.score(min(best, 200.0), min(total, 200.0)))
                    base = np.log(own.constant * max(b - a, 1))
                    passages.append([{"begin": int(begins[a + x]), "end": int(ends[a + y - 1]), "score": float(own.rate * s - base)} for x, y, s in segments if own.rate * s > base])
                kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(passages, kind)], names=["doc_id", "held_out", "score", "predicted", "passages"])
        release()

    key = F.col(id_column).cast("long")
    return docs.select(key.alias("doc_id"), held_out(key).alias("held_out"), F.col(text_column).alias("text")).mapInArrow(run, SCORED)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with their columns as they are."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            for part in slices(batch, "text"):
                levels, _, _, at = features(part.column(text))
                values = own.weights.of(levels, at)
                clean = []
                for i in range(part.num_rows):
                    best, total = own.document(maximal_segments(values[at[i] : at[i + 1]]), at[i + 1] - at[i])
                    clean.append(own.score(min(best, 200.0), min(total, 200.0)) < 0.5)
                yield part.filter(pa.array(clean, pa.bool_()))
        release()

    return docs.mapInArrow(run, docs.schema)
