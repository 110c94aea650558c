"""Best-fit packing with certified bin counts.

Documents become token pieces of at most ``capacity`` tokens.  Pieces are dealt by a hash
over groups of about ``GROUP_ROWS`` pieces, each of which is packed by best-fit
decreasing.  Lower bounds from dual feasible functions certify a group's number of bins;
groups with a gap between the two exchange their documents (they are dealt anew among
half as many groups) and run best-fit decreasing again; the new packing is taken if it
needs fewer bins in total.  Only lengths and keys are shuffled, never texts or ids, and a group's
size doesn't depend on the input's.

Defined results: a null text counts as empty and is one piece with the end id alone;
rows of one doc_id are told apart by a row number within it, so repeated rows are all packed;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stored
from .textbatch import release, slices, strings
from .vocab import BYTE_LEVEL_PATTERN, byte_characters, definition, is_plain, special_ids, tokenizer, vocabulary_path

#: Pieces dealt to a group on average; a group is a few numbers per piece.
GROUP_ROWS = 60_000
#: Times that groups with a gap exchange their documents.
EXCHANGES = 3

PIECES = "doc_id long, copy long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long, bins long, bound long"


def merges_by_id(path: str) -> bool:
    """Whether a vocabulary's merges come in the order of their results' ids."""
    model = definition(path)["model"]
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    return all(a < b for a, b in zip(merged, merged[1:], strict=False))


@lru_cache(maxsize=2)
def _fast(path: str):
    """The same vocabulary in a faster library, for texts on whose splitting both agree."""
    import tiktoken

    of = {c: b for b, c in byte_characters().items()}
    special = special_ids(path)
    if not merges_by_id(path):
        raise ValueError(f"{path}: merges aren't in the order of their ids")
    ranks = {bytes(of[c] for c in t): i for t, i in definition(path)["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("own", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encode(path: str, texts: list[str]) -> list[list[int]]:
    """Ids as the tokenizers library gives them, special strings included, without added tokens."""
    plain = [is_plain(t) for t in texts]
    fast = _fast(path)
    others = [t for t, p in zip(texts, plain, strict=True) if not p]
    rest = iter(tokenizer(path).encode_batch(others, add_special_tokens=False) if others else ())
    return [(fast.encode(t, allowed_special="all") if "<|" in t else fast.encode_ordinary(t)) if p else next(rest).ids for t, p in zip(texts, plain, strict=True)]


def token_pieces(docs: DataFrame, capacity: int = 2048, end_id: int = 0, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids; of a longer document all but the first have exactly so many.

    ``copy`` tells rows of the same doc_id apart.
    """
    path = path or vocabulary_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows: list[list] = [[], [], [], [], [], []]
                keys, copies = part.column("doc_id").to_pylist(), part.column("copy").to_pylist()
                for key, copy, ids in zip(keys, copies, encode(path, strings(part.column("text"))), strict=True):
                    ids = array("I", ids)
                    ids.append(end_id)
                    first = len(ids) % capacity or capacity
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        for column, value in zip(rows, (key, copy, k, a, b - a, zlib.crc32(ids[a:b].tobytes())), strict=True):
                            column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows, kinds, strict=True)], names=["doc_id", "copy", "piece", "start", "length", "ids_crc32"])
        release()

    own = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("copy"), F.col(text_column).alias("text"))
    return own.mapInArrow(run, PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of three families of dual feasible functions.

    The identity; the threshold functions (items over capacity - k count whole, those under k
    not at all) for every k; and the rounding functions x -> floor((k + 1) x / capacity) / k,
    exact where (k + 1) x is a multiple of capacity.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    mass = count * size
    best = -(-int(mass.sum()) // capacity)
    n_up_to, mass_up_to = np.cumsum(count), np.cumsum(mass)
    total = int(n_up_to[-1])
    for k in range(1, capacity // 2 + 1):
        whole = total - int(n_up_to[capacity - k])
        rest = int(mass_up_to[capacity - k] - mass_up_to[k - 1])
        best = max(best, whole + -(-rest // capacity))
    used = np.flatnonzero(count)
    for k in range(1, 101):
        scaled = (k + 1) * used
        value = np.where(scaled % capacity == 0, used * k, scaled // capacity * capacity)  # times k * capacity
        best = max(best, -(-int((value * count[used]).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each item, and the number of bins.

    One bit for each amount of room that some bin has left, so the tightest bin that fits is the lowest
    set bit from the item's length on.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            target = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, target = capacity, used
            used += 1
        bins[i], offsets[i] = target, capacity - room
        left = room - length
        if left:
            if not by_room[left]:
                rooms |= 1 << left
            by_room[left].append(target)
    return bins, offsets, used


def _pack(pieces: DataFrame, groups: int, turn: int, capacity: int) -> DataFrame:
    """Packs each group; sequence numbers of different turns and groups don't meet."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "copy", "piece"], ignore_index=True)
        lengths = rows["length"].to_numpy()
        bins, offsets, used = best_fit_decreasing(lengths, capacity)
        rows["sequence_id"] = (np.int64(turn) << 60) + (np.int64(key[0]) << 28) + bins
        return rows.assign(offset=offsets, bins=used, bound=lower_bound(lengths, capacity))[[c.split()[0] for c in PACKED.split(", ")]]

    dealt = pieces.select("doc_id", "copy", "piece", "start", "length", "ids_crc32", F.pmod(F.xxhash64("doc_id", "copy", "piece", F.lit(turn)), F.lit(groups)).alias("group"))
    return dealt.groupBy("group").applyInPandas(run, PACKED)


def pack_pieces(pieces: DataFrame, capacity: int = 2048, group_rows: int = GROUP_ROWS, exchanges: int = EXCHANGES) -> DataFrame:
    """Adds sequence_id, offset, bins and bound (of the piece's group) to pieces."""
    groups = max(1, -(-pieces.count() // group_rows))
    done: list[DataFrame] = []
    current = stored(_pack(pieces, groups, 0, capacity), "packed")
    for turn in range(1, exchanges + 1):
        open_groups, bins = _gaps(current)
        if open_groups < 2:
            break
        done.append(current.where("bins = bound"))
        current = current.where("bins > bound")
        again = stored(_pack(current, -(-open_groups // 2), turn, capacity), "packed")
        if _bins(again) >= bins:  # both over the same pieces
            break
        current = again
    for part in done:
        current = current.unionByName(part)
    return current


def _bins(packed: DataFrame) -> int:
    """Bins of all groups."""
    by_group = packed.groupBy((F.col("sequence_id") / F.lit(1 << 28)).cast("long").alias("group")).agg(F.max("bins").alias("bins"))
    return by_group.agg(F.coalesce(F.sum("bins"), F.lit(0)).alias("bins")).first()["bins"]


def _gaps(packed: DataFrame) -> tuple[int, int]:
    """Groups with a gap, and the bins these have together: two numbers for any input."""
    by_group = packed.where("bins > bound").groupBy((F.col("sequence_id") / F.lit(1 << 28)).cast("long").alias("group")).agg(F.max("bins").alias("bins"))
    row = by_group.agg(F.count("*").alias("n"), F.coalesce(F.sum("bins"), F.lit(0)).alias("bins")).first()
    return row["n"], row["bins"]


def pack_documents(docs: DataFrame, capacity: int = 2048, path: str | None = None, end_id: int = 0) -> DataFrame:
    """Pieces of all documents with their places.

    The pieces (a few numbers each) are stored once, so that texts are encoded once however
    often groups are dealt anew.
    """
    pieces = stored(token_pieces(docs, capacity, end_id, path), "pieces")
    return pack_pieces(pieces, capacity)
