"""Arrow text columns as flat byte arrays: the numpy side shared by the text operators.

Everything here works on whole texts.  A batch is cut into slices of a bounded number of
bytes only so that the numpy temporaries stay small; a text longer than the bound is a
slice of its own.  Null texts count as empty.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Bytes of text handled at once; numpy temporaries are about 20 times this.
SLICE_BYTES = 1 << 20

#: Rows and bytes that Spark hands to Python at once in the registered queries.
BATCH_ROWS, BATCH_BYTES = 1_000, 16 << 20

_RNG = np.random.default_rng(0x5EED)
_BYTE_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)

#: The white space of the shingle contract: space and the bytes 9 to 13.
ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[32, 9, 10, 11, 12, 13]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each part holds at most ``max_bytes`` of ``column`` or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start, total = np.cumsum(sizes), 0, 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(ends, total + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start, total = stop, int(ends[stop - 1])


def strings(array: pa.Array) -> list[str]:
    return pc.fill_null(array, "").to_pylist()


def flat_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another, and the len(array) + 1 offsets."""
    array = pc.fill_null(array, "").cast(pa.large_string())
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64, extended on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))
        return self.up, self.down


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), so that every bit depends on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = ASCII_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word: a maximal run of bytes that are no separators, within one text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~separator[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: a polynomial by differences of one running sum, then mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _POWERS.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(array: pa.Array, separator: np.ndarray = ASCII_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ASCII-lower-cased words of all texts, and where each text's words begin (len + 1)."""
    data, offsets = flat_bytes(array)
    data = LOWER[data]
    starts, ends = words(data, offsets, separator)
    return span_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def shingle_sets(array: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: ``width`` consecutive words.

    A text of fewer words has its whole word sequence as its only shingle; a text without
    words has the empty set.
    """
    hashes, at = word_hashes(array)
    count = np.diff(at)
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    if n >= width:
        part = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            part = mix(part * np.uint64(_BASE) + hashes[k : n - width + 1 + k])
        rolled[: n - width + 1] = part
    out = []
    for i, c in enumerate(count):
        a = at[i]
        if c >= width:
            out.append(np.unique(rolled[a : a + c - width + 1]))
        elif c:
            h = np.zeros(1, np.uint64)
            for k in range(c):
                h = mix(h * np.uint64(_BASE) + hashes[a + k : a + k + 1])
            out.append(h ^ np.uint64(c))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def small_batches(spark: SparkSession) -> None:
    """For an application's own session: less handed to Python at once than Spark's default (10,000 rows or 64 MB).

    Operators don't need it and don't set it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release() -> None:
    """Gives freed memory of this worker back, which it would keep for its next task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def single_threaded() -> None:
    """One thread per Python worker: the executor's cores are what Spark has given out."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
