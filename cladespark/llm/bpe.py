"""Byte-pair encoding and decoding with an index of pair occurrences.

The distinct pieces of a slice of a partition that are not known yet stand one after
another as linked symbols.  An index maps each mergeable pair to all its positions; the
active pairs are taken in ascending rank from a heap, every position of a pair merges in
one go, and only the lists of the pairs beside it change.  A merge can only make pairs
of higher rank (checked when the vocabulary is loaded), so each rank is taken once and the
result is that of merging each piece by itself.

Positions that an earlier merge has changed stay in their lists and are recognised when
read, which costs less than deleting them.

Defined results: a null text counts as empty (no ids, empty decoded text); special strings
in a text give their special ids, as the tokenizers library has it by default; repeated
rows give equal rows; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbatch import slices, strings
from .vocab import PLAIN_BYTE_LEVEL, PLAIN_WORD, byte_characters, definition, is_plain, sections, special_ids, tokenizer, vocabulary_path

#: Distinct pieces whose ids a worker keeps; beyond it the store starts anew.
MAX_PIECES = 250_000

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PairIndexEncoder:
    """Encodes and decodes with one vocabulary file (byte-level, or lower-cased words with word ends)."""

    def __init__(self, path: str) -> None:
        self.path = path
        model = definition(path)["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.lower_words = definition(path)["normalizer"] is not None
        byte = [byte_characters()[b] for b in range(256)]
        #: Ids of the bytes inside a piece and at its end.
        self.inner = [self.vocab[c] for c in byte]
        self.last = [self.vocab[c + self.suffix] for c in byte]
        self.special = special_ids(path)
        self.token_of = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.byte_decoder = definition(path)["decoder"] is not None
        #: (rank, merged id) by the two ids.
        self.merge: dict[int, tuple[int, int]] = {}
        made: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, whole = self.vocab[left], self.vocab[right], self.vocab[left + right]
            self.merge[a << 20 | b] = (rank, whole)
            made[whole] = min(rank, made.get(whole, rank))
        for key, (rank, _) in self.merge.items():
            if max(made.get(key >> 20, -1), made.get(key & 0xFFFFF, -1)) >= rank:
                raise ValueError("a merge uses a token that is only made later: ranks can't be taken in one ascending pass")
        self.merge_keys = np.array(sorted(self.merge), np.int64)
        #: Ids of a piece as little-endian 32-bit integers, and the piece decoded.
        self.known: dict[str, bytes] = {}
        self.spelled: dict[str, str] = {}

    # -- splitting ---------------------------------------------------------------------------

    def pieces(self, text: str) -> list[str]:
        out: list[str] = []
        for special, part in sections(self.path, text):
            if special:
                out.append(part)
            elif not is_plain(part):
                out += self._library_pieces(part)
            elif self.lower_words:
                # White space only separates here, so the normaliser's joining of it changes nothing.
                out += PLAIN_WORD.findall(unicodedata.normalize("NFC", part).lower())
            else:
                out += PLAIN_BYTE_LEVEL.findall(part)
        return out

    def _library_pieces(self, part: str) -> list[str]:
        library = tokenizer(self.path)
        if library.normalizer is not None:
            part = library.normalizer.normalize_str(part)
        return [part[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(part)]

    # -- merging -----------------------------------------------------------------------------

    def learn(self, pieces: Iterable[str]) -> None:
        """Encodes pieces that are not known yet, all together."""
        asked = set(pieces)
        new = [p for p in asked if p not in self.known]
        if len(self.known) + len(new) > MAX_PIECES:
            self.known.clear()
            self.spelled.clear()
            new = list(asked)
        symbols: list[int] = []
        starts: list[int] = []
        inner, last = self.inner, self.last
        for piece in new:
            starts.append(len(symbols))
            if piece in self.special:
                symbols.append(self.special[piece])
            else:
                raw = piece.encode()
                symbols += map(inner.__getitem__, raw)
                symbols[-1] = last[raw[-1]]
            symbols.append(-1)  # no pair reaches over the end of a piece
        self._merge_all(symbols)
        starts.append(len(symbols))
        names = self.token_of
        for piece, a, b in zip(new, starts, starts[1:], strict=False):
            ids = [s for s in symbols[a:b] if s >= 0]
            self.known[piece] = array("I", ids).tobytes()
            self.spelled[piece] = ("" if self.byte_decoder else " ").join(names[i] for i in ids)

    def _merge_all(self, symbols: list[int]) -> None:
        """Merges in place; a symbol that went into its left neighbour becomes -2."""
        n = len(symbols)
        if n < 2:
            return
        merge, push = self.merge.get, heapq.heappush
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        positions = self._index(np.array(symbols, np.int64))
        listed = positions.get
        active = [(self.merge[key][0], key) for key in positions]
        heapq.heapify(active)
        while active:
            key = heapq.heappop(active)[1]
            a, b, whole = key >> 20, key & 0xFFFFF, self.merge[key][1]
            places = positions.pop(key)
            places.sort()  # leftmost first, for runs of one symbol
            high = whole << 20
            for i in places:
                j = after[i]
                if symbols[i] != a or symbols[j] != b:
                    continue
                symbols[i], symbols[j] = whole, -2
                k = after[i] = after[j]
                before[k] = i
                pair = high | symbols[k]
                if (found := merge(pair)) is not None:
                    if (places_of := listed(pair)) is not None:
                        places_of.append(i)
                    else:
                        positions[pair] = [i]
                        push(active, (found[0], pair))
                h = before[i]
                if h >= 0 and symbols[h] >= 0:
                    pair = symbols[h] << 20 | whole
                    if (found := merge(pair)) is not None:
                        if (places_of := listed(pair)) is not None:
                            places_of.append(h)
                        else:
                            positions[pair] = [h]
                            push(active, (found[0], pair))

    def _index(self, symbols: np.ndarray) -> dict[int, list[int]]:
        """Positions of every mergeable pair of neighbours."""
        keys = symbols[:-1] << 20 | symbols[1:]
        at = np.flatnonzero((symbols[:-1] >= 0) & (symbols[1:] >= 0))
        keys = keys[at]
        near = np.minimum(np.searchsorted(self.merge_keys, keys), len(self.merge_keys) - 1)
        mergeable = self.merge_keys[near] == keys
        at, keys = at[mergeable], keys[mergeable]
        order = np.argsort(keys, kind="stable")
        at, keys = at[order], keys[order]
        heads = np.flatnonzero(np.diff(keys, prepend=-1))
        ends = [*heads[1:].tolist(), len(keys)]
        at = at.tolist()
        return {key: at[x:y] for key, x, y in zip(keys[heads].tolist(), heads.tolist(), ends, strict=True)}

    # -- whole texts -------------------------------------------------------------------------

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return [ids for ids, _ in self.encode_pieces(texts)]

    def encode_pieces(self, texts: list[str]) -> list[tuple[bytes, list[str]]]:
        split = [self.pieces(t) for t in texts]
        self.learn(itertools.chain.from_iterable(split))
        return [(b"".join(map(self.known.__getitem__, pieces)), pieces) for pieces in split]

    def decode(self, ids: Iterable[int]) -> str:
        """As the library decodes with special tokens kept; ids outside the vocabulary are left out."""
        tokens = [self.token_of[i] for i in ids if i in self.token_of]
        return self._text("".join(tokens)) if self.byte_decoder else " ".join(tokens)

    def decode_pieces(self, pieces: list[str]) -> str:
        """decode() of the ids of pieces that were just encoded, from what is stored by piece."""
        spelled = map(self.spelled.__getitem__, pieces)
        return self._text("".join(spelled)) if self.byte_decoder else " ".join(spelled)

    def _text(self, characters: str) -> str:
        of = {c: b for b, c in byte_characters().items()}
        return b"".join(bytes([of[c]]) if c in of else c.encode() for c in characters).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> PairIndexEncoder:
    return PairIndexEncoder(path)


def encode_documents(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of whole texts: the operator's real outputs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, blobs, decoded in _encoded(batches, path):
            arrays = [pa.array(array("I", blob).tolist(), pa.int32()) for blob in blobs]
            yield pa.RecordBatch.from_arrays([ids, pa.array([a.to_pylist() for a in arrays], pa.list_(pa.int32())), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of whole texts. One narrow pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, blobs, decoded in _encoded(batches, path):
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(b) // 4 for b in blobs], pa.int64()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in blobs], pa.string()),
                    pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, SCHEMA)


def _encoded(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[tuple[pa.Array, list[bytes], list[str]]]:
    own = encoder(path or vocabulary_path("word_bpe_49k.json"))
    for batch in batches:
        for part in slices(batch, "text"):
            found = own.encode_pieces(strings(part.column("text")))
            yield part.column("doc_id").cast(pa.int64()), [ids for ids, _ in found], [own.decode_pieces(pieces) for _, pieces in found]
