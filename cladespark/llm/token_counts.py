"""Exact token counts at every prefix of a text, by dynamic programming.

Byte-pair encoding has a local test: a sequence of tokens is the encoding of a string
exactly when every two neighbours are *compatible*, that is, when the encoding of
their concatenation is the two of them.  So the last token of the encoding of a prefix
can be found from shorter prefixes: it is the one vocabulary token that ends there and is
compatible with the last token of what it leaves.  ``count[p] = count[p - len(last[p])] + 1``
then gives the exact number of tokens of *every* prefix in one pass, and truncation and
budget questions are answered from the stored counts without encoding anything again.

Merges never cross the pieces into which the vocabulary's pattern splits a text, so the
recurrence runs once for each distinct piece; a text's counts are the running sums.
Where a cut changes the split itself (inside white space or a contraction),
:class:`PrefixCounts` splits the cut tail again and takes its stored or newly computed counts.

Defined results: a null text counts as empty (0 tokens); repeated rows give equal rows;
an empty table gives an empty table; other columns are not read and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbatch import slices, strings
from .vocab import PLAIN_BYTE_LEVEL, byte_characters, definition, is_plain, sections, special_ids, tokenizer, vocabulary_path

#: Distinct pieces whose counts a worker keeps; beyond it the store starts anew.
MAX_PIECES = 200_000
#: Likewise for tokens that were found to be compatible or not.
MAX_PAIRS = 400_000

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, prefix_bytes_at_limit long"


class PrefixCounter:
    """The recurrence for one byte-level vocabulary."""

    def __init__(self, path: str) -> None:
        self.path = path
        model = definition(path)["model"]
        of = {c: b for b, c in byte_characters().items()}
        spell = lambda token: bytes(of[c] for c in token).decode("latin-1")
        special = set(special_ids(path))
        self.ids = {spell(t): i for t, i in model["vocab"].items() if t not in special}
        #: Id of the token that a pair of ids merges into, and the pair's rank.
        self.rank: dict[int, int] = {}
        #: How each token is made: (left, right, rank); (-1, -1, -1) for single bytes.
        self.made = {i: (-1, -1, -1) for i in self.ids.values()}
        for r, merge in enumerate(model["merges"]):
            left, right = (merge.split(" ") if isinstance(merge, str) else merge)
            a, b = self.ids[spell(left)], self.ids[spell(right)]
            self.rank[a << 20 | b] = r
            whole = self.ids[spell(left) + spell(right)]
            if self.made[whole][2] < 0:
                self.made[whole] = (a, b, r)
        #: Finds every vocabulary token in a piece, byte by byte.
        self.matches = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.matches.add_word(token, (i, len(token)))
        self.matches.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.totals = _Totals(self, special)
        self.stored: dict[str, bytes | tuple[int, ...]] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoding of two tokens' text is the two: no merge across the border comes before those that make them.

        Undoes the merges of both from the latest to the earliest; the pair at the border must not
        merge before the stage it stands in has ended.
        """
        last = 1 << 60
        while True:
            if self.rank.get(a << 20 | b, last) < last:
                return False
            _, right_of_a, ra = self.made[a]
            left_of_b, _, rb = self.made[b]
            if ra < 0 and rb < 0:
                return True
            # Of two equal merges the left one is made first, so the right one is undone first.
            if ra > rb:
                a, last = right_of_a, ra
            else:
                b, last = left_of_b, rb + 1

    def piece_counts(self, piece: bytes) -> bytes | tuple[int, ...]:
        """count[p] for p = 0..len(piece): tokens of the encoding of piece[:p]."""
        size = len(piece) + 1
        count, last, pairs = [0] * size, [-1] * size, self.pairs
        for end, (token, length) in self.matches.iter(piece.decode("latin-1")):
            end += 1
            if last[end] < 0:
                start = end - length
                if start:
                    pair = last[start] << 20 | token
                    fits = pairs.get(pair)
                    if fits is None:
                        if len(pairs) >= MAX_PAIRS:
                            pairs.clear()
                        fits = pairs[pair] = self.compatible(last[start], token)
                    if not fits:
                        continue
                last[end], count[end] = token, count[start] + 1
        return bytes(count) if size <= 256 else tuple(count)

    def counts_of(self, piece: str) -> bytes | tuple[int, ...]:
        """Stored counts at the bytes of a piece; those of a special string, which is one token, are its whole."""
        found = self.stored.get(piece)
        if found is None:
            if len(self.stored) >= MAX_PIECES:
                self.stored.clear()
                self.totals.clear()
            raw = piece.encode()
            found = (0,) + (1,) * len(raw) if piece in self.totals.special else self.piece_counts(raw)
            self.stored[piece] = found
            self.totals[piece] = found[-1]
        return found

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text without special strings, as the library splits it."""
        if is_plain(text):
            return PLAIN_BYTE_LEVEL.findall(text)
        split = tokenizer(self.path).pre_tokenizer.pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in split]

    def prefixes(self, text: str) -> PrefixCounts:
        if "<|" not in text:
            return PrefixCounts(self, self.pieces(text))
        names: list[str] = []
        for special, part in sections(self.path, text):
            names += [part] if special else self.pieces(part)
        return PrefixCounts(self, names)


class _Totals(dict):
    """The whole count of each piece, computed when first asked for."""

    def __init__(self, counter: PrefixCounter, special: set[str]) -> None:
        super().__init__()
        self.counter, self.special = counter, special

    def __missing__(self, piece: str) -> int:
        return self.counter.counts_of(piece)[-1]


class PrefixCounts:
    """The counts of one text: its pieces, each with its stored counts. Questions about prefixes need no encoding."""

    def __init__(self, counter: PrefixCounter, names: list[str]) -> None:
        self.counter, self.names = counter, names
        self.tokens = sum(map(counter.totals.__getitem__, names))

    def at(self, n_bytes: int) -> int:
        """Exact tokens of the prefix of so many bytes, which must end between characters.

        A prefix that ends inside a special string has it as ordinary text, as the library has.
        """
        own, done, tokens = self.counter, 0, 0
        for k, piece in enumerate(self.names):
            size = len(piece.encode())
            if done + size > n_bytes or (done + size == n_bytes and k + 1 < len(self.names) and piece.isspace()):
                # The split of the tail may differ from the whole text's: white space gives its last
                # character to the next word, and contractions need their last letter.
                raw = piece.encode()
                if k and self.names[k - 1].isspace():
                    before = self.names[k - 1]
                    tokens -= own.totals[before]
                    raw, done = before.encode() + raw, done - len(before.encode())
                tail = raw[: n_bytes - done].decode()
                return tokens + sum(own.totals[p] for p in own.pieces(tail)) if tail else tokens
            done, tokens = done + size, tokens + own.totals[piece]
        return tokens

    def fitting(self, budget: int) -> int:
        """Bytes of the longest prefix that ends between characters and whose tokens fit in a budget.

        Pieces are those of the whole text; in the piece that crosses the budget its stored counts decide.
        """
        own, done, tokens = self.counter, 0, 0
        for piece in self.names:
            have = own.totals[piece]
            if tokens + have > budget:
                counts, raw = own.counts_of(piece), piece.encode()
                if piece not in own.totals.special:
                    done += max(p for p in range(len(raw)) if counts[p] <= budget - tokens and (raw[p] & 0xC0) != 0x80)
                return done
            done, tokens = done + len(piece.encode()), tokens + have
        return done

    def every(self) -> np.ndarray:
        """Counts at every byte of the whole text (n_bytes + 1), with its own split into pieces."""
        out, tokens = [np.zeros(1, np.int64)], 0
        for piece in self.names:
            own = np.array(list(self.counter.counts_of(piece)[1:]), np.int64)
            out.append(own + tokens)
            tokens += int(own[-1])
        return np.concatenate(out)


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(docs: DataFrame, limit: int = 512, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Token counts of whole texts and where a budget of ``limit`` tokens ends.

    Returns doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) and prefix_bytes_at_limit
    (bytes of the text that fit in the budget, from the stored prefix counts).
    One narrow pass, no shuffle.
    """
    path = path or vocabulary_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = strings(part.column("text"))
                n_bytes, n_tokens, fits = [], [], []
                for text in texts:
                    prefixes = own.prefixes(text)
                    size = len(text.encode())
                    n_bytes.append(size)
                    n_tokens.append(prefixes.tokens)
                    fits.append(size if prefixes.tokens <= limit else prefixes.fitting(limit))
                over = [n > limit for n in n_tokens]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(over, pa.bool_()), pa.array(fits, pa.int64())], names=["doc_id", "n_bytes", "n_tokens", "over_limit", "prefix_bytes_at_limit"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, SCHEMA)
