"""Token counts, encoding and packing against the tokenizer library, and packing bounds."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cladespark.llm import bpe, packing, token_counts
from cladespark.llm.vocab import vocabulary_path

ODD = [
    "I'm we're  <|endoftext|> x \n\n y '' 'r <|startoftext|>A", "日本語 テキスト", "é" * 50, " " * 40 + "a", "a" * 300 + "b" * 300, "abcabcabc" * 40, "", "   ",
    "ﬁ İ ẞ Ⅷ ² \x1c \x85 x", "👍🏽é", "tab\tand\r\nline", "word " * 3000, " nbsp thin",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(100, None, "x", 1), (101, ODD[0], "x", 1), (101, ODD[0], "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, copy int")


def library(name):
    found = Tokenizer.from_file(vocabulary_path(name))
    found.no_truncation()
    return found


def test_counts(spark, docs):
    own = library("byte_bpe_50k.json")
    rows = token_counts.count_tokens(docs).collect()
    assert len(rows) == docs.count()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in rows:
        n = len(own.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 512), texts[r["doc_id"]][:20]
    assert token_counts.count_tokens(docs.limit(0)).count() == 0


def test_every_prefix():
    own, counter = library("byte_bpe_50k.json"), token_counts.counter(vocabulary_path("byte_bpe_50k.json"))
    rng = random.Random(3)
    for text in [*ODD, "The theatre's   rest,\n\n 'tis  12345 don't"]:
        text = text[:400]
        prefixes = counter.prefixes(text)
        for cut in {rng.randrange(len(text) + 1) for _ in range(40)} | {0, len(text)}:
            part = text[:cut]
            if "<|" in part:
                continue
            assert prefixes.at(len(part.encode())) == len(own.encode(part, add_special_tokens=False).ids), (text[:30], cut)
        every = prefixes.every()
        assert every[0] == 0 and every[-1] == prefixes.tokens and len(every) == len(text.encode()) + 1
        for budget in (0, 1, 5, 1000):
            fits = prefixes.fitting(budget)
            assert every[fits] <= budget
            assert fits == len(text.encode()) or every[fits:].max() > budget or budget >= prefixes.tokens


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoding(spark, docs, name):
    own = library(name)
    rows = bpe.digest_documents(docs, vocabulary_path(name)).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        ids = own.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(own.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    real = bpe.encode_documents(docs.where("doc_id = 0"), vocabulary_path(name)).first()
    assert real["ids"] == own.encode(ODD[0], add_special_tokens=False).ids
    assert bpe.encoder(vocabulary_path(name)).decode(real["ids"]) == real["decoded"]


def test_random_words():
    rng = random.Random(1)
    own, encoder = library("word_bpe_49k.json"), bpe.encoder(vocabulary_path("word_bpe_49k.json"))
    texts = ["".join(rng.choices("aabcdehinorst '.1é\n", k=rng.randrange(80))) for _ in range(500)]
    for text, ids in zip(texts, encoder.encode_batch(texts), strict=True):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == own.encode(text, add_special_tokens=False).ids


def test_packing(spark, docs):
    own = library("byte_bpe_50k.json")
    rows = packing.pack_documents(docs, 256).toPandas()
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    wanted = []
    for key, text in texts:
        ids = [*own.encode(text, add_special_tokens=False).ids, 0]
        first = len(ids) % 256 or 256
        cuts = [0, *range(first, len(ids) + 1, 256)]
        wanted += [(key, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(rows[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(wanted)
    for _, part in rows.sort_values("offset").groupby("sequence_id"):
        assert (part["offset"] == part["length"].cumsum() - part["length"]).all() and part["length"].sum() <= 256
    assert packing.pack_documents(docs.limit(0)).count() == 0


def optimum(lengths, capacity):
    """Least bins, by search."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i] and rooms[k] not in rooms[:k]:
                place(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


def test_bounds():
    rng = random.Random(2)
    for _ in range(150):
        lengths = sorted((rng.randrange(1, 21) for _ in range(rng.randrange(1, 8))), reverse=True)
        least = optimum(lengths, 20)
        bins, offsets, used = packing.best_fit_decreasing(np.array(lengths), 20)
        assert packing.lower_bound(np.array(lengths), 20) <= least <= used
        assert all(sum(n for n, b in zip(lengths, bins) if b == k) <= 20 for k in range(used))
    assert packing.lower_bound(np.array([11] * 5 + [9] * 2), 20) == 5
    assert packing.lower_bound(np.zeros(0, int), 20) == 0


def test_exchange(spark):
    """Groups with a gap exchange their documents; all pieces stay, and no more bins are used than before."""
    rng = random.Random(4)
    rows = [(i, 0, 0, 0, rng.choice([700, 690, 680, 1300, 1350]), i) for i in range(900)]
    pieces = spark.createDataFrame(rows, packing.PIECES)
    alone = packing.pack_pieces(pieces, 2048, group_rows=50, exchanges=0).toPandas()
    found = packing.pack_pieces(pieces, 2048, group_rows=50).toPandas()
    assert sorted(found["doc_id"]) == list(range(900))
    assert found["sequence_id"].nunique() <= alone["sequence_id"].nunique()
    assert (found.groupby("sequence_id")["length"].sum() <= 2048).all()


def test_exchange_compares_all_bins(spark, monkeypatch):
    # one piece a bin; the second turn closes its group with more bins than both groups had
    turns = [[(0, 3, 2), (1, 3, 2)], [(0, 7, 7)]]

    def canned(pieces, groups, turn, capacity):
        if turn >= len(turns):
            return pieces.limit(0)
        rows = [(g, 0, 0, 0, 1, 0, (turn << 60) + (g << 28) + b, 0, bins, bound) for g, bins, bound in turns[turn] for b in range(bins)]
        return spark.createDataFrame(rows, packing.PACKED)

    monkeypatch.setattr(packing, "_pack", canned)
    pieces = spark.createDataFrame([(0, 0, 0, 0, 1, 0)], "doc_id long, copy long, piece int, start long, length int, ids_crc32 long")
    found = packing.pack_pieces(pieces, 4, group_rows=1)
    assert found.select("sequence_id").distinct().count() == 6


@pytest.mark.parametrize("seed", range(6))
def test_packing_never_gets_worse(spark, seed):
    """With exchanges a packing has at most the bins it has without, over ties and over lengths that leave gaps."""
    rng = random.Random(seed)
    kinds = [lambda: rng.randrange(1, 101), lambda: rng.choice([34, 35, 51, 66]), lambda: 50, lambda: rng.choice([26, 27, 41, 42])]
    lengths = [kinds[seed % 4]() for _ in range(600)]
    pieces = spark.createDataFrame([(i, i, 0, 0, n, 0) for i, n in enumerate(lengths)], packing.PIECES)
    bins = []
    for exchanges in (0, 3):
        rows = packing.pack_pieces(pieces, 100, 60, exchanges).toPandas()
        assert sorted(rows["doc_id"]) == list(range(600))
        assert (rows.groupby("sequence_id")["length"].sum() <= 100).all()
        bins.append(rows["sequence_id"].nunique())
    assert sum(lengths) / 100 <= bins[1] <= bins[0]


def test_very_long_texts(spark):
    """A text of megabytes, one very long word, and as many empty ones."""
    rng = random.Random(3)
    prose = " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randrange(1, 9))) for _ in range(250_000))
    texts = [prose, "ab" * 60_000, "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own, words = library("byte_bpe_50k.json"), library("word_bpe_49k.json")
    counted = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(frame).collect()}
    digests = {r["doc_id"]: r for r in bpe.digest_documents(frame).collect()}
    pieces = packing.pack_documents(frame).groupBy("doc_id").agg({"length": "sum"}).collect()
    for i, text in enumerate(texts):
        n = len(own.encode(text or "", add_special_tokens=False).ids)
        ids = words.encode(text or "", add_special_tokens=False).ids
        assert counted[i] == n and {r["doc_id"]: r["sum(length)"] for r in pieces}[i] == n + 1
        assert digests[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_merge_order_is_id_order():
    """The faster library merges by least id, the tokenizer by the order of its merges: both must be the same order."""
    path = vocabulary_path("byte_bpe_50k.json")
    assert packing.merges_by_id(path)
