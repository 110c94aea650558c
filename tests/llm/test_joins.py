"""N-gram joins, vector links and components against brute force."""

import random
import re

import numpy as np
import pytest

from cladespark.llm import components, hnsw, ngram_join


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    loose = [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    links = chain + star + loose + [(5, 5), (1, 0)]
    found = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = roots({x for a, b in links if a != b for x in (a, b)}, links)
    assert found == wanted
    parts = components.components(spark.createDataFrame(links, "a long, b long"), chunk=40)
    assert {r["id"]: r["component"] for r in parts.collect()} == wanted
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def make_corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for length in (3, 6, 12, 40, 66, 90, 200):
        for _ in range(3):
            base = rng.choices(words, k=length)
            texts.append(base)
            for edits in (0, 1, 1, 2, 3, 5):
                copy = list(base)
                for _ in range(edits):
                    copy[rng.randrange(len(copy))] = rng.choice(words)
                texts.append(copy)
    shared = rng.choices(words, k=50)
    texts += [shared + rng.choices(words, k=rng.randrange(3, 80)) for _ in range(25)]
    texts += [shared + shared[:10], [], ["one"], ["One"], ["one", "two"]]
    return [" ".join(t) for t in texts] + [None, "", " \t\n", "É x y z É x y z"]


@pytest.mark.parametrize(("width", "percent", "seed"), [(4, 85, 1), (5, 80, 2), (1, 60, 3)])
def test_ngram_join(spark, width, percent, seed):
    texts = make_corpus(seed)
    docs = spark.createDataFrame([(i * 3, t, 1, "x") for i, t in enumerate(texts)] + [(0, texts[0], 1, "x")], "doc_id long, text string, n long, component_id string")
    rows = ngram_join.join(docs, width, percent).collect()
    assert len(rows) == len(texts) + 1
    sets = {i * 3: shingles(t, width) for i, t in enumerate(texts)}
    keys = list(sets)
    links = [(a, b) for k, a in enumerate(keys) for b in keys[k + 1 :] if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    wanted = roots(keys, links)
    for r in rows:
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["component_id"] == wanted[r["doc_id"]], texts[r["doc_id"] // 3]
    kept = ngram_join.without_near_copies(docs, width, percent)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(wanted.values()))


def test_join_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.join(docs).count() == 0
    assert ngram_join.join(spark.createDataFrame([(1, None), (2, "a b c d e f")], "doc_id long, text string")).count() == 2


def test_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 16))
    many = [base[i % 40] + rng.normal(size=16) * rng.choice([0.01, 0.08, 0.3]) for i in range(600)]
    many += [base[0] + rng.normal(size=16) * 0.01 for _ in range(300)]
    rows = [(i, [float(np.float32(x)) for x in v], 1) for i, v in enumerate(many)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] * 16, 1), (2004, [1.0, None] * 8, 1), (2005, [1.0, 2.0], 1), (2006, [2.0, 4.0], 1), (0, rows[0][1], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    found = hnsw.near_duplicates(frame).collect()
    assert len(found) == len(rows)
    full = np.array([np.float64(v) for _, v, _ in rows[:900]])
    unit = full / np.linalg.norm(full, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    wanted = roots(range(900), zip(*np.nonzero(linked)))
    got = {r["vec_id"]: r for r in found}
    counts = np.array([got[i]["n_links"] for i in range(900)])
    assert (counts <= linked.sum(axis=1)).all() and counts.sum() >= 0.98 * linked.sum()
    assert sum(got[i]["component_id"] == wanted[i] for i in range(900)) >= 895
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (2000, 2001, 2002, 2003, 2004))
    assert (got[2005]["n_links"], got[2006]["component_id"], got[2006]["kept"]) == (1, 2005, False)
    assert hnsw.near_duplicates(frame.limit(0)).count() == 0


def test_recall():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(1500, 24)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    layers = hnsw.build(vectors, 0)
    near, _ = hnsw.search(layers, vectors, vectors[:200], 64)
    best = np.argsort(-(vectors[:200] @ vectors.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b[:10])) / 10 for a, b in zip(best, near)]) >= 0.9
    for n in (1, 2, 5):
        small = hnsw.build(vectors[:n], 0)
        assert sorted(hnsw.search(small, vectors[:n], vectors[:1], 8)[0][0].tolist()) == list(range(n))


def ring(n):
    """A poor graph: one layer in which each node leads to the next alone."""
    neighbours = np.full((n, hnsw.NEIGHBOURS), n, np.int64)
    neighbours[:, 0] = (np.arange(n) + 1) % n
    return [(np.arange(n), neighbours)]


def test_audit_without_near_copies():
    rng = np.random.default_rng(5)
    full = rng.normal(size=(700, 24))
    queries = rng.normal(size=(300, 24))
    queries[131] = full[650] + 0.01 * rng.normal(size=24)  # the only link, and no audited query
    unit, query_unit = [(x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32) for x in (full, queries)]
    q, node, spanning, many = hnsw.link_slice(ring(700), np.arange(700), full, unit, np.arange(1000, 1300), queries, query_unit, 0.95)
    assert list(zip(q, node)) == [(131, 650)] and not many and not sum(map(len, spanning))


def test_sealed_off_vectors():
    rng = np.random.default_rng(6)
    full = rng.normal(size=(700, 24))
    queries = np.concatenate([full[350:] + 0.01 * rng.normal(size=(350, 24))])
    layers = ring(700)
    layers[0][1][349] = 700  # nothing leads from the first half to the second
    unit, query_unit = [(x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32) for x in (full, queries)]
    q, node, _, _ = hnsw.link_slice(layers, np.arange(700), full, unit, np.arange(1000, 1350), queries, query_unit, 0.95)
    assert set(zip(q, node)) == {(i, 350 + i) for i in range(350)}


def test_links_found_from_one_end(spark):
    """A listed link counts for both ends; what a vector has as a number isn't counted again."""
    shards = 4
    shard = {r["v"]: r["s"] for r in spark.range(20).selectExpr("id as v", f"pmod(xxhash64(id), {shards}) as s").collect()}
    rows = [(hnsw.LISTED, 1, 2, 1, 3, shard[2]), (hnsw.LISTED, 2, 1, 3, 1, shard[1]), (hnsw.LISTED, 3, 4, 5, 2, shard[4]), (hnsw.SPANNING, 6, 7, 0, 0, shard[7])]
    rows += [(hnsw.NUMBER, 4, 0, 40, 0, shard[3]), (hnsw.NUMBER, 4, 0, 50, 0, (shard[3] + 1) % shards)]
    found = hnsw.link_counts(spark.createDataFrame(rows, hnsw.FOUND), shards)
    assert {r["vec_id"]: r["n_links"] for r in found.collect()} == {1: 1, 2: 3, 3: 5, 4: 90}


def test_sparse_links(spark):
    """One vector in a hundred has a near copy, in several shards: recall and symmetric counts against brute force."""
    rng = np.random.default_rng(11)
    full = rng.normal(size=(3000, 32))
    full[2970:] = full[:30] + 0.05 * rng.normal(size=(30, 32))
    full[2999] = full[2998]  # a tie
    unit = full / np.linalg.norm(full, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    wanted = linked.sum(axis=1)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(full)] + [(None, [1.0] * 32)], "vec_id long, embedding array<double>")
    rows = hnsw.near_duplicates(frame, shard_rows=400).collect()
    got = np.array([r["n_links"] for r in sorted((r for r in rows if r["vec_id"] is not None), key=lambda r: r["vec_id"])])
    assert len(rows) == 3001 and (got <= wanted).all() and got.sum() >= 0.9 * wanted.sum()
    pairs = {(a, b) for a, b in zip(*np.nonzero(linked))}
    of = {r["vec_id"]: r["component_id"] for r in rows}
    assert sum(of[a] == of[b] for a, b in pairs) >= 0.9 * len(pairs)


def test_many_equal_vectors(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(300, 16))
    rows = [(i, base[i].tolist()) for i in range(300)]
    rows += [(1000 + i, base[0].tolist()) for i in range(400)] + [(2000 + i, (base[0] + 0.01 * rng.normal(size=16)).tolist()) for i in range(3)]
    got = {r["vec_id"]: r for r in hnsw.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    group = [0, *range(1000, 1400), *range(2000, 2003)]
    assert all((got[i]["n_links"], got[i]["component_id"]) == (403, 0) for i in group)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(1, 300))


def test_cells_do_not_grow_with_the_input():
    """A vector goes to few of many cells, and pairs at just the threshold meet in one."""
    rng = np.random.default_rng(13)
    full = rng.normal(size=(9000, 32))
    full[:400] = full[0] + 0.02 * rng.normal(size=(400, 32))
    unit = (full / np.linalg.norm(full, axis=1)[:, None]).astype(np.float32)
    unit = unit[rng.permutation(9000)]
    cells = hnsw.fit_cells(unit[:3000], 9000, 0.95, 60)
    assert len(cells.pivots) >= 100 and (cells.pivots @ cells.pivots.T - np.eye(len(cells.pivots))).max() < 0.95
    away = rng.normal(size=unit.shape)
    away -= np.einsum("ad,ad->a", away, unit)[:, None] * unit
    partners = (0.95 * unit + (1 - 0.95**2) ** 0.5 * away / np.linalg.norm(away, axis=1)[:, None]).astype(np.float32)
    own, other = cells.of(unit), cells.of(partners)
    assert own.shape[1] <= max(hnsw.CELLS) and (own[:, 0] >= 0).all()
    assert (hnsw._meet(own, other) < len(cells.pivots)).mean() >= 0.95
    assert hnsw.fit_cells(unit[:3000], 9000, 0.95, 9000) is None


def test_cells_of_several_blocks(spark):
    """Large cells are dealt to blocks: numbers and components by brute force, with equal vectors and two lengths."""
    rng = np.random.default_rng(17)
    full = rng.normal(size=(4000, 24))
    full[:1500] = full[0] + 0.05 * rng.normal(size=(1500, 24))
    full[1500:1560] = full[1500]
    unit = full / np.linalg.norm(full, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(full)] + [(5000 + i, [1.0, i / 10]) for i in range(3)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in hnsw.near_duplicates(frame, shard_rows=50).collect()}
    assert len(got) == 4003 and [got[5000 + i]["n_links"] for i in range(3)] == [2, 2, 2]
    counts = np.array([got[i]["n_links"] for i in range(4000)])
    wanted = linked.sum(axis=1)
    assert (counts <= wanted).all() and counts.sum() >= 0.98 * wanted.sum()
    assert (counts[1500:1560] >= 59).all()
    of = roots(range(4000), zip(*np.nonzero(linked)))
    assert sum(got[i]["component_id"] == of[i] for i in range(4000)) >= 3980


def test_vectors_go_to_few_cells(spark, monkeypatch):
    """The rows that are dealt out grow with the vectors, not with vectors times cells."""
    rng = np.random.default_rng(19)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3000, 32)))], "vec_id long, embedding array<double>")
    dealt = []
    monkeypatch.setattr(hnsw, "dealt", lambda *a, deal=hnsw.dealt: dealt.append(deal(*a)) or dealt[0])
    assert hnsw.near_duplicates(frame, shard_rows=30).where("n_links = 0").count() == 3000
    assert dealt[0].count() <= max(hnsw.CELLS) * 3000 and dealt[0].select("cell").distinct().count() >= 60
