"""The pipeline's stages, one after another, on a small corpus with known cases."""

import random
import struct
import zlib

from test_joins import roots, shingles
from test_text_scans import masked
from tokenizers import Tokenizer

import corpus_pipeline
from cladespark.llm import toxicity
from cladespark.llm.vocab import vocabulary_path


def test_stages(spark, tmp_path):
    rng = random.Random(3)
    words = [a + b for a in ("ber", "tan", "lor", "mis") for b in ("da", "no", "ri", "tu", "el")]
    rows, labels = [], []
    for i in range(300):
        text = rng.choices(words, k=60)
        if i % 5 == 0:
            for _ in range(6):
                text[rng.randrange(60)] = rng.choice(["vexor", "grumple"])
        rows.append((i, " ".join(text), "en", "s", 1))
        labels.append((i, 1, int(i % 5 == 0)))
    near = rows[1][1].split()
    near[30] = "other"
    rows += [(1000, rows[1][1], "en", "s", 1), (1001, " ".join(near), "en", "s", 1), (1002, 'token = "' + "0a1b2c3d" * 5 + '" rest of it', "en", "s", 1), (1003, None, "en", "s", 1), (1004, "", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
    clean = {i for i, *_ in rows if i % 5 or i >= 1000}
    assert len(set(seen["toxicity"]) & clean) >= len(clean) - 2 and len(set(seen["toxicity"]) - clean) <= 2
    assert set(seen["toxicity"]) - set(seen["ngram_jaccard"]) == {1000, 1001}
    assert set(seen["secret_scan"]) == set(seen["ngram_jaccard"])
    masked = seen["secret_scan"][1002]
    assert masked["text"].startswith("[SECRET]") and masked["n_chars"] == len(masked["text"])
    assert set(seen["packing"]) == set(seen["secret_scan"])


def test_rows_without_own_id(spark):
    rng = random.Random(8)
    a, b, c, d = (" ".join(f"{x}{rng.randrange(300)}" for _ in range(60)) for x in "abcd")
    rows = [(1, a), (1, b), (1, b), (None, c), (None, d), (None, d), (7, c), (2, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in found.collect()) == sorted([(1, a), (1, b), (7, c), (0, d)])


def test_run_by_brute_force(spark, tmp_path):
    """All four stages at once: what is kept, linked, masked and packed, by plain means."""
    rng = random.Random(6)
    words = [a + b for a in ("ber", "tan", "lor", "mis", "quo") for b in ("da", "no", "ri", "tu", "el")]
    texts = {}
    for i in range(150):
        texts[i] = rng.choices(words, k=rng.choice((3, 30, 80)))
        if i % 4 == 0:
            texts[i] += ["vexor", "grumple"] * 8
    for i in range(60):  # copies with edits
        copy = list(texts[1 + 2 * (i % 12)])
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        texts[1000 + i] = copy
    texts = {i: " ".join(t) for i, t in texts.items()}
    texts |= {5000: "token: abcdef and password = 'zzzzzz'", 5001: None, 5002: "", 5003: "a b", 5004: "A  b", 5005: "tanri " * 9000}
    rows = [(i, t, "en", "s", len(t or ""), "x") for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component_id string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).toPandas()

    docs, labels = (spark.read.parquet(f"{tmp_path}/{x}.parquet") for x in ("documents", "labels"))
    toxic = {r["doc_id"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect() if r["predicted"]}
    assert len(toxic ^ set(range(0, 150, 4))) <= 2
    kept = sorted(set(texts) - toxic)
    sets = {i: shingles(texts[i], 5) for i in kept}
    links = [(a, b) for k, a in enumerate(kept) for b in kept[k + 1 :] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0]
    root = roots(kept, links)
    library = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    wanted = []
    for i in sorted(set(root.values())):
        ids = [*library.encode(masked(texts[i] or ""), add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        wanted += [(i, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(found[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == wanted
    for _, part in found.sort_values("offset").groupby("sequence_id"):
        assert (part["offset"] == part["length"].cumsum() - part["length"]).all() and part["length"].sum() <= 2048


def test_stages_on_nothing_and_on_clashing_columns(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    schema = "doc_id long, text string, lang string, n_chars long, _row long, row string, spans string, base string, own string, component_id long, n long"
    row = (4, "token=abcdef", None, 12, 1, "a", "b", "c", "d", 7, 8)
    for rows in ([], [row, row, (None, None, None, None, None, "a", None, None, None, None, None)]):
        docs = spark.createDataFrame(rows, schema)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            if k < 3:
                assert out.columns == docs.columns, name
            wanted = len(rows) - (name == "ngram_jaccard" and len(rows) == 3)
            assert out.count() == wanted, name
