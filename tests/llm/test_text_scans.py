"""Secrets, licences and toxicity."""

import hashlib
import math
import random
import re
import string
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from cladespark.llm import licences, secret_scan, textbatch, toxicity
from cladespark.llm.licence_texts import KNOWN

SECRETS = [
    "password = 'abcdef' and PASSWD:x secret=\"ghijkl99\"", "password:token:abcdefgh", "api_key=short API-key=abcdef apikey : zzzzzz", "AKIA" + "A1" * 8, "AKIA" + "A1" * 7, "xAKIAAKIA" + "Z" * 16,
    "deadbeef" * 3, "deadbeef" * 2 + "dead", "é token = \"" + "0a1b2c3d" * 5 + "\" ü", "", None, "token==abcdef", "secretoken=abcdef", "key " + "".join(random.Random(5).choices(string.ascii_letters + string.digits, k=24)) + " end",
    "z" * 5000 + " token=abcdef", "0123456789012345678901234567890123456789", "nothing", "nothing",
]


def base_spans(text):
    out = []
    word = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
    for m in re.finditer(rf"""({word}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


def test_secrets(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(SECRETS)], "doc_id long, text string, spans string")
    rows = secret_scan.report(secret_scan.scan(docs)).collect()
    assert len(rows) == len(SECRETS)
    for r in rows:
        wanted = base_spans(SECRETS[r["doc_id"]] or "")
        text = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in wanted)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), SECRETS[r["doc_id"]]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, k, _ in wanted) for x in range(3))
        assert set(text.split(",")) <= set(r["spans"].split(",")) or not text
    added = {r["doc_id"] for r in rows if "random:" in r["spans"]}
    assert 13 in added and 15 not in added and 16 not in added
    assert secret_scan.report(secret_scan.scan(docs.limit(0))).count() == 0


def test_redaction(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(SECRETS)], "doc_id long, text string, n_chars int")
    rows = {r["doc_id"]: r for r in secret_scan.redact(docs).collect()}
    assert secret_scan.redact(docs).columns == docs.columns
    assert rows[8]["text"] == 'é [SECRET]" ü' and rows[10]["text"] is None and rows[16]["text"] == "nothing"
    assert rows[14]["text"] == "z" * 5000 + " [SECRET]"


def test_battery(spark):
    """Random runs stay; runs that are not random go, however many of either there are."""
    rng = random.Random(1)
    random_runs = ["".join(rng.choices("0123456789abcdef", k=64)) for _ in range(60)]
    patterns = ["0a" * 32, "1111111111111111111111111111111a" * 2, "0123456789abcdef" * 4, "00112233445566778899aabbccddeeff" * 2]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(random_runs + patterns)], "doc_id long, text string")
    kept = {r["doc_id"] for r in secret_scan.report(secret_scan.scan(docs)).collect() if "random:" in r["spans"]}
    assert len(kept & set(range(60))) >= 57 and not kept & set(range(60, 64))


def test_natural_names(spark):
    """Identifiers, paths and dates are no secrets, with any number of random runs beside them."""
    names = ["getUserAccountById2FromCache", "testShouldReturn404WhenMissing", "Build2024ReleaseNotesFinal", "https://host/org/Docs/Guide2/Install", "MAX_RETRY_COUNT_2_Default_Value", "2024-05-01T12_00_00Z_report_Final", "userProfilePictureUrl300x300", "convertUtf8ToLatin1WithFallback", "org_apache_spark_sql_functions2", "versionone2versiontwo3"]
    rng = random.Random(4)
    keys = ["".join(rng.choices(string.ascii_letters + string.digits + "+/", k=k)) for k in (24, 28, 32, 32, 40, 40, 44, 64, 64, 88) for _ in range(6)]
    for texts in (names, names + keys):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = {r["doc_id"] for r in secret_scan.report(secret_scan.scan(docs)).collect() if "random:" in r["spans"]}
        assert not found & set(range(len(names))), [names[i] for i in found if i < len(names)]
    assert len(found) >= 0.85 * len(keys)


def tail(z):
    return max(1e-60, math.erfc(z / math.sqrt(2)) / 2)


def own_buckets(run):
    """Both buckets of a mixed-case run in base 64, by other means."""
    alphabet = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"
    codes = [alphabet.index(c) for c in run.translate(str.maketrans("-_", "+/"))]
    n, k = len(codes), 64
    chi = sum((codes.count(c) - n / k) ** 2 / (n / k) for c in range(k))
    z_chi = ((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
    high = [2 * c >= k for c in codes]
    a, b = sum(high), n - sum(high)
    mean = 2 * a * b / n + 1
    z_runs = (1 + sum(x != y for x, y in zip(high, high[1:])) - mean) / math.sqrt((mean - 1) * (mean - 2) / (n - 1))
    m = sum(codes) / n
    r = sum((x - m) * (y - m) for x, y in zip(codes, codes[1:])) / sum((x - m) ** 2 for x in codes)
    z_serial = (r + 1 / (n - 1)) * math.sqrt(n)
    h = -(math.log(tail(z_chi)) + math.log(min(1, 2 * tail(abs(z_runs)))) + math.log(min(1, 2 * tail(abs(z_serial)))))
    kind = ["U" if c.isupper() else "l" if c.islower() else "d" if c.isdigit() else "s" for c in run]
    changes = sum(x != y for x, y in zip(kind, kind[1:]))
    letters, vowels = sum(c.isalpha() for c in run), sum(c in "aeiouAEIOU" for c in run)
    z = (changes - 0.35 * (n - 1)) / math.sqrt((n - 1) * 0.35 * 0.65) * math.sqrt(0.5) + (0.33 * letters - vowels) / math.sqrt(letters * 0.33 * 0.67) * math.sqrt(0.5)
    return 20 * max(0, h - math.log(1 + h + h * h / 2)) / math.log(10), -20 * math.log10(tail(z))


def test_p_values(spark):
    rng = random.Random(9)
    runs = ["".join(rng.choices(string.ascii_letters + string.digits + "-_", k=rng.randrange(24, 90))) + "aB3" for _ in range(60)] + ["getUserAccountById2FromCache"]
    docs = spark.createDataFrame(list(enumerate(runs)), "doc_id long, text string")
    rows = {r["doc_id"]: r["r"] for r in secret_scan.annotated(docs).selectExpr("row.doc_id", "runs[0] as r").collect()}
    for i, run in enumerate(runs):
        for name, wanted in zip(("bucket", "unnatural"), own_buckets(run)):
            assert abs(rows[i][name] - wanted) <= 1.05, (run, name)  # whole buckets


def masked(text):
    out, at = [], 0
    merged = []
    for a, _, b in base_spans(text):
        if merged and merged[-1][1] >= a:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out += [text[at:a], secret_scan.MARK]
        at = b
    return "".join(out) + text[at:]


def test_very_many_secrets(spark):
    """A hundred thousand matches in one text, and places that overlap and touch over borders of blocks."""
    many = "".join(f"é token=abc{i:05d} x" if i % 3 else f"password:token:abcdef{i:05d}" for i in range(100_000))
    none = "word " * 1_000_000
    docs = spark.createDataFrame([(1, many, "x"), (2, none, "y"), (3, None, "z")], "doc_id long, text string, _secret_text string")
    began = time.time()
    rows = {r["doc_id"]: r for r in secret_scan.report(secret_scan.scan(docs)).collect()}
    wanted = base_spans(many)
    assert rows[1]["n_assign"] == len(wanted)
    assert rows[1]["base_sha256"] == hashlib.sha256(",".join(f"assign:{a}:{b}" for a, _, b in wanted).encode()).hexdigest()
    found = secret_scan.redact(docs)
    assert found.columns == docs.columns
    texts = {r["doc_id"]: r for r in found.collect()}
    assert texts[1]["text"] == masked(many) and texts[2]["text"] == none and texts[3]["text"] is None and texts[3]["_secret_text"] == "z"
    assert time.time() - began < 120


def test_licences(spark):
    mit = KNOWN["MIT"]
    variants = [
        ("MIT", "Copyright (c) 2020 Somebody\n\n" + mit.upper()), ("MIT", mit.replace(" ", "\n").replace('"', "“") + "\n\n(c) 2001-2003 X\nAll rights reserved."),
        ("Unlicense", KNOWN["Unlicense"].replace("non-commercial", "noncommercial").replace("https", "http")), ("Apache-2.0-notice", "licensed under the APACHE licence, version 2.0"),
        (None, mit + " and more"), (None, ""), (None, None), ("ISC", KNOWN["ISC"]), ("ISC", KNOWN["ISC"]),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, (_, t) in enumerate(variants)], "doc_id long, text string, digest string")
    rows = {r["doc_id"]: r["licence_id"] for r in licences.scan(docs).collect()}
    assert rows == {i: name for i, (name, _) in enumerate(variants)}
    assert len(licences.known_digests(spark).collect()) == len(KNOWN)
    con = duckdb.connect()
    documents = docs.select("doc_id", "text").toPandas()  # noqa: F841
    sql = con.execute(licences.sql()).fetchall()
    assert sorted(sql) == sorted(tuple(r) for r in licences.scan(docs).collect())
    assert licences.scan(docs.limit(0)).count() == 0


def plain_segments(scores):
    """All maximal scoring segments by their definition: split around the best segment, again and again."""
    out = []

    def visit(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-12 and (best is None or total > best[2] + 1e-9):
                    best = (i, j + 1, total)
        if best:
            visit(a, best[0])
            out.append(best)
            visit(best[1], b)

    visit(0, len(scores))
    return out


def test_segments():
    rng = random.Random(1)
    for _ in range(200):
        scores = np.array([rng.choice([-3.1, -1.7, -0.5, 1.3, 2.9, 0.7]) + rng.random() / 100 for _ in range(rng.randrange(0, 25))])
        found = toxicity.maximal_segments(scores)
        wanted = plain_segments(scores.tolist())
        assert [x[:2] for x in found] == [x[:2] for x in wanted]
        assert [x[2] for x in found] == pytest.approx([x[2] for x in wanted])


def corpus(n, seed):
    rng = random.Random(seed)
    words = [a + b for a in ("ber", "tan", "lor", "mis", "que") for b in ("da", "no", "ri", "tu", "el", "os")]
    rows = []
    for i in range(n):
        text = rng.choices(words, k=rng.randrange(20, 200))
        bad = i % 6 == 0
        if bad:
            for _ in range(rng.randrange(3, 8)):
                text[rng.randrange(len(text))] = rng.choice(["Vexor", "vexorine", "GRUMPLE", "grumples"])
        rows.append((i, " ".join(text), int(bad)))
    return rows


def test_toxicity(spark):
    rows = corpus(700, 1)
    extra = [(1000, None), (1001, ""), (1002, "grumple " * 3), (1003, "berda " * 2000), (0, rows[0][1])]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(i, t, "x") for i, t in extra], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(5000, 1, 0), (6, None, 0)], "doc_id long, toxic int, text int")
    model = toxicity.fit(docs, labels)
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(rows) + len(extra)
    truth = {i: y for i, _, y in rows}
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    clean = toxicity.without_toxic(docs, labels)
    assert clean.columns == docs.columns
    kept = {r["doc_id"] for r in clean.collect()}
    assert {1000, 1001, 1003} <= kept
    one_class = toxicity.fit(docs, labels.where("toxic = 0"))
    assert not any(r["predicted"] for r in toxicity.score(docs, one_class).collect())
    assert toxicity.score(docs.limit(0), model).count() == 0


def tokens_of(text):
    return re.findall("[a-z\x80-\U0010ffff]+", (text or "").lower())


def own_features(word):
    """(level, string) from the shortest prefix on."""
    return [(k, word[:n]) for k, n in enumerate(toxicity.PREFIXES) if len(word) >= n] + [(len(toxicity.PREFIXES), word)]


def own_weights(rows, keep):
    """Log-odds by feature from rows (toxic, half, text) of the halves to keep; a deeper one's prior is its deepest known prefix's share."""
    seen = {h: {f: [sum(1 for t, half, text in rows if half == h and t == y and f in text) for y in (1, 0)] for f in {f for _, half, text in rows if half == h for f in text}} for h in (0, 1)}
    everywhere = {f: sum(sum(seen[h].get(f, (0, 0))) for h in (0, 1)) for h in (0, 1) for f in seen[h]}
    n = [sum(1 for t, h, _ in rows if t == y and h in keep) for y in (1, 0)]
    scale = (n[0] + 1) / (n[1] + 1)
    share = {}
    for level, text in sorted(everywhere):
        toxic, clean = (sum(seen[h].get((level, text), (0, 0))[y] for h in keep) for y in (0, 1))
        if toxic + clean < toxicity.LEAST_DOCUMENTS:
            continue
        prior = 0.5
        for k in range(level):
            size = toxicity.PREFIXES[k]
            if len(text) >= size and (k, text[:size]) in share:
                prior = share[k, text[:size]]
        share[level, text] = (toxic + toxicity.PRIOR * prior) / (toxic + clean * scale + toxicity.PRIOR)
    return {f: math.log(x / (1 - x)) for f, x in share.items()}


def own_scores(text, weights):
    out, before = [], None
    for word in tokens_of(text):
        known = [weights[f] for f in own_features(word) if f in weights]
        out.append((known[-1] if known and word != before else 0.0) - toxicity.DRIFT)
        before = word
    return out


def own_evidence(scores, rate, constant):
    each = [rate * sum(scores[a:b]) - math.log(constant * max(1, len(scores))) for a, b, _ in toxicity.maximal_segments(np.array(scores))]
    return [1.0, min(200.0, max([0.0, *each])), min(200.0, sum(x for x in each if x > 0))]


def test_scores_by_brute_force(spark):
    """Weights, calibration and scores of the whole path, by dictionaries and loops."""
    rows = corpus(260, 5)
    texts = {i: t for i, t, _ in rows} | {2000: None, 2001: "vexor", 2002: "Vexor vexor, grumple.", 2003: "ÉTÉ berda tanri grumples"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    half = {r["v"]: r["h"] for r in spark.range(300).selectExpr("id as v", "pmod(xxhash64(id), 2) as h").collect()}
    training = [(y, half[i], t) for i, t, y in rows if zlib.crc32(str(i).encode()) % 5]
    sets = [(y, h, {f for w in tokens_of(t) for f in own_features(w)}) for y, h, t in training]
    halves = [own_weights(sets, (h,)) for h in (0, 1)]
    scored = [(y, own_scores(t, halves[1 - h])) for y, h, t in training]
    best = [max([0.0, *(float(s[2]) for s in toxicity.maximal_segments(np.array(x)))]) for y, x in scored if y == 0]
    lengths = [max(1, len(x)) for y, x in scored if y == 0]
    over = sorted(b for b in best if b > 0)
    if len(over) < 20:
        rate, constant = 1.0, 1e-3
    else:
        edge = float(np.quantile(over, 0.5))
        rate = min(5.0, 1 / max(1e-3, float(np.mean([b - edge for b in over if b > edge]))))
        constant = max(1e-12, sum(b > edge for b in best) / (sum(lengths) * math.exp(-rate * edge)))
    x = np.array([own_evidence(s, rate, constant) for _, s in scored])
    y = np.array([t for t, _ in scored], float)
    w = np.zeros(3)
    for _ in range(4000):  # Newton steps, cut as the operator's are
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.clip(np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 0.01 * np.eye(3), x.T @ (y - p) - 0.01 * w), -5, 5)
        w = w + step
        if np.abs(step).max() < 1e-10:
            break
    weights = own_weights(sets, (0, 1))
    shuffled = docs.unionByName(docs.orderBy("text")).repartition(5)  # repeated rows, another order
    found = toxicity.score(shuffled, toxicity.fit(docs, labels)).collect()
    assert len(found) == 2 * len(texts)
    for r in found:
        wanted = 1 / (1 + math.exp(-np.clip(w @ own_evidence(own_scores(texts[r["doc_id"]], weights), rate, constant), -30, 30)))
        assert abs(r["score"] - wanted) < 1e-6, texts[r["doc_id"]]


def test_word_spans():
    texts = pa.array(["A b\tC", None, "", "x" * 10, " lead", "tail ", "é à\x0bü"])
    hashes, at = textbatch.word_hashes(texts)
    assert np.diff(at).tolist() == [3, 0, 0, 1, 1, 1, 3]
    again, _ = textbatch.word_hashes(pa.array(["a B c"]))
    assert (again == hashes[:3]).all()
    sliced, _ = textbatch.word_hashes(texts.slice(3, 2))
    assert (sliced == hashes[3:5]).all()


def test_first_words_count():
    texts = ["grumple", "grumple", "", "grumple grumple", "grumple tanri", "tanri grumple"]
    levels, _, _, at = toxicity.features(pa.array(texts))
    whole = levels[-1]
    empty = [np.zeros(0, np.uint64)] * len(toxicity.PREFIXES)
    weights = toxicity.Weights([*empty, whole[:1]], [*empty, np.array([2.0])])
    scores = weights.of(levels, at) + toxicity.DRIFT
    assert [scores[a:b].tolist() for a, b in zip(at, at[1:])] == [[2.0], [2.0], [], [2.0, 0.0], [2.0, 0.0], [0.0, 2.0]]


def test_equal_texts_score_equally(spark):
    rows = corpus(300, 4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    texts = ["grumple", "grumple", "berda grumple berda", "berda grumple berda", "grumple"]
    model = toxicity.fit(spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"), labels)
    own = spark.createDataFrame([(5000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    found = {r["doc_id"] - 5000: r["score"] for r in toxicity.score(own, model).collect()}
    assert found[0] == found[1] == found[4] and found[2] == found[3]


def test_full_licences(spark):
    from pathlib import Path

    files = sorted((Path(licences.__file__).parent / "licence_files").glob("*.txt"))
    docs = spark.createDataFrame([(f.stem, f.read_text().upper()) for f in files] + [("own", "My own terms.")], "doc_id string, text string")
    found = {r["doc_id"]: r["licence_id"] for r in licences.scan(docs).collect()}
    assert len(files) == 7 and found == {f.stem: f.stem for f in files} | {"own": None}
    known = spark.createDataFrame([("mine", "my own   terms")], "licence_id string, text string")
    assert [r["licence_id"] for r in licences.scan(docs.where("doc_id = 'own'"), known=known).collect()] == ["mine"]
