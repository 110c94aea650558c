"""Round trips of media and web archives."""

import gzip
import hashlib
import json
import zlib

import pytest
from pyarrow import fs

from cladespark.llm import media, warc
from cladespark.storage import new_path

TEXTS = ["", None, "x", "y" * 576, "é" * 400, "z" * 5000, "x", "x"]


def test_media(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, digest string")
    rows = {r["doc_id"]: r for r in media.media_of_documents(docs).collect()}
    assert sorted(rows) == list(range(len(TEXTS)))
    for i, text in enumerate(TEXTS):
        raw = (text or "").encode()
        padded = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        image = b"P5\n24 %d\n255\n" % (len(padded) // 24) + padded
        r = rows[i]
        assert (r["n_bytes"], r["payload_bytes"], r["media_bytes"]) == (len(raw), len(padded), len(image))
        assert r["payload_sha256"] == hashlib.sha256(padded).hexdigest() and r["media_sha256"] == hashlib.sha256(image).hexdigest()
        assert r["tail_crc32"] == zlib.crc32(padded[-32:]) and r["caption"] == f"{len(raw)} bytes"
    assert rows[2]["feature"] == rows[6]["feature"] != rows[3]["feature"]
    assert media.media_of_documents(docs.limit(0)).count() == 0
    for bad in (b"P5\n24 2\n255\nshort", b"P6\n24 1\n255\n" + b"x" * 24):
        with pytest.raises(ValueError):
            media.from_image(bad)


def test_sequences(spark):
    html = '<head><title>t</title></head><p>One &amp; two<img src="sha256:AB" alt="a">three</p><script>no()</script><figure><img src="http://x/y.png"><figcaption>A <b>cap</b></figcaption></figure>end<img>'
    pages = spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "<p>broken <img src='sha256:cd'")], "page_id long, html string")
    items = {r["page_id"]: [tuple(x) for x in r["items"]] for r in media.interleave(pages).collect()}
    other = hashlib.sha256(b"http://x/y.png").hexdigest()
    assert items[1] == [(0, "text", "One & two", None, None), (1, "image", None, "ab", "a"), (2, "text", "three", None, None), (3, "image", None, other, "A cap"), (4, "text", "end", None, None)]
    assert items[2] == items[3] == []
    refs = media.references(media.interleave(pages))
    assert {(r["page_id"], r["position"], r["digest"]) for r in refs.collect()} >= {(1, 1, "ab"), (1, 3, other)}


def test_archives(spark):
    long = "<html>" + "p" * 200
    pages = [(3, "http://a/ b?c=é", long), (1, "u", long), (2, None, "short"), (5, "u", "short"), (4, "u", None), (7, "u", "q" * 100), (6, "u", "q" * 100), (8, "u", "r" * 99), (9, "u", "r" * 99), (10, "u", "WARC/1.1\r\n\r\n" * 20)]
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, payload_digest string")
    rows = {r["page_id"]: r for r in warc.archive_pages(frame).collect()}
    assert sorted(rows) == sorted(p[0] for p in pages)
    for key, _, html in pages:
        raw = (html or "").encode()
        first = min(k for k, _, h in pages if (h or "") == (html or ""))
        wanted = ("revisit", first) if len(raw) >= 100 and first != key else ("response", None)
        assert (rows[key]["record_type"], rows[key]["refers_to"]) == wanted
        assert (rows[key]["payload_bytes"], rows[key]["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
    assert warc.archive_pages(frame.limit(0)).count() == 0


def test_repeated_pages(spark):
    frame = spark.createDataFrame([(1, "u", "w" * 150)] * 3, "page_id long, url string, html string")
    assert sorted(r["record_type"] for r in warc.archive_pages(frame).collect()) == ["response", "revisit", "revisit"]


def test_rows_without_an_id(spark):
    frame = spark.createDataFrame([(None, "u", "w" * 150), (None, None, "w" * 150), (4, "u", "w" * 150), (9, "u", "w" * 150), (None, "u", None)], "page_id long, url string, html string")
    rows = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.archive_pages(frame).collect())
    assert rows == [(0, "response", None, 0), (0, "response", None, 150), (0, "response", None, 150), (4, "response", None, 150), (9, "revisit", 4, 150)]
    docs = spark.createDataFrame([(None, "abc"), (None, None), (1, "abc")], "doc_id long, text string")
    found = sorted((r["doc_id"] or 0, r["n_bytes"], r["caption"]) for r in media.media_of_documents(docs).collect())
    assert found == [(0, 0, "0 bytes"), (0, 3, "3 bytes"), (1, 3, "3 bytes")]


def test_hot_and_missing_digests(spark):
    """References by digest alone: a digest that most hold, and one that nothing is stored under."""
    stored = media.read_media(media.store_media(spark.createDataFrame([(1, "abc"), (2, "abc"), (3, "d")], "doc_id long, text string")))
    hot, cold = (hashlib.sha256(x).hexdigest() for x in (b"abc", b"d"))
    pages = spark.createDataFrame([(i, f'<img src="sha256:{hot if i % 10 else cold}" alt="{i}"><img src="x">') for i in range(200)], "page_id long, html string")
    rows = media.resolve(media.references(media.interleave(pages)), stored).collect()
    assert len(rows) == 400
    for r in rows:
        wanted = None if r["position"] else 3 if r["page_id"] % 10 else 1
        assert r["n_bytes"] == wanted and r["caption"] == (None if r["position"] else str(r["page_id"]))


def test_many_archives_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 10)
    frame = spark.createDataFrame([(i, "u", f"text {i} " * 40) for i in range(200)], "page_id long, url string, html string")
    found = warc.archive_pages(frame)
    assert found.rdd.getNumPartitions() >= 20 and found.count() == 200


def test_members(spark, monkeypatch):
    """The rewritten files are one member a record, and their index finds each; the first ones are one stream."""
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 4)
    frame = spark.createDataFrame([(i, "u", "text %d " % i * 50) for i in range(11)], "page_id long, url string, html string").coalesce(1)
    folder = new_path(spark, "warc-test")
    written = warc.write_monolithic(frame, f"{folder}/a")
    index = warc.normalise(warc.decide_revisits(written), f"{folder}/b", 3).collect()
    for archive in {r["archive"] for r in index}:
        system, path = fs.FileSystem.from_uri(archive)
        data = system.open_input_stream(path, compression=None).read()
        side = [json.loads(x) for x in system.open_input_stream(f"{path}.idx", compression=None).read().splitlines()]
        assert sum(x["length"] for x in side) == len(data)
        for x in side:
            assert gzip.decompress(data[x["offset"] : x["offset"] + x["length"]]).startswith(b"WARC/1.1\r\nWARC-Type: response")
        one = zlib.decompressobj(31)
        raw = system.open_input_stream(path.replace("/b/", "/a/"), compression=None).read()
        one.decompress(raw)
        assert one.eof and not one.unused_data
    assert len({r["archive"] for r in index}) == 3
