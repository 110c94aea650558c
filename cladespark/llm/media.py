"""Interleaved document sequences: HTML to ordered text and media references, resolved by digest.

``interleave`` parses HTML into one row per document with an array of structs in reading
order; each is a text or a media reference with its position, digest and caption (alt text
or figcaption).  ``store_media`` keeps payloads losslessly as binary grey-map images
(8-bit samples, ``WIDTH`` per line) in a table; ``read_media`` reads the stored bytes back,
decodes them and computes features; ``resolve`` joins references to features by digest,
so that positions and captions stay with what they describe.

Skew: copies of one payload share its digest.  Stored media and references are keyed by digest
and a salt from the document, so a digest that a third of all documents hold is spread over
all partitions; only digests and numbers are shuffled, payloads never are.

Defined results: null HTML or text counts as empty; references without a stored payload keep
null features; repeated rows resolve alike; a null doc_id is kept; an empty table gives an empty table;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stored
from .textbatch import slices

#: Samples in a line of the image; with BLOCK / WIDTH lines for each block of payload.
WIDTH = 24
#: Payloads are padded with bytes 255 to a positive multiple of this.
BLOCK = 576

ITEM = "struct<position:int,kind:string,text:string,media_digest:string,caption:string>"
MEDIA = "doc_id long, digest string, n_bytes long, media binary"
FEATURES = "doc_id long, digest string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
_FEATURE_COLUMNS = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]


# -- payloads and their stored form ---------------------------------------------------------------


def padded(payload: bytes) -> bytes:
    return payload + b"\xff" * (max(1, -(-len(payload) // BLOCK)) * BLOCK - len(payload))


def to_image(payload: bytes) -> bytes:
    """A binary grey map whose samples are the padded payload's bytes."""
    samples = padded(payload)
    return b"P5\n%d %d\n255\n" % (WIDTH, len(samples) // WIDTH) + samples


def from_image(image: bytes) -> bytes:
    """The samples of a binary grey map with 8-bit samples."""
    magic, size, depth, samples = image.split(b"\n", 3)
    width, height = map(int, size.split())
    if magic != b"P5" or depth != b"255" or len(samples) != width * height:
        raise ValueError("no whole binary grey map of 8-bit samples")
    return samples


def feature_of(samples: bytes) -> str:
    """Lines, mean, spread, and a 64-bit average hash over an 8 x 8 grid of the image."""
    grid = np.frombuffer(samples, np.uint8).reshape(-1, WIDTH)
    lines = grid.sum(axis=1, dtype=np.int64)
    total, n = int(lines.sum()), grid.size
    squares = int(np.square(np.arange(256, dtype=np.int64)) @ np.bincount(grid.ravel(), minlength=256))
    variance = (squares * n - total * total) // (n * n)
    columns = grid.reshape(len(grid), 8, WIDTH // 8).sum(axis=2, dtype=np.int64)
    edges = np.arange(9) * len(grid) // 8
    running = np.vstack([np.zeros(8, np.int64), np.cumsum(columns, axis=0)])
    cells = (running[edges[1:]] - running[edges[:-1]]) * n > total * (WIDTH // 8) * (edges[1:] - edges[:-1])[:, None]
    bits = int("".join("1" if c else "0" for c in cells.ravel()), 2)
    return f"lines={len(grid)};mean={total // n};variance={variance};hash={bits:016x}"


def store_media(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Stores each whole text's payload as an image in a table of the shared folder: (doc_id, digest, n_bytes, media)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                payloads = [(t or "").encode() for t in part.column("text").to_pylist()]
                digests = [hashlib.sha256(p).hexdigest() for p in payloads]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(digests, pa.string()), pa.array([len(p) for p in payloads], pa.int64()), pa.array([to_image(p) for p in payloads], pa.binary())], names=["doc_id", "digest", "n_bytes", "media"])

    return stored(docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, MEDIA), "media")


def read_media(media: DataFrame) -> DataFrame:
    """Reads stored images back, decodes them and computes what is known of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch, "media")):
            rows = []
            for image in part.column("media").to_pylist():
                samples = from_image(image)
                rows.append((len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), len(image), hashlib.sha256(image).hexdigest(), feature_of(samples)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            found = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.select(["doc_id", "digest", "n_bytes"]).columns, *found], names=["doc_id", "digest", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return media.mapInArrow(run, FEATURES)


# -- HTML -----------------------------------------------------------------------------------------

#: Fixed: elements that end a text block, whose text is no content, and that hold media.
_BLOCKS = frozenset("address article aside blockquote body br dd div dl dt figure figcaption footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
_SILENT = frozenset("script style template noscript head".split())
_MEDIA = {"img": "image", "video": "video", "audio": "audio", "source": "media", "embed": "media"}
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Sequence(HTMLParser):
    """Items of a page in reading order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[list] = []
        self.text: list[str] = []
        self.silent = 0
        self.figure: list[int] | None = None
        self.caption: list[str] | None = None

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text = []
        if text:
            self.items.append(["text", text, None, None])

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _SILENT:
            self.silent += 1
        if tag in _BLOCKS:
            self.flush()
        if tag == "figure":
            self.figure = []
        elif tag == "figcaption":
            self.caption = []
        elif tag in _MEDIA and not self.silent:
            values = dict(attrs)
            source = values.get("src") or values.get("data-src")
            if source:
                self.flush()
                if self.figure is not None:
                    self.figure.append(len(self.items))
                self.items.append([_MEDIA[tag], None, digest_of(source), values.get("alt") or values.get("title")])

    def handle_endtag(self, tag: str) -> None:
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        if tag == "figcaption" and self.caption is not None:
            words = " ".join("".join(self.caption).split())
            for k in self.figure or []:
                self.items[k][3] = words or self.items[k][3]
            self.caption = None
        if tag in _BLOCKS:
            self.flush()
        if tag == "figure":
            self.figure = None

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        (self.text if self.caption is None else self.caption).append(data)


def digest_of(source: str) -> str:
    """The digest in a ``sha256:`` reference; of any other address the digest of the address."""
    return source[7:].lower() if source.startswith("sha256:") else hashlib.sha256(source.encode("utf-8", "replace")).hexdigest()


def parse_page(html: str) -> list[dict]:
    parser = _Sequence()
    parser.feed(html)
    parser.close()
    parser.flush()
    return [{"position": k, "kind": kind, "text": text, "media_digest": digest, "caption": caption} for k, (kind, text, digest, caption) in enumerate(parser.items)]


def interleave(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """(id, items array<struct<position, kind, text, media_digest, caption>>) of whole pages."""
    schema = f"{id_column} long, items array<{ITEM}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("media_digest", pa.string()), ("caption", pa.string())]))
        for batch in batches:
            for part in slices(batch, html_column):
                yield pa.RecordBatch.from_arrays([part.column(id_column), pa.array([parse_page(h or "") for h in part.column(html_column).to_pylist()], kind)], names=[id_column, "items"])

    return pages.select(F.col(id_column).cast("long").alias(id_column), F.col(html_column).alias(html_column)).mapInArrow(run, schema)


def references(pages: DataFrame, id_column: str = "page_id") -> DataFrame:
    """One row per media reference, in order: (id, position, kind, digest, caption)."""
    return pages.select(id_column, F.explode("items").alias("item")).where("item.media_digest is not null").select(id_column, F.col("item.position").alias("position"), F.col("item.kind").alias("kind"), F.col("item.media_digest").alias("digest"), F.col("item.caption").alias("caption"))


def resolve(refs: DataFrame, features: DataFrame, salt_column: str | None = None) -> DataFrame:
    """Left-joins references to features by digest.

    With ``salt_column`` (a document id that both sides have) copies of one digest are told
    apart by a salt: each side keeps its rows of a digest in as many parts as there are
    shuffle partitions, and features are reduced to one row per digest and salt first.
    Without it features are reduced to a row per digest, by salt and then as a whole, and handed to each salt that
    the references have of the digest, so that a digest that a third of all references hold is spread as well.
    """
    n = int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = [F.min(c).alias(c) for c in _FEATURE_COLUMNS]
    if salt_column:
        salt = F.pmod(F.xxhash64(salt_column), F.lit(n))
        one, salted = features.withColumn("_salt", salt).groupBy("digest", "_salt").agg(*least), refs.withColumn("_salt", salt)
    else:
        salted = refs.withColumn("_salt", F.pmod(F.xxhash64(*refs.columns), F.lit(n)))
        whole = features.withColumn("_part", F.pmod(F.xxhash64("payload_sha256", "doc_id"), F.lit(n))).groupBy("digest", "_part").agg(*least).groupBy("digest").agg(*least)
        one = salted.select("digest", "_salt").distinct().join(whole, "digest")
    return salted.join(one, ["digest", "_salt"], "left").drop("_salt")


def document_pages(media: DataFrame) -> DataFrame:
    """A page for each stored document that shows its media by digest, with a caption."""
    page = F.concat(F.lit("<article><p>Document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit('</p><figure><img src="sha256:'), F.col("digest"), F.lit('"><figcaption>'), F.col("n_bytes").cast("string"), F.lit(" bytes</figcaption></figure></article>"))
    return media.select("doc_id", page.alias("html"))


def media_of_documents(docs: DataFrame) -> DataFrame:
    """The whole path: store payloads, interleave pages that refer to them, resolve by digest."""
    media = store_media(docs)
    refs = references(interleave(document_pages(media), "doc_id"), "doc_id")
    return resolve(refs, read_media(media), "doc_id")
