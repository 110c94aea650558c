"""Web archives: whole-file gzip archives made into per-record members with a sidecar index.

1. ``write_monolithic`` writes a WARC record per page into gzip files that are one stream each,
   in one narrow pass, as a crawler may leave them.
2. ``decide_revisits`` finds equal payloads by digest; only digests and keys are shuffled.
3. ``normalise`` inflates each file's stream once, record after record, and rewrites every record
   as a gzip member of its own (a revisit without its payload), with a sidecar index of offsets.
4. ``read_archives`` reads every member back by its offset, by itself.

Files are in the cluster's shared folder.  A task writes under a name of its own and then
renames, and the content depends on the input alone, so a retried task leaves the same file.
An archive is closed at ``ARCHIVE_BYTES`` of records, so what one task handles is bounded;
one record at a time is in memory.

Skew: equal payloads may be a third of all pages.  Digests are counted and joined with a salt from
the page, so such a group is spread over all partitions.

Archives are dealt to tasks by an explicit number, up to ``MOST_TASKS``: what is shuffled of them is so little that
adaptive coalescing would put all in one task.

Defined results: null HTML is an empty payload and null URLs are empty; of rows with equal page_id
and payload the first written is the response; rows with a null page_id are responses, and nothing refers to
them; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import new_path, stored
from .textbatch import slices

#: Uncompressed bytes after which an archive is closed, and records.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 64 << 20, 20_000
#: Tasks that archives are dealt to, at most.
MOST_TASKS = 1 << 14
#: Payloads under this are always stored, however often they repeat.
LEAST_REVISIT = 100
LEVEL = 4

WRITTEN = "archive string, ordinal int, page_id long, payload_bytes long, payload_digest string"
INDEX = "archive string, ordinal int, page_id long, record_type string, offset long, length long"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long"


# -- records --------------------------------------------------------------------------------------


def _record_id(page_id: int | None, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{kind}')}>"


def record(kind: str, page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None = None, n_bytes: int | None = None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP header alone."""
    n_bytes = len(payload) if n_bytes is None else n_bytes
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n_bytes
    if kind == "response":
        block += payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_record_id(page_id, digest, kind)}",
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers_to, digest, 'response')}", f"WARC-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_record(stream) -> tuple[dict[str, str], bytes] | None:
    """Headers and block of the next record, or None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError("no WARC record where one should begin")
    headers: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode().partition(":")
        headers[name.strip().lower()] = value.strip()
    block = stream.read(size := int(headers["content-length"]))
    if len(block) != size:
        raise ValueError("a record is cut off")
    return headers, block


def split_block(block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP headers and payload of a record's block."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


# -- files ----------------------------------------------------------------------------------------


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class _Output:
    """A file that appears under its name when it is whole."""

    def __init__(self, uri: str) -> None:
        self.system, self.path = _open(uri)
        self.system.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.own = f"{self.path}.{uuid.uuid4().hex}"
        self.file = self.system.open_output_stream(self.own, compression=None)

    def __enter__(self):
        return self.file

    def __exit__(self, kind, value, trace) -> None:
        self.file.close()
        if kind is None:
            self.system.move(self.own, self.path)
        else:
            self.system.delete_file(self.own)


def write_monolithic(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Writes all pages as response records; returns (archive, ordinal, page_id, payload_bytes, payload_digest)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, bytes]]:
        for batch in batches:
            for part in slices(batch, "html"):
                for key, url, html in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                    yield key, url or "", (html or "").encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, source = TaskContext.get().partitionId(), 0, rows(batches)
        row = next(source, None)
        while row is not None:
            archive = f"{folder}/part-{task:06d}-{number:06d}.warc.gz"
            found, size = [], 0
            with _Output(archive) as out:
                stream = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                while row is not None and size < ARCHIVE_BYTES and len(found) < ARCHIVE_RECORDS:
                    key, url, payload = row
                    digest = hashlib.sha256(payload).hexdigest()
                    raw = record("response", key, url, payload, digest)
                    out.write(stream.compress(raw))
                    found.append((archive, len(found), key, len(payload), digest))
                    size += len(raw)
                    row = next(source, None)
                out.write(stream.flush())
            number += 1
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=["archive", "ordinal", "page_id", "payload_bytes", "payload_digest"])

    own = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    return stored(own.mapInArrow(run, WRITTEN), "warc-written")


def decide_revisits(written: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Adds refers_to: the page whose record a revisit points to, null for responses."""
    n = int(written.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = written.withColumn("_salt", F.when((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull(), F.pmod(F.xxhash64("page_id"), F.lit(n))))
    place = F.struct("page_id", "archive", "ordinal")
    parts = keyed.where("_salt is not null").groupBy("payload_digest", "_salt").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    groups = parts.groupBy("payload_digest").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.collect_list("_salt").alias("salts")).where("n > 1")
    targets = groups.select("payload_digest", F.explode("salts").alias("_salt"), "first")
    joined = keyed.join(targets, ["payload_digest", "_salt"], "left")
    return joined.select(*written.columns, F.when(F.col("first").isNotNull() & (F.col("first") != place), F.col("first.page_id")).alias("refers_to"))


def normalise(decided: DataFrame, folder: str, archives: int) -> DataFrame:
    """Rewrites each of so many archives with a member per record, and writes its index beside it; returns the index."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ordinal")
        archive = f"{folder}/{key[0].rpartition('/')[2]}"
        system, path = _open(key[0])
        index, at = [], 0
        with system.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as inflated, _Output(archive) as out:
            stream = io.BufferedReader(inflated, 1 << 20)
            for ordinal, page_id, refers_to in zip(*(rows[c].tolist() for c in ("ordinal", "page_id", "refers_to")), strict=True):
                headers, block = read_record(stream)
                page_id = _number(page_id)
                if _number(headers["warc-page-id"]) != page_id:
                    raise ValueError(f"{key[0]}: record {ordinal} isn't that of page {page_id}")
                http, payload = split_block(block)
                refers_to = _number(refers_to)
                kind = "response" if refers_to is None else "revisit"
                digest = headers["warc-payload-digest"].removeprefix("sha256:")
                # the address stands quoted in the record and is quoted no more
                member = record(kind, page_id, headers["warc-target-uri"], payload, digest, refers_to, int(http["content-length"]))
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                data = packer.compress(member) + packer.flush()
                out.write(data)
                index.append((archive, ordinal, page_id, kind, at, len(data)))
                at += len(data)
            if read_record(stream) is not None:
                raise ValueError(f"{key[0]}: more records than were written")
        with _Output(f"{archive}.idx") as side:
            for _, ordinal, page_id, kind, offset, length in index:
                side.write(json.dumps({"ordinal": ordinal, "page_id": page_id, "type": kind, "offset": offset, "length": length}).encode() + b"\n")
        return pd.DataFrame(index, columns=["archive", "ordinal", "page_id", "record_type", "offset", "length"]).astype({"page_id": "Int64"})

    rows = decided.select("archive", "ordinal", *[F.col(c).cast("string").alias(c) for c in ("page_id", "refers_to")])
    return stored(_dealt(rows, archives).groupBy("archive").applyInPandas(run, INDEX), "warc-index")


def _number(text: str | None) -> int | None:
    return int(text) if text and text == text else None


def _dealt(rows: DataFrame, archives: int) -> DataFrame:
    return rows.repartition(max(1, min(archives, MOST_TASKS)), "archive")


def read_archives(index: DataFrame, archives: int) -> DataFrame:
    """Reads every record of the archives in an index back, each by its offset in the sidecar file."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive in frame["archive"]:
                system, path = _open(archive)
                with system.open_input_stream(f"{path}.idx", compression=None) as side:
                    entries = [json.loads(line) for line in side.read().splitlines()]
                rows, size = [], 0
                with system.open_input_file(path) as file:
                    for entry in entries:
                        headers, block = read_record(io.BytesIO(zlib.decompress(file.read_at(entry["length"], entry["offset"]), 31)))
                        http, payload = split_block(block)
                        digest = headers["warc-payload-digest"].removeprefix("sha256:")
                        kind = headers["warc-type"]
                        if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(http["content-length"])):
                            raise ValueError(f"{archive}: the payload of page {entry['page_id']} isn't what its header says")
                        refers = headers.get("warc-refers-to-page-id")
                        rows.append((pd.NA if not headers["warc-page-id"] else int(headers["warc-page-id"]), int(http["content-length"]), digest, kind, pd.NA if refers is None else int(refers), archive, entry["offset"], entry["length"]))
                        size += 1
                        if size % 5000 == 0:
                            yield _frame(rows)
                            rows = []
                yield _frame(rows)

    return _dealt(index.select("archive"), archives).distinct().mapInPandas(run, READ)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset", "length"])
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def archive_pages(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """The whole path: write, decide, normalise, read back."""
    folder = new_path(pages.sparkSession, "warc")
    written = write_monolithic(pages, f"{folder}/monolithic")
    archives = written.select("archive").distinct().count()
    index = normalise(decide_revisits(written, least), f"{folder}/members", archives)
    return read_archives(index, archives)
