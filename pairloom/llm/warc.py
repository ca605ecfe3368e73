"""Deterministic sharded WARC archives: writer and reader.

Records are put in the order of their page id and digest and cut into shards of
RECORDS_PER_SHARD pages; the cuts are exact ranks, so equal input gives equal
files whatever the partitions are, and an id with very many rows is cut as well
(only rows of equal id and payload stay together).  A shard is written as one or more files,
rolled by compressed size, each under a temporary name first and then moved to
its own name; a task that runs again makes the same bytes.  The manifest, one
row per file with its record count, size and SHA-256, is written by Spark when all
files are there: an archive without it is not complete.

Headers and digests are made anew.  Of pages with equal payloads of at least
MIN_REVISIT bytes the one with the smallest id is a ``response`` record, the
others are ``revisit`` records that name it and hold no payload.

Special rows.  A NULL payload is empty; a NULL url is left out of the header.
Pages without an id come first, and are never named by a revisit.  Of rows with
equal id and payload the first is the response and the others revisit it; rows
with equal id and other payloads are records of their own.  An empty table gives
an empty manifest.  Columns besides page_id, url and html are not written.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import numbered
from pairloom.session import staged

MIN_REVISIT = 100
RECORDS_PER_SHARD = 4096
#: Compressed bytes after which a file is closed.
FILE_BYTES = 32 << 20
#: Shards an archive may have: their first ids are one array in every task.
MAX_SHARDS = 4_000_000
#: Tasks that write shards, one shard each up to this number.
MAX_TASKS = 1 << 14
DATE = "2000-01-01T00:00:00Z"

_FIRST = -(1 << 63)  # where pages without an id go
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FILES = "file string, shard long, records long, bytes long, sha256 string"
_RECORDS = (
    "file string, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)


def record_id(page_id: int | None, digest: str, copy: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}:{copy}')}>"


def record(page_id, url, payload: bytes, digest: str, refers_to: int | None, revisit: bool, copy: int, date: str) -> bytes:
    """The bytes of one record, not compressed."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest, copy)}"]
    head.append(f"WARC-Date: {date}")
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='!#$%&()*+,/:;=?@[]~' + chr(39))}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Refers-To-Page-ID: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(pages: DataFrame, root: str, date: str = DATE, file_bytes: int = FILE_BYTES, per_shard: int = RECORDS_PER_SHARD) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as an archive under the new path ``root``; returns its manifest."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"))
    key = F.coalesce("page_id", F.lit(_FIRST).cast("long"))
    narrow = staged(rows.select(key.alias("page_id"), F.length("payload").alias("size"), F.sha2("payload", 256).alias("digest")))
    ranked = numbered(narrow.select("page_id", "digest"), F.col("page_id"), F.col("digest"), name="rank")
    starts = ranked.where(F.col("rank") % per_shard == 0).select("page_id", "digest").distinct().toArrow()
    if starts.num_rows > MAX_SHARDS:
        raise ValueError(f"{starts.num_rows} shards; raise per_shard to have {MAX_SHARDS} at most")
    cuts = rows.sparkSession.sparkContext.broadcast(np.sort(_places(starts.combine_chunks())))
    large = narrow.where((F.col("size") >= MIN_REVISIT) & (F.col("page_id") != _FIRST))
    copies = large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    # pages without an id revisit the others as well
    found = narrow.where(F.col("size") >= MIN_REVISIT).join(copies, "digest")
    found = found.where((F.col("n") > 1) | (F.col("page_id") == _FIRST)).select("page_id", "digest", "refers_to").distinct()
    nothing = F.lit(None)
    decided = found.select(
        "page_id", nothing.cast("string").alias("url"), nothing.cast("binary").alias("payload"), "digest", "refers_to"
    )
    every = rows.select(key.alias("page_id"), "url", "payload", F.sha2("payload", 256).alias("digest"), nothing.cast("long").alias("refers_to"))

    def route(batches):
        for batch in batches:
            at = np.searchsorted(cuts.value, _places(batch), "right")
            yield batch.append_column("shard", pa.array(at.astype(np.int64) - 1))

    fields = "page_id long, url string, payload binary, digest string, refers_to long, shard long"
    routed = every.unionByName(decided).mapInArrow(route, fields)
    # what is decided for a page comes before the page
    whole = F.col("payload").isNotNull()
    parts = min(max(starts.num_rows, 1), MAX_TASKS)
    dealt = routed.repartitionById(parts, (F.col("shard") % parts).cast("int"))
    sorted_rows = dealt.sortWithinPartitions("shard", "page_id", "digest", whole, "url")

    def save(batches):
        with _Shards(root, date, file_bytes) as shards:
            for batch in batches:
                yield from shards.add(batch)
            yield from shards.end()

    manifest = sorted_rows.mapInArrow(save, _FILES)
    manifest.write.parquet(f"{root}/manifest")
    return rows.sparkSession.read.parquet(f"{root}/manifest")


def _places(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Page id and the first half of the digest as bytes in their order."""
    ids = rows.column("page_id").to_numpy(zero_copy_only=False).astype(np.int64) if rows.num_rows else np.zeros(0, np.int64)
    out = np.empty((len(ids), 40), np.uint8)
    out[:, :8] = (ids.view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 8:] = np.array(rows.column("digest").to_pylist(), "S64").view(np.uint8).reshape(-1, 64)[:, :32]
    return out.view("S40").ravel()


class _Shards:
    """Writes a task's shards, one file open at a time."""

    def __init__(self, root: str, date: str, file_bytes: int):
        self.files, base = fs.FileSystem.from_uri(root)
        self.folder, self.hidden = f"{base}/archive", f"{base}/_temporary_{TaskContext.get().taskAttemptId()}"
        self.date, self.file_bytes = date, file_bytes
        self.files.create_dir(self.folder)
        self.shard = self.page = self.out = None
        self.seq = 0
        self.decided: dict[str, int] = {}
        self.written: dict[str, int] = {}

    def __enter__(self):
        return self

    def __exit__(self, *error):
        if self.out is not None:
            self.out.close()
        if self.files.get_file_info(self.hidden).type != fs.FileType.NotFound:
            self.files.delete_dir(self.hidden)

    def add(self, batch: pa.RecordBatch):
        names = ("shard", "page_id", "url", "digest", "refers_to")
        payloads = batch.column("payload")
        for i, (shard, page, url, digest, refers_to) in enumerate(zip(*(batch.column(c).to_pylist() for c in names))):
            if shard != self.shard:
                yield from self.end()
                self.shard, self.seq = shard, 0
            if page != self.page:
                self.page, self.decided, self.written = page, {}, {}
            payload = payloads[i].as_py()
            if payload is None:
                self.decided[digest] = refers_to
            else:
                yield from self._put(page, url, payload, digest)

    def _put(self, page: int, url: str | None, payload: bytes, digest: str):
        copy = self.written.get(digest, 0)
        self.written[digest] = copy + 1
        first = self.decided.get(digest)
        revisit = first is not None and (first != page or copy > 0)
        name = None if page == _FIRST else page
        data = zlib.compress(record(name, url, payload, digest, first, revisit, copy, self.date), 6, wbits=31)
        if self.out is not None and self.size + len(data) > self.file_bytes:
            yield from self.end()
        if self.out is None:
            self.name = f"shard-{self.shard:08d}-{self.seq:05d}.warc.gz"
            self.files.create_dir(self.hidden)
            self.out = self.files.open_output_stream(f"{self.hidden}/{self.name}", compression=None)
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
        self.out.write(data)
        self.sha.update(data)
        self.size, self.records = self.size + len(data), self.records + 1

    def end(self):
        """Close the open file, give it its name, and return its row of the manifest."""
        if self.out is None:
            return
        self.out.close()
        self.out = None
        final = f"{self.folder}/{self.name}"
        if self.files.get_file_info(final).type != fs.FileType.NotFound:
            self.files.delete_file(final)  # by an earlier run of this task: the same bytes
        self.files.move(f"{self.hidden}/{self.name}", final)
        self.seq += 1
        row = {"file": self.name, "shard": self.shard, "records": self.records, "bytes": self.size, "sha256": self.sha.hexdigest()}
        yield pa.RecordBatch.from_pylist([row])


def read(spark: SparkSession, root: str, payloads: bool = True) -> DataFrame:
    """The records of the archive under ``root``; digests of payloads are made from what is read.

    A file that the manifest names and whose bytes are not those written is an
    error.  Without ``payloads`` the column of that name is NULL.
    """
    manifest = spark.read.parquet(f"{root}/manifest")
    if manifest.isEmpty():
        return spark.createDataFrame([], _RECORDS)
    files = spark.read.format("binaryFile").load(f"{root}/archive").select(
        F.substring_index("path", "/", -1).alias("file"), "content"
    )
    listed = files.join(manifest.select("file"), "file", "left_semi")

    def parse(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _records(batch.column("file")[i].as_py(), batch.column("content")[i].as_buffer(), payloads)

    return listed.mapInArrow(parse, _RECORDS)


#: Compressed bytes that are unpacked at once: what is left of them after a record is copied.
_PIECE = 1 << 14


def _members(file: str, data) -> object:
    """The unpacked records of a file."""
    at, view = 0, memoryview(data)
    while at < len(view):
        member, parts = zlib.decompressobj(wbits=31), []
        while not member.eof:
            piece = view[at : at + _PIECE]
            if not len(piece):
                raise ValueError(f"{file}: a record is cut off")
            parts.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
        yield b"".join(parts)


def _records(file: str, data, payloads: bool) -> object:
    rows, size = [], 0
    for raw in _members(file, data):
        rows.append(_parsed(file, raw, payloads))
        size += len(raw)
        if size > 8 << 20:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


_ARROW = pa.schema(
    [
        ("file", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ]
)


def _headers(lines: list[str]) -> dict[str, str]:
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}


def _parsed(file: str, raw: bytes, payloads: bool) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    field = _headers(head.decode().split("\r\n")[1:])
    block = rest[: int(field["content-length"])]
    if field["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"{file}: the block of {field['warc-record-id']} has another digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = field["warc-type"] == "revisit"
    size = int(_headers(http.decode().split("\r\n")[1:])["content-length"]) if revisit else len(payload)
    digest = field["warc-payload-digest"].removeprefix("sha256:") if revisit else hashlib.sha256(payload).hexdigest()
    number = lambda name: int(field[name]) if name in field else None
    return {
        "file": file, "page_id": number("warc-page-id"), "url": field.get("warc-target-uri"), "record_type": field["warc-type"],
        "refers_to": number("warc-refers-to-page-id"), "payload_bytes": size, "payload_digest": digest,
        "payload": payload if payloads and not revisit else None,
    }
