"""WARC archives: one gzip member per record, and a sequential reader.

A page becomes a ``response`` record holding an HTTP header and the html. Of
pages with equal payloads of at least ``min_bytes``, the one with the largest
page_id (ties: largest url, then last row) is the response; each other one is a
``revisit`` that holds the HTTP header alone and refers to it. The HTTP header
of either states the payload's length.

The reader walks a file from its first byte: it inflates one gzip member at a
time in small pieces, takes each block by its Content-Length, and compares the
block digest, and for responses the payload digest, with what it read. A record
that does not agree stops the read.

Edge cases: null html counts as empty; a null page_id is written without its
header and read back as null (it counts as the smallest when a response is
chosen); a revisit of a response without page_id has a null refers_to; an empty
table gives no file and no row. Other input columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from squall.llm.common import attempt_token, create_file, open_stream, placed, scratch, ship, stage, task_file

MIN_REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20  # compressed size at which a task begins the next file
GZIP_LEVEL = 5
SALTS = 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# records carry no clock time, so that a retried task writes the same bytes
DATE = "1970-01-01T00:00:00Z"


def _sha1(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_bytes(row: dict) -> bytes:
    """One page as a gzip member."""
    payload = (row["html"] or "").encode()
    revisit = row["original"] is not None
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    key = f"{row['page_id']}\n{row['place']}"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>", f"WARC-Date: {DATE}"]
    if row["url"]:
        head.append("WARC-Target-URI: " + quote(row["url"], safe=":/?#[]@!$&'()*+,;=%-._~"))
    if row["page_id"] is not None:
        head.append(f"X-Page-Id: {row['page_id']}")
    if revisit:
        first = row["original"]
        key = f"{first['page_id']}\n{first['place']}"
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>"]
        if first["page_id"] is not None:
            head.append(f"X-Refers-To-Page-Id: {first['page_id']}")
    head += ["Content-Type: application/http;msgtype=response",
             "WARC-Payload-Digest: " + _sha1(hashlib.sha1(payload).digest()),
             "WARC-Block-Digest: " + _sha1(hashlib.sha1(block).digest()), f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(GZIP_LEVEL, wbits=31)
    return pack.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + pack.flush()


def with_originals(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages with ``original`` (page_id, place): the record a revisit refers to,
    null for responses."""
    pages, place = placed(pages)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"),
                        place.alias("place"))
    rows = rows.withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary"))).withColumn(
        "long", F.coalesce(F.octet_length("html"), F.lit(0)) >= min_bytes)
    # groups are reduced before the shuffle; a group's row goes to every salt, so
    # a payload shared by a large part of the pages is not joined in one task
    groups = (rows.where("long").groupBy("digest")
              .agg(F.max(F.struct("page_id", "url", "place")).alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    joined = (rows.withColumn("salt", F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("int"))
              .join(groups, ["digest", "salt"], "left"))
    own = F.col("first").isNull() | (F.col("first.place") == F.col("place"))
    original = F.struct(F.col("first.page_id").alias("page_id"), F.col("first.place").alias("place"))
    return joined.select("page_id", "url", "html", "place", F.when(~own, original).alias("original"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write a record per page to ``.warc.gz`` files; returns the staged list of
    files (path, records, bytes)."""
    ship(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, token, seq, out = TaskContext.get().partitionId(), attempt_token(), 0, None
        path, records, used = "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, records, used = task_file(folder, ".warc.gz", pid, seq, token), 0, 0
                    out = create_file(path)
                member = record_bytes(row)
                out.write(member)
                records, used = records + 1, used + len(member)
                if used >= FILE_BYTES:
                    out.close()
                    yield _files(path, records, used)
                    out, seq = None, seq + 1
        if out is not None:
            out.close()
            yield _files(path, records, used)

    return stage(with_originals(pages, min_bytes).mapInArrow(write, "path string, records long, bytes long"),
                 "warc-files")


def _files(path: str, records: int, used: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [used]})


class Member:
    """The inflated bytes of one gzip member, read in order."""

    def __init__(self, source, pending: bytes) -> None:
        self.source, self.pending, self.buffer = source, pending, bytearray()
        self.inflate = zlib.decompressobj(wbits=31)

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        if not self.pending:
            self.pending = self.source.read(1 << 16)
            if not self.pending:
                raise ValueError("archive ends inside a record")
        self.buffer += self.inflate.decompress(self.pending, 1 << 18)
        self.pending = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        at = 0
        while (end := self.buffer.find(mark, at)) < 0:
            at = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                raise ValueError("record header without an end")
        found = bytes(self.buffer[:end + len(mark)])
        del self.buffer[:end + len(mark)]
        return found

    def chunks(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self._more():
                raise ValueError("block shorter than its Content-Length")
            part = bytes(self.buffer[:n])
            del self.buffer[:n]
            n -= len(part)
            if part:
                yield part

    def rest(self) -> bytes:
        while self._more():
            pass
        return bytes(self.buffer)


def _headers(text: bytes) -> dict[str, str]:
    lines = text.decode().split("\r\n")
    fields = (line.split(":", 1) for line in lines[1:] if line)
    return {k.strip().lower(): v.strip() for k, v in fields}


def _digest(value: str) -> bytes:
    kind, _, text = value.partition(":")
    if kind != "sha1":
        raise ValueError(f"unknown digest {kind}")
    return base64.b32decode(text)


def read_records(source, payloads: bool = False) -> Iterator[dict]:
    """The records of an archive in order, verified. Payloads are hashed as they
    are inflated, and kept only if asked for."""
    pending = b""
    while pending or (pending := source.read(1 << 16)):
        member = Member(source, pending)
        head = _headers(member.until(b"\r\n\r\n"))
        size = int(head["content-length"])
        http = member.until(b"\r\n\r\n")
        whole, content, kept = hashlib.sha1(http), hashlib.sha1(), []
        for part in member.chunks(size - len(http)):
            whole.update(part)
            content.update(part)
            if payloads:
                kept.append(part)
        if member.rest() != b"\r\n\r\n":
            raise ValueError("record does not end after its block")
        revisit = head["warc-type"] == "revisit"
        if whole.digest() != _digest(head["warc-block-digest"]):
            raise ValueError(f"block digest differs in {head['warc-record-id']}")
        if not revisit and content.digest() != _digest(head["warc-payload-digest"]):
            raise ValueError(f"payload digest differs in {head['warc-record-id']}")
        number = lambda name: int(head[name]) if name in head else None
        record = {"page_id": number("x-page-id"), "payload_bytes": int(_headers(http)["content-length"]),
                  "payload_digest": _digest(head["warc-payload-digest"]).hex(), "record_type": head["warc-type"],
                  "refers_to": number("x-refers-to-page-id"), "target_uri": head.get("warc-target-uri")}
        yield record | ({"payload": b"".join(kept)} if payloads else {})
        pending = member.pending


RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "target_uri string")
_RECORDS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                      ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string())])


def read_archives(files: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the archives listed in ``files`` (path)."""
    ship(files.sparkSession)
    schema = _RECORDS.append(pa.field("payload", pa.binary())) if payloads else _RECORDS

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, used = [], 0
                with open_stream(path) as source:
                    for record in read_records(source, payloads):
                        rows.append(record)
                        used += record["payload_bytes"] if payloads else 0
                        if len(rows) >= 4096 or used > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, used = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    # few small rows stand for large files: spread them by number, not by size
    tasks = max(1, min(files.count(), 10_000))
    return (files.select("path").repartition(tasks, "path")
            .mapInArrow(read, RECORDS + (", payload binary" if payloads else "")))


def archive_roundtrip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write pages to archives in the shared folder and read them back."""
    return read_archives(write_archives(pages, scratch(pages.sparkSession, "warc"), min_bytes))
