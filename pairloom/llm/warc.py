"""WARC archives as chunked record tables.

An archive is a table of raw WARC bytes: one row per record (``rec``) and chunk number, in the order of the
file, with the SHA-1 of the payload up to that chunk. A record is cut into rows while it is written and fed to
an incremental parser while it is read, so that beside the page itself no more than a chunk is held, however
large the payload. Records of one chunk, nearly all, are read where they lie; only the rows of larger ones
are brought together, by record, and streamed in order. The bytes of a record's rows are a valid WARC 1.1
record; ``WarcReader`` also reads files of records, plain or gzipped.

Payloads are told by SHA-256 and length, and described by SHA-1, as the format does. Of records with equal payloads of at least ``least`` bytes, that with the largest id is stored whole (response);
the others are revisits that hold the headers and refer to it.

Nulls and edges: a null payload counts as empty; a null address gives a record without one; a null id is
lower than all others, and a record with it refers to one with an id where there is one; rows that repeat the
largest id are all responses; payloads of any length are stored whole; extra columns are ignored.
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
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_arrow, join_small, written

CHUNK_BYTES = 64 << 10
LEAST = 1_000
DATE = "2020-01-01T00:00:00Z"
CHUNK_SCHEMA = "rec string, chunk_no int, last boolean, data binary, sha1 string"
RECORD_SCHEMA = "payload_bytes long, payload_digest string, record_type string, refers_to {id}, url string, stored_bytes long, intact boolean"


def record_id(page_id: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def head(kind: str, page_id: object, url: str | None, size: int, sha1: str, refers_to: object) -> bytes:
    """The headers of a record whose payload has ``size`` bytes, up to where the payload begins."""
    inner = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    fields = {
        "WARC-Type": kind, "WARC-Record-ID": record_id(page_id), "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode(),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(inner) + (size if kind == "response" else 0),
    }
    if kind == "revisit":
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["WARC-Refers-To"] = record_id(refers_to)
        fields["X-Refers-To-Page"] = refers_to
    fields["X-Page"] = page_id
    lines = [f"{k}: {v}" for k, v in fields.items() if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + inner


class WarcReader:
    """An incremental parser: feed it bytes as they come, and it yields events.

    ("record", headers), then ("payload", bytes) as often as there are any, then ("end", None).
    ``unzip`` reads files of gzip members. HTTP headers are kept apart from the payload of a response.
    """

    def __init__(self, unzip: bool = False):
        self.buffer, self.state, self.left, self.headers = bytearray(), "head", 0, {}
        self.zip = zlib.decompressobj(31) if unzip else None

    def feed(self, data: bytes) -> Iterator[tuple[str, object]]:
        if self.zip is None:
            yield from self._parse(data)
            return
        while data:
            yield from self._parse(self.zip.decompress(data, CHUNK_BYTES))
            data = self.zip.unconsumed_tail
            if self.zip.eof:
                data, self.zip = self.zip.unused_data, zlib.decompressobj(31)

    def _parse(self, data: bytes) -> Iterator[tuple[str, object]]:
        if self.state == "payload":  # the larger part: not through the buffer
            take = data[: self.left]
            if take:
                self.left -= len(take)
                yield "payload", take
            data = data[len(take) :]
            if self.left:
                return
            self.state = "tail"
        self.buffer += data
        while True:
            if self.state == "tail":
                if len(self.buffer) < 4:
                    return
                if self.buffer[:4] != b"\r\n\r\n":
                    raise ValueError("a record does not end as it should")
                del self.buffer[:4]
                self.state = "head"
                yield "end", None
            end = self.buffer.find(b"\r\n\r\n")
            if end < 0:
                return
            block, n = bytes(self.buffer[:end]), end + 4
            if self.state == "head":
                lines = block.split(b"\r\n")
                if not lines[0].startswith(b"WARC/"):
                    raise ValueError("not a WARC record")
                self.headers = {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines[1:])}
                self.left = int(self.headers["content-length"])
                if self.left < 0:
                    raise ValueError("a record of less than no bytes")
                del self.buffer[:n]
                if self.headers.get("content-type", "").startswith("application/http"):
                    self.state = "http"
                    continue
            else:
                for x in block.split(b"\r\n")[1:]:
                    k, _, v = x.decode("latin-1").partition(":")
                    self.headers[f"http:{k.strip().lower()}"] = v.strip()
                del self.buffer[:n]
                self.left -= n
            yield "record", self.headers
            self.state = "payload" if self.left else "tail"
            if self.left:
                take = bytes(self.buffer[: self.left])
                del self.buffer[: len(take)]
                self.left -= len(take)
                if take:
                    yield "payload", take
                if self.left:
                    return
                self.state = "tail"


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST, chunk_bytes: int = CHUNK_BYTES, limit: int | None = None, path: str | None = None) -> DataFrame:
    """Writes the pages as a chunked record table and returns it (CHUNK_SCHEMA).

    It is written to ``path`` (to stay), or into the shared folder as a scratch table.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha1"), F.sha2(payload, 256).alias("sha256"), F.length(payload).alias("n"))
    marks = own.select("id", "sha256", "n").filter(F.col("n") >= least)
    first = written(marks.groupBy("sha256", "n").agg(F.max("id").alias("first"), F.count("*").alias("copies")).filter("copies > 1").drop("copies"), "first")
    joined = join_small(own, first, ["sha256", "n"], "left", ["id", "url"], limit)
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    rows = joined.select("id", "url", "payload", "sha1", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        out: list[tuple] = []
        held = 0
        for b in batches:
            for i in range(b.num_rows):
                page_id, url, sha1, refers_to, again = (b.column(k)[i].as_py() for k in (0, 1, 3, 4, 5))
                body = memoryview(b.column(2)[i].as_buffer())
                start = head("revisit" if again else "response", page_id, url, len(body), sha1, refers_to)
                rec, count = f"{part}-{count}", count + 1
                digest, at, number = hashlib.sha1(), 0, 0
                stored = 0 if again else len(body)
                while True:
                    take = body[at : min(stored, at + max(1, chunk_bytes - len(start)))]
                    at += len(take)
                    digest.update(take)
                    last = at >= stored
                    out.append((rec, number, last, b"".join((start, take, b"\r\n\r\n" if last else b"")), digest.hexdigest()))
                    held, number, start = held + len(out[-1][3]), number + 1, b""
                    if held > 4 << 20:
                        yield _chunks(out)
                        out, held = [], 0
                    if last:
                        break
        if out:
            yield _chunks(out)

    out = in_arrow(rows, run, CHUNK_SCHEMA)
    if path is None:
        return written(out, "archive")
    out.write.parquet(path)
    return pages.sparkSession.read.schema(CHUNK_SCHEMA).parquet(path)


def _chunks(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.bool_(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["rec", "chunk_no", "last", "data", "sha1"])


def read_archive(chunks: DataFrame, id_col: str = "page_id", id_type: str = "bigint") -> DataFrame:
    """One row per record: id_col and RECORD_SCHEMA; ``intact`` says that all digests on the way agree.

    Size and digest are those of the full payload; a revisit's come from its headers.
    """
    number = id_type in ("bigint", "int", "smallint", "tinyint")
    kind = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}.get(id_type, pa.string())

    def ident(x: str | None) -> object:
        return None if x is None else int(x) if number else x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, rec, size, digest, ok, h = WarcReader(), None, 0, None, True, {}
        for b in batches:
            out = []
            for r, number_, data, sha1 in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3), b.column(4).to_pylist(), strict=True):
                if number_ == 0:
                    reader, rec, size, digest, ok = WarcReader(), r, 0, hashlib.sha1(), True
                elif r != rec:
                    raise ValueError(f"record {r} begins with chunk {number_}")
                for event, x in reader.feed(data.as_buffer()):
                    if event == "record":
                        h = dict(x)
                    elif event == "payload":
                        digest.update(x)
                        size += len(x)
                    else:
                        told = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                        full = int(h["http:content-length"])
                        again = h["warc-type"] == "revisit"
                        ok = ok and (again and size == 0 or digest.hexdigest() == told and size == full)
                        out.append((ident(h.get("x-page")), full, told, h["warc-type"], ident(h.get("x-refers-to-page")), h.get("warc-target-uri"), size, ok))
                ok = ok and digest.hexdigest() == sha1
            if out:
                kinds = (kind, pa.int64(), pa.string(), pa.string(), kind, pa.string(), pa.int64(), pa.bool_())
                names = [id_col, *(x.split()[0] for x in RECORD_SCHEMA.split(", "))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    schema = f"`{id_col}` {id_type}, {RECORD_SCHEMA.format(id=id_type)}"
    alone = in_arrow(chunks.filter("chunk_no = 0 and last"), run, schema)
    large = in_arrow(chunks.filter("not (chunk_no = 0 and last)").repartition("rec").sortWithinPartitions("rec", "chunk_no"), run, schema)
    return alone.unionByName(large)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """WARC files (.warc, .warc.gz) as payload chunks: path, record_no, chunk_no, type, uri, record_id, data, sha1, error.

    Files come through Spark's own reader, so any store it reads will do; a file is one value there, so it has at most 2 GB
    and is held whole (archives that this package writes are tables of chunks, and are not). A file that is not well formed, or
    ends within a record, gives what was read before, and a last row whose ``error`` says so.
    """
    schema = "path string, record_no long, chunk_no int, type string, uri string, record_id string, data binary, sha1 string, error string"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.string())

    def rows(file: str, data: memoryview) -> Iterator[tuple]:
        reader, record, number, h, digest = WarcReader(bytes(data[:2]) == b"\x1f\x8b"), -1, 0, {}, hashlib.sha1()
        try:
            for at in range(0, len(data), CHUNK_BYTES):
                for event, x in reader.feed(bytes(data[at : at + CHUNK_BYTES])):
                    if event == "record":
                        record, number, h, digest = record + 1, 0, dict(x), hashlib.sha1()
                        continue
                    if event == "end" and number:
                        continue
                    part = x or b""  # a record without a payload has one empty chunk
                    digest.update(part)
                    yield file, record, number, h.get("warc-type"), h.get("warc-target-uri"), h.get("warc-record-id"), bytes(part), digest.hexdigest(), None
                    number += 1
            error = "the file ends within a record" if reader.state != "head" or reader.buffer.strip() else None
        except (ValueError, KeyError, zlib.error) as e:
            error = str(e) or type(e).__name__
        if error:
            yield file, record, number, h.get("warc-type"), h.get("warc-target-uri"), h.get("warc-record-id"), None, None, error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for row in rows(file, memoryview(content.as_buffer())):
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    return in_arrow(spark.read.format("binaryFile").load(path).select("path", "content"), run, schema)
