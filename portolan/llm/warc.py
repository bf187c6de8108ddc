"""Operator 7: WARC archives as a Spark data source.

Writing: a record per row, in files of a folder, every record a gzip member of its own.
A task writes a file under a name of its own and reports it with the offsets of its segments; the driver
commits the job by writing one manifest, so files of failed or repeated tasks are never
read. A gzip member's header carries the member's compressed length in an extra field (id ``SL``),
so a reader can pass over a payload without inflating it.

Reading: one input partition per segment of about ``segment_bytes`` (from the manifests), or per
file for archives from elsewhere. Equality and ``IN`` filters on ``record_type`` and on header
columns are pushed down; the reader inflates the first bytes of a record, parses its headers, judges the
filters, and only then inflates the payload, and not at all if the payload isn't asked for.

Records: ``response`` holds an HTTP head and the payload; ``revisit`` holds headers only and refers to
the response with the same payload. Defined results: a null payload counts as empty; null ids and
URLs have no header; rows that repeat the largest id of their payload are all responses; an empty
table gives an archive without records. The digest is over the whole payload (SHA-1, base32), and
the reader recomputes the digest that a record names, by its own algorithm, for every payload it reads and raises on a difference. So it
does on bytes that are no record; blank lines and empty members between records are passed over. An archive that does not say a payload's length
has it taken from the payload (null if payloads are not read).

Files are opened by pyarrow's file systems, so a folder may be local to all (as in tests) or in any store that pyarrow opens.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition,
                                    WriterCommitMessage)

from portolan.llm.common import checkpoint, table, utf8
from portolan.session import scratch_path

SCHEMA = ("record_id string, record_type string, url string, page_id long, refers_to long, payload_digest string, "
          "payload_bytes long, payload binary")
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "url": "WARC-Target-URI", "page_id": "X-Page-ID",
           "refers_to": "X-Refers-To-Page", "payload_digest": "WARC-Payload-Digest", "payload_bytes": "X-Payload-Length"}
NUMBERS = ("page_id", "refers_to", "payload_bytes")
MANIFEST = "_manifest-"


def matches(payload: bytes, digest: str | None) -> bool:
    """Whether a digest as archives label it (``sha1:``, ``sha256:`` and so on, in base32 or hex digits) is that of the payload. No digest
    and algorithms that Python lacks match everything."""
    name, found, value = (digest or "").strip().partition(":")
    name = name.lower().replace("-", "")
    if not found or name not in hashlib.algorithms_guaranteed or name.startswith("shake"):
        return True
    raw, value = hashlib.new(name, payload).digest(), value.strip()
    return value.upper().rstrip("=") == base64.b32encode(raw).decode().rstrip("=") or value.lower() == raw.hex()


def open_folder(path: str):
    """pyarrow's file system and path of a folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://") if path.startswith("file:") else f"file://{path}")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(data: bytes) -> bytes:
    """One gzip member that names its own length in the extra field SL."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    length = 20 + len(body) + 8
    if length >= 1 << 32:  # too long for the field: such a member is read to its end
        return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 8) + b"SL" + struct.pack("<HI", 4, length) + body
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def _clean(value: object) -> str:
    """A header value must stay on its line; other characters go as UTF-8."""
    return str(value).replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(row: dict) -> bytes:
    """The bytes of a record (before compression)."""
    response = row["record_type"] == "response"
    payload = row["payload"] or b"" if response else b""
    block = b""
    if response:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    head = ["WARC/1.1", "WARC-Date: 1970-01-01T00:00:00Z",
            f"Content-Type: application/http; msgtype={'response' if response else 'revisit'}"]
    if not response:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    for column, name in HEADERS.items():
        if row.get(column) is not None:
            value = _clean(row[column]) if column == "url" else row[column]
            head.append(f"{name}: {'sha1:' if column == 'payload_digest' else ''}{value}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    file: str
    segments: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, segment_bytes: int):
        self.path, self.segment_bytes = path, segment_bytes

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = open_folder(self.path)
        fs.create_dir(folder, recursive=True)
        name, at, start, segments = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0, []
        with fs.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for batch in batches:
                for i in range(batch.num_rows):
                    data = member(record(batch.slice(i, 1).to_pylist()[0]))
                    out.write(data)
                    at += len(data)
                    if at - start >= self.segment_bytes:
                        segments.append((start, at))
                        start = at
        if at > start:
            segments.append((start, at))
        return Written(name, segments)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = open_folder(self.path)
        fs.create_dir(folder, recursive=True)
        files = {m.file: m.segments for m in messages if m is not None}
        with fs.open_output_stream(f"{folder}/{MANIFEST}{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, folder = open_folder(self.path)
        for m in messages:
            if m is not None:
                fs.delete_file(f"{folder}/{m.file}")


@dataclass
class Segment(InputPartition):
    file: str
    start: int
    stop: int | None  # None: to the end of the file


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema, with_payload: bool):
        self.path, self.schema, self.with_payload = path, schema, with_payload
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take equality and IN on header columns; leave the rest to Spark."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name not in HEADERS:
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.wanted[name] = self.wanted.get(name, values) & values

    def partitions(self) -> list[Segment]:
        from pyarrow.fs import FileSelector

        fs, folder = open_folder(self.path)
        names = [i.base_name for i in fs.get_file_info(FileSelector(folder, allow_not_found=True))]
        out = []
        for name in sorted(n for n in names if n.startswith(MANIFEST)):
            with fs.open_input_stream(f"{folder}/{name}", compression=None) as f:
                out += [Segment(file, a, b) for file, parts in json.loads(f.read()).items() for a, b in parts]
        if not any(n.startswith(MANIFEST) for n in names):  # archives from elsewhere
            out = [Segment(n, 0, None) for n in sorted(names) if n.endswith((".warc.gz", ".warc"))]
        return out

    def read(self, segment: Segment) -> Iterator[tuple]:
        fs, folder = open_folder(self.path)
        if segment is None:
            return
        with fs.open_input_file(f"{folder}/{segment.file}") as f:
            size = f.size()
            stop, at = (size if segment.stop is None else segment.stop), segment.start
            one = GzipRecord if segment.file.endswith(".gz") else PlainRecord
            while at < stop:
                item = one(f, at, size)
                if item.headers is None:
                    if item.blank():
                        at = item.end()
                        continue
                    raise ValueError(f"{segment.file} at {at}: no WARC headers")
                row = self._row(item.headers)
                if row["payload_bytes"] is None and row["record_type"] == "response" and self.with_payload:
                    row["payload_bytes"] = len(item.payload())  # an archive from elsewhere, which doesn't say
                if all(row.get(c) in values for c, values in self.wanted.items()):
                    payload = None
                    if self.with_payload and row["record_type"] == "response":
                        payload = item.payload()
                        if not matches(payload, item.headers.get(HEADERS["payload_digest"].lower())):
                            raise ValueError(f"{segment.file} at {at}: the payload doesn't match its digest")
                        row["payload_bytes"] = len(payload)
                    yield tuple(payload if c == "payload" else row.get(c) for c in self.schema.names)
                at = item.end()

    @staticmethod
    def _row(headers: dict[str, str]) -> dict:
        row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
        for c in NUMBERS:
            row[c] = int(row[c]) if row[c] is not None else None
        if row["url"] is not None:
            row["url"] = _plain(row["url"])
        if row["payload_digest"] is not None:
            row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
        return row


class _Payload:
    """What both kinds of record have in common."""

    _payload: bytes | None = None

    def payload(self) -> bytes:
        """The block after the HTTP headers; a block without them is all payload."""
        if self._payload is None:
            block = self.block()
            self._payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
        return self._payload


def parse_headers(head: bytes) -> dict[str, str]:
    rows = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {k.decode("utf-8", "replace").strip().lower(): v.decode("utf-8", "replace").strip() for k, _, v in rows}


class PlainRecord(_Payload):
    """A record of an uncompressed archive: headers now, the block on demand."""

    def __init__(self, f, at: int, size: int):
        self.f, self.head = f, b""
        while b"\r\n\r\n" not in self.head.lstrip(b"\r\n") and at + len(self.head) < size:
            f.seek(at + len(self.head))
            self.head += f.read(4096)
        # Lines left over between records belong to the one before.
        lead = len(self.head) - len(self.head.lstrip(b"\r\n"))
        head, found, _ = self.head[lead:].partition(b"\r\n\r\n")
        self.headers = parse_headers(head) if found and head.startswith(b"WARC/") else None
        self.size = size
        if self.headers is not None:
            self.start, self.length = at + lead + len(head) + 4, int(self.headers["content-length"])

    def blank(self) -> bool:
        return not self.head.strip()

    def block(self) -> bytes:
        self.f.seek(self.start)
        return self.f.read(self.length)

    def end(self) -> int:
        return self.start + self.length + 4 if self.headers is not None else self.size


class GzipRecord(_Payload):
    """A record in a gzip member: inflated as far as its headers now, the rest on demand."""

    def __init__(self, f, at: int, size: int):
        self.f, self.size, self.at, self.pos, self.raw = f, size, at, at, b""
        self.inflate, self.data, self.headers = zlib.decompressobj(31), b"", None
        f.seek(at)
        first = f.read(20)
        self.length = None
        if len(first) == 20 and first[3] & 4 and first[12:14] == b"SL":
            self.length = struct.unpack("<I", first[16:20])[0]
        while b"\r\n\r\n" not in self.data.lstrip(b"\r\n") and not self.inflate.eof and self._more(2048, 4096):
            pass
        head, found, self.rest = self.data.lstrip(b"\r\n").partition(b"\r\n\r\n")
        if found and head.startswith(b"WARC/"):
            self.headers = parse_headers(head)

    def blank(self) -> bool:
        """Whether the member holds nothing; an empty one is allowed anywhere."""
        return self.inflate.eof and not self.data.strip()

    def _more(self, compressed: int, most: int = 0) -> bool:
        raw = self.inflate.unconsumed_tail
        if not raw:
            self.f.seek(self.pos)
            raw = self.f.read(compressed)
            self.pos += len(raw)
        if not raw:
            return False
        self.data += self.inflate.decompress(raw, most)
        return True

    def block(self) -> bytes:
        parts, length = [self.rest], int(self.headers["content-length"])
        while not self.inflate.eof:
            self.data = b""
            if not self._more(1 << 16):
                break
            parts.append(self.data)
        return b"".join(parts)[:length]

    def end(self) -> int:
        """Where the next member starts: by the extra field, else by inflating to the end."""
        if self.length is not None:
            return self.at + self.length
        while not self.inflate.eof:
            self.data = b""
            if not self._more(1 << 16, 1 << 20):
                return self.size
        return self.pos - len(self.inflate.unused_data)


class WarcDataSource(DataSource):
    """``format("warc")``. Options: ``path``; ``payload`` (``false``: headers only); ``segment_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], schema, self.options.get("payload", "true").lower() == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("segment_bytes", str(32 << 20))))


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known and let Spark push filters into Python sources: ``spark.sql.python.filterPushdown.enabled`` is set
    for the whole session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def base32(digest: Column) -> Column:
    """Base32 of 20 bytes (four groups of five bytes, eight letters each)."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    groups = []
    for g in range(4):
        number = F.conv(F.hex(F.substring(digest, 5 * g + 1, 5)), 16, 10).cast("long")
        groups += [F.substring(letters, (F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1))
                   for shift in range(35, -1, -5)]
    return F.concat(*groups)


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The records of ``pages`` (``page_id``, ``url``, ``html``): equal payloads of at least ``least_bytes`` become
    one response, that of the largest id, and revisits.

    The largest id per digest is a small aggregation; the join that brings it to the pages reads both sides
    anew, so the pages of a frequent payload are split by AQE.
    """
    rows = pages.select("page_id", "url", utf8(F.col("html")).alias("payload"))
    rows = rows.withColumn("payload_digest", base32(F.unhex(F.sha1("payload")))).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    heads = checkpoint(rows.groupBy(F.col("payload_digest").alias("__digest"), F.col("payload_bytes").alias("__bytes"))
                       .agg(F.max("page_id").alias("__head")))
    joined = rows.join(heads, (F.col("payload_digest") == F.col("__digest")) & (F.col("payload_bytes") == F.col("__bytes")))
    revisit = (F.col("payload_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("__head"))
    return joined.select(
        F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), "url", F.col("page_id").cast("long").alias("page_id"),
        F.when(revisit, F.col("__head")).cast("long").alias("refers_to"), "payload_digest", "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"))


def write_warc(rows: DataFrame, path: str) -> None:
    register(rows.sparkSession)
    rows.write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """Contract query of operator 7: all pages written as archives, then read back with every payload checked."""
    path = scratch_path(spark, "warc")
    write_warc(records(table(spark, sf_dir, "pages")), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = r"""
WITH RECURSIVE p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
q AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, unhex(sha1(payload)) AS d FROM p),
b AS (SELECT page_id, payload_bytes, array_to_string([
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(('0x' || hex(d)[10 * (i // 8) + 1:10 * (i // 8) + 10])::BIGINT
    // (1::BIGINT << (35 - 5 * (i % 8))) % 32 + 1 AS BIGINT), 1) for i in range(32)], '') AS payload_digest FROM q),
m AS (SELECT payload_digest, max(page_id) AS head FROM b GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> head THEN head END AS refers_to
FROM b JOIN m USING (payload_digest)"""
