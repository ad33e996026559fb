"""Legacy archive converter: ARC version 1 and 2 files to WARC 1.1.

ARC: a file starts with a version block (``filedesc://``) whose body names the version; each
record is a header line, exactly as many content bytes as that line declares, and a newline.
Version 1 lines hold URL, IP, date, type, length; version 2 adds result code, checksum,
location, offset and file name before the length. Lines are read from the right, so blanks inside a URL do no harm.

WARC: the version block becomes a ``warcinfo`` record; an HTTP page becomes ``response``, or ``revisit`` when
another record already holds the same payload. Record ids are name-based UUIDs of the record's place and content
(a rerun after a lost executor gives the same ids), the 14-digit date becomes an ISO instant,
digests are base32 SHA-1 of payload and block.

Archives are gzip files written by Spark's text writer (records are bytes; the record terminator is the line
separator) and read back as whole files by ``binaryFile``, so any file system Spark knows will do.
One file is one task's partition of the input.

Defined cases: null or empty payload is empty; null URL is written as ``-``; blanks and control characters in a
URL are percent-encoded; a null page id is left out of the HTTP headers and reads back as null; rows that repeat the
largest page id of a payload are all responses; a record cut short by the end of its file keeps the bytes that are
there and is marked truncated; a line that is no header is skipped. An empty table gives no archive records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import as_bytes, join_counted, slices, written
from martlet.session import work_dir

VERSION_LINES = {
    1: b"1 0 archive\nURL IP-address Archive-date Content-type Archive-length\n",
    2: b"2 0 archive\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
       b"Archive-length\n",
}
#: Space-separated fields of a record's header line, by version.
FIELDS = {1: 5, 2: 10}
RECORD_SCHEMA = ("file string, offset long, version int, url string, ip string, arc_date string, mime string, "
                 "truncated boolean, page_id long, block binary, payload_at int, payload_bytes long, "
                 "payload_digest string, record_id string")
WARC_SCHEMA = ("file string, record_type string, record_id string, target_uri string, warc_date string, "
               "page_id long, payload_bytes long, payload_digest string, refers_to long, digests_match boolean")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _encoded_url(url: bytes | None) -> bytes:
    return b"".join(b"%%%02X" % c if c <= 0x20 or c == 0x7F else bytes((c,)) for c in url) if url else b"-"


def _http(page_id: int | None, n: int) -> bytes:
    own = b"" if page_id is None else b"X-Page-Id: %d\r\n" % page_id
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n%sContent-Length: %d\r\n\r\n" % (own, n)


def _http_fields(block: bytes) -> tuple[int, dict[bytes, bytes]]:
    """Where the payload of an HTTP block starts, and its header fields by lower-case name."""
    end = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or end < 0:
        return 0, {}
    pairs = (line.partition(b":") for line in block[:end].split(b"\r\n")[1:])
    return end + 4, {k.strip().lower(): v.strip() for k, _, v in pairs}


def _number(value: bytes | None) -> int | None:
    try:
        return int(value)
    except (TypeError, ValueError):
        return None


# -- ARC -----------------------------------------------------------------------------------------------------------

def arc_record(version: int, url: bytes, date: bytes, mime: bytes, block: bytes, name: bytes, offset: int) -> bytes:
    extra = b"" if version == 1 else b"200 %s - %d %s " % (sha1_base32(block).encode(), offset, name)
    return b"%s 0.0.0.0 %s %s %s%d\n%s" % (url, date, mime, extra, len(block), block)


def write_arc(pages: DataFrame, path: str, *, key: str = "page_id", url: str = "url", payload: str = "html",
              date: str = "20200101000000") -> None:
    """Write pages as gzip ARC files, one per input partition, of versions 1 and 2 in turn."""

    def render(index_and_batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version, name = 1 + part % 2, b"part-%05d.arc" % part
        offset = 0
        for batch in slices(index_and_batches):
            out = []
            if not offset:
                out.append(arc_record(version, b"filedesc://" + name, date.encode(), b"text/plain",
                                      VERSION_LINES[version], name, 0))
                offset = len(out[0]) + 1
            ids = batch.column(0).to_pylist()
            for k, u, body in zip(ids, as_bytes(batch, "url"), as_bytes(batch, "payload"), strict=True):
                block = _http(k, len(body or b"")) + (body or b"")
                out.append(arc_record(version, _encoded_url(u), date.encode(), b"text/html", block, name, offset))
                offset += len(out[-1]) + 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    rows = pages.select(F.col(key).cast("bigint").alias("key"), F.col(url).cast("string").alias("url"),
                        F.col(payload).cast("binary").alias("payload"))
    _write_records(rows.mapInArrow(render, "value binary"), path, "\n")


def _write_records(records: DataFrame, path: str, separator: str) -> None:
    (records.select(F.col("value").cast("string").alias("value")).write
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("lineSep", separator).text(path))


class _Stream:
    """Bytes of a gzip (or plain) file, read forward; only what is asked for is held unpacked."""

    def __init__(self, data: bytes, step: int = 1 << 20):
        self.data, self.step, self.at, self.buffer, self.offset = memoryview(data), step, 0, bytearray(), 0
        self.unzip = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else None

    def _more(self) -> bool:
        if self.at >= len(self.data):
            return False
        raw = self.data[self.at:self.at + self.step]
        self.at += len(raw)
        if self.unzip is None:
            self.buffer += raw
            return True
        self.buffer += self.unzip.decompress(raw)
        while self.unzip.eof and self.unzip.unused_data:  # members one after another
            rest, self.unzip = self.unzip.unused_data, zlib.decompressobj(31)
            self.buffer += self.unzip.decompress(rest)
        return True

    def read(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        out = bytes(self.buffer[:n])
        del self.buffer[:len(out)]
        self.offset += len(out)
        return out

    def until(self, mark: bytes) -> bytes | None:
        """Up to and including the mark; None at the end of the file."""
        seen = 0
        while (k := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark))
            if not self._more():
                return None
        return self.read(k + len(mark))


def parse_arc(data: bytes) -> Iterator[tuple[int, int, list[str], bytes, bool]]:
    """(offset, version, header fields, content, truncated) of each record, version blocks included."""
    stream, version = _Stream(data), 1
    while True:
        at, line = stream.offset, stream.until(b"\n")
        if line is None:
            return
        line = line.rstrip(b"\r\n")
        if line.startswith(b"filedesc://"):
            fields = line.split(b" ")
            size = _number(fields[-1])
            content = stream.read(size or 0)
            version = _number(content[:1]) or 1
        else:
            fields = line.rsplit(b" ", FIELDS.get(version, 5) - 1)
            size = _number(fields[-1])
            if len(fields) != FIELDS.get(version, 5) or size is None or size < 0 or not fields[2].isdigit():
                continue
            content = stream.read(size)
        yield at, version, [f.decode("utf-8", "replace") for f in fields], content, len(content) < (size or 0)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The page records of ARC files: place, header fields, block, payload length and digest, WARC record id."""

    def parse(batches):
        for batch in slices(batches, 1):
            name, (data,) = batch.column(0)[0].as_py(), as_bytes(batch, "content")
            rows, held = [], 0
            for at, version, fields, block, cut in parse_arc(data):
                if fields[0].startswith("filedesc://"):
                    continue
                begin, http = _http_fields(block)
                payload = block[begin:]
                file = name.rsplit("/", 1)[-1]
                digest = sha1_base32(payload)
                own = uuid.uuid5(uuid.NAMESPACE_URL, f"{file}#{at}:{fields[0]}:{digest}")
                rows.append((file, at, version, fields[0], fields[1], fields[2], fields[3], cut,
                             _number(http.get(b"x-page-id")), block, begin, len(payload), digest, f"urn:uuid:{own}"))
                held += len(block)
                if held > 4 << 20:
                    yield _batch(rows, RECORD_TYPES)
                    rows, held = [], 0
            yield _batch(rows, RECORD_TYPES)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(parse, RECORD_SCHEMA)


_KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
RECORD_TYPES = [(n, _KINDS[t]) for n, t in (c.split() for c in RECORD_SCHEMA.split(", "))]
WARC_TYPES = [(n, _KINDS[t]) for n, t in (c.split() for c in WARC_SCHEMA.split(", "))]


def _batch(rows: list[tuple], types: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)],
                                      names=[n for n, _ in types])


# -- WARC ----------------------------------------------------------------------------------------------------------

def with_responses(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Records with ``n_equal`` and, where another one is the payload's response, ``first`` (its page id and record id).

    Only (digest, length, page id, record id) is grouped, combined map-side; only repeated payloads are
    kept. A payload that a third of all records share is resolved by a broadcast of bounded size.
    """
    groups = written(
        records.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
        .agg(F.count(F.lit(1)).alias("n_equal"), F.max(F.struct("page_id", "record_id", "url", "arc_date")).alias("first"))
        .filter("n_equal > 1"), "warc-payloads")
    total = groups.agg(F.sum("n_equal")).first()[0] or 0
    return join_counted(records, groups, ["payload_digest", "payload_bytes"], "n_equal", total)


def _instant(arc_date: str) -> str:
    d = (arc_date + "00000101000000"[len(arc_date):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(r: dict) -> bytes:
    """One WARC record, without its terminator."""
    first = r["first"]
    revisit = first is not None and first["page_id"] != r["page_id"] and first["page_id"] is not None
    block, at = r["block"], r["payload_at"]
    body = block[:at] if revisit else block
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"),
            b"WARC-Record-ID: <%s>" % r["record_id"].encode(), b"WARC-Date: " + _instant(r["arc_date"]).encode(),
            b"WARC-Target-URI: " + r["url"].encode(), b"WARC-IP-Address: " + r["ip"].encode(),
            b"WARC-Payload-Digest: sha1:" + r["payload_digest"].encode(),
            b"WARC-Block-Digest: sha1:" + sha1_base32(body).encode()]
    if revisit:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 b"WARC-Refers-To: <%s>" % first["record_id"].encode(),
                 b"WARC-Refers-To-Target-URI: " + first["url"].encode(),
                 b"WARC-Refers-To-Date: " + _instant(first["arc_date"]).encode(),
                 b"X-Refers-To-Page-Id: %d" % first["page_id"]]
    if r["truncated"]:
        head.append(b"WARC-Truncated: unspecified")
    head += [b"Content-Type: " + (b"application/http; msgtype=response" if at else r["mime"].encode()),
             b"Content-Length: %d" % len(body)]
    return b"\r\n".join(head) + b"\r\n\r\n" + body


def _warcinfo() -> bytes:
    body = b"format: WARC File Format 1.1\r\n"
    own = uuid.uuid5(uuid.NAMESPACE_URL, "martlet:warcinfo")
    return (b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:%s>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\n"
            b"Content-Type: application/warc-fields\r\nContent-Length: %d\r\n\r\n%s" % (str(own).encode(), len(body), body))


def write_warc(records: DataFrame, path: str) -> None:
    """Write converted records (of ``with_responses``) as gzip WARC files."""

    def render(batches):
        begun = False
        for batch in slices(batches):
            out = [] if begun else [_warcinfo()]
            begun = True
            out += [warc_record(r) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    _write_records(records.mapInArrow(render, "value binary"), path, "\r\n\r\n")


def parse_warc(data: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """(header fields by lower-case name, block) of each record."""
    stream = _Stream(data)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.strip(b"\r\n").split(b"\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines[1:])}
        block = stream.read(_number(fields.get(b"content-length")) or 0)
        stream.read(4)
        yield fields, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record; ``digests_match`` compares the declared digests with the bytes read.

    A revisit has no payload: its payload length is the one its HTTP headers declare.
    """

    def parse(batches):
        for batch in slices(batches, 1):
            name, (data,) = batch.column(0)[0].as_py(), as_bytes(batch, "content")
            rows = []
            for f, block in parse_warc(data):
                kind = f[b"warc-type"].decode()
                if kind not in ("response", "revisit"):
                    continue
                at, http = _http_fields(block)
                digest = f[b"warc-payload-digest"].removeprefix(b"sha1:").decode()
                right = f[b"warc-block-digest"] == b"sha1:" + sha1_base32(block).encode()
                if kind == "response":
                    size, right = len(block) - at, right and sha1_base32(block[at:]) == digest
                else:
                    size = _number(http.get(b"content-length"))
                rows.append((name, kind, f[b"warc-record-id"].decode()[1:-1], f[b"warc-target-uri"].decode("utf-8", "replace"),
                             f[b"warc-date"].decode(), _number(http.get(b"x-page-id")), size, digest,
                             _number(f.get(b"x-refers-to-page-id")), right))
            yield _batch(rows, WARC_TYPES)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(parse, WARC_SCHEMA)


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = 0) -> None:
    """ARC files to WARC files; of equal payloads of at least ``min_bytes`` the largest page id's is the response."""
    write_warc(with_responses(read_arc(spark, arc_path), min_bytes), warc_path)


def archive_pages(pages: DataFrame, min_bytes: int = 0, **columns) -> DataFrame:
    """Pages to ARC archives, those to WARC archives, and what is read back from the latter."""
    spark = pages.sparkSession
    root = work_dir(spark, "archives")
    write_arc(pages, f"{root}/arc", **columns)
    if not _any_file(spark, f"{root}/arc"):
        return spark.createDataFrame([], WARC_SCHEMA)
    convert(spark, f"{root}/arc", f"{root}/warc", min_bytes)
    return read_warc(spark, f"{root}/warc")


def _any_file(spark: SparkSession, path: str) -> bool:
    return bool(spark.read.format("binaryFile").load(path).select("path").take(1))

