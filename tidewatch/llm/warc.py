"""WARC archives as a Spark data source (``spark.read.format("warc")``).

Reading plans partitions from the files (small files share one, a large
file has its own), takes equality, ``IN``, prefix and null tests on the
header columns to the parser, parses a record's header first and only then
decides whether to decode its payload.  A payload nobody wants is skipped:
by a seek in plain files, by the skip length in the gzip header where the
writer left one, else by inflating and discarding bounded pieces.

Writing gives every task its own files, rolled at ``max_file_bytes``, one
gzip member per record with its skip length.  The files of committed tasks
are listed in a manifest when the job commits, and readers of a folder with
manifests read the listed files only, so files of lost or repeated task
attempts are never seen.

Files are opened through ``pyarrow.fs`` by their URI, so archives can lie in
any store it knows (local or mounted folders, HDFS, S3, GCS).
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, In,
                                    InputPartition, IsNotNull, IsNull, StringStartsWith, WriterCommitMessage)

from tidewatch.llm._util import Scratch

SCHEMA = ("record_id string, record_type string, target_uri string, date string, refers_to string, "
          "content_type string, payload_digest string, payload_length long, headers map<string,string>, "
          "payload binary")
#: Column of each header field that has one (field names are case-insensitive).
FIELDS = {"warc-record-id": "record_id", "warc-type": "record_type", "warc-target-uri": "target_uri",
          "warc-date": "date", "warc-refers-to": "refers_to", "content-type": "content_type",
          "warc-payload-digest": "payload_digest"}
_ARROW = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
                    ("date", pa.string()), ("refers_to", pa.string()), ("content_type", pa.string()),
                    ("payload_digest", pa.string()), ("payload_length", pa.int64()),
                    ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
_PIECE = 1 << 16


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _fs(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri else re.sub(r"^file:/*", "/", uri))


# --- parsing ---------------------------------------------------------------

class _Plain:
    """Bytes of an uncompressed archive."""

    def __init__(self, f):
        self.f, self.out = f, bytearray()

    def more(self, n: int) -> bool:
        got = self.f.read(n)
        self.out += got
        return bool(got)

    def skip(self, n: int) -> None:
        self.f.seek(self.f.tell() - len(self.out) + n)
        self.out.clear()


class _Gzip:
    """Bytes of an archive made of gzip members."""

    def __init__(self, f):
        self.f, self.out, self.raw, self.d = f, bytearray(), b"", None

    def more(self, n: int) -> bool:
        while True:
            if not self.raw:
                self.raw = self.f.read(_PIECE)
                if not self.raw:
                    if self.d is not None:
                        raise EOFError("truncated gzip member")
                    return False
            if self.d is None:
                self._member()
            got = self.d.decompress(self.raw, n)
            self.raw = self.d.unused_data if self.d.eof else self.d.unconsumed_tail
            self.left -= len(got)
            if self.d.eof:
                self.d = None
            if got:
                self.out += got
                return True

    def _member(self) -> None:
        while len(self.raw) < 24:
            got = self.f.read(_PIECE)
            if not got:
                break
            self.raw += got
        start = self.f.tell() - len(self.raw)
        self.d, self.left, self.end = zlib.decompressobj(31), 0, None
        h = self.raw
        if len(h) >= 24 and h[3] & 4 and h[12:16] == b"sl\x08\x00":
            packed, whole = struct.unpack("<II", h[16:24])
            self.left, self.end = whole, start + packed

    def skip(self, n: int) -> None:
        n -= len(self.out)
        if n < 0:
            del self.out[:n]
            return
        self.out.clear()
        if n and self.d is not None and self.end is not None and self.left == n:
            self.f.seek(self.end)
            self.raw, self.d = b"", None
            return
        while n > 0 and self.more(min(n, _PIECE)):
            n -= len(self.out)
            self.out.clear()


def parse(f, gzipped: bool, want, payloads: bool) -> Iterator[dict]:
    """Records of one open archive as dicts of the schema's columns.
    ``want(columns)`` sees the header columns before the block is read."""
    src = _Gzip(f) if gzipped else _Plain(f)
    while True:
        while True:                     # blank lines end the record before
            src.out = src.out.lstrip(b"\r\n")
            if src.out:
                break
            if not src.more(2048):
                return
        while (cut := src.out.find(b"\r\n\r\n")) < 0:
            if not src.more(2048):
                return                  # a torn header at the end of the file
        lines = src.out[:cut].decode("utf-8", "replace").split("\r\n")
        del src.out[:cut + 4]
        headers: dict[str, str] = {}
        for line in lines[1:]:
            key, _, value = line.partition(":")
            headers[key.strip().lower()] = value.strip()
        size = int(headers.get("content-length") or 0)
        row = dict.fromkeys(_ARROW.names)
        row |= {FIELDS[k]: v for k, v in headers.items() if k in FIELDS}
        for k in ("record_id", "refers_to"):
            if row[k]:
                row[k] = row[k].strip("<>")
        if row["payload_digest"]:
            row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
        row["headers"] = headers
        length = headers.get("x-payload-length")
        row["payload_length"] = int(length) if length else None
        if not want(row):
            src.skip(size)
            continue
        if payloads and row["record_type"] != "revisit":
            while len(src.out) < size and src.more(size - len(src.out)):
                pass
            block = bytes(src.out[:size])
            del src.out[:size]
            if (row["content_type"] or "").startswith("application/http"):
                block = block.partition(b"\r\n\r\n")[2]
            row |= {"payload": block, "payload_length": len(block), "payload_digest": base32_sha1(block)}
        else:
            src.skip(size)
        yield row


# --- reading ---------------------------------------------------------------

@dataclass
class Files(InputPartition):
    files: list


_TESTS = {
    EqualTo: lambda v, x: v is not None and v == x,
    EqualNullSafe: lambda v, x: v == x,
    In: lambda v, x: v is not None and v in x,
    StringStartsWith: lambda v, x: v is not None and v.startswith(x),
    IsNull: lambda v, x: v is None,
    IsNotNull: lambda v, x: v is not None,
}


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payloads = options.get("payload", "true").lower() == "true"
        self.most = int(options.get("partition_bytes", 32 << 20))
        self.filters: list = []

    def pushFilters(self, filters):
        known = set(FIELDS.values()) - {"payload_digest"}
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in known:
                self.filters.append((f.attribute[0], type(f), getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs
        store, root = _fs(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        sizes = {x.path: x.size for x in found if x.is_file and re.search(r"\.warc(\.gz)?$", x.path)}
        lists = [x.path for x in found if x.is_file and "/_manifest/" in x.path and x.path.endswith(".json")]
        if lists:
            named = [n for p in lists for n in json.loads(store.open_input_file(p).read())]
            sizes = {f"{root}/{n}": sizes[f"{root}/{n}"] for n in named}
        parts, room = [], 0
        for path, size in sorted(sizes.items()):
            if not parts or room + size > self.most:
                parts.append([])
                room = 0
            parts[-1].append(path)
            room += size
        return [Files(p) for p in parts] or [Files([])]

    def read(self, partition):
        store, _ = _fs(self.path)

        def want(row):
            return all(_TESTS[kind](row[c], x) for c, kind, x in self.filters)

        rows, held = [], 0
        for path in partition.files:
            with store.open_input_file(path) as f:
                for row in parse(f, path.endswith(".gz"), want, self.payloads):
                    row["headers"] = list(row["headers"].items())
                    rows.append(row)
                    held += len(row["payload"] or b"") + 500
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


# --- writing ---------------------------------------------------------------

@dataclass
class Written(WriterCommitMessage):
    files: list


def _field(value) -> str:
    """A header value on one line (control characters percent-encoded)."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(value))


def record_bytes(row: dict) -> bytes:
    """One WARC record.  A ``revisit`` carries no payload; its digest and
    length are those of the payload it stands for."""
    payload = row.get("payload") or b""
    kind = row.get("record_type") or "resource"
    digest, length = row.get("payload_sha1"), row.get("payload_length")
    if kind != "revisit" or digest is None:
        digest = hashlib.sha1(payload).digest()
    if kind != "revisit" or length is None:
        length = len(payload)
    content = row.get("content_type") or ("application/http; msgtype=response" if kind in ("response", "revisit")
                                          else "application/octet-stream")
    block = b"" if kind == "revisit" else payload
    if content.startswith("application/http"):
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + block
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{row.get('record_id') or uuid.uuid4().urn}>"),
              ("WARC-Date", row.get("date") or "1970-01-01T00:00:00Z"), ("Content-Type", content),
              ("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest).decode()), ("X-Payload-Length", length)]
    if row.get("target_uri") is not None:
        fields.append(("WARC-Target-URI", row["target_uri"]))
    if row.get("refers_to") is not None:
        fields.append(("WARC-Refers-To", f"<{row['refers_to']}>"))
    if kind == "revisit":
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    fields.append(("Content-Length", len(block)))
    head = "".join(f"{k}: {_field(v)}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    """A gzip member whose header holds its own and its content's length."""
    c = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    whole = 24 + len(body) + 8
    if max(whole, len(data)) >> 32:     # the skip length has 32 bits
        return b"\x1f\x8b\x08\x00" + b"\0" * 4 + b"\x00\xff" + body + tail
    extra = struct.pack("<H2sHII", 12, b"sl", 8, whole, len(data))
    return b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\x00\xff" + extra + body + tail


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.gzipped = options.get("compression", "gzip") == "gzip"
        self.most = int(options.get("max_file_bytes", 64 << 20))

    def write(self, batches) -> Written:
        from pyspark import TaskContext
        store, root = _fs(self.path)
        store.create_dir(root, recursive=True)
        files, f, used = [], None, 0
        try:
            for b in batches:
                for i in range(b.num_rows):
                    data = record_bytes(b.slice(i, 1).to_pylist()[0])
                    data = gzip_member(data) if self.gzipped else data
                    if f is None or used + len(data) > self.most:
                        if f is not None:
                            f.close()
                        n = TaskContext.get().partitionId()
                        files.append(f"part-{n:05d}-{uuid.uuid4().hex}.warc" + ".gz" * self.gzipped)
                        f, used = store.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                    f.write(data)
                    used += len(data)
        finally:
            if f is not None:
                f.close()
        return Written(files)

    def commit(self, messages) -> None:
        store, root = _fs(self.path)
        names = sorted(x for m in messages if m is not None for x in m.files)
        store.create_dir(f"{root}/_manifest", recursive=True)
        with store.open_output_stream(f"{root}/_manifest/{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages) -> None:
        store, root = _fs(self.path)
        for m in messages:
            for name in m.files if m is not None else []:
                store.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def register_source(spark: SparkSession) -> None:
    """Make ``format("warc")`` known and let filters reach its reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# --- pages -> archive ------------------------------------------------------

def page_records(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html",
                 min_bytes: int = 0) -> DataFrame:
    """Records for the writer, one per row of ``pages``.

    The payload is the page in UTF-8 (null: empty).  Of rows with equal
    payloads of at least ``min_bytes`` bytes the one with the largest id is
    a ``response`` and the others are a ``revisit`` of it; rows that tie for
    the largest id are all responses, and a null id is smaller than every
    other (a group of null ids only is all responses).  Other columns are
    ignored; an empty table gives no records.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(id).alias("page"), F.col(url).alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("payload_sha1", F.unhex(F.sha1("payload"))).withColumn("payload_length",
                                                                               F.octet_length("payload").cast("long"))
    keys = ["payload_sha1", "payload_length"]
    first = rows.filter(F.col("payload_length") >= min_bytes).groupBy(*keys).agg(F.max("page").alias("first"),
                                                                                F.count("*").alias("n"))
    first = scratch.save(first.filter("n > 1 AND first IS NOT NULL").select(*keys, "first"), "first")
    rows = rows.join(first, keys, "left")
    again: Column = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page").cast("string"), F.lit("null")))
    return rows.select(
        name.alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.when(again, F.concat(F.lit("urn:page:"), F.col("first").cast("string"))).alias("refers_to"),
        F.when(~again, F.col("payload")).alias("payload"), "payload_sha1", "payload_length")


def write_archive(records: DataFrame, path: str, **options) -> None:
    """Append records to the archive folder ``path``."""
    register_source(records.sparkSession)
    records.write.format("warc").mode("append").options(**options).save(path)


def read_archive(spark: SparkSession, path: str, payload: bool = True, **options) -> DataFrame:
    """Records of an archive folder; without ``payload`` none is decoded
    (their ``payload`` is null, digest and length come from the headers)."""
    register_source(spark)
    return spark.read.format("warc").options(payload=str(payload).lower(), **options).load(path)
