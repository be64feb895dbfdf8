"""Operator 3: WARC archives as a PySpark data source.

``spark.read.format("warc").load(folder)`` and ``df.write.format("warc")``.

Writing: every task writes one ``.warc.gz`` file, a gzip member per record.
Each member carries the ``sl`` extra field (its compressed and plain length),
so a reader can step over a record without inflating it.  Committing writes a
manifest of the files of successful tasks, with a cut point about every
``split_bytes``; files of failed or repeated attempts are never listed.

Reading: partitions are the manifest's cuts (without a manifest: whole files,
or one file).  Simple predicates on header columns are pushed down.  The
reader inflates a member only up to the end of its WARC header, applies the
predicates there, and then steps over unwanted records; payloads are inflated
only if the ``payload`` option asks for them (``text``, ``check``: length and
digest are recomputed from the payload, ``skip``).

Revisit records (RFC-style identical-payload-digest) carry no payload; their
length and digest are those of the full payload, kept in the header.

Paths are opened through ``pyarrow.fs``, so local, HDFS and object-store
folders work alike.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)

SCHEMA = ("page_id long, url string, record_type string, refers_to long,"
          " payload_bytes long, payload_digest string, payload string")
MANIFEST = "_manifest.json"
SPLIT_BYTES = 32 << 20
#: Least payload that is worth a revisit record.
REVISIT_BYTES = 100
END = b"\r\n\r\n"


# Records -----------------------------------------------------------------------
def record(page_id: int | None, url: str | None, record_type: str, refers_to: int | None,
           size: int, digest: str, payload: bytes) -> bytes:
    """One WARC/1.1 record; a revisit's block is the HTTP header alone."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            + b"Content-Length: %d\r\n\r\n" % size)
    block = http + (payload if record_type == "response" else b"")
    fields = [("WARC-Type", record_type),
              ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"),
              ("WARC-Date", "2000-01-01T00:00:00Z"),
              ("Content-Type", "application/http;msgtype=response"),
              ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(size))]
    if url is not None:
        # Control characters would end a header line.
        fields.append(("WARC-Target-URI", "".join(
            quote(c) if c < " " or c == "\x7f" else c for c in url)))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        fields.append(("X-Refers-To-Page-Id", str(refers_to)))
        fields.append(("WARC-Refers-To",
                       f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>"))
        fields.append(("WARC-Profile",
                       "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + END


def member(plain: bytes, level: int = 6) -> bytes:
    """A gzip member with its lengths in the ``sl`` extra field."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(plain) + squeeze.flush()
    size = 10 + 2 + 12 + len(body) + 8
    known = (size, len(plain)) if max(size, len(plain)) < 1 << 32 else (0, 0)
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, *known)
            + body + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF))


@dataclass
class Record:
    """A record whose header has been read; the block is inflated on demand."""

    header: dict[str, str]
    row: dict
    inflate: object
    begun: bytes
    rest: object

    def block(self) -> bytes:
        size = int(self.header["content-length"])
        out = bytearray(self.begun)
        while len(out) < size + len(END):
            more = self.inflate.decompress(self.inflate.unconsumed_tail or self.rest())
            if not more and self.inflate.eof:
                break
            out += more
        return bytes(out[:size])

    def payload(self) -> bytes:
        return self.block().partition(END)[2]


def records(source, start: int, end: int | None) -> Iterator[Record]:
    """The records of members that begin in [start, end)."""
    at = start
    while end is None or at < end:
        source.seek(at)
        first = source.read(4096)
        if len(first) < 18:
            return
        if first[:4] != b"\x1f\x8b\x08\x04" or first[12:14] != b"sl":
            raise ValueError(f"no gzip member with a length field at byte {at}")
        extra, = struct.unpack_from("<H", first, 10)
        size, _ = struct.unpack_from("<II", first, 16)
        inflate = zlib.decompressobj(-15)
        plain = inflate.decompress(first[12 + extra:], 8192)
        position = [at + len(first)]

        def rest(position=position) -> bytes:
            source.seek(position[0])
            chunk = source.read(1 << 18)
            position[0] += len(chunk)
            return chunk

        while END not in plain:
            plain += inflate.decompress(inflate.unconsumed_tail or rest(), 8192)
        head, _, begun = plain.partition(END)
        lines = head.decode().split("\r\n")[1:]
        header = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
        number = lambda key: int(header[key]) if key in header else None
        row = {"page_id": number("x-page-id"), "url": header.get("warc-target-uri"),
               "record_type": header["warc-type"], "refers_to": number("x-refers-to-page-id"),
               "payload_bytes": number("x-payload-length"),
               "payload_digest": header["warc-payload-digest"].partition(":")[2]}
        found = Record(header, row, inflate, begun, rest)
        yield found
        if not size:  # longer than the length field can say: find the end by inflating
            while not inflate.eof:
                inflate.decompress(inflate.unconsumed_tail or rest(), 1 << 20)
            size = position[0] - at - len(inflate.unused_data) + 8
        at += size


# Pushed predicates ---------------------------------------------------------------
_COMPARE = {
    EqualTo: lambda a, b: a is not None and a == b,
    EqualNullSafe: lambda a, b: a == b,
    GreaterThan: lambda a, b: a is not None and a > b,
    GreaterThanOrEqual: lambda a, b: a is not None and a >= b,
    LessThan: lambda a, b: a is not None and a < b,
    LessThanOrEqual: lambda a, b: a is not None and a <= b,
    In: lambda a, b: a is not None and a in b,
    StringStartsWith: lambda a, b: a is not None and a.startswith(b),
    IsNull: lambda a, b: a is None,
    IsNotNull: lambda a, b: a is not None,
}
_HEADER_COLUMNS = {"page_id", "url", "record_type", "refers_to", "payload_bytes",
                   "payload_digest"}


@dataclass
class Cut(InputPartition):
    path: str
    start: int
    end: int | None

    def __init__(self, path: str, start: int, end: int | None):
        super().__init__((path, start, end))
        self.path, self.start, self.end = path, start, end


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: str):
        self.path, self.payload, self.tests = path, payload, []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if type(f) in _COMPARE and name in _HEADER_COLUMNS:
                self.tests.append((name, type(f), getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        store, folder = pafs.FileSystem.from_uri(self.path)
        if store.get_file_info(folder).type == pafs.FileType.File:
            return [Cut(self.path, 0, None)]
        if store.get_file_info(f"{folder}/{MANIFEST}").type == pafs.FileType.File:
            with store.open_input_stream(f"{folder}/{MANIFEST}") as f:
                listed = json.loads(f.read())
            return [Cut(f"{self.path.rstrip('/')}/{x['file']}", a, b) for x in listed
                    for a, b in zip(x["cuts"], x["cuts"][1:])] or [Cut("", 0, 0)]
        files = store.get_file_info(pafs.FileSelector(folder))
        return [Cut(f"{self.path.rstrip('/')}/{x.base_name}", 0, None) for x in files
                if x.base_name.endswith(".warc.gz")] or [Cut("", 0, 0)]

    def read(self, cut: Cut):
        if not cut.path:
            return
        tests = [(name, _COMPARE[kind], value) for name, kind, value in self.tests]
        fields = [f.split() for f in SCHEMA.split(", ")]
        types = {"long": pa.int64(), "string": pa.string()}
        schema = pa.schema([(name, types[kind]) for name, kind in fields])
        store, path = pafs.FileSystem.from_uri(cut.path)
        rows, held = [], 0
        with store.open_input_file(path) as source:
            for r in records(source, cut.start, cut.end):
                if not all(test(r.row[name], value) for name, test, value in tests):
                    continue
                row = r.row | {"payload": None}
                if self.payload != "skip" and row["record_type"] == "response":
                    payload = r.payload()
                    digest = hashlib.sha256(payload).hexdigest()
                    if digest != row["payload_digest"]:
                        raise ValueError(f"payload of page {row['page_id']} is damaged")
                    row |= {"payload_bytes": len(payload), "payload_digest": digest}
                    if self.payload == "text":
                        row["payload"] = payload.decode()
                        held += len(payload)
                rows.append(row)
                if len(rows) == 4096 or held > 16 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


# Writing -------------------------------------------------------------------------
@dataclass
class Written(WriterCommitMessage):
    file: str | None
    cuts: list[int]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, split_bytes: int):
        self.path, self.split_bytes = path, split_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = pafs.FileSystem.from_uri(self.path)
        name, out, at, cuts = f"part-{uuid.uuid4().hex}.warc.gz", None, 0, [0]
        for batch in iterator:
            if out is None:
                store.create_dir(folder, recursive=True)
                out = store.open_output_stream(f"{folder}/{name}", compression=None)
            for row in batch.to_pylist():
                payload = (row["payload"] or "").encode()
                data = member(record(row["page_id"], row["url"], row["record_type"],
                                     row["refers_to"], row["payload_bytes"],
                                     row["payload_digest"], payload))
                if at + len(data) - cuts[-1] > self.split_bytes and at > cuts[-1]:
                    cuts.append(at)
                out.write(data)
                at += len(data)
        if out is None:
            return Written(None, [])
        out.close()
        return Written(name, [*cuts, at] if at else [])

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = pafs.FileSystem.from_uri(self.path)
        store.create_dir(folder, recursive=True)
        listed = [{"file": m.file, "cuts": m.cuts} for m in messages if m and m.file]
        with store.open_output_stream(f"{folder}/{MANIFEST}", compression=None) as f:
            f.write(json.dumps(listed).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = pafs.FileSystem.from_uri(self.path)
        for m in messages:
            if m and m.file:
                store.delete_file(f"{folder}/{m.file}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "text"))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("split_bytes", SPLIT_BYTES)))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# Pages ---------------------------------------------------------------------------
def page_records(pages: DataFrame) -> DataFrame:
    """Pages as WARC rows: of equal payloads of at least 100 bytes the one with
    the smallest page_id is the response and the others revisit it.

    Defined results: null html is an empty payload; smaller payloads are all
    responses; rows that repeat the winning page_id are responses too; a null
    page_id is a response only if its whole group has null ids.
    """
    text = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", text.alias("payload")).withColumns({
        "payload_bytes": F.octet_length("payload").cast("long"),
        "payload_digest": F.sha2(F.col("payload").cast("binary"), 256)})
    firsts = (pages.select(F.octet_length(text).alias("_n"), "page_id",
                           F.sha2(text.cast("binary"), 256).alias("_d"))
              .filter(F.col("_n") >= REVISIT_BYTES).groupBy("_d")
              .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
              .filter("_rows > 1").drop("_rows"))
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return (rows.join(firsts, F.col("payload_digest") == F.col("_d"), "left")
            .withColumn("refers_to", F.when(again, F.col("_first")))
            .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
            .withColumn("payload", F.when(~again, F.col("payload")))
            .select(*[f.split()[0] for f in SCHEMA.split(", ")]))


def write_pages(pages: DataFrame, path: str, split_bytes: int = SPLIT_BYTES) -> None:
    register(pages.sparkSession)
    (page_records(pages).write.format("warc").option("split_bytes", str(split_bytes))
     .mode("append").save(path))


def read_warc(spark: SparkSession, path: str, payload: str = "text") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", payload).load(path)


ORACLE = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest AS d, min(page_id) AS first FROM p
      WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f ON d = payload_digest AND payload_bytes >= 100
"""
