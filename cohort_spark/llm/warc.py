"""Operator 10: WARC files as a PySpark Python data source, and their writer.

Reading: ``spark.read.format("warc").load(folder)`` plans one partition per run of
files of about ``split_bytes`` (never one per record), takes equality and IN
predicates on ``record_type`` and equality on the other header columns from
Spark (``spark.sql.python.filterPushdown.enabled``) or as options, parses each
record's headers first and passes over the body of a record that a predicate rules
out: a body is skipped by its Content-Length, and a gzip member that gives its
length in its header (subfield ``sl``, as the writer below sets it) is jumped over once
its first bytes show the headers.  Foreign files without that field are inflated through.

Writing: one gzip member per record.  The first record of a payload of at least
``min_revisit`` bytes in order of falling page_id is a response; others are revisits that
name it and carry the full payload's length and digest.

Results for odd input: null html is the empty payload; a null url is written as an
empty WARC-Target-URI; a null page_id sorts below all others and comes back null;
rows repeating a page_id are records of their own; an empty table gives no file
and no row; further columns are ignored.
"""
from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from .common import fs_of, shared_path, table

SCHEMA = ("record_id string, record_type string, target_uri string, date string, content_type string, "
          "payload_digest string, refers_to string, payload_bytes long, payload binary")
#: Column -> WARC header (fixed names of the format; the last is an extension field).
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
           "payload_bytes": "X-Payload-Length"}
DATE = "1970-01-01T00:00:00Z"  # pages carry no time


# ------------------------------------------------------------------ records
def member(data: bytes, level: int = 1) -> bytes:
    """One gzip member whose header tells its own length and that of its data (subfield ``sl``)."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    size = 10 + 2 + 4 + 8 + len(body) + 8
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
            + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def record(headers: dict[str, str], body: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + f"Content-Length: {len(body)}\r\n\r\n"
    return head.encode("utf-8") + body + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


class Stream:
    """Records of one file, gzip members or plain: headers, then the body if it is wanted."""

    CHUNK = 1 << 16

    def __init__(self, f: BinaryIO, size: int):
        self.f, self.size, self.at = f, size, 0
        self.skipped = 0  # bodies never decoded
        f.seek(0)
        self.gzip = f.read(2) == b"\x1f\x8b"

    def records(self, wanted) -> Iterator[tuple[dict[str, str], bytes]]:
        yield from self._members(wanted) if self.gzip else self._plain(wanted)

    def _plain(self, wanted) -> Iterator[tuple[dict[str, str], bytes]]:
        while self.at < self.size:
            self.f.seek(self.at)
            head = b""
            while b"\r\n\r\n" not in head and (more := self.f.read(4096)):
                head += more
            end = head.find(b"\r\n\r\n")
            if end < 0:
                return
            headers = parse_head(head[:end].lstrip(b"\r\n"))
            start, length = self.at + end + 4, int(headers.get("content-length", 0))
            if wanted(headers):
                self.f.seek(start)
                yield headers, self.f.read(length)
            else:
                self.skipped += 1
            self.at = start + length + 4

    def _members(self, wanted) -> Iterator[tuple[dict[str, str], bytes]]:
        while self.at < self.size:
            self.f.seek(self.at)
            raw = self.f.read(self.CHUNK)
            known = raw[3] & 4 and raw[12:14] == b"sl" and struct.unpack("<I", raw[16:20])[0]
            inflate, data = zlib.decompressobj(31), b""
            used = 0
            while b"\r\n\r\n" not in data and not inflate.eof and raw:
                data += inflate.decompress(raw)
                used += len(raw)
                raw = self.f.read(self.CHUNK) if b"\r\n\r\n" not in data and not inflate.eof else b""
            end = data.find(b"\r\n\r\n")
            headers = parse_head(data[:max(end, 0)])
            take = end >= 0 and wanted(headers)
            if not take:
                self.skipped += 1
            if not take and known:
                self.at += known
                continue
            parts = [data[end + 4:]]
            while not inflate.eof and (raw := self.f.read(self.CHUNK)):
                used += len(raw)
                part = inflate.decompress(raw)
                if take:
                    parts.append(part)
            self.at += used - len(inflate.unused_data)
            if take:
                yield headers, b"".join(parts)[:int(headers.get("content-length", 0))]


# ------------------------------------------------------------------ the data source
class Files(InputPartition):
    def __init__(self, files: list[str]):
        super().__init__(files)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.split = options["path"], int(options.get("split_bytes", 64 << 20))
        self.payload = options.get("payload", "true").lower() == "true"
        types = options.get("record_types", "")
        self.tests: list[tuple[str, frozenset]] = [("record_type", frozenset(types.split(",")))] if types else []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and name != "payload_bytes" and isinstance(f, (EqualTo, In)):
                values = f.value if isinstance(f, In) else [f.value]
                self.tests.append((name, frozenset(v for v in values if v is not None)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow.fs import FileSelector, FileType

        fs, root = fs_of(self.path)
        found = sorted((x.path, x.size) for x in fs.get_file_info(FileSelector(root, recursive=True, allow_not_found=True))
                       if x.type == FileType.File and x.path.endswith((".warc", ".warc.gz")) and not x.base_name.startswith("_"))
        out, held = [[]], 0
        for path, size in found:
            if out[-1] and held + size > self.split:
                out.append([])
                held = 0
            out[-1].append(path)
            held += size
        return [Files(x) for x in out if x]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a folder without files
            return
        fs, _ = fs_of(self.path)
        names = {c: h.lower() for c, h in HEADERS.items()}
        schema = pa.schema([(c, pa.int64() if c == "payload_bytes" else pa.string()) for c in HEADERS] + [("payload", pa.binary())])

        def wanted(headers: dict[str, str]) -> bool:
            return all(headers.get(names[c]) in values for c, values in self.tests)

        rows, held = [], 0
        for path in partition.value:
            with fs.open_input_file(path) as f:
                for headers, body in Stream(f, f.size()).records(wanted):
                    row = {c: headers.get(h) for c, h in names.items()}
                    row["payload_bytes"] = int(row["payload_bytes"]) if row["payload_bytes"] else len(body)
                    row["payload"] = body if self.payload else None
                    rows.append(row)
                    held += len(body) + 512
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


class WarcSource(DataSource):
    """Format ``warc``; options: path, record_types (comma-separated), payload, split_bytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)


# ------------------------------------------------------------------ writing pages
def page_urn(page_id) -> str:
    return "" if page_id is None else f"<urn:page:{page_id}>"


def with_decisions(pages: DataFrame, min_revisit: int) -> DataFrame:
    """page_id, url, body, digest, refers_to (null for a response) of every row.

    The response of a digest is its largest page_id; rows repeating that id are responses
    too.  Payloads meet their decision on (digest, page_id), so a payload that a third
    of all pages share is spread evenly; the digest alone keys light rows only."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("body"))
    rows = rows.withColumn("digest", F.sha1("body"))
    keys = rows.where(F.octet_length("body") >= min_revisit).select("digest", "page_id")
    first = keys.groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("pages")).where("pages > 1")
    later = (keys.distinct().join(first.select("digest", "first"), "digest")
             .where(~F.col("page_id").eqNullSafe(F.col("first")))
             .select(F.col("digest").alias("d"), F.col("page_id").alias("p"), F.col("first").alias("refers_to")))
    same = (F.col("digest") == F.col("d")) & F.col("page_id").eqNullSafe(F.col("p"))
    return rows.join(later, same, "left").drop("d", "p")


def write_warc(pages: DataFrame, path: str, min_revisit: int = 1000) -> int:
    """Write one record per row of ``pages`` (page_id, url, html) below ``path``; returns
    the number of files.  A file gets its name only when whole."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx, out, n = TaskContext.get(), None, 0
        fs, root = fs_of(path)
        for batch in batches:
            for page, url, body, digest, refers in zip(*(batch.column(c) for c in ("page_id", "url", "body", "digest", "refers_to"))):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name = f"pages-{ctx.partitionId():06d}.warc.gz"
                    aside = f"{root}/_{name}-{ctx.taskAttemptId()}"
                    out = fs.open_output_stream(aside, compression=None)
                body, refers = body.as_py(), refers.as_py()
                head = {"WARC-Type": "response" if refers is None else "revisit", "WARC-Record-ID": page_urn(page.as_py()),
                        "WARC-Target-URI": (url.as_py() or "").replace("\r", "%0D").replace("\n", "%0A"), "WARC-Date": DATE,
                        "Content-Type": "text/html; charset=utf-8", "WARC-Payload-Digest": "sha1:" + digest.as_py()}
                if refers is not None:
                    head |= {"WARC-Refers-To": page_urn(refers), "X-Payload-Length": str(len(body))}
                    body = b""
                out.write(member(record(head, body)))
                n += 1
        if out is not None:
            out.close()
            fs.move(aside, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [n]})

    rows = with_decisions(pages, min_revisit).select("page_id", "url", "body", "digest", "refers_to")
    return rows.mapInArrow(write, "file string, records long").count()


def read_warc(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The records below ``path``; where() on header columns reaches the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").options(**options).load(path)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back: responses with their payloads
    digested anew, revisits by their headers alone."""
    path = shared_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    split = str(8 << 20)
    page = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1)
    as_id = lambda c: F.when(page(c) != "", page(c)).cast("long")
    full = read_warc(spark, path, split_bytes=split).where(F.col("record_type") == "response").select(
        as_id(F.col("record_id")).alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    again = read_warc(spark, path, split_bytes=split, payload="false").where(F.col("record_type") == "revisit").select(
        as_id(F.col("record_id")).alias("page_id"), "payload_bytes", F.substring("payload_digest", 6, 40).alias("payload_digest"),
        "record_type", as_id(F.col("refers_to")).alias("refers_to"))
    return full.unionByName(again)


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d,
    octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT d, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
    CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)
"""
