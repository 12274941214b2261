"""Operator 6: token ids in fixed-width bit-packed files.

Each id takes the fewest bits that hold the vocabulary.  One file per range of
doc_id, in ascending order:

* header (16 bytes): ``CBP1``, bits u32, ids per block u32, 0 u32
* blocks: ``ids per block`` ids each, packed least significant bit first
* index: doc_id i64[docs], null flag u8[docs], end id position u64[docs]
* block offsets u64[blocks + 1] (bytes from the file's start)
* trailer (40 bytes): docs u64, ids u64, blocks u64, index offset u64, ``CBP1`` + 0 u32

Any id or document is reached by seeking to its block and unpacking that block
alone with numpy.  A ``manifest`` table names the files in order with each
file's first id position in the whole corpus.

Results for odd input: a null or empty text has the end id alone; null doc_ids
come first; repeated rows are kept, each with ids of its own (equal doc_ids in
order of their text); an empty table gives no file and no row; further columns
are ignored.
"""
from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import fs_of, shared_path

MAGIC, HEADER, TRAILER = b"CBP1", struct.Struct("<4sIII"), struct.Struct("<QQQQ4sI")


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold the ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids to bytes, ``bits`` each, least significant bit first."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    rows = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(rows[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of packed bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=count).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, dtype=np.uint8), bitorder="little")[: count * bits].reshape(count, bits)
    full = np.zeros((count, 32), dtype=np.uint8)
    full[:, :bits] = flat
    return np.packbits(full, axis=1, bitorder="little").view("<u4").ravel()


class Writer:
    """Streams documents into one file; holds one block and the index."""

    def __init__(self, out, bits: int, block_ids: int):
        if block_ids % 8:
            raise ValueError("block_ids must be a multiple of 8")
        self.out, self.bits, self.block = out, bits, block_ids
        self.left: list[np.ndarray] = []
        self.held = self.total = 0
        self.docs, self.null, self.ends, self.offsets = [], [], [], [HEADER.size]
        out.write(HEADER.pack(MAGIC, bits, block_ids, 0))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError("an id is larger than the vocabulary")
        self.docs.append(doc_id or 0)
        self.null.append(doc_id is None)
        self.total += len(ids)
        self.ends.append(self.total)
        self.left.append(ids)
        self.held += len(ids)
        if self.held >= 64 * self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.left) if self.left else np.zeros(0, np.uint32)
        whole = len(ids) if last else len(ids) - len(ids) % self.block
        for at in range(0, whole, self.block):
            data = pack(ids[at:min(at + self.block, whole)], self.bits)
            self.out.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.left, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        for values, kind in ((self.docs, "<i8"), (self.null, "u1"), (self.ends, "<u8"), (self.offsets, "<u8")):
            self.out.write(np.array(values, dtype=kind).tobytes())
        self.out.write(TRAILER.pack(len(self.docs), self.total, len(self.offsets) - 1, self.offsets[-1], MAGIC, 0))


class Reader:
    """Random access to one file (a seekable binary file object)."""

    def __init__(self, f, size: int):
        self.f = f
        f.seek(size - TRAILER.size)
        n, self.total, blocks, at, magic, _ = TRAILER.unpack(f.read(TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a bit-packed id file")
        f.seek(0)
        _, self.bits, self.block, _ = HEADER.unpack(f.read(HEADER.size))
        f.seek(at)
        take = lambda kind, k: np.frombuffer(f.read(k * np.dtype(kind).itemsize), dtype=kind)
        self.docs, self.null, self.ends, self.offsets = take("<i8", n), take("u1", n), take("<u8", n), take("<u8", blocks + 1)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids at positions [start, end) of the file; reads their blocks alone."""
        if end <= start:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, (end - 1) // self.block + 1
        self.f.seek(int(self.offsets[a]))
        data = self.f.read(int(self.offsets[b] - self.offsets[a]))
        count = min(b * self.block, self.total) - a * self.block
        return unpack(data, count, self.bits)[start - a * self.block:end - a * self.block]

    def spans(self, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
        """(index of the document, a run of its ids) in order, ``most`` ids at a time."""
        at, doc = 0, 0
        ends = self.ends.astype(np.int64)
        while at < self.total:
            stop = min(at + most, int(self.total))
            ids, done = self.ids(at, stop), at
            while done < stop:
                till = min(int(ends[doc]), stop)
                yield doc, ids[done - at:till - at]
                done = till
                if done == ends[doc]:
                    doc += 1
            at = stop


def write_ids(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 2,
              block_ids: int = 4096) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write the files and their manifest under ``path``.

    Returns the manifest: file, docs, ids, start.  A file appears under its name
    only when whole (written aside, then renamed), so a task may run again.
    """
    vocab = vocabulary or tokens.default_vocabulary()
    bits = bits_for(max(tokens.vocabulary_size(vocab), end_id + 1))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, ctx, end = tokens.encoder(vocab), TaskContext.get(), np.array([end_id], dtype="<u4").tobytes()
        fs, root = fs_of(path)
        writer = None
        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    name = f"ids-{ctx.partitionId():06d}.cbp"
                    aside = f"{root}/_{name}-{ctx.taskAttemptId()}"
                    out = fs.open_output_stream(aside)
                    writer = Writer(out, bits, block_ids)
                writer.add(i, np.frombuffer(enc.encode(text.as_py()) + end, dtype="<u4"))
        if writer is not None:
            writer.close()
            out.close()
            fs.move(aside, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"part": [ctx.partitionId()], "file": [name], "docs": [len(writer.docs)], "ids": [writer.total]})

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranged = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    # one row per file reaches the driver
    files = sorted(ranged.mapInArrow(write, "part long, file string, docs long, ids long").collect())
    start, manifest = 0, []
    for _, file, n, ids in files:
        manifest.append((f"{path}/{file}", n, ids, start))
        start += ids
    out = spark.createDataFrame(manifest, "file string, docs long, ids long, start long")
    out.coalesce(1).write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """Documents from the files: doc_id, start, n_tokens and crc32 of the ids (as
    little-endian unsigned 32-bit integers)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, file = fs_of(row["file"])
                with fs.open_input_file(file) as f:
                    r = Reader(f, f.size())
                    crc = np.zeros(len(r.docs), dtype=np.int64)
                    for doc, ids in r.spans():
                        crc[doc] = zlib.crc32(ids.astype("<u4").tobytes(), int(crc[doc]))
                    ends = r.ends.astype(np.int64)
                    lengths = np.diff(ends, prepend=0)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(r.docs, mask=r.null.astype(bool)), "start": ends - lengths + row["start"],
                        "n_tokens": lengths, "ids_crc32": crc})

    n = max(1, manifest.count())
    return manifest.repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(path: str, file: str, start: int, end: int) -> np.ndarray:
    """Ids at positions [start, end) of one file, anywhere in Python."""
    fs, root = fs_of(path)
    with fs.open_input_file(f"{root}/{file}") as f:
        return Reader(f, f.size()).ids(start, end)


def op6_bitpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, written bit-packed in doc_id order and read back."""
    from .common import documents

    return read_documents(write_ids(documents(spark, sf_dir), shared_path(spark, "bitpack")))
