"""Operator 4: sequence packing by cutting-stock column generation.

Every document is its ids and an end id.  Whole runs of ``capacity`` ids fill a
sequence each; what is left of a document (1 .. capacity-1 ids) is an item.

1. The items' length histogram (at most capacity-1 counts) reaches the driver.
2. A linear program over patterns (how many items of which length share a
   sequence) is solved by column generation: an unbounded-knapsack dynamic
   programme over the lengths prices the next pattern; Farley's bound ends it
   when the gap is below ``gap``.
3. The solution is rounded down, then single copies are added while items last.
   Patterns under 99.5 % full are not used.
4. Items are ranked within their length; a rank range of a length belongs to a
   pattern's copies, so rank arithmetic against a small table (bounded by the
   histogram) places each item.  Items left over by rounding or by emptier
   patterns (their number hangs on the lengths) are laid end to end and cut at sequence ends.

Ranks come from counts per (length, bucket) plus a window within the bucket, so
a length that a third of all documents share is spread over all tasks.

Results for odd input: null or empty text is the end id alone; repeated rows and
rows with equal or null doc_id are packed each on its own; an empty table gives
no pieces; further columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import documents, shuffle_width, slices, stage, tidy


# ------------------------------------------------------------------ the driver's linear program
def knapsack(values: np.ndarray, capacity: int) -> tuple[float, dict[int, int]]:
    """The multiset of lengths (1 .. capacity) with total at most ``capacity`` and the
    largest value; values[w] is the value of length w, -inf where absent."""
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for c in range(1, capacity + 1):
        gains = best[c - 1::-1] + values[1:c + 1]
        w = int(gains.argmax())
        if gains[w] > best[c - 1] + 1e-12:
            best[c], took[c] = gains[w], w + 1
        else:
            best[c] = best[c - 1]
    pattern: dict[int, int] = {}
    c = capacity
    while c > 0:
        if w := int(took[c]):
            pattern[w] = pattern.get(w, 0) + 1
            c -= w
        else:
            c -= 1
    return float(best[capacity]), pattern


def greedy_basis(histogram: dict[int, int], capacity: int) -> tuple[list[dict[int, int]], list[float]]:
    """A first basis: one pattern per length, longest length first, filled up with the
    longest that fit, each used until one of its lengths runs out."""
    left = {w: float(n) for w, n in sorted(histogram.items(), reverse=True) if n > 0}
    patterns, copies = [], []
    while left:
        pattern, room = {}, capacity
        for w in left:
            if w <= room:
                pattern[w] = min(room // w, max(1, int(left[w])))
                room -= pattern[w] * w
        last = min(pattern, key=lambda w: left[w] / pattern[w])
        n = left[last] / pattern[last]
        for w, k in pattern.items():
            left[w] = max(0.0, left[w] - n * k)
        del left[last]
        patterns.append(pattern)
        copies.append(n)
    return patterns, copies


def column_generation(histogram: dict[int, int], capacity: int, gap: float = 0.002,
                      most: int = 1500) -> list[tuple[dict[int, int], float]]:
    """Patterns and their (fractional) copies that cover the histogram with close to
    the fewest sequences: a revised simplex over priced columns."""
    patterns, copies = greedy_basis(histogram, capacity)
    if not patterns:
        return []
    lengths = sorted(w for w, n in histogram.items() if n > 0)
    at = {w: i for i, w in enumerate(lengths)}

    def column(pattern: dict[int, int]) -> np.ndarray:
        out = np.zeros(len(lengths))
        for w, k in pattern.items():
            out[at[w]] = k
        return out

    inverse, x = np.linalg.inv(np.array([column(p) for p in patterns]).T), np.array(copies)
    prices = np.full(capacity + 1, -np.inf)
    for _ in range(most):
        prices[lengths] = inverse.sum(axis=0)
        value, pattern = knapsack(prices, capacity)
        if value <= 1 + gap:  # Farley: no solution is below the present one / value
            break
        way = inverse @ column(pattern)
        ratio = np.where(way > 1e-9, x / np.where(way > 1e-9, way, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        x -= step * way
        x[out] = step
        np.maximum(x, 0, out=x)
        row = inverse[out] / way[out]
        inverse -= np.outer(way, row)
        inverse[out] = row
        patterns[out] = pattern
    return list(zip(patterns, x.tolist()))


def rounded(solution: list[tuple[dict[int, int], float]], histogram: dict[int, int],
            fullest: int) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """Whole copies of the patterns that hold at least ``fullest`` ids, and the items left:
    those of emptier patterns too, as cutting them wastes nothing."""
    solution = [x for x in solution if sum(w * k for w, k in x[0].items()) >= fullest]
    left, copies = dict(histogram), [0] * len(solution)

    def use(p: int, wanted: int) -> None:
        pattern = solution[p][0]
        n = min([wanted, *(left[w] // k for w, k in pattern.items())])
        copies[p] += n
        for w, k in pattern.items():
            left[w] -= n * k

    for p, (_, x) in enumerate(solution):
        use(p, int(x + 1e-6))
    for p in sorted(range(len(solution)), key=lambda p: -(solution[p][1] % 1)):
        use(p, 1)
    return [(solution[p][0], n) for p, n in enumerate(copies) if n], {w: n for w, n in left.items() if n}


def slot_rows(plan: list[tuple[dict[int, int], int]], left: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Rank ranges: (length, first rank, end rank, per copy, first sequence, offset, cut).

    Ranks from ``first`` on take ``per copy`` places in each copy of a pattern, from
    ``offset`` on; with ``cut`` they lie end to end from id ``offset`` of the stream that
    begins at ``first sequence``.  Also the number of sequences.
    """
    rows, used, sequence = [], {}, 0
    for pattern, n in plan:
        offset = 0
        for w, k in sorted(pattern.items(), reverse=True):
            first = used.get(w, 0)
            rows.append((w, first, first + n * k, k, sequence, offset, False))
            used[w] = first + n * k
            offset += w * k
        sequence += n
    stream = 0
    for w, n in sorted(left.items(), reverse=True):
        first = used.get(w, 0)
        rows.append((w, first, first + n, 1, sequence, stream, True))
        stream += w * n
    return rows, sequence + -(-stream // capacity)


# ------------------------------------------------------------------ Spark
def encoded(docs: DataFrame, vocabulary: str | None, end_id: int, table: int = tokens.MAX_CACHED) -> DataFrame:
    """uid, doc_id, n and ids (unsigned 16-bit if the vocabulary allows, else 32) of each row,
    written in the shared folder."""
    vocab = vocabulary or tokens.default_vocabulary()
    kind = vocabulary_kind(vocab, end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, uid, end = tokens.encoder(vocab, table), TaskContext.get().partitionId() << 40, np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, 200):
            raw = [enc.encode(t) + end for t in batch.column("text").to_pylist()]
            n = np.array([len(x) // 4 for x in raw], dtype=np.int64)
            ids = np.frombuffer(b"".join(raw), "<u4").astype(kind)  # one buffer a slice
            ends = (np.concatenate([[0], np.cumsum(n)]) * ids.itemsize).astype(np.int32)
            column = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(uid, uid + len(n))), batch.column("doc_id"), pa.array(n), column],
                                             ["uid", "doc_id", "n", "ids"])
            uid += len(n)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(rows.mapInArrow(tidy(encode, "chunks"), "uid long, doc_id long, n long, ids binary"), "pack-ids")


def placed(lengths: DataFrame, capacity: int, gap: float = 0.002) -> DataFrame:
    """uid and its pieces (start, length, sequence_id, offset) for rows (uid, n)."""
    spark = lengths.sparkSession
    rows = lengths.select(
        "uid", F.expr(f"n div {capacity}").alias("whole"), (F.col("n") % capacity).cast("int").alias("w"),
        F.pmod(F.xxhash64("uid"), F.lit(shuffle_width(spark))).cast("int").alias("bucket"))
    sums = rows.groupBy("w", "bucket").agg(F.count(F.lit(1)).alias("items"), F.sum("whole").alias("wholes"))
    sums = stage(sums, "pack-histogram")  # at most capacity x buckets rows
    histogram = {r["w"]: r["items"] for r in sums.where("w > 0").groupBy("w").agg(F.sum("items").alias("items")).collect()}
    plan, left = rounded(column_generation(histogram, capacity, gap), histogram, int(capacity * 0.995))
    table, sequences = slot_rows(plan, left, capacity)
    slots = spark.createDataFrame(table, "w int, a long, b long, k long, seq long, off long, cut boolean")
    slots = slots.groupBy("w").agg(F.collect_list(F.struct("a", "b", "k", "seq", "off", "cut")).alias("slots"))

    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    whole_at = sums.groupBy("bucket").agg(F.sum("wholes").alias("wholes")).select(
        "bucket", F.coalesce(F.sum("wholes").over(before), F.lit(0)).alias("whole_at"))
    in_w = Window.partitionBy("w").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    rank_at = sums.select("w", "bucket", F.coalesce(F.sum("items").over(in_w), F.lit(0)).alias("rank_at"))

    order = Window.partitionBy("bucket").orderBy("uid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = rows.withColumns({
        "whole_before": F.sum("whole").over(order) - F.col("whole"),
        "rank_in": F.row_number().over(Window.partitionBy("bucket", "w").orderBy("uid")) - 1})
    ranked = (ranked.join(rank_at, ["w", "bucket"], "left").join(whole_at, "bucket", "left")
              .join(F.broadcast(slots), "w", "left")  # bounded by the histogram's capacity rows
              .withColumn("rank", F.col("rank_in") + F.col("rank_at"))
              .withColumn("s", F.expr("filter(slots, s -> s.a <= rank and rank < s.b)[0]")))
    at = F.expr("s.off + (rank - s.a) * w")  # in the stream of cut items
    head = F.least(F.col("w").cast("long"), F.lit(capacity) - at % capacity)
    piece = lambda start, length, seq, off: F.struct(
        start.cast("long").alias("start"), length.cast("long").alias("length"),
        seq.cast("long").alias("sequence_id"), off.cast("long").alias("offset"))
    start = F.col("whole") * capacity
    item = F.when(F.col("w") == 0, F.array().cast("array<struct<start:long,length:long,sequence_id:long,offset:long>>")) \
        .when(~F.col("s.cut"), F.array(piece(
            start, F.col("w"), F.expr("s.seq + (rank - s.a) div s.k"), F.expr("s.off + ((rank - s.a) % s.k) * w")))) \
        .when(head == F.col("w"), F.array(piece(start, head, F.expr("s.seq") + F.floor(at / capacity), at % capacity))) \
        .otherwise(F.array(
            piece(start, head, F.expr("s.seq") + F.floor(at / capacity), at % capacity),
            piece(start + head, F.col("w") - head, F.expr("s.seq") + F.floor(at / capacity) + 1, F.lit(0))))
    wholes = F.expr(f"""transform(if(whole > 0, sequence(0L, whole - 1), array()), i -> named_struct(
        'start', i * {capacity}L, 'length', {capacity}L, 'sequence_id', {sequences}L + whole_at + whole_before + i, 'offset', 0L))""")
    return ranked.select("uid", F.concat(wholes, item).alias("pieces"))


def pack(docs: DataFrame, capacity: int = 1024, vocabulary: str | None = None, end_id: int = 0,
         gap: float = 0.002, table: int = tokens.MAX_CACHED) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` ids.  ``table`` bounds what
    a worker remembers of encoded chunks: memory against time, the same pieces.

    One row per piece: uid (of the input row), doc_id, start (ids of the document
    before it), length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset (the piece's place in its sequence, gapless from 0).
    """
    ids = encoded(docs, vocabulary, end_id, table)
    pieces = placed(ids.select("uid", "n"), capacity, gap)
    wide = vocabulary_kind(vocabulary, end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            out: dict[str, list] = {k: [] for k in ("uid", "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
            for uid, doc, n, raw, parts in zip(*(batch.column(c) for c in ("uid", "doc_id", "n", "ids", "pieces"))):
                values = np.frombuffer(raw.as_py(), dtype=wide).astype("<u4")
                for p in parts.as_py():
                    out["ids"].append(values[p["start"]:p["start"] + p["length"]].tobytes())
                    for k, v in (("uid", uid.as_py()), ("doc_id", doc.as_py()), ("doc_tokens", n.as_py()), *p.items()):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=_PIECES)

    return ids.join(pieces, "uid").select("uid", "doc_id", "n", "ids", "pieces").mapInArrow(
        tidy(cut, "chunks"), "uid long, doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


_PIECES = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def vocabulary_kind(vocabulary: str | None, end_id: int) -> str:
    size = tokens.vocabulary_size(vocabulary or tokens.default_vocabulary())
    return "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"


def pieces_with_crc(packed: DataFrame) -> DataFrame:
    """The contract's columns: ids replaced by their crc32."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids, end id 0."""
    return pieces_with_crc(pack(documents(spark, sf_dir)))
