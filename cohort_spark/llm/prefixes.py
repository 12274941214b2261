"""Operator 9 for lower similarities (the pipeline's 0.8): Jaccard join by adaptive multi-match prefixes.

The cells of ``jaccard.py`` hold fewer shingles there; tried on large tables they took too much disk.

A document is the set of its ``size``-word shingles (64-bit hashes); documents with
equal sets are one class from there on.  Shingles are ordered by estimated frequency (a counter table of fixed
size over all documents), rare first.  With overlap ``o = ceil(t n)`` needed, two similar sets share at
least ``m`` shingles of their first ``n - o + m``; each class picks its own ``m`` by the
candidates its prefix would meet, as estimated from the counters, and a pair must share as many as the smaller of
their two ``m`` before it is verified on the full sets.

Only reachability is asked for, so no pairs are listed within a group that is already
known to hang together.  In the star rounds, which go on until one finds no link, every class is compared, under each of its
prefix shingles, with one class of each of two components there (drawn by hash, anew for each shingle);
the links found give new components.  The last round takes, exactly, all pairs under a shingle whose components
differ.  Bounds that lose nothing thin them out: what lies before a shared shingle in no other
class's prefix is not shared; the parities of 256 cells of the hash space bound from below
how much two sets differ.  Every link between different components is verified, and no cap is set
anywhere.

Odd input is treated as in ``jaccard.py``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stage, tidy
from .jaccard import PARITY, components, parity, shingles, verified

COUNTERS, SLICES = 1 << 18, 64
MATCHES = (1, 2, 3, 4, 6, 8)


def least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def prefix(own: np.ndarray, counters: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The prefix's shingles and the matches it asks for: the longest prefixes cost more
    postings, more matches leave fewer candidates to verify."""
    n = len(own)
    often = counters[own % np.uint64(COUNTERS)]
    order = np.lexsort((own, often))
    base = n - least_overlap(n, percent)
    reach = np.cumsum(often[order])
    best, cost = 1, np.inf
    for m in MATCHES:
        if base + m > n or m > max(1, n - base):
            break
        met = float(reach[base + m - 1])
        own_cost = met + met / m ** 2 * max(1.0, n / 64)  # postings read, sets verified
        if own_cost < cost:
            best, cost = m, own_cost
    return own[order[:base + best]], best


def sets_and_counters(docs: DataFrame, size: int) -> DataFrame:
    """Rows (doc_id, n, key) for documents, and (part, counts) for each task's counters."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        counts = np.zeros(COUNTERS, np.int64)
        some = False
        for batch in slices(batches):
            out: dict[str, list] = {"n": [], "key": [], **{p: [] for p in PARITY}}
            for text in batch.column("text"):
                own = shingles(text.as_py(), size)
                for p, x in zip(PARITY, parity(own).tolist()):
                    out[p].append(x)
                np.add.at(counts, (own % np.uint64(COUNTERS)).astype(np.int64), 1)
                out["n"].append(len(own))
                out["key"].append(int(np.uint64(xxhash.xxh64_intdigest(own.tobytes())).astype(np.int64)) if len(own) else None)
            some |= batch.num_rows > 0
            k = len(out["n"])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n": pa.array(out["n"], pa.int64()), "key": pa.array(out["key"], pa.int64()),
                **{p: pa.array(out[p], pa.int64()) for p in PARITY}, "part": pa.nulls(k, pa.int64()), "counts": pa.nulls(k, pa.binary())})
        if some:
            parts = counts.reshape(SLICES, -1)
            none = pa.nulls(SLICES, pa.int64())
            yield pa.RecordBatch.from_pydict({"doc_id": none, "n": none, "key": none, **{p: none for p in PARITY}, "part": np.arange(SLICES), "counts": [x.tobytes() for x in parts]})

    return docs.mapInArrow(tidy(read), f"doc_id long, n long, key long, {', '.join(f'{p} long' for p in PARITY)}, part long, counts binary")


def summed_counters(rows: DataFrame) -> np.ndarray:
    """All tasks' counters added up (a table of fixed size)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(COUNTERS // SLICES, np.int64), None
        for batch in batches:
            for part, x in zip(batch.column("part").to_pylist(), batch.column("counts")):
                total += np.frombuffer(x.as_py(), np.int64)
        yield pa.RecordBatch.from_pydict({"part": [part], "counts": [total.tobytes()]})

    out = np.zeros((SLICES, COUNTERS // SLICES), np.int64)
    for r in rows.where(F.col("part").isNotNull()).select("part", "counts").groupBy("part").applyInArrow(add, "part long, counts binary").collect():
        out[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return out.ravel()


def postings(docs: DataFrame, counters: np.ndarray, size: int, percent: int) -> DataFrame:
    """h, key, n, m, at (place in the class's order): one row for each prefix shingle of each class."""
    table = np.minimum(counters, 2 ** 31 - 1).astype(np.int32)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in slices(batches):
            h, key, n, m, at = [np.zeros(0, np.uint64)], [], [], [], []
            for text in batch.column("text"):
                own = shingles(text.as_py(), size)
                if not len(own):
                    continue
                first, matches = prefix(own, table, percent)
                h.append(first)
                k = len(first)
                key.append(np.full(k, np.uint64(xxhash.xxh64_intdigest(own.tobytes()))))
                n.append(np.full(k, len(own)))
                m.append(np.full(k, matches))
                at.append(np.arange(k))
            if key:
                yield pa.RecordBatch.from_pydict({
                    "h": np.concatenate(h).view(np.int64), "key": np.concatenate(key).view(np.int64),
                    "n": np.concatenate(n).astype(np.int64), "m": np.concatenate(m).astype(np.int64),
                    "at": np.concatenate(at).astype(np.int64)})

    rows = docs.select("text").mapInArrow(tidy(read), "h long, key long, n long, m long, at long")
    return rows.groupBy("h", "key", "n").agg(F.min("m").alias("m"), F.min("at").alias("at"))


SIDE = ("key", "n", "m", "at", "u", *PARITY)


def side(name: str, source: str = "") -> list:
    """The posting columns as name, name_n, name_m and so on."""
    return [F.col(f"{source}{c}").alias(name if c == "key" else f"{name}_{c}") for c in SIDE]


def candidates(pairs: DataFrame, percent: int) -> DataFrame:
    """a, b of pairs (one row per shared prefix shingle, columns of two sides and h) that
    share enough, and whose order leaves room for the overlap: what both share up to the
    last shared prefix shingle is all counted, and behind it lie at most the shorter rest."""
    swap = F.col("a") > F.col("b")
    one = lambda c: F.when(swap, F.col(f"b{c}")).otherwise(F.col(f"a{c}"))
    two = lambda c: F.when(swap, F.col(f"a{c}")).otherwise(F.col(f"b{c}"))
    rows = pairs.where(may_be_similar(percent)).select(
        "h", one("").alias("a"), two("").alias("b"), F.least("a_m", "b_m").alias("least"), (one("_n") + two("_n")).alias("sizes"),
        (one("_n") - one("_at")).alias("a_rest"), (two("_n") - two("_at")).alias("b_rest"))
    room = F.col("shared") - 1 + F.least("a_rest", "b_rest")
    return (rows.groupBy("a", "b").agg(F.max("least").alias("least"), F.max("sizes").alias("sizes"), F.count(F.lit(1)).alias("shared"),
                                       F.min("a_rest").alias("a_rest"), F.min("b_rest").alias("b_rest"))
            .where((F.col("shared") >= F.col("least")) & (room * (100 + percent) >= F.col("sizes") * percent)).select("a", "b"))


def may_be_similar(percent: int):
    """Sizes allow the overlap, also without the ``u`` earlier shingles that neither can share,
    and the sets do not differ in too many cells."""
    sizes = F.col("a_n") + F.col("b_n")
    room = F.least(F.col("a_n") - F.col("a_u"), F.col("b_n") - F.col("b_u"))
    differ = sum((F.bit_count(F.col(f"a_{p}").bitwiseXOR(F.col(f"b_{p}"))) for p in PARITY), F.lit(0))
    return (room * (100 + percent) >= sizes * percent) & (differ * (100 + percent) <= sizes * (100 - percent))


def with_unshared(rows: DataFrame, percent: int) -> DataFrame:
    """``rows`` with ``u``: how many shingles before this one in its class's order are not in
    ``rows``.  A partner under this shingle would hold them in its own prefix, so no partner
    does; postings that this leaves without room for any partner go."""
    earlier = F.row_number().over(Window.partitionBy("key", "n").orderBy("at")) - 1
    rows = rows.withColumn("u", (F.col("at") - earlier).cast("long"))
    return rows.where((F.col("n") - F.col("u")) * 100 >= F.col("n") * percent)


def mixed(known: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Postings under shingles held in two components (``c``): only those can link further.  The
    parities come in here, by class, once most postings are gone."""
    two = known.groupBy("h").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y").select("h")
    rows = with_unshared(known.join(two, "h"), percent)
    return stage(rows.join(classes.select("key", "n", *PARITY), ["key", "n"]), "jaccard-mixed")


def join_components(docs: DataFrame, size: int = 3, percent: int = 90, stars: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every row.
    Rounds against shingles' end classes, until one finds no link or ``stars`` are done, come before
    the exact round, which gives the same components after any number of them."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = stage(sets_and_counters(docs, size), "jaccard-base")
    counters = summed_counters(base)
    rows = base.where(F.col("part").isNull()).drop("part", "counts")
    classes = rows.where(F.col("key").isNotNull()).groupBy("key", "n").agg(
        F.min("doc_id").alias("doc_id"), *[F.first(p).alias(p) for p in PARITY])

    index = stage(postings(docs, counters, size, percent), "jaccard-postings")
    often = index.groupBy("h").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1").select("h")
    index = stage(index.join(often, "h"), "jaccard-shared")

    classes = stage(classes, "jaccard-classes")
    links, tried, found, step, done = None, None, None, "star", 0
    while step:
        known = index.withColumn("low", F.lit(None).cast("long")) if found is None else index.join(found, "key", "left")
        known = mixed(known.withColumn("c", F.coalesce("low", "key")).select("h", *SIDE[:4], "c"), classes, percent)
        index = known.select("h", *SIDE[:4])  # what is one component's now stays so
        left = known.select("h", *side("a"), F.col("c").alias("ac"))
        if step == "star":  # a class each of two components, by an order of the shingle's own
            end = F.struct(F.xxhash64("h", "c").alias("x"), F.xxhash64("h", "key").alias("y"), "c", *SIDE)
            ends = known.groupBy("h").agg(F.min(end).alias("lo"), F.max(end).alias("hi"))
            pairs = left.join(ends, "h").withColumn("e", F.explode(F.array("lo", "hi"))).where("ac <> e.c")
            pairs = pairs.select("h", *(c for c in left.columns if c not in ("h", "ac")), *side("b", "e."))
            pairs = pairs.where(may_be_similar(percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        else:
            right = known.select(F.col("h").alias("g"), *side("b"), F.col("c").alias("bc"))
            pairs = left.join(right, (F.col("h") == F.col("g")) & (F.col("ac") < F.col("bc")) & may_be_similar(percent))
            pairs = candidates(pairs, percent)
        pairs = stage(pairs.join(tried, ["a", "b"], "left_anti") if tried is not None else pairs, "jaccard-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        more = stage(verified(pairs, docs, classes, size, percent), "jaccard-links")
        none = more.isEmpty()
        if not none:
            links = more if links is None else links.unionByName(more)
            found = stage(components(links), "jaccard-found")
        done += 1
        step = None if step == "all" else "all" if none or done == stars else "star"

    label = classes.withColumn("low", F.col("key")) if found is None else classes.join(found, "key", "left").withColumn("low", F.coalesce("low", "key"))
    smallest = label.groupBy("low").agg(F.min("doc_id").alias("component_id"))
    label = label.join(smallest, "low").select("key", "component_id")
    return rows.join(label, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
