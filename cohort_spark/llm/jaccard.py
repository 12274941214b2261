"""Operator 9: Jaccard join of word n-gram sets by agreeing cells of the hash space.

A document is the set of its ``size``-word shingles (64-bit hashes); documents with
equal sets are one class from there on.  Two similar sets of which the smaller has n shingles differ in
at most ``k = (1 - t) / t n``.  The hash space is cut into more than k cells, so that among the first k + 1 + s of
them at least s + 1 hold the same shingles in both; each class has one signature for each of its first cells, a hash of
all that is in it, and similar classes share one.  The number of cells grows with the size, in bands;
a class whose larger partners may lie in the next band signs there as well.  Cells empty in both
are no signature: the s spare cells stand in for them, and a class with more than s empty cells signs
again over another order of the hash space.

Only reachability is asked for, so no pairs are listed within a group that is already
known to hang together.  In the first star round each class is compared, under each of its signatures, with the
smallest class there; in further ones with one class of each of two components (drawn by hash, anew for each
signature); the links found give new components.  The last round takes, exactly, all pairs under a signature whose
components differ; it comes once they are few, or no star round finds a link any more.  A bound that loses nothing
thins pairs out: the parities of 256 cells of the hash space bound from below how much two sets
differ.  Every link between different components is verified, and no cap is set anywhere.

Results for odd input: a null or empty text (or one without words) has no shingles and links
with nothing; fewer words than ``size`` are one shingle; a null doc_id takes part but lends its
component no id (null if it holds no other); rows repeating a doc_id are each compared; an
empty table gives no rows; further columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, slices, stage, tidy

NEED_BITS = 1 << 23
#: Sizes of a band, largest to smallest; orders of the hash space, of which the last signs empty cells too.
BAND, ORDERS = 1.5, 3
#: Classes that a task remembers to have signed; all pairs are few if they are no more than FEW a posting
#: (each is a comparison of a few longs); postings of a signature that meet in one task.
SIGNED, FEW, BLOCK = 1 << 18, 256, 2000
PARITY = ("p0", "p1", "p2", "p3")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted different hashes of the text's shingles: words of ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(size, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width))
    for k in range(width):
        out = (out ^ h[k:len(h) - width + 1 + k]) * _A
        out ^= out >> np.uint64(31)
    return np.unique(out * _B)


def may_differ(n: int, percent: int) -> int:
    """In how many shingles a set of ``n`` and a similar one, no smaller, differ at most."""
    return (100 - percent) * n // percent


@cache
def bands(percent: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The largest size of each band; its cells and how many of them are spare.  Sets too small to
    be similar to any other are below the first band."""
    tops, cells = [], []
    low = -(-percent // (100 - percent)) if percent < 100 else 1 << 40
    while low < 1 << 40:
        top = max(low, int(low * BAND))
        least = may_differ(top, percent) + 1
        spare = 1 + int(least * math.exp(-low / least))
        tops.append(top)
        cells.append((least + spare, spare))
        low = top + 1
    return np.array(tops, np.int64), cells


def signatures(own: np.ndarray, percent: int) -> np.ndarray:
    """One hash for what each of the set's first cells holds, for its band and those of larger partners."""
    n, (tops, cells) = len(own), bands(percent)
    if may_differ(n, percent) < 1:
        return np.zeros(0, np.uint64)
    out = []
    for band in range(int(np.searchsorted(tops, n)), int(np.searchsorted(tops, n * 100 // percent)) + 1):
        count, spare = cells[band]
        first = may_differ(n, percent) + 1 + spare
        ids = own
        for order in range(ORDERS):
            if order:
                ids = (ids ^ (ids >> np.uint64(32))) * _A
                ids = np.sort(ids ^ (ids >> np.uint64(29)))
            ends = np.searchsorted(((ids >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32), np.arange(first + 1, dtype=np.uint64))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((ids ^ (ids >> np.uint64(31))) * _B)])
            held = np.diff(ends)
            place = np.arange(first, dtype=np.uint64) + np.uint64((band * ORDERS + order) << 40)
            h = ((sums[ends[1:]] - sums[ends[:-1]]) ^ (place * _A)) * _B
            h = (h ^ (h >> np.uint64(31))) * _A
            out.append(h if order == ORDERS - 1 else h[held > 0])
            if first - np.count_nonzero(held) <= spare:
                break
    return np.concatenate(out)


def parity(own: np.ndarray) -> np.ndarray:
    """Whether each of 256 cells of the hash space holds an odd number of shingles, as four
    longs: sets differ in at least as many shingles as in cells."""
    cells = np.bincount((own >> np.uint64(56)).astype(np.int64), minlength=256) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.int64)


def signed(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Rows (doc_id, n, key, parities, sigs) for documents; a task gives the signatures of equal sets
    with one of them, as long as it remembers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        known: set[int] = set()
        for batch in slices(batches):
            out: dict[str, list] = {"n": [], "key": [], **{p: [] for p in PARITY}}
            sigs, ends = [np.zeros(0, np.uint64)], [0]
            for text in batch.column("text"):
                own = shingles(text.as_py(), size)
                key = int(np.uint64(xxhash.xxh64_intdigest(own.tobytes())).astype(np.int64)) if len(own) else None
                for p, x in zip(PARITY, parity(own).tolist()):
                    out[p].append(x)
                out["n"].append(len(own))
                out["key"].append(key)
                if len(own) and key not in known:
                    sigs.append(signatures(own, percent))
                    known.add(key)
                    ends.append(ends[-1] + len(sigs[-1]))
                else:
                    ends.append(ends[-1])
            if len(known) > SIGNED:
                known.clear()
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n": pa.array(out["n"], pa.int64()), "key": pa.array(out["key"], pa.int64()),
                **{p: pa.array(out[p], pa.int64()) for p in PARITY},
                "sigs": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sigs).view(np.int64)))})

    return docs.mapInArrow(tidy(read), f"doc_id long, n long, key long, {', '.join(f'{p} long' for p in PARITY)}, sigs array<long>")


def shared(rows: DataFrame) -> DataFrame:
    """sig, key, low: the classes under signatures that at least two classes have, and the smallest there."""
    there = Window.partitionBy("sig")
    rows = rows.select(F.explode("sigs").alias("sig"), "key")
    rows = rows.withColumn("low", F.min("key").over(there)).withColumn("high", F.max("key").over(there))
    return stage(rows.where("low <> high").select("sig", "key", "low").distinct(), "jaccard-shared")


SIDE = ("key", "n", *PARITY)


def side(name: str) -> list:
    """The class columns as name, name_n and so on."""
    return [F.col(c).alias(name if c == "key" else f"{name}_{c}") for c in SIDE]


def may_be_similar(percent: int):
    """Sizes allow the overlap, and the sets do not differ in too many cells."""
    sizes = F.col("a_n") + F.col("b_n")
    differ = sum((F.bit_count(F.col(f"a_{p}").bitwiseXOR(F.col(f"b_{p}"))) for p in PARITY), F.lit(0))
    return (F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent) & (differ * (100 + percent) <= sizes * (100 - percent))


def possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs that may be similar."""
    return pairs.join(classes.select(*side("a")), "a").join(classes.select(*side("b")), "b").where(may_be_similar(percent)).select("a", "b")


def mixed(index: DataFrame, labels: DataFrame) -> DataFrame:
    """sig, key, c: the postings under signatures held in two components (``c``): only those can link further."""
    there = Window.partitionBy("sig")
    rows = index.select("sig", "key").join(labels, "key")
    rows = rows.withColumn("x", F.min("c").over(there)).withColumn("y", F.max("c").over(there))
    return stage(rows.where("x <> y").select("sig", "key", "c"), "jaccard-mixed")


def few_pairs(known: DataFrame) -> bool:
    """Whether pairs of different components, listed for each signature, are few beside the postings."""
    per = known.groupBy("sig", "c").agg(F.count(F.lit(1)).cast("double").alias("k")).groupBy("sig").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("kk"))
    total = per.agg(F.sum("k").alias("k"), F.sum((F.col("k") * F.col("k") - F.col("kk")) / 2).alias("pairs")).first()
    return total["k"] is None or total["pairs"] <= FEW * total["k"]


def star_pairs(known: DataFrame) -> DataFrame:
    """a, b: each class with a class each of two components, by an order of the signature's own."""
    end = F.struct(F.xxhash64("sig", "c").alias("x"), F.xxhash64("sig", "key").alias("y"), "c", "key")
    there = Window.partitionBy("sig")
    pairs = known.withColumn("lo", F.min(end).over(there)).withColumn("hi", F.max(end).over(there))
    pairs = pairs.withColumn("e", F.explode(F.array("lo", "hi"))).where("c <> e.c")
    return pairs.select(F.least("key", "e.key").alias("a"), F.greatest("key", "e.key").alias("b")).distinct()


def all_pairs(known: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """a, b: all pairs under a signature whose components differ and that may be similar.  The
    postings of a common signature are cut into blocks, and each two blocks meet on their own."""
    blocks = F.ceil(F.count(F.lit(1)).over(Window.partitionBy("sig")) / BLOCK)
    rows = known.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).join(classes.select(*SIDE), "key")
    left, right = (rows.select("sig", "i", "j", F.col("c").alias(f"{x}c"), F.col("own").alias(f"{x}_own"), *side(x)) for x in "ab")
    here = (F.least("a_own", "b_own") == F.col("i")) & (F.greatest("a_own", "b_own") == F.col("j"))
    pairs = left.join(right, ["sig", "i", "j"]).where((F.col("ac") < F.col("bc")) & here & may_be_similar(percent))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs of classes whose full sets are similar enough."""
    needed = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    needed = stage(classes.join(needed, "key").select("key", "doc_id"), "jaccard-needed")
    # texts out of the question are not hashed again: a bit filter of fixed size
    at = F.pmod(F.xxhash64("doc_id"), F.lit(NEED_BITS))
    marks = np.zeros(NEED_BITS // 64, np.int64)
    for r in needed.select(at.alias("at")).groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")).collect():
        marks[r["word"]] = r["bits"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            places = batch.column("at").to_numpy()
            batch = batch.filter(pa.array((marks[places >> 6] >> (places & 63) & 1).astype(bool)))
            for part in slices([batch], 512):
                sets = [shingles(t.as_py(), size) for t in part.column("text")]
                yield pa.RecordBatch.from_pydict({
                    "key": [int(np.uint64(xxhash.xxh64_intdigest(s.tobytes())).astype(np.int64)) for s in sets],
                    "own": [s.tobytes() for s in sets]}, schema=pa.schema([("key", pa.int64()), ("own", pa.binary())]))

    sets = docs.select("text", F.coalesce(at, F.lit(0)).alias("at")).mapInArrow(tidy(hashed), "key long, own binary")
    # other texts under a marked bit, or under a repeated doc_id, have another key and go
    sets = stage(sets.join(needed.select("key"), "key", "left_semi").groupBy("key").agg(F.first("own").alias("own")), "jaccard-sets")

    @F.pandas_udf("boolean")
    def similar(a, b):
        import pandas as pd

        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.concatenate([x, y])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            out.append(100 * shared >= percent * (len(both) - shared))
        return pd.Series(out)

    left, right = sets.toDF("a", "own_a"), sets.toDF("b", "own_b")
    return pairs.join(left, "a").join(right, "b").where(similar("own_a", "own_b")).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """key and the smallest key reachable, for every key with an edge, by rounds of large
    and small stars until nothing changes; each round is a written table."""
    edges = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "jaccard-edges")
    while True:
        # stars already, if every node is either the smaller one of its edges or has a single smaller one
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up")))
        if ends.groupBy("x").agg(F.min("up").alias("low"), F.sum("up").alias("ups")).where("ups > 1 or ups = 1 and low = 0").isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        # large star: neighbours above a node go to the node's smallest
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        # small star: a node and its neighbours below go to its smallest
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (large.join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .unionByName(least.select("u", F.col("low").alias("v"))).distinct())
        edges = stage(small, "jaccard-edges")
    stars = edges.select("u", F.col("v").alias("low"))
    return stars.select(F.col("u").alias("key"), "low").unionByName(stars.select(F.col("low").alias("key"), "low").distinct())


def join_components(docs: DataFrame, size: int = 3, percent: int = 90, stars: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every row.
    Star rounds, until all pairs are few, no link is found or ``stars`` are done, come before
    the exact round, which gives the same components after any number of them."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stage(signed(docs, size, percent), "jaccard-base")
    classes = stage(rows.where(F.col("key").isNotNull()).groupBy("key", "n").agg(
        F.min("doc_id").alias("doc_id"), *[F.first(p).alias(p) for p in PARITY]), "jaccard-classes")
    index = shared(rows)

    labels = classes.select("key", F.col("key").alias("c"))
    pairs = possible(index.where("key <> low").select(F.col("low").alias("a"), F.col("key").alias("b")).distinct(), classes, percent)
    tried, done, last = None, 0, False
    while True:
        pairs = stage(pairs.join(tried, ["a", "b"], "left_anti") if tried is not None else pairs, "jaccard-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = stage(verified(pairs, docs, classes, size, percent), "jaccard-links")
        none = links.isEmpty()
        if not none:
            edges = links if not done else links.join(labels.toDF("a", "ac"), "a").join(labels.toDF("b", "bc"), "b").select(F.col("ac").alias("a"), F.col("bc").alias("b"))
            found = components(edges).toDF("c", "low")
            labels = stage(labels.join(found, "c", "left").select("key", F.coalesce("low", "c").alias("c")), "jaccard-labels")
        done += 1
        if last:
            break
        index = mixed(index, labels)  # what is one component's now stays so
        last = none or done == stars or few_pairs(index)
        pairs = all_pairs(index, classes, percent) if last else possible(star_pairs(index), classes, percent)

    label = labels.join(classes.select("key", "doc_id"), "key")
    smallest = label.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    label = label.join(smallest, "c").select("key", "component_id")
    return rows.join(label, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 3-word shingles and a Jaccard similarity of 0.9."""
    return join_components(documents(spark, sf_dir))
