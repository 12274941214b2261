"""Operator 2: nearest neighbours by randomly rotated one-bit codes.

Equal vectors stand once.  A bounded sample (``sample`` vectors) gives cell centroids.
A vector's residual to its centroid, randomly rotated, is kept as one sign bit per
dimension, packed, with its length and the inner product of code and direction (the
correction).  ``<q, v> = <q, c> + length * <q', code> / correction`` up to an error that
stays below ``epsilon * |q'| * length * sqrt((1 - corr^2) / corr^2 / (dim - 1))`` with high probability.

Search: every query takes its k-th best of the sample as a first threshold, is sent to
the cells whose bound (centroid product plus radius) reaches it, and there estimates
all codes of a block; vectors whose estimate plus error bound reaches the threshold
are reranked with exact double-precision products, which raise it.  Cells are cut into
blocks of about ``block`` vectors and queries into groups of about ``group``,
so a task holds one of each, whatever the share of one cell or vector.

Results for odd input: vectors that are null, zero, or hold null or non-finite
components take no part, nor do those whose length is not the table's most common
(ties: the longest), nor null vec_ids; equal vectors tie and order by vec_id; repeated rows of a vec_id
count once; an empty table gives no rows; further columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, cells: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Lloyd's k-means on the sample."""
    rng = np.random.default_rng(seed)
    c = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest_cell(sample, c)
        for k in range(len(c)):
            if (own := sample[near == k]).size:
                c[k] = own.mean(axis=0)
    return c


def nearest_cell(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(axis=1) - 2 * (x @ c.T)).argmin(axis=1)


def encode(x: np.ndarray, c: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cell, packed sign bits, residual length and correction of each row of ``x``."""
    cell = nearest_cell(x, c)
    rest = (x - c[cell]) @ turn
    length = np.linalg.norm(rest, axis=1)
    bits = rest >= 0
    # <code, direction> with the code's components +-1/sqrt(dim)
    corr = np.where(length > 0, np.abs(rest).sum(axis=1) / np.where(length > 0, length, 1) / np.sqrt(x.shape[1]), 1.0)
    return cell, np.packbits(bits, axis=1), length, corr


def estimate(codes: np.ndarray, length: np.ndarray, corr: np.ndarray, turned: np.ndarray, base: np.ndarray,
             epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x vectors) and their error bounds' factor per vector,
    which times the query's length bounds the error."""
    dim = turned.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    scale = (length / corr / np.sqrt(dim)).astype(np.float32)
    est = (turned.astype(np.float32) @ signs.T) * scale + base[:, None].astype(np.float32)
    bound = epsilon * length * np.sqrt(np.maximum(0, 1 - corr ** 2) / corr ** 2 / max(1, dim - 1))
    return est, bound


def search_block(vectors: np.ndarray, ids: np.ndarray, codes: np.ndarray, length: np.ndarray, corr: np.ndarray,
                 centroid: np.ndarray, queries: np.ndarray, thresholds: np.ndarray, turn: np.ndarray, k: int, epsilon: float,
                 step: int = 4096) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query row, vector ids, exact products) of each query's up to k best in one block
    that reach its threshold."""
    turned, base, size = queries @ turn, queries @ centroid, np.linalg.norm(queries, axis=1)
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * len(queries)
    floor = thresholds.astype(float).copy()
    for at in range(0, len(ids), step):
        part = slice(at, at + step)
        est, bound = estimate(codes[part], length[part], corr[part], turned, base, epsilon)
        own = vectors[part]
        for q in range(len(queries)):
            pick = np.flatnonzero(est[q] + bound * size[q] >= floor[q] - 1e-6)
            if not len(pick):
                continue
            exact = own[pick] @ queries[q]
            keep = exact >= floor[q] - 1e-9
            scores = np.concatenate([best[q][0], exact[keep]])
            names = np.concatenate([best[q][1], ids[part][pick[keep]]])
            if len(scores) > k:
                top = np.lexsort((names, -scores))[:k]
                scores, names = scores[top], names[top]
            if len(scores) == k:
                floor[q] = max(floor[q], scores.min())
            best[q] = scores, names
    for q, (scores, names) in enumerate(best):
        if len(names):
            yield q, names, scores


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """vec_id and embedding (array<double>) of the rows that take part, and their length."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.expr("""vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0
        AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')) AND exists(embedding, x -> x <> 0)"""))
    sizes = rows.groupBy(F.size("embedding").alias("n")).count()
    top = sizes.orderBy(F.col("count").desc(), F.col("n").desc()).first()
    dim = top["n"] if top else 0
    return rows.where(F.size("embedding") == dim), dim


def search(vectors: DataFrame, k: int = 20, every: int = 20, cells: int = 64, sample: int = 4096, block: int = 16384,
           group: int = 2048, epsilon: float = 1.9, seed: int = 7) -> DataFrame:
    """The k nearest (largest inner product) of every row whose vec_id is divisible by
    ``every`` among all other rows: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows, dim = usable(vectors)
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    # of equal vectors the k + 1 smallest ids can be among any query's k nearest
    first = (rows.groupBy("embedding", "salt", "vec_id").agg(F.lit(1).alias("one"))
             .withColumn("r", F.row_number().over(Window.partitionBy("embedding", "salt").orderBy("vec_id"))).where(F.col("r") <= k + 1)
             .withColumn("r", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))).where(F.col("r") <= k + 1))
    asked = rows.where(F.col("vec_id") % every == 0)
    asks = asked.groupBy("embedding").agg(F.lit(True).alias("asked"))
    distinct = first.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    distinct = stage(distinct.join(asks, "embedding", "left"), "ann-distinct")

    few = distinct.select("rep", "embedding").orderBy(F.xxhash64("rep"), "rep").limit(sample).collect()  # bounded by ``sample``
    drawn, drawn_ids = np.array([r["embedding"] for r in few]), np.array([r["rep"] for r in few])
    centers, turn = centroids(drawn, cells, seed=seed), rotation(dim, seed)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column("embedding").flatten()).reshape(-1, dim)
            cell, bits, length, corr = encode(x, centers, turn)
            yield pa.RecordBatch.from_pydict({
                "rep": batch.column("rep"), "asked": batch.column("asked"), "cell": cell.astype(np.int64),
                "code": [b.tobytes() for b in bits], "length": length, "corr": corr, "vector": [v.tobytes() for v in x]})

    index = stage(distinct.select("rep", "asked", "embedding").mapInArrow(
        code, "rep long, asked boolean, cell long, code binary, length double, corr double, vector binary"), "ann-index")
    facts = {r["cell"]: r for r in index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("radius")).collect()}
    blocks = {c: -(-r["n"] // block) for c, r in facts.items()}
    radius = np.array([facts[c]["radius"] if c in facts else -np.inf for c in range(len(centers))])
    groups = -(-index.where("asked").count() // group) or 1

    count = F.element_at(F.create_map(*[F.lit(int(x)) for c, n in blocks.items() for x in (c, n)]), F.col("cell"))
    codes = index.withColumns({"part": F.pmod(F.xxhash64("rep"), count), "grp": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))})
    codes = codes.select("cell", "part", F.col("grp").cast("long"), "rep", "code", "length", "corr", "vector")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("cell", "part", "rep", "vector", "floor")}
            for rep, raw in zip(batch.column("rep").to_pylist(), batch.column("vector")):
                raw = raw.as_py()
                q = np.frombuffer(raw)
                known = drawn @ q
                # of the sample's k + 1 best one may be the query itself
                floor = np.partition(known, -(k + 1))[-(k + 1)] if len(known) > k else -np.inf
                for c in np.flatnonzero(centers @ q + radius * np.linalg.norm(q) >= floor - 1e-9):
                    for part in range(blocks.get(int(c), 0)):
                        for name, value in zip(out, (int(c), part, rep, raw, floor)):
                            out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("cell", pa.int64()), ("part", pa.int64()), ("rep", pa.int64()),
                                                                    ("vector", pa.binary()), ("floor", pa.float64())]))

    routed = index.where("asked").select("rep", "vector").mapInArrow(route, "cell long, part long, rep long, vector binary, floor double")
    routed = routed.withColumn("grp", F.pmod(F.xxhash64("rep"), F.lit(groups)))

    def meet(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "rep": [], "score": []}
        if left.num_rows and right.num_rows:
            matrix = lambda t, c, kind: np.frombuffer(b"".join(t.column(c).to_pylist()), dtype=kind).reshape(t.num_rows, -1)
            of = right.column("rep").to_numpy()
            for q, names, scores in search_block(
                    matrix(left, "vector", "f8"), left.column("rep").to_numpy(), matrix(left, "code", "u1"),
                    left.column("length").to_numpy(), left.column("corr").to_numpy(), centers[key[0].as_py()],
                    matrix(right, "vector", "f8"), right.column("floor").to_numpy(), turn, k + 1, epsilon):
                out["query"] += [of[q]] * len(names)
                out["rep"] += names.tolist()
                out["score"] += scores.tolist()
        return pa.table({"query": pa.array(out["query"], pa.int64()), "rep": pa.array(out["rep"], pa.int64()),
                         "score": pa.array(out["score"], pa.float64())})

    keys = ["cell", "part", "grp"]
    found = codes.groupBy(*keys).cogroup(routed.groupBy(*keys)).applyInArrow(meet, "query long, rep long, score double")

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"query": [], "rep": [], "score": []}
            for rep, raw in zip(batch.column("rep").to_pylist(), batch.column("vector")):
                exact = drawn @ np.frombuffer(raw.as_py())
                top = np.lexsort((drawn_ids, -exact))[:k + 1]
                out["query"] += [rep] * len(top)
                out["rep"] += drawn_ids[top].tolist()
                out["score"] += exact[top].tolist()
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("query", pa.int64()), ("rep", pa.int64()), ("score", pa.float64())]))

    # the sample's own best are exact and make every list whole
    seen = index.where("asked").select("rep", "vector").mapInArrow(known, "query long, rep long, score double")
    found = found.unionByName(seen).groupBy("query", "rep").agg(F.max("score").alias("score"))
    ids = distinct.select("rep", "ids")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    near = (found.join(ids, "rep").select("query", "score", F.explode("ids").alias("vec_id"))
            .withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1))
    near = near.groupBy("query").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("less"), "vec_id"))).alias("near"))  # k + 1 at most
    # a vector that a third of all rows share may be asked for by a third of the queries:
    # its list meets them on (vector, salt)
    who = (asked.select("vec_id", "embedding", "salt").distinct()
           .join(distinct.where("asked").select("embedding", F.col("rep").alias("query"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long"))).alias("salt")),
                 ["embedding", "salt"]).select("query", "salt", F.col("vec_id").alias("query_id")))
    near = near.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long"))))
    lists = who.join(near, ["query", "salt"]).select(
        "query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return lists.select("query_id", F.posexplode("near").alias("pos", "x")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.less")).alias("score"))


def op2_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vec_id divisible by 20 in ``embeddings``."""
    return search(table(spark, sf_dir, "embeddings"))
