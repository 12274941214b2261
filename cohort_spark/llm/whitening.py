"""Operator 11: embedding whitening by shifted CholeskyQR.

An entry ``c`` is read as the integer ``floor(scale * c) + offset``; the fit list holds each
distinct integer vector once.  With ``A`` the fit list's centred rows, every pass over the
cluster solves the triangular systems of the passes before (``Q = A / R1 / R2 ...``), sums the
Gram matrix ``Q'Q`` by blocks of rows in the tasks and by (row, column) in a shuffle, and the
driver, which holds matrices of dim x dim only, takes its Cholesky factor; while the Gram matrix
is too ill-conditioned for that, it is shifted by ``11 (n dim + dim (dim + 1)) u |Q|^2`` first.
Passes go on until ``Q'Q`` is close to the identity on the range of ``A``; its root is the last
factor.  The product of the factors is the R of ``A = QR``; its singular values over ``sqrt(n)``
are the components' standard deviations, its right singular vectors the components.  A Gram
matrix of ``A`` itself, whose condition is squared, never decides a component.

Centring is exact: ``n * x - S`` is formed in integers and divided once by ``n``.

Results for odd input: a vector that is null, empty, or holds a null, NaN, infinite or (beyond
2^55, so that its integer is no long) huge entry is left out, as is one whose length is not the
table's most common (ties: the longest).  Rows with null vec_id and repeated rows stay, each with
a result of its own; equal vectors count once in the fit.  Components without variance (rank
below ``components``, fewer dimensions, one distinct vector) are not returned; an empty table
gives no rows.  ``deviation`` is null where it exceeds a long.  Further columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage, table

#: Unit roundoff of double precision.
U = 2.0 ** -53
#: Rows of one block in a task.
BLOCK = 4096
#: Below this ratio of its eigenvalues a Gram matrix is shifted before it is factored.
SAFE = 1e-6


@dataclass
class Whitening:
    """A fitted model; arrays of dim, of components, or of dim x components."""
    n: int
    total: list[int]
    low: list[int]
    high: list[int]
    components: np.ndarray
    variance: np.ndarray
    explained: np.ndarray
    identity_error: float
    passes: int
    scale: int
    offset: int


def integers(vectors: DataFrame, scale: int, offset: int) -> DataFrame:
    """vec_id and x, the integer vector of every row that takes part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.expr("embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND abs(x) <= 36028797018963968)"))
    sizes = rows.groupBy(F.size("embedding").alias("dim")).count()
    top = sizes.orderBy(F.col("count").desc(), F.col("dim").desc()).first()
    rows = rows.where(F.size("embedding") == (top["dim"] if top else 0))
    return rows.select("vec_id", F.transform("embedding", lambda c: F.floor(c * scale).cast("long") + offset).alias("x"))


def solve_right(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``q / r`` for an upper triangular ``r``, column by column."""
    out = np.empty_like(q)
    for j in range(q.shape[1]):
        out[:, j] = (q[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dim)


def centred(x: np.ndarray, n: int, total: np.ndarray, wide: bool) -> np.ndarray:
    """Rows less their mean; ``wide``: n * x may leave 64 bits."""
    num = x.astype(object) * n - total.astype(object) if wide else x * n - total
    return num.astype(float) / n


def blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield matrix(batch.slice(at, BLOCK).column("x"), dim)


def summed(fit: DataFrame, dim: int, width: int, rows_of) -> np.ndarray:
    """Gram matrix of ``rows_of(block)`` over the fit list, ``width`` columns: one partial matrix
    a task, its entries added up by (row, column)."""
    up = np.triu_indices(width)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((width, width))
        for x in blocks(batches, dim):
            rows = rows_of(x)
            gram += rows.T @ rows
        yield pa.RecordBatch.from_pydict({"i": up[0].astype(np.int32), "j": up[1].astype(np.int32), "v": gram[up]})

    entries = fit.mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((width, width))
    out[entries["i"].to_numpy(), entries["j"].to_numpy()] = entries["v"].to_numpy()
    return out + np.triu(out, 1).T


def shifted_cholesky_qr(fit: DataFrame, n: int, total: np.ndarray, wide: bool, most: int = 20) -> tuple[np.ndarray, int]:
    """R of the centred fit list, and the passes taken."""
    dim, done = len(total), []
    composed, grown = np.eye(dim), 1.0
    for k in range(most):
        def turned(x: np.ndarray, factors=tuple(done)) -> np.ndarray:
            q = centred(x, n, total, wide)
            for r in factors:
                q = solve_right(q, r)
            return q

        gram = summed(fit, dim, dim, turned)
        values, axes = np.linalg.eigh(gram)
        if not values[-1] > 0:
            return np.zeros((dim, dim)), k + 1
        near, none = np.abs(values - 1) < 1e-2, values < 1e-13
        if k == most - 1 or k and (near | none).all() and (grown > 1 / U or not none.any()):
            # Q is orthonormal but for rounding and shifts; a direction that the shifts have not
            # raised from rounding size to here has no variance.  The root of the Gram matrix is
            # the last factor, singular or not
            return np.sqrt(np.where(none, 0, values))[:, None] * axes.T @ composed, k + 1
        shift = 0.0 if values[0] > SAFE * values[-1] else min(1e-2, 11 * (n * dim + dim * (dim + 1)) * U)
        factor = np.linalg.cholesky(gram + shift * values[-1] * np.eye(dim)).T
        composed = factor @ composed
        grown /= np.sqrt(shift) if shift else 1.0
        done.append(factor)


def fit_whitening(vectors: DataFrame, components: int = 16, scale: int = 64, offset: int = 1_000_000) -> tuple[DataFrame, Whitening | None]:
    """The rows as integers, written, and the model (None without rows)."""
    rows = stage(integers(vectors, scale, offset), "whitening-rows")
    fit = stage(rows.select("x").distinct(), "whitening-fit")
    # one row a dimension
    facts = (fit.select(F.posexplode("x").alias("d", "x")).groupBy("d")
             .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("x").cast("decimal(20,0)")).alias("total"), F.min("x").alias("low"), F.max("x").alias("high"))
             .orderBy("d").collect())
    if not facts:
        return rows, None
    n, dim = facts[0]["n"], len(facts)
    exact = [int(f["total"]) for f in facts]
    low, high = [f["low"] for f in facts], [f["high"] for f in facts]
    wide = max(n * max(abs(a), abs(b)) + abs(s) for a, b, s in zip(low, high, exact)) >= 2 ** 62
    total = np.array(exact, dtype=object if wide else np.int64)
    r, passes = shifted_cholesky_qr(fit, n, total, wide)
    _, sigma, turned = np.linalg.svd(r)
    rank = int((sigma > max(dim, 16) * 8 * U * sigma[0]).sum()) if sigma[0] > 0 else 0
    keep = min(components, rank)
    v = turned[:keep].T
    v = v * np.where(v[np.abs(v).argmax(axis=0), np.arange(keep)] < 0, -1.0, 1.0) if keep else v
    variance = sigma[:keep] ** 2 / n
    model = Whitening(n, exact, low, high, v, variance, sigma[:keep] ** 2 / max((sigma[:rank] ** 2).sum(), 1e-300), 0.0, passes, scale, offset)
    if keep:
        turn = v / np.sqrt(variance)

        def with_one(x: np.ndarray) -> np.ndarray:  # a column of ones sums the whitened columns
            return np.hstack([centred(x, n, total, wide) @ turn, np.ones((len(x), 1))])

        gram = summed(fit, dim, keep + 1, with_one) / n
        mean = gram[:keep, keep]
        model.identity_error = float(np.abs(gram[:keep, :keep] - np.outer(mean, mean) - np.eye(keep)).max())
    return rows, model


def transform(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """vec_id, deviation and whitened (array of the model's components) of every row of ``integers``."""
    schema = "vec_id long, deviation long, whitened array<double>"
    if model is None or not len(model.variance):
        return rows.sparkSession.createDataFrame([], schema)
    n, dim, keep = model.n, len(model.total), len(model.variance)
    far = [max(abs(n * a - s), abs(n * b - s)) for a, b, s in zip(model.low, model.high, model.total)]
    wide = max(n * max(abs(a), abs(b)) + abs(s) for a, b, s in zip(model.low, model.high, model.total)) >= 2 ** 62
    long_squares = not wide and sum(f * f for f in far) < 2 ** 63
    total = np.array(model.total, dtype=object if wide else np.int64)
    turn = model.components / np.sqrt(model.variance)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = matrix(part.column("x"), dim)
                num = x.astype(object) * n - total if wide else x * n - total
                if long_squares:
                    deviation = pa.array((num * num).sum(axis=1), pa.int64())
                else:
                    sums = [sum(int(c) ** 2 for c in row) for row in num]
                    deviation = pa.array([s if s < 2 ** 63 else None for s in sums], pa.int64())
                white = (num.astype(float) / n) @ turn
                ends = pa.array(np.arange(0, white.size + 1, keep), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), deviation, pa.ListArray.from_arrays(ends, pa.array(white.ravel()))],
                                                 ["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(project, schema)


def whiten(vectors: DataFrame, components: int = 16, scale: int = 64, offset: int = 1_000_000) -> tuple[DataFrame, Whitening | None]:
    """Fit on ``vectors`` and transform them."""
    rows, model = fit_whitening(vectors, components, scale, offset)
    return transform(rows, model), model


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable row of ``embeddings`` on its first 16 components."""
    white, model = whiten(table(spark, sf_dir, "embeddings"))
    shares = [float(e) for e in model.explained] if model else []
    explained = F.array(*[F.lit(e) for e in shares]) if shares else F.expr("cast(array() AS array<double>)")
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error if model else 0.0).cast("double").alias("identity_error"))
