"""Running totals and positions over a GLOBAL order without a single-task window.

A window ``orderBy`` without ``partitionBy`` (or partitioned by a 2-valued
class label) moves every row into one task.  ``running_totals`` instead:

1. cuts the ordering key into ~B quantile buckets (``percentile_approx``; only
   the B-1 edges reach the driver, a bounded list),
2. sums each bucket (a tiny ``groups x B`` table) and turns those sums into
   per-bucket offsets with a window over that tiny table,
3. runs the window inside ``(group, bucket)`` partitions -- B-way parallel and
   balanced because the edges are quantiles -- and adds the broadcast offset.

The result is exact: buckets are monotone in the order, so every row's total
is (all earlier buckets) + (earlier rows of its own bucket).
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark import StorageLevel


def _n_buckets(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def add_bucket(df: DataFrame, key: Column, n_buckets: int | None = None,
               out: str = "_bkt") -> DataFrame:
    """Add a bucket id that is non-decreasing in ``key`` (numeric)."""
    b = _n_buckets(df, n_buckets)
    df = df.withColumn("_bkey", key.cast("double"))
    probs = [i / b for i in range(1, b)]
    row = df.agg(F.percentile_approx("_bkey", probs, 10000).alias("q")).first()
    edges = sorted({float(x) for x in (row["q"] or []) if x is not None and math.isfinite(x)})
    splits = [float("-inf")] + edges + [float("inf")]
    if len(splits) < 3:
        return df.withColumn(out, F.lit(0.0)).drop("_bkey")
    bz = Bucketizer(splits=splits, inputCol="_bkey", outputCol=out, handleInvalid="keep")
    # nulls come first in the order
    return bz.transform(df).withColumn(out, F.when(F.col("_bkey").isNull(), F.lit(-1.0)).otherwise(F.col(out))).drop("_bkey")


def running_totals(df: DataFrame, key: Column, order: list[Column], values: dict[str, Column],
                   groups: list[str] | None = None, descending: bool = False,
                   n_buckets: int | None = None) -> DataFrame:
    """Inclusive running sums of ``values`` (name -> Column) within ``groups``.

    ``key`` is a numeric column that is monotone in ``order`` (it decides the
    bucket); ``order`` must be a total order within each group for the sums to
    be deterministic (collapse ties first, or add tie-break columns).
    With ``descending`` the sums run from the largest key down.

    Every task is bounded at every size.
    """
    groups = list(groups or [])
    # the input is read several times (bucket edges, totals, windows): persist it (memory, spilling to disk) so upstream work runs
    # once; a lost partition is recomputed from its short lineage
    df = df.withColumns({f"_v_{k}": v for k, v in values.items()}).persist(
        StorageLevel.MEMORY_AND_DISK)
    ords = [o.desc() for o in order] if descending else order
    df = add_bucket(df, key, n_buckets)
    tot = df.groupBy(*groups, "_bkt").agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in values])
    bo = F.col("_bkt").desc() if descending else F.col("_bkt").asc()
    w_off = Window.partitionBy(*groups).orderBy(bo).rowsBetween(Window.unboundedPreceding, -1)
    offsets = tot.select(*groups, "_bkt", *[
        F.coalesce(F.sum(f"_t_{k}").over(w_off), F.lit(0)).alias(f"_o_{k}") for k in values])
    w_in = (Window.partitionBy(*groups, "_bkt").orderBy(*ords)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = df.withColumns({f"_l_{k}": F.sum(f"_v_{k}").over(w_in) for k in values})
    # offsets has at most (#groups x #buckets) rows: a bounded broadcast
    # (null is a group as any other)
    ids = groups + ["_bkt"]
    offsets = offsets.select(*[F.col(f"`{c}`").alias(f"_g_{i}") for i, c in enumerate(ids)], *[f"_o_{k}" for k in values])
    match = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"_g_{i}")) for i, c in enumerate(ids)])
    joined = local.join(F.broadcast(offsets), match, "left").drop(*[f"_g_{i}" for i in range(len(ids))])
    out = joined.withColumns({k: F.col(f"_o_{k}") + F.col(f"_l_{k}") for k in values})
    drop = ["_bkt"] + [f"_{p}_{k}" for k in values for p in ("v", "o", "l")]
    return out.drop(*drop)


def md5_key(seed: int, key: Column) -> tuple[Column, Column]:
    """(full md5 hex of ``'<seed>:<key>'``, numeric prefix monotone in that hex)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    prefix = F.conv(F.substring(h, 1, 13), 16, 10).cast("double")  # 52 bits: exact
    return h, prefix


def positions(df: DataFrame, key: Column, order: list[Column], groups: list[str] | None = None,
              out: str = "pos", n_buckets: int | None = None) -> DataFrame:
    """1-based row position within ``groups`` in ``order`` (a scalable row_number)."""
    return running_totals(df, key, order, {out: F.lit(1).cast("long")}, groups, n_buckets=n_buckets)


def quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """(column, q): exact quantiles at ``probs`` (linear interpolation, as
    ``percentile``) of every column that holds a value, from a (column, value,
    count) table and its running counts; no buffer grows with the distinct values."""
    long = (df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
            .unpivot([], columns, "column", "x").where(F.col("x").isNotNull()))
    return group_quantiles(long, ["column"], "x", probs).drop("n")


def group_quantiles(df: DataFrame, groups: list[str], value: str, probs: list[float]) -> DataFrame:
    """(groups, n, q): the same per group for the non-null numbers of one column, ``n`` of them."""
    freq = df.where(F.col(value).isNotNull()).groupBy(*groups, F.col(value).cast("double").alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    return frequency_quantiles(freq, groups, "_x", "_c", probs)


def frequency_quantiles(freq: DataFrame, groups: list[str], value: str, count: str, probs: list[float]) -> DataFrame:
    """The same from a table with one row per group and value, ``count`` times each."""
    freq = freq.select(*groups, F.col(value).alias("_x"), F.col(count).alias("_c"))
    cum = running_totals(freq, F.col("_x"), [F.col("_x")], {"_upto": F.col("_c")}, groups)
    names = [f"_g{i}" for i in range(len(groups))]
    total = freq.groupBy(*[F.col(f"`{g}`").alias(n) for g, n in zip(groups, names)]).agg(F.sum("_c").alias("n"))
    match = reduce(lambda a, b: a & b, [F.col(f"`{g}`").eqNullSafe(F.col(n)) for g, n in zip(groups, names)])
    j = cum.join(total, match).drop(*names)
    at = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]

    def picked(index: Column) -> Column:
        return F.max(F.when((index >= F.col("_upto") - F.col("_c")) & (index < F.col("_upto")), F.col("_x")))

    ends = j.groupBy(*groups).agg(F.max("n").alias("n"), *[picked(F.floor(p)).alias(f"_l{i}") for i, p in enumerate(at)],
                                  *[picked(F.ceil(p)).alias(f"_h{i}") for i, p in enumerate(at)])
    q = [F.when(F.col(f"_l{i}") == F.col(f"_h{i}"), F.col(f"_l{i}"))
         .otherwise((F.ceil(p) - p) * F.col(f"_l{i}") + (p - F.floor(p)) * F.col(f"_h{i}")) for i, p in enumerate(at)]
    return ends.select(*groups, "n", F.array(*q).alias("q"))
