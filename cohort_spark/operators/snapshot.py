"""The reference side of drift as a written, mergeable snapshot.

``freq`` has one row per (column, value) with its count, null a value as any other; everything
else follows from it: ``facts`` has per column its kind, rows, missing rows, distinct values,
standard deviation and PSI edges.  Two snapshots merge by adding counts, so a reference can grow
by parts; batches and micro-batches read the snapshot and never the reference rows.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions.columns import col
from .ordered import frequency_quantiles

NUMERIC, CATEGORY = "numeric", "category"


@dataclass
class Snapshot:
    """``freq``: column, value, x (its number, null for categories), n.  ``facts``: column, kind,
    rows, missing, n_values, std, edges (inner PSI edges; null where values are categories)."""

    freq: DataFrame
    facts: DataFrame

    def kinds(self) -> dict[str, str]:
        """Column -> kind (one row a column)."""
        return {r["column"]: r["kind"] for r in self.facts.select("column", "kind").collect()}

    def varying(self) -> list[str]:
        """Columns with more than one level, null counted as one."""
        more = F.col("n_values") + F.when(F.col("missing") > 0, 1).otherwise(0) > 1
        return sorted(r["column"] for r in self.facts.where(more).select("column").collect())


def kinds_of(df: DataFrame, columns: list[str]) -> dict[str, str]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return {c: NUMERIC if isinstance(types[c], T.NumericType) else CATEGORY for c in columns}


def frequencies(frames: dict[str, DataFrame], kinds: dict[str, str]) -> DataFrame:
    """(batch, column, value, n) of the columns of ``kinds`` in every frame, by its name: one pass
    and one map-side combined aggregation.  Numbers stand as the string of their double, NaN as
    null; a column that a frame lacks is null throughout."""
    def shown(df: DataFrame, c: str) -> Column:
        if c not in df.columns:
            return F.lit(None).cast("string")
        x = col(c).cast("double") + F.lit(0.0)  # one zero
        return (F.when(~F.isnan(x), x) if kinds[c] == NUMERIC else col(c)).cast("string")

    wide = [df.select(F.lit(name).alias("__batch"), *[shown(df, c).alias(c) for c in kinds]) for name, df in frames.items()]
    long = reduce(DataFrame.unionByName, wide).unpivot(["__batch"], list(kinds), "column", "value")
    return long.groupBy(F.col("__batch").alias("batch"), "column", "value").agg(F.count(F.lit(1)).alias("n"))


def with_numbers(freq: DataFrame, kinds: dict[str, str]) -> DataFrame:
    numeric = [c for c, k in kinds.items() if k == NUMERIC]
    return freq.withColumn("x", F.when(F.col("column").isin(*numeric), F.col("value").cast("double")))


def facts_of(freq: DataFrame, kinds: dict[str, str], bins: int = C.PSI_BINS) -> DataFrame:
    """``facts`` of a frequency table (one row a column)."""
    held = F.col("value").isNotNull()
    g = freq.groupBy("column").agg(
        F.sum("n").alias("rows"), F.sum(F.when(held, 0).otherwise(F.col("n"))).alias("missing"), F.count("value").alias("n_values"),
        (F.sum(F.col("n") * F.col("x")) / F.sum(F.when(F.col("x").isNotNull(), F.col("n")))).alias("mean"))
    # centred before squaring; one row a column is joined back
    spread = freq.join(F.broadcast(g.select(F.col("column").alias("_c"), "mean")), F.col("column") == F.col("_c")).where(F.col("x").isNotNull())
    spread = spread.groupBy("column").agg(F.sqrt(F.sum(F.col("n") * (F.col("x") - F.col("mean")) * (F.col("x") - F.col("mean"))) / F.sum("n")).alias("std"))
    probs = [i / bins for i in range(bins + 1)]
    numbers = freq.where(F.col("x").isNotNull())
    edges = frequency_quantiles(numbers, ["column"], "x", "n", probs).select("column", F.array_distinct("q").alias("e"))
    edges = edges.select("column", F.slice("e", 2, F.greatest(F.size("e") - 2, F.lit(0))).alias("inner"))
    kind = F.create_map(*[F.lit(v) for p in kinds.items() for v in p])[F.col("column")]
    out = g.join(spread, "column", "left").join(edges, "column", "left")
    return out.select("column", kind.alias("kind"), "rows", "missing", "n_values", "std",
                      F.when(F.col("n_values") > bins, F.col("inner")).alias("edges"))


def write_snapshot(freq: DataFrame, kinds: dict[str, str], path: str) -> Snapshot:
    path = path.rstrip("/")
    freq.write.mode("overwrite").parquet(f"{path}/freq")
    stored = freq.sparkSession.read.parquet(f"{path}/freq")
    facts_of(stored, kinds).coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")
    return read_snapshot(freq.sparkSession, path)


def take_snapshot(reference: DataFrame, columns: list[str], path: str) -> Snapshot:
    """Snapshot of ``columns`` of the reference rows, written to ``path``."""
    kinds = kinds_of(reference, columns)
    return write_snapshot(with_numbers(frequencies({"": reference}, kinds).drop("batch"), kinds), kinds, path)


def read_snapshot(spark: SparkSession, path: str) -> Snapshot:
    path = path.rstrip("/")
    return Snapshot(spark.read.parquet(f"{path}/freq"), spark.read.parquet(f"{path}/facts"))


def merge_snapshots(a: Snapshot, b: Snapshot, path: str) -> Snapshot:
    """The snapshot of both references' rows, written to a new ``path``."""
    kinds = a.kinds()
    if kinds != b.kinds():
        raise ValueError("the snapshots are not of the same columns")
    both = a.freq.unionByName(b.freq).groupBy("column", "value").agg(F.max("x").alias("x"), F.sum("n").alias("n"))
    return write_snapshot(both, kinds, path)
