"""Deterministic splits, folds and samples, plus the set operations around them.

Random order is a salted hash, ``md5('<seed>:<key>')``, so a split is
reproducible across runs, engines and cluster sizes.  Exact per-class sizes
use the scalable running count (``ordered.positions``), never a window over a
two-valued label (that would put each class in one task).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .ordered import md5_key, positions


def _class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))


def stratified_split(df: DataFrame, key: str, label: str = C.TARGET, seed: int = C.SPLIT_SEED,
                     test_frac: float = C.TEST_FRACTION, mode: str = "exact") -> DataFrame:
    """Add ``split`` ('train'/'test').

    ``exact``: within each class the first ceil(n_c·f) rows in hash order are
    test (scalable running count); rows without a label are a class of their own.
    ``hash``: a row is test when its salted hash falls below ``f`` -- no
    shuffle at all, class shares are binomial around ``f`` (recommended for very
    large tables); both are deterministic and disjoint."""
    if mode == "hash":
        return df.withColumn("split", F.when(hash_fraction(key, seed, test_frac), "test")
                             .otherwise("train"))
    h, pre = md5_key(seed, F.col(key))
    d = positions(df.withColumns({"_h": h, "_hp": pre}), F.col("_hp"), [F.col("_h")],
                  groups=[label], out="_pos")
    counts = _class_counts(df, label).withColumnRenamed(label, "_label")
    d = d.join(counts, d[label].eqNullSafe(counts["_label"])).drop("_label")
    is_test = F.col("_pos") <= F.ceil(F.col("_nc") * F.lit(test_frac))
    return (d.withColumn("split", F.when(is_test, "test").otherwise("train"))
            .drop("_h", "_hp", "_pos", "_nc"))


def stratified_folds(df: DataFrame, key: str, label: str = C.TARGET, k: int = C.N_FOLDS,
                     seed: int = C.SPLIT_SEED) -> DataFrame:
    """Add ``fold`` in 0..k-1: hash order within class, dealt round-robin, so
    every fold holds floor or ceil of n_c/k rows of each class."""
    h, pre = md5_key(seed, F.col(key))
    d = positions(df.withColumns({"_h": h, "_hp": pre}), F.col("_hp"), [F.col("_h")],
                  groups=[label], out="_pos")
    return d.withColumn("fold", ((F.col("_pos") - 1) % k).cast("int")).drop("_h", "_hp", "_pos")


def hash_fraction(key: str, seed, frac: float):
    """True for about ``frac`` of keys: the first 8 hex digits of the salted md5
    as a number in [0, 1)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    u = F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return u < F.lit(frac)


def sample_n(df: DataFrame, key: str, n: int, seed: int = C.SPLIT_SEED) -> DataFrame:
    """n rows without replacement, in salted-hash order (a top-n: per-partition
    top-n, then a merge of n x partitions rows)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h").limit(n).drop("_h")


def heldout_rows(raw: DataFrame, split: DataFrame, key: str = "encounter_id") -> DataFrame:
    """Raw rows whose key is in the test split (left semi join)."""
    test_ids = split.where(F.col("split") == "test").select(key)
    return raw.join(test_ids.hint("merge"), key, "left_semi")  # keys grow with the rows: no broadcast


def train_minus_test(all_rows: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Training rows = all rows without the test keys (left anti join)."""
    return all_rows.join(test.select(key).hint("merge"), key, "left_anti")


def shared_entities(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Entities present on both sides (INTERSECT of distinct keys)."""
    return a.select(key).intersect(b.select(key))
