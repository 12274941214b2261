"""Categorical encodings used for display and explanations."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col
from .ordered import positions


def factorize(df: DataFrame, columns: list[str], order_key: str, suffix: str = "_code") -> DataFrame:
    """Integer codes by first appearance (the level whose first row, by
    ``order_key``, comes earliest gets 0); null -> -1.

    The level table (column, value, first key) has one row per distinct level;
    codes are scalable positions within each column; each column's codes are
    joined back by value."""
    long = (df.select(F.col(order_key).alias("_k"), *[col(c).cast("string").alias(c) for c in columns])
            .unpivot(["_k"], columns, "column", "value").where(F.col("value").isNotNull()))
    first = long.groupBy("column", "value").agg(F.min("_k").alias("_first"))
    codes = positions(first, F.col("_first"), [F.col("_first"), F.col("value")], ["column"], out="_pos")
    out = df
    for c in columns:
        t = codes.where(F.col("column") == c).select(F.col("value").alias(f"_v_{c}"),
                                                      (F.col("_pos") - 1).cast("int").alias(f"{c}{suffix}"))
        out = (out.join(t, col(c).cast("string") == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
               .withColumn(f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), F.lit(-1))))
    return out
