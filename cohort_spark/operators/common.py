"""Small shared building blocks for operators."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a ONE-row frame (a global aggregate) to every row.

    The row is packed into a struct and used as a scalar subquery: Spark runs
    the aggregate once and substitutes its value, so there is no join at all
    (no shuffle of ``df``, no nested-loop or cross product).
    """
    cols = one_row.columns
    packed = one_row.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_one")).scalar()
    return (df.withColumn("_one_row", packed)
              .select("*", *[F.col(f"_one_row.`{c}`").alias(c) for c in cols])
              .drop("_one_row"))


def top_k_per_group(df: DataFrame, groups: list[str], order: list, k: int, rank_col: str = "rank", buckets: int | None = None) -> DataFrame:
    """Exact top-k rows per group: Spark keeps each task's top k of a group before the shuffle
    (a window group limit), so a group's task sees at most k rows of every other task.
    ``order`` must be a total order (add a tie-break).  With ``buckets`` a group is first ranked in
    that many parts, so its last task sees at most k rows of every part.
    """
    from pyspark.sql import Window
    if buckets:
        part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c not in groups]), F.lit(buckets))
        first = Window.partitionBy(*groups, "_part").orderBy(*order)
        df = df.withColumn("_part", part).withColumn("_first", F.row_number().over(first)).where(F.col("_first") <= k).drop("_part", "_first")
    return (df.withColumn(rank_col, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
            .where(F.col(rank_col) <= k))
