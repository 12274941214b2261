"""Readers with explicit missing-value modes, and sinks.

Three missing modes exist because the studied pipeline reads the same raw
file three ways:

* ``literal``  -- ``?`` stays a string (contract checks).
* ``pipeline`` -- only ``?`` becomes null; the lab level ``"None"`` is kept.
* ``eda``      -- ``?`` and the usual NA spellings (``None``, ``NA``, ...)
  become null, so an unordered lab test counts as missing.

Schemas are always declared, never inferred.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C

# FIXED VALUES: the default NA spellings of the profiling loader.
EDA_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                 "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                 "n/a", "nan", "null"]

MODES = ("literal", "pipeline", "eda")


def raw_schema(with_score: bool = False) -> T.StructType:
    fields = []
    for c in C.RAW_COLUMNS:
        if c in C.KEY_COLS:
            t = T.LongType()
        elif c in C.INT_RANGES:
            t = T.IntegerType()
        else:
            t = T.StringType()
        fields.append(T.StructField(c, t, True))
    if with_score:
        fields.append(T.StructField("score", T.DoubleType(), True))
    return T.StructType(fields)


def apply_missing_mode(df: DataFrame, mode: str) -> DataFrame:
    """Apply a missing mode to every string column of ``df``."""
    if mode not in MODES:
        raise ValueError(f"unknown missing mode {mode!r}; use one of {MODES}")
    if mode == "literal":
        return df
    tokens = [C.MISSING_TOKEN] + (EDA_NA_TOKENS if mode == "eda" else [])
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    lst = ", ".join("'" + t.replace("'", "\\'") + "'" for t in tokens)
    return df.selectExpr(*[
        f"CASE WHEN `{c}` IN ({lst}) THEN NULL ELSE `{c}` END AS `{c}`" if c in strings else f"`{c}`"
        for c in df.columns])


def normalize_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Intake normalisation (V15): trim, blanks and ``?`` become null."""
    strings = columns or [f.name for f in df.schema.fields
                          if isinstance(f.dataType, T.StringType)]
    out = {}
    for c in strings:
        t = F.trim(F.col(f"`{c}`"))
        out[c] = F.when((t != "") & (t != C.MISSING_TOKEN), F.col(f"`{c}`"))
    return df.withColumns(out)


def read_raw_csv(spark: SparkSession, path: str, mode: str = "pipeline") -> DataFrame:
    """Raw encounter CSV (S1-S3) with a declared schema and a missing mode.  An empty
    string field is an empty string (Spark's reader makes it null, and nothing else), which only
    the ``eda`` mode calls missing; numbers are null where nothing stands."""
    df = (spark.read.schema(raw_schema()).option("header", True)
          .option("mode", "PERMISSIVE").csv(path))
    df = df.fillna("", subset=[f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    return apply_missing_mode(df, mode)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan (S4); with ``columns`` only those are read."""
    df = spark.read.parquet(path)
    return df.select([F.col(f"`{c}`") for c in columns]) if columns else df


def request_schema() -> T.StructType:
    """The 44-field request record (raw minus keys, label and dropped columns)."""
    excluded = set(C.KEY_COLS) | {C.TARGET_RAW} | set(C.DROPPED_IN_CLEANING)
    fields = [f for f in raw_schema().fields if f.name not in excluded]
    return T.StructType(fields)


def read_records_json(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """JSON request records (S10), one object per line, declared schema.

    The raw line is kept in ``_raw`` so unknown extra fields can be detected.
    """
    reader = spark.readStream if streaming else spark.read
    lines = reader.format("text").load(path)
    parsed = F.from_json("value", request_schema())
    return lines.select(F.col("value").alias("_raw"), parsed.alias("r")).select("_raw", "r.*")


# ------------------------------------------------------------------- sinks
def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def append_audit(df: DataFrame, path: str) -> None:
    """Append-only audit sink (S9): one JSON line per scored record."""
    df.write.mode("append").json(path)
