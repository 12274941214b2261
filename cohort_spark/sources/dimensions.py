"""Small fixed dimension tables (decoders, column families, code groups).

Their size is fixed by the contract (tens of rows), so broadcasting them is
always safe.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C


def decoder_table(spark: SparkSession) -> DataFrame:
    """(column, code, label) for the three coded id columns."""
    rows = [(col, int(code), label) for col, mapping in C.ID_DECODERS.items()
            for code, label in mapping.items()]
    return spark.createDataFrame(rows, "column string, code int, label string")


def family_table(spark: SparkSession) -> DataFrame:
    """(column, family) taxonomy."""
    rows = [(c, fam) for fam, cols in C.COLUMN_FAMILY.items() for c in cols]
    return spark.createDataFrame(rows, "column string, family string")


def chapter_order_table(spark: SparkSession) -> DataFrame:
    rows = [(name, i) for i, name in enumerate(C.ICD9_CHAPTER_ORDER)]
    return spark.createDataFrame(rows, "chapter string, chapter_order int")


def drop_disposition_table(spark: SparkSession) -> DataFrame:
    """(code, label, kind) for expired / hospice dispositions."""
    rows = []
    for code in C.EXPIRED_IDS + C.HOSPICE_IDS:
        kind = "expired" if code in C.EXPIRED_IDS else "hospice"
        rows.append((code, C.DISCHARGE_DISPOSITION_LABELS.get(code, str(code)), kind))
    return spark.createDataFrame(rows, "code int, label string, kind string")


def decode_ids(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Add ``<col>_label`` per coded id; unknown codes -> ``Unknown code N``.

    The decoder is a fixed ~60-row table, so the lookup is a broadcast join.
    """
    spark = df.sparkSession
    dec = decoder_table(spark)
    for c in columns or C.ADMINISTRATIVE_ID_COLS:
        d = F.broadcast(dec.where(F.col("column") == c)
                        .select(F.col("code").alias(f"_{c}_code"),
                                F.col("label").alias(f"_{c}_label")))
        df = (df.join(d, df[c] == d[f"_{c}_code"], "left")
              .withColumn(f"{c}_label", F.coalesce(
                  F.col(f"_{c}_label"),
                  F.when(F.col(c).isNotNull(),
                         F.concat(F.lit("Unknown code "), F.col(c).cast("string")))))
              .drop(f"_{c}_code", f"_{c}_label"))
    return df
