"""Row filters, column cleaning, first-encounter dedup and the cleaning report.

Order matters and is kept: row filters run before dedup, so the "first"
encounter is the first *surviving* one; column fills run after dedup.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions.columns import col, order_keys_first, round_half_up


# ------------------------------------------------------------------ P1, P2
def bad_gender(gender: Column) -> Column:
    """True when the row must go: not Male/Female (null goes too)."""
    return ~F.coalesce(gender.isin(*C.VALID_GENDERS), F.lit(False))


def expired_or_hospice(disp: Column) -> Column:
    """True for expired/hospice codes; a null code is kept (not dropped)."""
    return F.coalesce(disp.isin(*C.EXPIRED_HOSPICE_IDS), F.lit(False))


def filter_gender(df: DataFrame) -> DataFrame:
    return df.where(~bad_gender(F.col("gender")))


def filter_disposition(df: DataFrame) -> DataFrame:
    return df.where(~expired_or_hospice(F.col("discharge_disposition_id")))


# ------------------------------------------------------------------ P3-P6, P10
def lab_not_measured(c: Column) -> Column:
    return F.when(c == "None", F.lit("NotMeasured")).otherwise(c)


def clean_columns(df: DataFrame) -> DataFrame:
    """Column-level cleaning shared by batch, single record and stream (P10)."""
    df = df.drop(*[c for c in C.DROPPED_IN_CLEANING if c in df.columns])
    fixes = {c: lab_not_measured(col(c)) for c in C.LAB_COLS if c in df.columns}
    fixes.update({c: F.coalesce(col(c), F.lit("Unknown"))
                  for c in C.MISSING_AS_UNKNOWN if c in df.columns})
    return df.withColumns(fixes)


def binary_target(readmitted: Column) -> Column:
    return F.coalesce(readmitted == C.POSITIVE_LABEL, F.lit(False)).cast("byte")


# ------------------------------------------------------------------ W1
def first_encounter(df: DataFrame, mode: str = "coalesce", key: str = "patient_nbr",
                    order: str = "encounter_id") -> DataFrame:
    """One row per entity, earliest by ``order``.

    ``coalesce`` (parity with the studied pipeline): every column takes its
    first NON-NULL value in encounter order, so later visits can fill gaps.
    ``row``: the earliest row as a whole.

    Both are hash aggregates with ``min_by`` (partial + final), so a patient
    holding a large share of rows is combined map-side; no per-patient sort
    and no single hot task.  Null keys are dropped, as a group-by does.
    """
    others = [c for c in df.columns if c not in (key, order)]
    keyed = df.where(F.col(key).isNotNull())
    if mode == "coalesce":
        aggs = [F.min(order).alias(order)] + [
            F.min_by(col(c), F.when(col(c).isNotNull(), F.col(order))).alias(c)
            for c in others]
        out = keyed.groupBy(key).agg(*aggs)
    elif mode == "row":
        packed = F.struct(*[col(c) for c in [order] + others])
        out = keyed.groupBy(key).agg(F.min_by(packed, F.col(order)).alias("_r"))
        out = out.select(F.col(key), *[F.col(f"_r.`{c}`").alias(c) for c in [order] + others])
    else:
        raise ValueError("mode must be 'coalesce' or 'row'")
    return out.select([col(c) for c in df.columns])


# ------------------------------------------------------------------ full pass
def clean(df: DataFrame, dedup: str = "coalesce") -> DataFrame:
    """Raw (pipeline missing mode) -> clean table: filters, dedup, fills, target."""
    df = filter_disposition(filter_gender(df))
    df = first_encounter(df, dedup)
    df = clean_columns(df)
    df = df.withColumn(C.TARGET, binary_target(F.col(C.TARGET_RAW))).drop(C.TARGET_RAW)
    return order_keys_first(df)


def clean_report(raw: DataFrame, key: str = "patient_nbr",
                 order: str = "encounter_id") -> DataFrame:
    """Stepwise row counts of the cleaning pass in ONE shuffle.

    Per patient: raw rows, rows dropped by each rule, surviving rows and the
    first non-null surviving label; then a global sum over patients.
    """
    bad = bad_gender(F.col("gender"))
    dead = ~bad & expired_or_hospice(F.col("discharge_disposition_id"))
    kept = ~bad & ~dead
    per = raw.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_raw"),
        F.sum(bad.cast("int")).alias("n_bad"),
        F.sum(dead.cast("int")).alias("n_dead"),
        F.sum(kept.cast("int")).alias("n_kept"),
        F.min_by(F.col(C.TARGET_RAW),
                 F.when(kept & F.col(C.TARGET_RAW).isNotNull(), F.col(order))).alias("label"),
    )
    survivor = (F.col("n_kept") > 0) & F.col(key).isNotNull()
    tgt = binary_target(F.col("label")).cast("double")
    n_cols = len([c for c in raw.columns if c not in C.DROPPED_IN_CLEANING])
    return per.agg(
        F.sum("n_raw").alias("rows_raw"),
        F.sum("n_bad").alias("rows_dropped_bad_gender"),
        F.sum("n_dead").alias("rows_dropped_expired_hospice"),
        F.sum("n_kept").alias("rows_after_discharge_filter"),
        F.count_if(survivor).alias("rows_after_first_encounter_dedup"),
        F.count_if(survivor).alias("rows_final"),
        F.lit(n_cols).alias("cols_final"),
        round_half_up(F.avg(F.when(survivor, tgt)), 4).alias("pos_rate"),
        F.count_if(survivor).alias("unique_patients"),
    )


# ------------------------------------------------------------------ P12, P13
def role_split(df: DataFrame, exclude=(*C.KEY_COLS, C.TARGET)) -> DataFrame:
    """(column, role, n_present): strings are categorical, numbers numeric; with the rows that have
    a value, in one aggregation."""
    kept = [f for f in df.schema.fields if f.name not in exclude]
    roles = {f.name: "categorical" if isinstance(f.dataType, T.StringType) else "numeric" for f in kept}
    return labelled_counts(df, roles, "role")


def labelled_counts(df: DataFrame, labels: dict[str, str], name: str) -> DataFrame:
    """(column, ``name``, n_present) of the columns that ``labels`` names."""
    one = df.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(labels)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(v).alias(name), F.col(f"n{i}").alias("n_present"))
                                          for i, (c, v) in enumerate(labels.items())])).alias("r")).select("r.*")


def zero_variance_columns(df: DataFrame, exclude=(*C.KEY_COLS, C.TARGET)) -> DataFrame:
    """Columns with at most one level on ``df`` (null counts as a level).

    min/max/count per column in one aggregation: O(1) state per column, no
    distinct-count expansion.
    """
    cols = [c for c in df.columns if c not in exclude]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs += [F.count(col(c)).alias(f"n{i}"), F.min(col(c)).alias(f"lo{i}"),
                 F.max(col(c)).alias(f"hi{i}")]
    one = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        nn, lo, hi = F.col(f"n{i}"), F.col(f"lo{i}"), F.col(f"hi{i}")
        has_null = (nn < F.col("_n")).cast("int")
        distinct_ge2 = F.when(nn == 0, 0).when(lo == hi, 1).otherwise(2)
        rows.append(F.struct(F.lit(c).alias("column"),
                             (distinct_ge2 + has_null <= 1).alias("constant")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# ------------------------------------------------------------------ P15, P16
def topk_other(df: DataFrame, column: str, k: int = C.TOP_LEVELS,
               out: str | None = None) -> DataFrame:
    """null -> «missing»; keep the k most frequent levels, the rest -> «other».

    Frequencies are one hash aggregate; the kept-level list has at most k rows,
    so it is broadcast.  Ties are broken by level text.
    """
    out = out or column
    lvl = F.coalesce(col(column).cast("string"), F.lit(C.MISSING_LEVEL))
    counts = df.groupBy(lvl.alias("_lvl")).count()
    top = (counts.orderBy(F.desc("count"), F.asc("_lvl")).limit(k)
           .select("_lvl", F.lit(True).alias("_keep")))
    joined = df.withColumn("_lvl", lvl).join(F.broadcast(top), "_lvl", "left")
    return (joined.withColumn(out, F.when(F.col("_keep"), F.col("_lvl"))
                              .otherwise(F.lit(C.OTHER_LEVEL)))
            .drop("_lvl", "_keep"))


def missing_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({f"{c}_missing": col(c).isNull().cast("int") for c in columns})
