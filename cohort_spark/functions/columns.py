"""Deterministic feature and scoring expressions, all native Columns.

Each function returns a Column (or a ``DataFrame -> DataFrame`` transform
named ``add_*``) so the same code serves a batch table, a single record and a
streaming frame.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.common import attach_row
from .icd9 import bucket_icd9


def col(name: str) -> Column:
    """Column by name, safe for hyphenated names (``glyburide-metformin``)."""
    return F.col(f"`{name}`")


def map_lookup(c: Column, mapping: dict, default=None) -> Column:
    """Literal-map lookup (``create_map`` is evaluated inside codegen)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    looked = F.try_element_at(F.create_map(*pairs), c)
    return looked if default is None else F.coalesce(looked, F.lit(default))


def count_true(conds: list[Column]) -> Column:
    """Number of true conditions; a null condition counts as false."""
    return reduce(lambda a, b: a + b,
                  [F.coalesce(c, F.lit(False)).cast("int") for c in conds])


def round_half_up(c: Column, digits: int) -> Column:
    """Round to ``digits`` decimals as floor(x*10^d + 0.5)/10^d (engine independent)."""
    scale = float(10 ** digits)
    return (F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both sides are non-null; null when a
    side has no variance (Spark's ``corr`` raises divide-by-zero under ANSI)."""
    both = a.isNotNull() & b.isNotNull()
    a2, b2 = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(a2, b2), F.stddev_pop(a2) * F.stddev_pop(b2))


def pearson_pairs(df: DataFrame, pairs: list[tuple[str, str]], digits: int | None = 3) -> DataFrame:
    """(a, b, corr) for the given column pairs, each over the rows where both sides are present.

    Rows are grouped by which columns they hold; within such a group every pair has the same rows,
    so it takes one sum a column and one product a pair (a row costs no more for nulls).  Values are
    centred on their column's mean first, so a large mean does not cancel; a side without variance
    gives null.
    """
    cols = list(dict.fromkeys(c for pr in pairs for c in pr))
    at = {c: i for i, c in enumerate(cols)}
    x = df.select(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    finite = lambda c: F.when(F.abs(c) < float("inf"), c)  # noqa: E731  false for NaN as well
    means = x.agg(*[F.coalesce(F.avg(finite(F.col(f"x{i}"))), F.lit(0.0)).alias(f"m{i}") for i in range(len(cols))])
    held = [f"h{i}" for i in range(len(cols))]
    d = attach_row(x, means).select(*[F.col(f"x{i}").isNotNull().alias(h) for i, h in enumerate(held)],
                                    *[F.coalesce(F.col(f"x{i}") - F.col(f"m{i}"), F.lit(0.0)).alias(f"d{i}") for i in range(len(cols))])
    crossed = dict.fromkeys([(i, i) for i in range(len(cols))] + [tuple(sorted((at[a], at[b]))) for a, b in pairs])
    g = d.groupBy(*held).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"d{i}").alias(f"s{i}") for i in range(len(cols))],
        *[F.min(f"d{i}").alias(f"lo{i}") for i in range(len(cols))], *[F.max(f"d{i}").alias(f"hi{i}") for i in range(len(cols))],
        *[F.sum(F.col(f"d{i}") * F.col(f"d{j}")).alias(f"p{i}_{j}") for i, j in crossed])
    # one row per set of present columns; a pair adds up those that hold both sides
    parts = F.explode(F.array(*[F.struct(
        F.lit(k).alias("k"), (F.col(f"h{i}") & F.col(f"h{j}")).alias("both"), "n",
        *[F.col(name).alias(out) for out, name in (
            ("sa", f"s{i}"), ("sb", f"s{j}"), ("la", f"lo{i}"), ("ha", f"hi{i}"), ("lb", f"lo{j}"), ("hb", f"hi{j}"),
            ("aa", f"p{i}_{i}"), ("bb", f"p{j}_{j}"), ("ab", "p{}_{}".format(*sorted((i, j)))))])
        for k, (i, j) in enumerate((at[a], at[b]) for a, b in pairs)]))
    t = g.select(parts.alias("r")).select("r.*").where("both").groupBy("k").agg(
        *[F.sum(c).alias(c) for c in ("n", "sa", "sb", "aa", "bb", "ab")],
        *[F.min(c).alias(c) for c in ("la", "lb")], *[F.max(c).alias(c) for c in ("ha", "hb")])
    va, vb = (F.col(q) - F.col(s) * F.col(s) / F.col("n") for q, s in (("aa", "sa"), ("bb", "sb")))
    varies = (F.col("la") != F.col("ha")) & (F.col("lb") != F.col("hb"))
    r = F.when(varies, F.try_divide(F.col("ab") - F.col("sa") * F.col("sb") / F.col("n"), F.sqrt(va) * F.sqrt(vb)))
    named = df.sparkSession.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    return (named.join(F.broadcast(t.select("k", r.alias("r"))), "k", "left")  # one row a pair
            .select("a", "b", (round_half_up(F.col("r"), digits) if digits is not None else F.col("r")).alias("corr")))


# --------------------------------------------------------------------- F3
def add_diagnosis_features(df: DataFrame) -> DataFrame:
    buckets = {c: bucket_icd9(col(c)) for c in C.DIAG_COLS}
    df = df.withColumns({f"{c}_bucket": b for c, b in buckets.items()})
    is_diab = [F.col(f"{c}_bucket") == "Diabetes" for c in C.DIAG_COLS]
    df = df.withColumns({
        "diabetes_primary": is_diab[0].cast("byte"),
        "n_diabetes_diag": count_true(is_diab).cast("byte"),
    })
    return df.drop(*C.DIAG_COLS)


# --------------------------------------------------------------------- F4-F6
def n_med_changes(drugs=C.MODEL_DRUGS) -> Column:
    return count_true([col(d).isin(*C.MED_CHANGE_LEVELS) for d in drugs]).cast("byte")


def n_meds_used(drugs=C.MODEL_DRUGS) -> Column:
    return count_true([col(d) != "No" for d in drugs]).cast("byte")


def drug_ordinal(c: Column) -> Column:
    """No 0, Down 1, Steady 2, Up 3; an unknown label gives null (caught by V16)."""
    return map_lookup(c, C.DRUG_ORDINAL).cast("byte")


def add_medication_features(df: DataFrame, drugs=C.MODEL_DRUGS) -> DataFrame:
    df = df.withColumns({"n_med_changes": n_med_changes(drugs),
                         "n_meds_used": n_meds_used(drugs)})
    return df.withColumns({d: drug_ordinal(col(d)) for d in drugs})


# --------------------------------------------------------------------- F7-F8
def a1c_state(a1c: Column, change: Column) -> Column:
    high = a1c.isin(*C.A1C_HIGH_LEVELS)
    changed = F.coalesce(change == "Ch", F.lit(False))
    return (F.when(high & changed, "high_changed")
            .when(high & ~changed, "high_not_changed")
            .when(a1c == "Norm", "normal")
            .otherwise("no_test"))


def add_lab_features(df: DataFrame) -> DataFrame:
    a1c, glu = F.col("A1Cresult"), F.col("max_glu_serum")
    return df.withColumns({
        "a1c_measured": F.coalesce(a1c.isin(*C.A1C_MEASURED_LEVELS), F.lit(False)).cast("byte"),
        "glu_measured": F.coalesce(glu.isin(*C.GLU_MEASURED_LEVELS), F.lit(False)).cast("byte"),
        "a1c_state": a1c_state(a1c, F.col("change")),
    })


# --------------------------------------------------------------------- F9-F10
def add_utilization_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "service_utilization": (F.col("number_outpatient") + F.col("number_emergency")
                                + F.col("number_inpatient")).cast("int"),
        "inpatient_ge_2": (F.col("number_inpatient") >= 2).cast("byte"),
    })


# --------------------------------------------------------------------- F11-F16, F19-F20
def age_midpoint(age: Column) -> Column:
    """``[60-70)`` -> 65."""
    return (F.regexp_extract(age, r"\[(\d+)-", 1).try_cast("int") + 5).cast("short")


def age_bucket(mid: Column) -> Column:
    return F.when(mid < 30, "[0-30)").when(mid < 60, "[30-60)").when(mid >= 60, "[60-100)")


def age_ordinal(age: Column) -> Column:
    """Position 0-9 in the decade order, null when unknown."""
    pos = F.array_position(F.array(*[F.lit(a) for a in C.AGE_ORDER]), age)
    return F.when(pos > 0, (pos - 1).cast("int"))


def age_band_10yr(mid: Column) -> Column:
    low = mid.cast("int") - 5
    return F.concat(F.lit("["), low.cast("string"), F.lit("-"),
                    (low + 10).cast("string"), F.lit(")"))


def add_demographic_features(df: DataFrame) -> DataFrame:
    df = df.withColumn("age_midpoint", age_midpoint(F.col("age")))
    disp = F.col("discharge_disposition_id")
    df = df.withColumns({
        "age_bucket": age_bucket(F.col("age_midpoint")),
        "admission_type_grp": map_lookup(F.col("admission_type_id"),
                                         C.ADMISSION_TYPE_GROUP, "Unknown"),
        "admission_source_grp": map_lookup(F.col("admission_source_id"),
                                           C.ADMISSION_SOURCE_GROUP, "Unknown"),
        "discharge_disposition_grp": map_lookup(disp, C.DISCHARGE_DISPOSITION_GROUP,
                                                "Unknown"),
        "discharged_home": F.coalesce(disp.isin(*C.DISCHARGED_HOME_CODES),
                                      F.lit(False)).cast("byte"),
    })
    return df.drop("age", "admission_type_id", "admission_source_id",
                   "discharge_disposition_id")


# --------------------------------------------------------------------- F17
def engineer_features(df: DataFrame) -> DataFrame:
    """The full deterministic feature composition (batch, record and stream)."""
    return (df.transform(add_diagnosis_features)
              .transform(add_medication_features)
              .transform(add_lab_features)
              .transform(add_utilization_features)
              .transform(add_demographic_features))


def order_keys_first(df: DataFrame, target: str = C.TARGET) -> DataFrame:
    keys = [k for k in C.KEY_COLS if k in df.columns]
    tail = [target] if target in df.columns else []
    mid = [c for c in df.columns if c not in keys + tail]
    return df.select([col(c) for c in keys + mid + tail])


def reindex(df: DataFrame, columns: list[str], types: dict | None = None) -> DataFrame:
    """Select exactly ``columns`` in order; a column the frame lacks becomes a
    typed null (the model frame of a record with absent fields)."""
    present = set(df.columns)
    types = types or {}
    return df.select(*[col(c) if c in present else F.lit(None).cast(types.get(c, "string")).alias(c)
                       for c in columns])


# --------------------------------------------------------------------- F23-F25
def risk_band(prob: Column, threshold: float) -> Column:
    return (F.when(prob >= threshold, "HIGH")
            .when(prob >= C.MODERATE_RISK, "MODERATE").otherwise("LOW"))


def verdict(flag: Column, label: Column) -> Column:
    f = F.coalesce(flag.cast("boolean"), F.lit(False))
    y = F.coalesce(label.cast("boolean"), F.lit(False))
    return (F.when(f & y, "TP").when(~f & ~y, "TN").when(f & ~y, "FP").otherwise("FN"))


def score_flag(prob: Column, threshold: float) -> tuple[Column, Column]:
    """(rounded probability for display, flag from the UNROUNDED probability)."""
    return round_half_up(prob, 6), prob >= F.lit(threshold)


# --------------------------------------------------------------------- A24
def wilson_ci(k: Column, n: Column, z: float = C.WILSON_Z) -> tuple[Column, Column]:
    """Wilson score interval, clamped to [0, 1]; n = 0 gives (0, 0)."""
    nd = n.cast("double")
    p = k.cast("double") / nd
    z2 = F.lit(z * z)
    denom = F.lit(1.0) + z2 / nd
    center = (p + z2 / (F.lit(2.0) * nd)) / denom
    half = F.lit(z) * F.sqrt(p * (F.lit(1.0) - p) / nd + z2 / (F.lit(4.0) * nd * nd)) / denom
    lo = F.when(n == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), center - half))
    hi = F.when(n == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), center + half))
    return lo, hi
