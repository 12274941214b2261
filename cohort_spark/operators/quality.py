"""Data-quality suites, row-level contract enforcement and guards.

A suite is a list of checks.  Every value check of a suite is evaluated in
ONE aggregation pass (``sum(violation)`` per check); the only other job is a
grouped count for uniqueness checks.  Results come back as a check table
``(suite, check, column, n_unexpected, success)``.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions.columns import col
from .common import attach_row


@dataclass
class Check:
    name: str                      # columns_match | row_count | in_set | not_null | between
    column: str | None = None      # | column_count | unique | mean_between
    values: list = field(default_factory=list)
    lo: float | None = None
    hi: float | None = None


@dataclass(frozen=True)
class Field:
    """One declared column; suites, contract rows and row rules are all read off it."""

    name: str
    levels: list | None = None             # allowed values
    bounds: tuple[int, int] | None = None  # inclusive integer range
    mean: tuple[float, float] | None = None
    nullable: bool = False                 # may be the missing token
    required: bool = False                 # a null breaks the table's suite
    unique: bool = False
    request: bool = False                  # part of a scoring request

    @property
    def kind(self) -> str:
        return "categorical" if self.levels else "integer" if self.bounds else "string"

    def checks(self) -> list[Check]:
        """The table checks this declaration stands for."""
        token = [C.MISSING_TOKEN] if self.nullable else []
        stated = {
            "unique": self.unique and Check("unique", self.name),
            "not_null": self.required and Check("not_null", self.name),
            "in_set": self.levels and Check("in_set", self.name, self.levels + token),
            "between": self.bounds and Check("between", self.name, lo=self.bounds[0], hi=self.bounds[1]),
            "mean": self.mean and Check("mean_between", self.name, lo=self.mean[0], hi=self.mean[1])}
        return [c for c in stated.values() if c]


def raw_fields() -> list[Field]:
    """The raw table, column by column."""
    levels = C.CATEGORICAL_VALUES | dict.fromkeys(C.ALL_DRUGS, C.DRUG_VALUES) | {C.TARGET_RAW: C.READMITTED_VALUES}
    outside = {*C.KEY_COLS, *C.DROPPED_IN_CLEANING, C.TARGET_RAW}
    return [Field(c, levels=levels.get(c), bounds=C.INT_RANGES.get(c), nullable=c in C.NULLABLE,
                  required=c == "gender", request=c not in outside) for c in C.RAW_COLUMNS]


def featurized_fields() -> list[Field]:
    """The declared columns of the featurized table."""
    levels = {C.TARGET: [0, 1], "a1c_state": C.A1C_STATE_VALUES, "age_bucket": C.AGE_BUCKET_VALUES,
              **{f"{d}_bucket": C.DIAG_BUCKETS for d in C.DIAG_COLS}}
    return [Field(c, levels=levels.get(c), unique=c == "patient_nbr", required=c in C.ENGINEERED_FEATURES,
                  mean=C.POS_RATE_RANGE if c == C.TARGET else None)
            for c in ("patient_nbr", C.TARGET, *C.ENGINEERED_FEATURES)]


def suite_of(fields: list[Field], *table_checks: Check) -> list[Check]:
    return [*table_checks, *(c for f in fields for c in f.checks())]


def raw_suite() -> list[Check]:
    """Checks on the raw table read literally (``?`` kept as a string)."""
    return suite_of(raw_fields(), Check("columns_match", values=C.RAW_COLUMNS), Check("row_count", lo=1))


def processed_suite() -> list[Check]:
    """Checks on the featurized table."""
    return suite_of(featurized_fields(), Check("column_count", lo=C.N_FEATURIZED_COLUMNS), Check("row_count", lo=1))


def _violation(chk: Check) -> Column | None:
    c = col(chk.column) if chk.column else None
    if chk.name == "in_set":          # nulls are ignored by value-set checks
        return c.isNotNull() & ~c.isin(*chk.values)
    if chk.name == "between":
        return c.isNotNull() & ~c.between(chk.lo, chk.hi)
    if chk.name == "not_null":
        return c.isNull()
    return None


def run_suite(df: DataFrame, checks: list[Check], suite: str = "suite") -> DataFrame:
    """Evaluate ``checks`` on ``df``; one aggregation for all value checks."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, chk in enumerate(checks):
        v = _violation(chk)
        if v is not None:
            aggs.append(F.sum(F.when(v, 1).otherwise(0)).cast("long").alias(f"v{i}"))
        elif chk.name == "mean_between":
            aggs.append(F.avg(col(chk.column).cast("double")).alias(f"m{i}"))
    one = df.agg(*aggs)
    cols = set(df.columns)
    entries = []
    for i, chk in enumerate(checks):
        column = F.lit(chk.column).cast("string")
        if chk.name == "columns_match":
            missing = len(set(chk.values) - cols)
            extra = len(cols - set(chk.values))
            n_bad = F.lit(missing + extra).cast("long")
            ok = F.lit(missing + extra == 0)
        elif chk.name == "column_count":
            n_bad = F.lit(abs(len(df.columns) - int(chk.lo))).cast("long")
            ok = F.lit(len(df.columns) == int(chk.lo))
        elif chk.name == "row_count":
            n_bad = F.lit(0).cast("long")
            ok = F.col("_rows") >= F.lit(int(chk.lo))
        elif chk.name == "mean_between":
            m = F.col(f"m{i}")
            n_bad = F.lit(0).cast("long")
            ok = F.coalesce(m.between(chk.lo, chk.hi), F.lit(False))
        elif chk.name == "unique":
            n_bad = F.lit(None).cast("long")      # filled by the grouped count below
            ok = F.lit(None).cast("boolean")
        else:
            n_bad = F.col(f"v{i}")
            ok = F.col(f"v{i}") == 0
        entries.append(F.struct(F.lit(i).alias("idx"), F.lit(suite).alias("suite"),
                                F.lit(chk.name).alias("check"), column.alias("column"),
                                n_bad.alias("n_unexpected"), ok.alias("success")))
    table = one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    for i, chk in enumerate(checks):
        if chk.name == "unique":
            dup = (df.where(col(chk.column).isNotNull()).groupBy(col(chk.column)).count()
                   .where(F.col("count") > 1)
                   .agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("_dup")))
            table = (attach_row(table, dup)
                     .withColumn("n_unexpected", F.when(F.col("idx") == i, F.col("_dup"))
                                 .otherwise(F.col("n_unexpected")))
                     .withColumn("success", F.when(F.col("idx") == i, F.col("_dup") == 0)
                                 .otherwise(F.col("success")))
                     .drop("_dup"))
    return table


def suite_report(check_table: DataFrame) -> DataFrame:
    """(suite, evaluated, successful, failed, success) -- the gate (V9)."""
    failed = F.array_join(F.sort_array(F.collect_list(
        F.when(~F.col("success"), F.concat_ws(":", F.col("check"),
                                              F.coalesce(F.col("column"), F.lit("table")))))),
        ",")
    return check_table.groupBy("suite").agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(F.col("success")).alias("successful"),
        failed.alias("failed"),
    ).withColumn("success", F.col("evaluated") == F.col("successful"))


class SuiteFailed(RuntimeError):
    pass


def gate(report: DataFrame) -> DataFrame:
    """Raise when any suite failed (downstream must not run); else pass through."""
    bad = report.where(~F.col("success")).select("suite", "failed").collect()  # one row a suite
    if bad:
        raise SuiteFailed("; ".join(f"{r.suite}: {r.failed}" for r in bad))
    return report


def inject_bad_row(df: DataFrame, column: str, value, key: str = "encounter_id") -> DataFrame:
    """Corrupt the row with the smallest key (fault injection, V10)."""
    first = df.agg(F.min(key).alias("_k"))
    return (attach_row(df, first)
            .withColumn(column, F.when(F.col(key) == F.col("_k"), F.lit(value))
                        .otherwise(col(column)))
            .drop("_k"))


# --------------------------------------------------------------- contract
def contract_fields() -> list[dict]:
    """The request fields with their rules, by name."""
    asked = {f.name: f for f in raw_fields() if f.request}
    return [{"field": n, "type": f.kind, "allowed": f.levels, "nullable": f.nullable,
             "min": f.bounds and f.bounds[0], "max": f.bounds and f.bounds[1]} for n, f in sorted(asked.items())]


CONTRACT_SCHEMA = T.StructType([
    T.StructField("field", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("allowed", T.ArrayType(T.StringType())),
    T.StructField("nullable", T.BooleanType()),
    T.StructField("min", T.IntegerType()), T.StructField("max", T.IntegerType()),
])


def contract_table(spark) -> DataFrame:
    rows = [(f["field"], f["type"], f["allowed"], f["nullable"], f["min"], f["max"])
            for f in contract_fields()]
    return spark.createDataFrame(rows, CONTRACT_SCHEMA)


def field_reasons(fields: list[dict] | None = None) -> list[Column]:
    """One nullable reason string per rule; null when the rule holds."""
    reasons = []
    for f in fields or contract_fields():
        c = col(f["field"])
        name = f["field"]
        missing = c.isNull() | (c.cast("string") == C.MISSING_TOKEN)
        if not f["nullable"]:
            reasons.append(F.when(missing, F.lit(f"{name}: missing")))
        present = ~missing
        if f["type"] == "categorical":
            reasons.append(F.when(present & ~c.isin(*f["allowed"]),
                                  F.lit(f"{name}: value not allowed")))
        elif f["type"] == "integer":
            reasons.append(F.when(present & ~c.between(f["min"], f["max"]),
                                  F.lit(f"{name}: out of range")))
    return reasons + semantic_reasons()


def semantic_reasons() -> list[Column]:
    """What the contract allows and the model cannot score."""
    return [F.when(F.col("gender") == C.REJECTED_GENDER, F.lit("gender: not scoreable")),
            F.when(F.col("discharge_disposition_id").isin(*C.EXPIRED_HOSPICE_IDS), F.lit("discharge_disposition_id: expired/hospice"))]


def reject_reasons(df: DataFrame) -> DataFrame:
    """Add ``reasons`` (array) and ``accepted``; rejects are rows, not failures."""
    return (df.withColumn("reasons", F.array_compact(F.array(*field_reasons())))
              .withColumn("accepted", F.size("reasons") == 0))


def extra_fields(json_col: Column, allowed: list[str]) -> Column:
    """Keys of a JSON object that are not contract fields (V13), sorted."""
    keys = F.json_object_keys(json_col)
    return F.array_sort(F.array_except(keys, F.array(*[F.lit(a) for a in allowed])))


def null_feature_guard(df: DataFrame, features: list[str]) -> DataFrame:
    """List the features that are null per row; such rows are unscoreable."""
    nulls = F.array_compact(F.array(*[F.when(col(c).isNull(), F.lit(c)) for c in features]))
    return df.withColumn("null_features", nulls).withColumn("scoreable", F.size(nulls) == 0)
