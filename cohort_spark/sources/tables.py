"""Driver-table access and the encounter view derived from it.

The encounter view turns ``orders`` + per-order ``lineitem`` aggregates into
rows of the raw 50-column encounter schema (plus an integer-derived ``score``)
with pure integer arithmetic, so every operator can run on data whose size
grows with the driver tables.  The view only shapes rows; it does none of the
operators' work.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Diagnosis code list used by the view: index = (order key + slot shift) % 14.
_DIAG_CODES = ["?", "250.83", "V45", "E909", "428", "486", "574", "820", "715",
               "599", "197", "785", "401.9", "38"]
_DIAG_SHIFT = {"diag_1": 0, "diag_2": 5, "diag_3": 9}
_ALWAYS_NO = {"examide", "citoglipton", "glimepiride-pioglitazone"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order line count, summed quantity and distinct parts (one shuffle: an order's lines come
    together first, so neither the distinct parts nor a join by order need another)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    li = li.where(F.col("l_orderkey").isNotNull()).repartition("l_orderkey")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_li"),
        F.sum("l_quantity").cast("bigint").alias("qty"),
        F.countDistinct("l_partkey").alias("n_part"),
    )


def _case(idx: str, values: list[str], default: str | None = None) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    tail = f" ELSE '{default}'" if default is not None else ""
    return f"CASE {idx} {arms}{tail} END"


def _encounter_exprs() -> list[str]:
    """SQL expressions of the view (parsed once in the JVM, one call per column)."""
    decade = "(p % 10) * 10"
    readm = ("CASE WHEN (k * 7 + p * 13 + n_li) % 11 = 0 THEN '<30' "
             "WHEN k % 3 = 0 THEN '>30' ELSE 'NO' END")
    e = [
        "k AS encounter_id", "p AS patient_nbr",
        _case("k % 9", ["?", "AfricanAmerican", "Asian", "Hispanic", "Other"], "Caucasian") + " AS race",
        "CASE WHEN k % 499 = 17 THEN 'Unknown/Invalid' WHEN p % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender",
        f"concat('[', CAST({decade} AS STRING), '-', CAST({decade} + 10 AS STRING), ')') AS age",
        "'?' AS weight",
        "CAST(k % 8 + 1 AS INT) AS admission_type_id",
        "CAST((k * 7) % 30 + 1 AS INT) AS discharge_disposition_id",
        "CAST((k * 11) % 26 + 1 AS INT) AS admission_source_id",
        "CAST(qty % 14 + 1 AS INT) AS time_in_hospital",
        _case("k % 4", ["?", "MC", "HM"], "SP") + " AS payer_code",
        "CASE WHEN k % 2 = 0 THEN '?' ELSE concat('Spec', CAST(p % 40 AS STRING)) END AS medical_specialty",
        "CAST(qty % 120 AS INT) AS num_lab_procedures",
        "CAST(n_li % 13 AS INT) AS num_procedures",
        "CAST(n_li * 3 + n_part AS INT) AS num_medications",
        "CAST(k % 3 AS INT) AS number_outpatient",
        "CAST(CASE WHEN k % 7 = 0 THEN 2 ELSE 0 END AS INT) AS number_emergency",
        "CAST(CASE WHEN k % 5 = 0 THEN k % 13 ELSE k % 2 END AS INT) AS number_inpatient",
    ]
    e += [f"{_case(f'(k + {sh}) % 14', _DIAG_CODES)} AS {c}" for c, sh in _DIAG_SHIFT.items()]
    e += ["CAST(k % 16 + 1 AS INT) AS number_diagnoses",
          _case("k % 10", [">200", ">300", "Norm"], "None") + " AS max_glu_serum",
          _case("k % 6", [">7", ">8", "Norm"], "None") + " AS A1Cresult"]
    for i, drug in enumerate(C.ALL_DRUGS):
        if drug in _ALWAYS_NO:
            e.append(f"'No' AS `{drug}`")
        else:
            m = f"((k * {i + 3} + p) % {7 if drug == 'insulin' else 23})"
            e.append(f"CASE WHEN {m} = 0 THEN 'Up' WHEN {m} = 1 THEN 'Down' "
                     f"WHEN {m} IN (2, 3) THEN 'Steady' ELSE 'No' END AS `{drug}`")
    e += ["CASE WHEN (k + p) % 2 = 0 THEN 'Ch' ELSE 'No' END AS change",
          "CASE WHEN k % 4 = 3 THEN 'No' ELSE 'Yes' END AS diabetesMed",
          f"{readm} AS readmitted",
          f"(((k * 37 + p * 11) % 101) + CASE WHEN {readm} = '<30' THEN 20 ELSE 0 END) "
          "/ CAST(121.0 AS DOUBLE) AS score"]
    return e


def encounter_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the encounter view is made of: the order's key, its customer and its line totals."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    stats = order_stats(spark, sf_dir)
    return (orders.join(stats, orders.o_orderkey == stats.l_orderkey, "left")
            .select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("p"),
                    F.coalesce("n_li", F.lit(0)).alias("n_li"),
                    F.coalesce("qty", F.lit(0)).alias("qty"),
                    F.coalesce("n_part", F.lit(0)).alias("n_part")))


def encounter_rows(facts: DataFrame) -> DataFrame:
    """Raw encounter records (literal ``?`` kept, as in the raw CSV) + ``score``, one per row of
    ``encounter_facts``."""
    return facts.selectExpr(*_encounter_exprs())


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw encounter records (literal ``?`` kept, as in the raw CSV) + ``score``."""
    return encounter_rows(encounter_facts(spark, sf_dir))
