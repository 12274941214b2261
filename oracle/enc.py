"""DuckDB twins of the Spark queries (the correctness oracle).

``ENC`` is the encounter view written in SQL; ``with_enc`` prefixes a query
body with it so each oracle string is self-contained.
"""
from __future__ import annotations

from cohort_spark import constants as C

_DIAG = ["?", "250.83", "V45", "E909", "428", "486", "574", "820", "715", "599",
         "197", "785", "401.9", "38"]
_ALWAYS_NO = {"examide", "citoglipton", "glimepiride-pioglitazone"}


def _case_list(expr: str, values: list[str]) -> str:
    parts = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {parts} END"


def _drug(i: int, name: str) -> str:
    if name in _ALWAYS_NO:
        return f"'No' AS \"{name}\""
    mod = 7 if name == "insulin" else 23
    m = f"((k * {i + 3} + p) % {mod})"
    return (f"CASE WHEN {m} = 0 THEN 'Up' WHEN {m} = 1 THEN 'Down' "
            f"WHEN {m} IN (2, 3) THEN 'Steady' ELSE 'No' END AS \"{name}\"")


def _enc_sql() -> str:
    drugs = ",\n    ".join(_drug(i, d) for i, d in enumerate(C.ALL_DRUGS))
    diags = ",\n    ".join(
        f"{_case_list(f'(k + {s}) % 14', _DIAG)} AS {c}"
        for c, s in (("diag_1", 0), ("diag_2", 5), ("diag_3", 9)))
    return f"""
li_stats AS (
  SELECT l_orderkey, COUNT(*) AS n_li, CAST(SUM(l_quantity) AS BIGINT) AS qty,
         COUNT(DISTINCT l_partkey) AS n_part
  FROM lineitem GROUP BY l_orderkey
),
enc_base AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS p,
         COALESCE(s.n_li, 0) AS n_li, COALESCE(s.qty, 0) AS qty,
         COALESCE(s.n_part, 0) AS n_part,
         CASE WHEN (o.o_orderkey * 7 + o.o_custkey * 13 + COALESCE(s.n_li, 0)) % 11 = 0
              THEN '<30' WHEN o.o_orderkey % 3 = 0 THEN '>30' ELSE 'NO' END AS readm
  FROM orders o LEFT JOIN li_stats s ON o.o_orderkey = s.l_orderkey
),
enc AS (
  SELECT
    k AS encounter_id, p AS patient_nbr,
    CASE k % 9 WHEN 0 THEN '?' WHEN 1 THEN 'AfricanAmerican' WHEN 2 THEN 'Asian'
         WHEN 3 THEN 'Hispanic' WHEN 4 THEN 'Other' ELSE 'Caucasian' END AS race,
    CASE WHEN k % 499 = 17 THEN 'Unknown/Invalid' WHEN p % 2 = 0 THEN 'Female'
         ELSE 'Male' END AS gender,
    '[' || CAST((p % 10) * 10 AS VARCHAR) || '-' || CAST((p % 10) * 10 + 10 AS VARCHAR) || ')' AS age,
    '?' AS weight,
    CAST(k % 8 + 1 AS INTEGER) AS admission_type_id,
    CAST((k * 7) % 30 + 1 AS INTEGER) AS discharge_disposition_id,
    CAST((k * 11) % 26 + 1 AS INTEGER) AS admission_source_id,
    CAST(qty % 14 + 1 AS INTEGER) AS time_in_hospital,
    CASE k % 4 WHEN 0 THEN '?' WHEN 1 THEN 'MC' WHEN 2 THEN 'HM' ELSE 'SP' END AS payer_code,
    CASE WHEN k % 2 = 0 THEN '?' ELSE 'Spec' || CAST(p % 40 AS VARCHAR) END AS medical_specialty,
    CAST(qty % 120 AS INTEGER) AS num_lab_procedures,
    CAST(n_li % 13 AS INTEGER) AS num_procedures,
    CAST(n_li * 3 + n_part AS INTEGER) AS num_medications,
    CAST(k % 3 AS INTEGER) AS number_outpatient,
    CAST(CASE WHEN k % 7 = 0 THEN 2 ELSE 0 END AS INTEGER) AS number_emergency,
    CAST(CASE WHEN k % 5 = 0 THEN k % 13 ELSE k % 2 END AS INTEGER) AS number_inpatient,
    {diags},
    CAST(k % 16 + 1 AS INTEGER) AS number_diagnoses,
    CASE k % 10 WHEN 0 THEN '>200' WHEN 1 THEN '>300' WHEN 2 THEN 'Norm' ELSE 'None' END AS max_glu_serum,
    CASE k % 6 WHEN 0 THEN '>7' WHEN 1 THEN '>8' WHEN 2 THEN 'Norm' ELSE 'None' END AS A1Cresult,
    {drugs},
    CASE WHEN (k + p) % 2 = 0 THEN 'Ch' ELSE 'No' END AS change,
    CASE WHEN k % 4 = 3 THEN 'No' ELSE 'Yes' END AS diabetesMed,
    readm AS readmitted,
    (((k * 37 + p * 11) % 101) + CASE WHEN readm = '<30' THEN 20 ELSE 0 END) / CAST(121.0 AS DOUBLE) AS score
  FROM enc_base
)"""


ENC = _enc_sql()


def with_enc(body: str, extra_ctes: str = "") -> str:
    """``WITH <enc view>[, extra] <body>``; ``body`` starts with SELECT or a CTE list."""
    ctes = ENC + ("," + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"
