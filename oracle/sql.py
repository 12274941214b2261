"""DuckDB oracle SQL per registered job (same column names, same rounding)."""
from __future__ import annotations

from .enc import with_enc

SQL: dict[str, str] = {}


def r6(x: str) -> str:
    """Engine-independent 6-decimal rounding, mirrors ``round_half_up``."""
    return f"CAST(FLOOR(({x}) * 1000000.0 + 0.5) / 1000000.0 AS DOUBLE)"


def rn(x: str, d: int) -> str:
    s = f"{10 ** d}.0"
    return f"CAST(FLOOR(({x}) * {s} + 0.5) / {s} AS DOUBLE)"


# --- shared SQL fragments -------------------------------------------------------
def icd9_bucket_sql(c: str) -> str:
    """Pipeline ICD-9 mapper."""
    s = f"TRIM({c})"
    num = (f"CASE WHEN regexp_full_match({s}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') "
           f"THEN TRY_CAST({s} AS DOUBLE) END")
    n = f"TRY_CAST(TRUNC({num}) AS BIGINT)"
    return f"""CASE WHEN {c} IS NULL THEN 'Missing'
      WHEN starts_with({s}, '250') THEN 'Diabetes'
      WHEN substring({s}, 1, 1) IN ('E', 'V') THEN 'Other'
      WHEN {n} IS NULL THEN 'Other'
      WHEN {n} BETWEEN 390 AND 459 OR {n} = 785 THEN 'Circulatory'
      WHEN {n} BETWEEN 460 AND 519 OR {n} = 786 THEN 'Respiratory'
      WHEN {n} BETWEEN 520 AND 579 OR {n} = 787 THEN 'Digestive'
      WHEN {n} BETWEEN 800 AND 999 THEN 'Injury'
      WHEN {n} BETWEEN 710 AND 739 THEN 'Musculoskeletal'
      WHEN {n} BETWEEN 580 AND 629 OR {n} = 788 THEN 'Genitourinary'
      WHEN {n} BETWEEN 140 AND 239 THEN 'Neoplasms'
      ELSE 'Other' END"""


def icd9_chapter_sql(c: str) -> str:
    """Profiling ICD-9 mapper."""
    s = f"TRIM({c})"
    num = (f"CASE WHEN regexp_full_match({s}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') "
           f"THEN TRY_CAST({s} AS DOUBLE) END")
    n = f"TRY_CAST(TRUNC({num}) AS BIGINT)"
    return f"""CASE WHEN {c} IS NULL THEN 'Missing'
      WHEN {s} = '' OR lower({s}) IN ('nan', '?', 'none') THEN 'Missing'
      WHEN substring({s}, 1, 1) IN ('V', 'v', 'E', 'e') THEN 'Other'
      WHEN {num} IS NULL THEN 'Other'
      WHEN {num} >= 250.0 AND {num} < 251.0 THEN 'Diabetes'
      WHEN {n} BETWEEN 390 AND 459 OR {n} = 785 THEN 'Circulatory'
      WHEN {n} BETWEEN 460 AND 519 OR {n} = 786 THEN 'Respiratory'
      WHEN {n} BETWEEN 520 AND 579 OR {n} = 787 THEN 'Digestive'
      WHEN {n} BETWEEN 580 AND 629 OR {n} = 788 THEN 'Genitourinary'
      WHEN {n} BETWEEN 140 AND 239 THEN 'Neoplasms'
      WHEN {n} BETWEEN 710 AND 739 THEN 'Musculoskeletal'
      WHEN {n} BETWEEN 800 AND 999 THEN 'Injury'
      ELSE 'Other' END"""


def wilson_sql(k: str, n: str, z: float = 1.96) -> tuple[str, str]:
    p = f"(CAST({k} AS DOUBLE) / {n})"
    z2 = f"{z * z!r}"
    denom = f"(1.0 + {z2} / {n})"
    center = f"(({p} + {z2} / (2.0 * {n})) / {denom})"
    half = f"({z!r} * SQRT({p} * (1.0 - {p}) / {n} + {z2} / (4.0 * {n} * {n})) / {denom})"
    lo = f"CASE WHEN {n} = 0 THEN 0.0 ELSE GREATEST(0.0, {center} - {half}) END"
    hi = f"CASE WHEN {n} = 0 THEN 0.0 ELSE LEAST(1.0, {center} + {half}) END"
    return lo, hi


# Pipeline-mode raw view: '?' -> NULL on every string column.
def raw_pipeline_cte() -> str:
    from cohort_spark import constants as C
    cols = []
    for c in C.RAW_COLUMNS:
        q = f'"{c}"'
        if c in C.KEY_COLS or c in C.INT_RANGES:
            cols.append(q)
        else:
            cols.append(f"CASE WHEN {q} = '?' THEN NULL ELSE {q} END AS {q}")
    cols.append("score")
    return "raw AS (SELECT " + ", ".join(cols) + " FROM enc)"


def clean_cte(dedup: str = "coalesce", with_score: bool = False) -> str:
    """Filters + first-encounter dedup + fills + target, as CTEs ``kept``/``clean``."""
    from cohort_spark import constants as C
    others = [c for c in C.RAW_COLUMNS if c not in ("patient_nbr", "encounter_id")]
    if with_score:
        others = others + ["score"]
    if dedup == "coalesce":
        aggs = ", ".join(
            f'arg_min("{c}", encounter_id) FILTER (WHERE "{c}" IS NOT NULL) AS "{c}"'
            for c in others)
        dd = (f"dedup AS (SELECT patient_nbr, MIN(encounter_id) AS encounter_id, {aggs} "
              f"FROM kept WHERE patient_nbr IS NOT NULL GROUP BY patient_nbr)")
    else:
        dd = ("dedup AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER "
              "(PARTITION BY patient_nbr ORDER BY encounter_id) AS rn FROM kept "
              "WHERE patient_nbr IS NOT NULL) WHERE rn = 1)")
    keep_cols = [c for c in C.RAW_COLUMNS if c not in C.DROPPED_IN_CLEANING and c != "readmitted"]
    sel = []
    for c in keep_cols:
        q = f'"{c}"'
        if c in C.LAB_COLS:
            sel.append(f"CASE WHEN {q} = 'None' THEN 'NotMeasured' ELSE {q} END AS {q}")
        elif c in C.MISSING_AS_UNKNOWN:
            sel.append(f"COALESCE({q}, 'Unknown') AS {q}")
        else:
            sel.append(q)
    if with_score:
        sel.append("score")
    sel.append("CAST(COALESCE(readmitted = '<30', FALSE) AS TINYINT) AS target")
    return (raw_pipeline_cte() + ",\n"
            "kept AS (SELECT * " + ("" if with_score else "EXCLUDE (score) ") + "FROM raw WHERE COALESCE(gender IN ('Male','Female'), FALSE) "
            "AND NOT COALESCE(discharge_disposition_id IN (11,13,14,19,20,21), FALSE)),\n"
            + dd + ",\nclean AS (SELECT " + ", ".join(sel) + " FROM dedup)")


# ====================================================================== flagship
_lo, _hi = wilson_sql("positives", "n")
SQL["flagship_diag_rates"] = with_enc(f"""
SELECT bucket, n, positives, {r6('CAST(positives AS DOUBLE) / n')} AS rate,
       {r6(_lo)} AS ci_low, {r6(_hi)} AS ci_high
FROM (SELECT bucket, COUNT(*) AS n, CAST(SUM(target) AS BIGINT) AS positives
      FROM (SELECT {icd9_bucket_sql('diag_1')} AS bucket, target FROM clean) GROUP BY bucket)
""", clean_cte())


# Oracle modules register their SQL on import.
from . import sql_core  # noqa: E402,F401
from . import sql_profile  # noqa: E402,F401
from . import sql_eval  # noqa: E402,F401
from . import sql_drift  # noqa: E402,F401
from . import sql_stream  # noqa: E402,F401
