"""Oracle SQL: profiling, dataset facts and association statistics."""
from __future__ import annotations

from cohort_spark import constants as C

from .enc import with_enc
from .sql import SQL, icd9_chapter_sql, r6, rn, wilson_sql
from .sql_core import in_list, is_string, lit, map_case, q, raw_eda_cte

EDA = raw_eda_cte() + (",\neda AS (SELECT * EXCLUDE (score), CAST(COALESCE(readmitted = '<30', FALSE) "
                       "AS INTEGER) AS readmitted_30d FROM raw_eda)")
PROFILED = [c for c in C.RAW_COLUMNS if c != "readmitted"]
NUMERIC_TYPED = [c for c in PROFILED if not is_string(c)]
NUMERIC = C.UTILIZATION_NUMERIC_COLS
Y = "readmitted_30d"

_UNPIVOT_IN = ", ".join(f"CAST({q(c)} AS VARCHAR) AS {q(c)}" for c in PROFILED)
LEVELS = (EDA + ",\nlong AS (UNPIVOT (SELECT readmitted_30d, " + _UNPIVOT_IN + " FROM eda) ON "
          + ", ".join(q(c) for c in PROFILED) + " INTO NAME \"column\" VALUE value),\n"
          "lv AS (SELECT \"column\", value, COUNT(*) AS count, CAST(SUM(readmitted_30d) AS BIGINT) AS positives "
          "FROM long GROUP BY 1, 2),\n"
          "uniq AS (SELECT \"column\", COUNT(*) AS n_unique FROM lv GROUP BY 1),\n"
          "miss AS (" + " UNION ALL ".join(
              f"SELECT {lit(c)} AS \"column\", COUNT(*) AS n, COUNT(*) FILTER (WHERE {q(c)} IS NULL) AS n_missing FROM eda"
              for c in PROFILED) + "),\n"
          "basics AS (SELECT m.\"column\", m.n, m.n_missing, COALESCE(u.n_unique, 0) AS n_unique "
          "FROM miss m LEFT JOIN uniq u ON m.\"column\" = u.\"column\"),\n"
          "roles AS (SELECT \"column\", CASE WHEN \"column\" IN ('encounter_id','patient_nbr') THEN 'identifier' "
          f"WHEN \"column\" IN {in_list(C.ADMINISTRATIVE_ID_COLS)} THEN 'coded_id' "
          "WHEN n_unique <= 1 THEN 'constant' "
          f"WHEN \"column\" IN {in_list(NUMERIC_TYPED)} THEN 'numeric' "
          "WHEN n_unique = 2 THEN 'binary_flag' WHEN n_unique > 30 THEN 'high_card_cat' "
          "ELSE 'categorical' END AS role, n_unique, n, n_missing FROM basics)")

_FAM = {c: f for f, cols in C.COLUMN_FAMILY.items() for c in cols}
_FAM_VALUES = "fam AS (SELECT * FROM (VALUES " + ", ".join(
    f"({lit(c)}, {lit(f)})" for c, f in _FAM.items()) + ") t(\"column\", family))"
_DEC_VALUES = "dec AS (SELECT * FROM (VALUES " + ", ".join(
    f"({lit(col)}, {lit(str(code))}, {lit(label)})" for col, m in C.ID_DECODERS.items()
    for code, label in m.items()) + ") t(dc, code, label))"

SQL["infer_roles"] = with_enc('SELECT "column", role, n_unique FROM roles', LEVELS)
SQL["column_profile"] = with_enc(
    f"SELECT r.\"column\", COALESCE(f.family, 'Other') AS family, role, n, n_missing, "
    f"{rn('100.0 * n_missing / n', 3)} AS pct_missing, n_unique, n_unique <= 1 AS is_constant "
    f"FROM roles r LEFT JOIN fam f ON r.\"column\" = f.\"column\"", LEVELS + ",\n" + _FAM_VALUES)

_LEVEL_STATS = (
    "ls AS (SELECT l.\"column\", CAST(rank AS INTEGER) AS rank, COALESCE(d.label, l.value) AS label, count, "
    f"{rn('100.0 * count / (SELECT COUNT(*) FROM eda)', 3)} AS pct, positives, "
    f"{rn('CAST(positives AS DOUBLE) / count', 5)} AS positive_rate, n_levels_total FROM "
    "(SELECT lv.*, ROW_NUMBER() OVER (PARTITION BY lv.\"column\" ORDER BY count DESC, value) AS rank, "
    "COUNT(*) OVER (PARTITION BY lv.\"column\") AS n_levels_total FROM lv JOIN roles r ON lv.\"column\" = r.\"column\" "
    "WHERE r.role IN ('coded_id','binary_flag','high_card_cat','categorical')) l "
    "LEFT JOIN dec d ON l.\"column\" = d.dc AND l.value = d.code WHERE rank <= 30)")
SQL["level_stats"] = with_enc("SELECT * FROM ls", LEVELS + ",\n" + _DEC_VALUES + ",\n" + _LEVEL_STATS)

_Q = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
_QN = ["p01", "p05", "p25", "median", "p75", "p95", "p99"]


def _num_summary(c: str) -> str:
    x = f"CAST({q(c)} AS DOUBLE)"
    qs = ", ".join(f"{r6(f'quantile_cont({x}, {p})')} AS {n}" for p, n in zip(_Q, _QN))
    n = f"CAST(COUNT({x}) AS DOUBLE)"
    return (f"SELECT {lit(c)} AS \"column\", {r6(f'MIN({x})')} AS min, {qs}, {r6(f'AVG({x})')} AS mean, "
            f"{r6(f'MAX({x})')} AS max, {r6(f'STDDEV_SAMP({x})')} AS std, "
            f"{r6(f'CASE WHEN {n} > 2 THEN SKEWNESS({x}) END')} AS skew, "
            f"{rn(f'100.0 * COUNT(*) FILTER (WHERE {x} = 0) / {n}', 2)} AS zeros_pct FROM eda")


SQL["numeric_summary"] = with_enc(" UNION ALL ".join(_num_summary(c) for c in NUMERIC), EDA)

_PROBS = "[" + ", ".join(repr(i / 10) for i in range(11)) + "]"
_DECILES = (EDA + ",\nnl AS (UNPIVOT (SELECT readmitted_30d, " + ", ".join(
    f"CAST({q(c)} AS DOUBLE) AS {q(c)}" for c in NUMERIC) + " FROM eda) ON " + ", ".join(
    q(c) for c in NUMERIC) + " INTO NAME \"column\" VALUE x),\n"
    f"edges AS (SELECT \"column\", list_sort(list_distinct(quantile_cont(x, {_PROBS}))) AS e FROM nl GROUP BY 1),\n"
    "binned AS (SELECT nl.\"column\", readmitted_30d, e, GREATEST(len(list_filter(e, lambda v: v < x)), 1) AS bin "
    "FROM nl JOIN edges ON nl.\"column\" = edges.\"column\" WHERE len(e) >= 2),\n"
    "dr AS (SELECT \"column\", CAST(bin AS INTEGER) AS bin, "
    "CASE WHEN bin = 1 THEN e[bin] - 0.001 ELSE e[bin] END AS left_, e[bin + 1] AS right_, count, positive_rate "
    "FROM (SELECT \"column\", bin, any_value(e) AS e, COUNT(*) AS count, "
    f"{rn('AVG(CAST(readmitted_30d AS DOUBLE))', 5)} AS positive_rate FROM binned GROUP BY 1, 2))")
SQL["decile_rates"] = with_enc(
    f"SELECT \"column\", bin, {r6('left_')} AS \"left\", {r6('right_')} AS \"right\", count, positive_rate FROM dr",
    _DECILES)
SQL["target_lift"] = with_enc(
    "SELECT \"column\", kind, CASE WHEN b > 0 THEN " + rn("mx / b", 3) + " END AS target_lift FROM ("
    "SELECT \"column\", 'numeric' AS kind, MAX(positive_rate) AS mx FROM dr GROUP BY 1 UNION ALL "
    "SELECT \"column\", 'categorical', MAX(positive_rate) FROM ls WHERE count >= 30 GROUP BY 1) t, "
    "(SELECT AVG(CAST(readmitted_30d AS DOUBLE)) AS b FROM eda) base",
    LEVELS + ",\n" + _DEC_VALUES + ",\n" + _LEVEL_STATS + ",\n" + _DECILES[len(EDA) + 2:])

_LIFT = ("lift AS (SELECT \"column\", CASE WHEN b > 0 THEN " + rn("mx / b", 3) + " END AS target_lift FROM ("
         "SELECT \"column\", MAX(positive_rate) AS mx FROM dr GROUP BY 1 UNION ALL "
         "SELECT \"column\", MAX(positive_rate) FROM ls WHERE count >= 30 GROUP BY 1) t, "
         "(SELECT AVG(CAST(readmitted_30d AS DOUBLE)) AS b FROM eda) base)")
SQL["fact_pack"] = with_enc(
    f"SELECT r.\"column\", COALESCE(f.family, 'Other') AS family, role, n, n_missing, {rn('100.0 * n_missing / n', 3)} AS pct_missing, n_unique, "
    "n_unique <= 1 AS is_constant, CASE WHEN role = 'constant' THEN cv END AS constant_value, CASE WHEN role = 'identifier' THEN n_unique = n END AS unique_key, "
    "CASE WHEN role NOT IN ('identifier', 'constant') THEN target_lift END AS target_lift, "
    + ", ".join(f"CASE WHEN role NOT IN ('identifier', 'constant') THEN ns.{c} END AS {c}" for c in ("mean", "median", "std", "zeros_pct"))
    + ", CASE WHEN role NOT IN ('identifier', 'constant') THEN top_levels END AS top_levels FROM roles r LEFT JOIN fam f ON r.\"column\" = f.\"column\" "
    "LEFT JOIN lift l ON r.\"column\" = l.\"column\" LEFT JOIN ns ON r.\"column\" = ns.\"column\" "
    "LEFT JOIN (SELECT \"column\", string_agg(label || '=' || count, '; ' ORDER BY rank) AS top_levels FROM ls WHERE rank <= 5 GROUP BY 1) t ON r.\"column\" = t.\"column\" "
    "LEFT JOIN (SELECT \"column\", MIN(value) AS cv FROM lv GROUP BY 1) c ON r.\"column\" = c.\"column\"",
    LEVELS + ",\n" + _FAM_VALUES + ",\n" + _DEC_VALUES + ",\n" + _LEVEL_STATS + ",\n" + _DECILES[len(EDA) + 2:] + ",\n" + _LIFT
    + ",\nns AS (" + " UNION ALL ".join(_num_summary(c) for c in NUMERIC) + ")")

SQL["target_facts"] = with_enc(
    f"SELECT readmitted AS value, COUNT(*) AS count, (SELECT COUNT(*) FROM eda) AS n_rows, "
    f"(SELECT CAST(SUM(readmitted_30d) AS BIGINT) FROM eda) AS binary_positives, "
    f"(SELECT {rn('AVG(CAST(readmitted_30d AS DOUBLE))', 5)} FROM eda) AS base_rate, "
    f"(SELECT {rn('1.0 - AVG(CAST(readmitted_30d AS DOUBLE))', 5)} FROM eda) AS majority_baseline_accuracy "
    "FROM eda GROUP BY readmitted", EDA)

_PER = "per AS (SELECT patient_nbr, COUNT(*) AS k FROM eda WHERE patient_nbr IS NOT NULL GROUP BY 1)"
SQL["grouping_facts"] = with_enc(
    f"SELECT (SELECT COUNT(*) FROM eda) AS n_rows, COUNT(*) AS n_unique_patients, "
    f"COUNT(*) FILTER (WHERE k > 1) AS n_patients_multi_encounter, MAX(k) AS max_encounters_per_patient, "
    f"{rn('100.0 * SUM(CASE WHEN k > 1 THEN k ELSE 0 END) / (SELECT COUNT(*) FROM eda)', 2)} "
    f"AS pct_rows_from_repeat_patients FROM per", EDA + ",\n" + _PER)

_DROP = "codes AS (SELECT * FROM (VALUES " + ", ".join(
    f"({code}, {lit(C.DISCHARGE_DISPOSITION_LABELS[code])}, {lit('expired' if code in C.EXPIRED_IDS else 'hospice')})"
    for code in C.EXPIRED_IDS + C.HOSPICE_IDS) + ") t(code, label, kind))"
SQL["discharge_facts"] = with_enc(
    "SELECT CAST(c.code AS INTEGER) AS code, label, kind, COALESCE(cnt, 0) AS count, "
    f"{rn('100.0 * COALESCE(cnt, 0) / tot.n', 3)} AS pct, n_expired_rows, n_hospice_rows, n_drop_rows, "
    f"{rn('100.0 * n_drop_rows / tot.n', 3)} AS pct_drop, tot.n - n_drop_rows AS rows_after_filter "
    "FROM codes c LEFT JOIN (SELECT discharge_disposition_id AS code, COUNT(*) AS cnt FROM eda "
    "GROUP BY 1) k ON c.code = k.code, (SELECT COUNT(*) AS n, "
    f"COUNT(*) FILTER (WHERE discharge_disposition_id IN {in_list(C.EXPIRED_IDS)}) AS n_expired_rows, "
    f"COUNT(*) FILTER (WHERE discharge_disposition_id IN {in_list(C.HOSPICE_IDS)}) AS n_hospice_rows, "
    f"COUNT(*) FILTER (WHERE discharge_disposition_id IN {in_list(C.EXPIRED_HOSPICE_IDS)}) AS n_drop_rows "
    "FROM eda) tot", EDA + ",\n" + _DROP)

_STR = [c for c in PROFILED if is_string(c)]
_pairs = [(a, b) for i, a in enumerate(_STR) for b in _STR[i + 1:]]


def _ind(c):
    return f"CAST({q(c)} IS NULL AS DOUBLE)"


SQL["co_missing"] = with_enc(
    "SELECT column_a, column_b, corr FROM (" + " UNION ALL ".join(
        f"SELECT {lit(a)} AS column_a, {lit(b)} AS column_b, CASE WHEN sa{j} > 0 AND sb{j} > 0 THEN "
        f"{rn(f'c{j}', 3)} END AS corr, s_{_STR.index(a)} AS sha, s_{_STR.index(b)} AS shb FROM a"
        for j, (a, b) in enumerate(_pairs)) + ") WHERE sha >= 0.01 AND shb >= 0.01",
    EDA + ",\na AS (SELECT " + ", ".join(
        [f"AVG({_ind(c)}) AS s_{i}" for i, c in enumerate(_STR)]
        + [f"CORR({_ind(a)}, {_ind(b)}) AS c{j}, STDDEV_POP({_ind(a)}) AS sa{j}, STDDEV_POP({_ind(b)}) AS sb{j}"
           for j, (a, b) in enumerate(_pairs)]) + " FROM eda)")

SQL["histogram"] = with_enc(
    "SELECT CAST(bin AS INTEGER) AS bin, " + r6("lo + (bin - 1) * ((hi - lo) / 40.0)") + " AS lo, "
    + r6("lo + bin * ((hi - lo) / 40.0)") + " AS hi, count FROM (SELECT CASE WHEN hi = lo THEN 1 ELSE "
    "LEAST(FLOOR((x - lo) / ((hi - lo) / 40.0)) + 1, 40) END AS bin, ANY_VALUE(lo) AS lo, ANY_VALUE(hi) AS hi, "
    "COUNT(*) AS count FROM (SELECT CAST(num_lab_procedures AS DOUBLE) AS x FROM eda WHERE num_lab_procedures "
    "IS NOT NULL) v, (SELECT MIN(CAST(num_lab_procedures AS DOUBLE)) AS lo, MAX(CAST(num_lab_procedures AS DOUBLE)) "
    "AS hi FROM eda) m GROUP BY 1)", EDA)

_HANDLING = {
    "weight": "dropped in cleaning", "race": "null -> Unknown level",
    "payer_code": "null -> Unknown level", "medical_specialty": "null -> Unknown level",
    "diag_1": "null -> Missing bucket", "diag_2": "null -> Missing bucket", "diag_3": "null -> Missing bucket",
    "max_glu_serum": "None -> NotMeasured level", "A1Cresult": "None -> NotMeasured level"}
SQL["missingness_rank"] = with_enc(
    f"SELECT b.\"column\", {rn('100.0 * n_missing / n', 3)} AS pct_missing, CASE WHEN "
    f"{rn('100.0 * n_missing / n', 3)} >= 40 THEN 'high' WHEN {rn('100.0 * n_missing / n', 3)} >= 5 THEN 'medium' "
    "ELSE 'low' END AS tier, COALESCE(h.handling, '—') AS handling FROM basics b LEFT JOIN (VALUES " + ", ".join(
        f"({lit(c)}, {lit(h)})" for c, h in _HANDLING.items()) + ") h(\"column\", handling) ON b.\"column\" = h.\"column\" "
    "WHERE n_missing > 0", LEVELS)

# ---------------------------------------------------------------- association
_CORR_COLS = NUMERIC + ["age_ordinal", Y]


def scorr(a: str, b: str) -> str:
    """Pearson correlation, null when a side has no variance."""
    return (f"CASE WHEN STDDEV_POP({a}) FILTER (WHERE {b} IS NOT NULL) > 0 AND STDDEV_POP({b}) FILTER "
            f"(WHERE {a} IS NOT NULL) > 0 THEN CORR({a}, {b}) END")
_AGE_ORD = map_case("age", {lit(a): i for i, a in enumerate(C.AGE_ORDER)}, None)
CORR_FRAME = EDA + (",\ncf AS (SELECT " + ", ".join(f"CAST({q(c)} AS DOUBLE) AS {q(c)}" for c in NUMERIC)
                    + f", CAST({_AGE_ORD} AS DOUBLE) AS age_ordinal, CAST({Y} AS DOUBLE) AS {Y} FROM eda)")
_CPAIRS = [(a, b) for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]]


def _pairwise(src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {lit(a)} AS a, {lit(b)} AS b, {rn(scorr(q(a), q(b)), 3)} AS corr FROM {src}"
        for a, b in _CPAIRS)


PEARSON = CORR_FRAME + ",\npear AS (" + _pairwise("cf") + ")"
SQL["corr_pearson"] = with_enc("SELECT * FROM pear", PEARSON)
SQL["corr_spearman"] = with_enc(
    _pairwise("rk"),
    CORR_FRAME + ",\nrk AS (SELECT " + ", ".join(
        f"CASE WHEN {q(c)} IS NULL THEN NULL ELSE RANK() OVER (ORDER BY {q(c)}) + "
        f"(COUNT(*) OVER (PARTITION BY {q(c)}) - 1) / 2.0 END AS {q(c)}" for c in _CORR_COLS) + " FROM cf)")
SQL["corr_top_pairs"] = with_enc(
    "SELECT a, b, corr, CAST(ROW_NUMBER() OVER (ORDER BY ABS(corr) DESC, a, b) AS INTEGER) AS rank "
    "FROM pear ORDER BY ABS(corr) DESC, a, b LIMIT 8", PEARSON)
SQL["corr_neighbors"] = with_enc(
    "SELECT partner, corr FROM (SELECT b AS partner, corr FROM pear WHERE a = 'number_inpatient' "
    "UNION ALL SELECT a, corr FROM pear WHERE b = 'number_inpatient') ORDER BY ABS(corr) DESC, partner LIMIT 6",
    PEARSON)


def cells_sql(columns: list[str], name: str = "cells") -> str:
    un = ", ".join(f"CAST({q(c)} AS VARCHAR) AS {q(c)}" for c in columns)
    return (f"cl_{name} AS (SELECT \"column\", COALESCE(x, '«missing»') AS x, y FROM "
            f"(SELECT {Y} AS y, {un} FROM eda) UNPIVOT INCLUDE NULLS (x FOR \"column\" IN ({', '.join(q(c) for c in columns)}))),\n"
            f"c0_{name} AS (SELECT \"column\", x, y, COUNT(*) AS count FROM cl_{name} GROUP BY 1, 2, 3),\n"
            f"lv_{name} AS (SELECT \"column\", x, ROW_NUMBER() OVER (PARTITION BY \"column\" ORDER BY SUM(count) DESC, x) AS rk, "
            f"COUNT(*) OVER (PARTITION BY \"column\") AS nl FROM c0_{name} GROUP BY 1, 2),\n"
            f"{name} AS (SELECT c.\"column\", CASE WHEN nl <= 30 OR rk <= 30 THEN c.x ELSE '«other»' END AS x, y, "
            f"SUM(count) AS count FROM c0_{name} c JOIN lv_{name} l ON c.\"column\" = l.\"column\" AND c.x = l.x GROUP BY 1, 2, 3)")


def cramer_sql(cells: str) -> str:
    return (f"SELECT \"column\", CASE WHEN r < 2 OR k < 2 OR n <= 1 THEN 0.0 WHEN LEAST(kc - 1, rc - 1) <= 0 THEN 0.0 "
            f"ELSE SQRT(GREATEST(0.0, n * (s - 1) / n - (k - 1) * (r - 1) / (n - 1)) / LEAST(kc - 1, rc - 1)) END AS v, "
            f"CAST(n AS BIGINT) AS n, r AS n_levels FROM (SELECT *, r - (r - 1) * (r - 1) / (n - 1) AS rc, "
            f"k - (k - 1) * (k - 1) / (n - 1) AS kc FROM (SELECT c.\"column\", "
            f"SUM(CAST(c.count AS DOUBLE) * c.count / (rx * cy)) AS s, CAST(SUM(c.count) AS DOUBLE) AS n, "
            f"CAST(COUNT(DISTINCT c.x) AS DOUBLE) AS r, CAST(COUNT(DISTINCT c.y) AS DOUBLE) AS k FROM {cells} c "
            f"JOIN (SELECT \"column\", x, SUM(count) AS rx FROM {cells} GROUP BY 1, 2) rr ON c.\"column\" = rr.\"column\" AND c.x = rr.x "
            f"JOIN (SELECT \"column\", y, SUM(count) AS cy FROM {cells} GROUP BY 1, 2) cc ON c.\"column\" = cc.\"column\" AND c.y = cc.y "
            f"GROUP BY c.\"column\"))")


_CRAMER_COLS = ["race", "gender", "age", "payer_code", "medical_specialty", "A1Cresult", "max_glu_serum",
                "admission_type_id"]
SQL["cramers_v"] = with_enc(
    f"SELECT \"column\", {r6('v')} AS cramers_v, n, CAST(n_levels AS BIGINT) AS n_levels FROM ({cramer_sql('cells')})",
    EDA + ",\n" + cells_sql(_CRAMER_COLS))

_ASSOC_NUM = [c for c in PROFILED if not is_string(c) and c not in C.KEY_COLS + C.ADMINISTRATIVE_ID_COLS]
_ASSOC_CAT = [c for c in PROFILED if c not in C.KEY_COLS and c not in _ASSOC_NUM]
SQL["feature_association"] = with_enc(
    "SELECT feature, " + r6("assoc") + " AS assoc, metric, kind FROM (" + " UNION ALL ".join(
        f"SELECT {lit(c)} AS feature, ABS({scorr(f'CAST({q(c)} AS DOUBLE)', f'CAST({Y} AS DOUBLE)')}) AS assoc, "
        f"'|point-biserial r|' AS metric, 'numeric' AS kind FROM eda HAVING COUNT(DISTINCT {q(c)}) > 1"
        for c in _ASSOC_NUM)
    + " UNION ALL SELECT \"column\", v, 'Cramér''s V', 'categorical' FROM (" + cramer_sql("cells") + ") "
    "WHERE \"column\" IN (SELECT \"column\" FROM uniq WHERE n_unique > 1))",
    LEVELS + ",\n" + cells_sql(_ASSOC_CAT))

_CH = icd9_chapter_sql("diag_1")
SQL["chapter_rates"] = with_enc(
    f"SELECT chapter, CAST(o.ord AS INTEGER) AS chapter_order, count, {rn('100.0 * count / n', 2)} AS pct, "
    f"{rn('r', 5)} AS positive_rate, CASE WHEN b > 0 THEN {rn('r / b', 3)} END AS lift, r >= b AS above_base FROM "
    f"(SELECT {_CH} AS chapter, COUNT(*) AS count, AVG(CAST({Y} AS DOUBLE)) AS r FROM eda GROUP BY 1) g "
    f"JOIN (VALUES " + ", ".join(f"({lit(ch)}, {i})" for i, ch in enumerate(C.ICD9_CHAPTER_ORDER))
    + f") o(ch, ord) ON g.chapter = o.ch, (SELECT COUNT(*) AS n, AVG(CAST({Y} AS DOUBLE)) AS b FROM eda) base",
    EDA)
_HAS = " OR ".join(f"({icd9_chapter_sql(c)}) = 'Diabetes'" for c in C.DIAG_COLS)
SQL["diabetes_anywhere"] = with_enc(
    f"SELECT CASE WHEN {_HAS} THEN 'with' ELSE 'without' END AS \"group\", COUNT(*) AS count, "
    f"{rn(f'AVG(CAST({Y} AS DOUBLE))', 5)} AS rate, (SELECT {rn(f'AVG(CAST({Y} AS DOUBLE))', 5)} FROM eda) AS base "
    f"FROM eda GROUP BY 1", EDA)
SQL["comorbidity_rates"] = with_enc(
    f"SELECT number_diagnoses AS n_diagnoses, COUNT(*) AS count, {rn(f'AVG(CAST({Y} AS DOUBLE))', 5)} AS positive_rate "
    "FROM eda GROUP BY 1 HAVING COUNT(*) >= 30", EDA)

_ML = (EDA + ",\nml AS (SELECT * FROM (SELECT readmitted_30d, " + ", ".join(q(d) for d in C.ALL_DRUGS)
       + " FROM eda) UNPIVOT INCLUDE NULLS (v FOR drug IN (" + ", ".join(q(d) for d in C.ALL_DRUGS) + ")))")
SQL["medication_landscape"] = with_enc(
    f"SELECT drug, {rn('100.0 * (n - \"No\") / n', 3)} AS pct_active, \"No\", \"Down\", \"Steady\", \"Up\", n_levels, "
    f"(n - \"No\") / n < 0.001 AS near_constant, CASE WHEN n - \"No\" > 0 THEN {rn('ra', 5)} END AS rate_active, "
    f"(SELECT {rn(f'AVG(CAST({Y} AS DOUBLE))', 5)} FROM eda) AS base FROM (SELECT drug, COUNT(*) AS n, "
    + ", ".join(f"COUNT(*) FILTER (WHERE v = '{lv}') AS \"{lv}\"" for lv in C.DRUG_VALUES)
    + ", COUNT(DISTINCT v) AS n_levels, AVG(CASE WHEN COALESCE(v <> 'No', TRUE) THEN CAST(readmitted_30d AS DOUBLE) END) AS ra "
    "FROM ml GROUP BY drug)", _ML)
_NACT = " + ".join(f"CAST(COALESCE({q(d)} <> 'No', TRUE) AS INTEGER)" for d in C.ALL_DRUGS)
SQL["medication_signal"] = with_enc(
    "SELECT signal, level, count, positive_rate FROM (" + " UNION ALL ".join(
        f"SELECT {lit(s)} AS signal, {q(s)} AS level, COUNT(*) AS count, "
        f"{rn(f'AVG(CAST({Y} AS DOUBLE))', 5)} AS positive_rate FROM eda WHERE {q(s)} IS NOT NULL GROUP BY 2"
        for s in ["change", "diabetesMed", "insulin"])
    + f" UNION ALL SELECT 'n_active_meds', CAST(LEAST({_NACT}, 6) AS VARCHAR), COUNT(*), "
    f"{rn(f'AVG(CAST({Y} AS DOUBLE))', 5)} FROM eda GROUP BY 2 HAVING COUNT(*) >= 30)", EDA)

_wlo, _whi = wilson_sql("k", "n")
SQL["wilson_ci"] = with_enc(
    f"SELECT level, k, n, {r6(_wlo)} AS ci_low, {r6(_whi)} AS ci_high FROM (SELECT COALESCE(payer_code, '«missing»') "
    f"AS level, COUNT(*) AS n, CAST(SUM({Y}) AS BIGINT) AS k FROM eda GROUP BY 1)", EDA)
SQL["subgroup_rates"] = with_enc(
    f"SELECT attribute, level, n AS count, {rn('CAST(k AS DOUBLE) / n', 5)} AS positive_rate, {rn(_wlo, 5)} AS ci_low, "
    f"{rn(_whi, 5)} AS ci_high, (SELECT {rn(f'AVG(CAST({Y} AS DOUBLE))', 5)} FROM eda) AS base FROM (" + " UNION ALL ".join(
        f"SELECT {lit(a)} AS attribute, COALESCE(CAST({q(a)} AS VARCHAR), '«missing»') AS level, COUNT(*) AS n, "
        f"CAST(SUM({Y}) AS BIGINT) AS k FROM eda GROUP BY 2" for a in ["age", "gender", "race"]) + ")", EDA)
SQL["encounter_distribution"] = with_enc(
    "SELECT CASE WHEN c = 5 THEN '5+' ELSE CAST(c AS VARCHAR) END AS encounters, COUNT(*) AS n_patients, "
    "(SELECT COUNT(*) FROM per) AS n_patients_total, (SELECT COUNT(*) FROM eda) AS n_rows FROM "
    "(SELECT LEAST(k, 5) AS c FROM per) GROUP BY c", EDA + ",\n" + _PER)


def _leak(split_cte: str) -> str:
    return (split_cte + ",\ntl AS (SELECT t.patient_nbr, t.patient_nbr IN (SELECT patient_nbr FROM sp WHERE NOT is_test) "
            "AS inn FROM sp t WHERE is_test)")


_LEAK_SELECT = ("SELECT COUNT(*) AS n_test_rows, (SELECT COUNT(DISTINCT patient_nbr) FROM tl) AS n_test_patients, "
                "(SELECT COUNT(DISTINCT patient_nbr) FROM tl WHERE inn) AS n_leaked_patients, "
                f"{rn('100.0 * AVG(CAST(inn AS DOUBLE))', 2)} AS pct_test_rows_leaked, "
                f"{rn('100.0 * (SELECT COUNT(DISTINCT patient_nbr) FROM tl WHERE inn) / GREATEST((SELECT COUNT(DISTINCT patient_nbr) FROM tl), 1)', 2)} "
                "AS pct_test_patients_leaked, CAST(0.2 AS DOUBLE) AS test_frac FROM tl")
SQL["leakage_overlap"] = with_enc(_LEAK_SELECT, EDA + ",\n" + _leak(
    "sp AS (SELECT patient_nbr, ROW_NUMBER() OVER (ORDER BY md5('42:' || CAST(encounter_id AS VARCHAR))) > "
    "FLOOR((SELECT COUNT(*) FROM eda) * 0.8) AS is_test FROM eda)"))
SQL["group_split_overlap"] = with_enc(_LEAK_SELECT, EDA + ",\n" + _leak(
    "pt AS (SELECT patient_nbr, ROW_NUMBER() OVER (ORDER BY md5('42:' || CAST(patient_nbr AS VARCHAR))) > "
    "FLOOR((SELECT COUNT(DISTINCT patient_nbr) FROM eda WHERE patient_nbr IS NOT NULL) * 0.8) AS is_test FROM "
    "(SELECT DISTINCT patient_nbr FROM eda WHERE patient_nbr IS NOT NULL)),\n"
    "sp AS (SELECT e.patient_nbr, is_test FROM eda e JOIN pt ON e.patient_nbr = pt.patient_nbr)"))
SQL["prior_visit_signal"] = with_enc(
    "SELECT signal, CASE WHEN c = 3 THEN '3+' ELSE CAST(c AS VARCHAR) END AS bucket, COUNT(*) AS count, "
    f"{rn(f'AVG(CAST({Y} AS DOUBLE))', 5)} AS positive_rate FROM (" + " UNION ALL ".join(
        f"SELECT {lit(s)} AS signal, LEAST(CAST({q(s)} AS BIGINT), 3) AS c, {Y} FROM eda WHERE {q(s)} IS NOT NULL"
        for s in ["number_inpatient", "number_emergency", "number_outpatient"]) + ") GROUP BY 1, 2", EDA)

_FCOLS = ["race", "payer_code", "medical_specialty", "A1Cresult"]
SQL["factorize_codes"] = with_enc(
    "SELECT e.encounter_id, " + ", ".join(f"COALESCE(f_{c}.code, -1) AS {c}_code" for c in _FCOLS)
    + " FROM eda e " + " ".join(
        f"LEFT JOIN (SELECT v, CAST(ROW_NUMBER() OVER (ORDER BY fk, v) - 1 AS INTEGER) AS code FROM "
        f"(SELECT {c} AS v, MIN(encounter_id) AS fk FROM eda WHERE {c} IS NOT NULL GROUP BY 1)) f_{c} "
        f"ON e.{c} = f_{c}.v" for c in _FCOLS), EDA)

_DOCS = "ld AS (SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
SQL["label_subgroup_rates"] = (
    "WITH " + _DOCS + f" SELECT attribute, level, n AS count, {rn('CAST(k AS DOUBLE) / n', 5)} AS positive_rate, "
    f"{rn(_wlo, 5)} AS ci_low, {rn(_whi, 5)} AS ci_high, (SELECT {rn('AVG(CAST(quality AS DOUBLE))', 5)} FROM ld) AS base "
    "FROM (" + " UNION ALL ".join(
        f"SELECT '{a}' AS attribute, COALESCE(CAST({a} AS VARCHAR), '«missing»') AS level, COUNT(*) AS n, "
        f"CAST(SUM(quality) AS BIGINT) AS k FROM ld GROUP BY 2" for a in ["lang", "source"]) + ")")
SQL["label_association"] = (
    "WITH " + _DOCS + ",\n" + cells_sql(["lang", "source"]).replace("FROM eda)", "FROM ld)").replace(
        f"SELECT {Y} AS y", "SELECT toxic AS y")
    + f"\nSELECT \"column\", {r6('v')} AS cramers_v, n, CAST(n_levels AS BIGINT) AS n_levels FROM ({cramer_sql('cells')})")
