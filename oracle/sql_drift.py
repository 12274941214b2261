"""Oracle SQL: drift statistics and the retrain decision."""
from __future__ import annotations

from cohort_spark import constants as C

from .enc import with_enc
from .sql import SQL, clean_cte, r6, rn
from .sql_core import feat_select, lit, q

FEAT_COLS = (
    ["race", "gender", "time_in_hospital", "payer_code", "medical_specialty", "num_lab_procedures",
     "num_procedures", "num_medications", "number_outpatient", "number_emergency", "number_inpatient",
     "number_diagnoses", "max_glu_serum", "A1Cresult"] + C.MODEL_DRUGS + ["change", "diabetesMed"]
    + ["diag_1_bucket", "diag_2_bucket", "diag_3_bucket", "diabetes_primary", "n_diabetes_diag",
       "n_med_changes", "n_meds_used", "a1c_measured", "glu_measured", "a1c_state",
       "service_utilization", "inpatient_ge_2", "age_midpoint", "age_bucket", "admission_type_grp",
       "admission_source_grp", "discharge_disposition_grp", "discharged_home"])
CAT = {"race", "gender", "payer_code", "medical_specialty", "max_glu_serum", "A1Cresult", "change",
       "diabetesMed", "diag_1_bucket", "diag_2_bucket", "diag_3_bucket", "a1c_state", "age_bucket",
       "admission_type_grp", "admission_source_grp", "discharge_disposition_grp"}
ALL = FEAT_COLS + ["prediction"]
NUM = [c for c in ALL if c not in CAT]
CATS = [c for c in ALL if c in CAT]
TOP = C.TOP_SHAP_FEATURES
SHIFTED = sorted(["age_midpoint", "age_bucket", "diag_1_bucket", "number_inpatient",
                  "service_utilization", "inpatient_ge_2", "admission_type_grp"])


def _hfrac(seed: str, frac: float) -> str:
    return (f"(('0x' || substr(md5('{seed}:' || CAST(encounter_id AS VARCHAR)), 1, 8))::UBIGINT / "
            f"4294967296.0 < {frac})")


# the registered scorecard and the columns that the vanished batch has lost
PRED = r6("1.0 / (1.0 + EXP(-(-3.0 + 0.35 * number_inpatient + 0.01 * age_midpoint + 0.03 * time_in_hospital + 0.05 * n_meds_used "
          "+ CASE WHEN admission_type_grp = 'Emergency' THEN 0.2 ELSE 0.0 END + CASE WHEN diag_1_bucket = 'Circulatory' THEN 0.25 ELSE 0.0 END)))")
VANISHED = [("medical_specialty", "VARCHAR"), ("number_inpatient", "INTEGER"), ("time_in_hospital", "INTEGER"), ("prediction", "DOUBLE")]
_MID = "CAST(LEAST(GREATEST(age_midpoint + 20, 5), 95) AS SMALLINT)"
BASE = (clean_cte(with_score=True) + ",\n"
        "feat AS (" + feat_select("clean", "target") + "),\n"
        "sp AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY target ORDER BY md5('42:' || "
        "CAST(encounter_id AS VARCHAR))) <= CEIL(COUNT(*) OVER (PARTITION BY target) * 0.2) "
        "THEN 'test' ELSE 'train' END AS split FROM feat),\n"
        f"ref AS (SELECT *, {PRED} AS prediction FROM sp WHERE split = 'train'),\n"
        f"control AS (SELECT *, {PRED} AS prediction FROM sp WHERE split = 'test'),\n"
        "vanished AS (SELECT * REPLACE (" + ", ".join(f"NULL::{t} AS {c}" for c, t in VANISHED) + ") FROM control),\n"
        f"shifted AS (SELECT *, {PRED} AS prediction FROM (SELECT * REPLACE ({_MID} AS age_midpoint, CASE WHEN {_MID} >= 60 THEN '[60-100)' "
        f"WHEN {_MID} >= 30 THEN '[30-60)' ELSE '[0-30)' END AS age_bucket, CASE WHEN {_hfrac('42-diag', 0.4)} "
        "THEN 'Circulatory' ELSE diag_1_bucket END AS diag_1_bucket, CAST(number_inpatient + 2 AS INTEGER) AS "
        "number_inpatient, CAST(service_utilization + 2 AS INTEGER) AS service_utilization, "
        "CAST(number_inpatient + 2 >= 2 AS TINYINT) AS inpatient_ge_2, CASE WHEN "
        f"{_hfrac('42-adm', 0.3)} THEN 'Emergency' ELSE admission_type_grp END AS admission_type_grp) FROM sp WHERE split = 'test')),\n"
        # columns constant on the reference are not monitored
        "refl AS (SELECT \"column\", value FROM (SELECT " + ", ".join(f"CAST({q(c)} AS VARCHAR) AS {q(c)}" for c in ALL)
        + " FROM ref) UNPIVOT INCLUDE NULLS (value FOR \"column\" IN (" + ", ".join(q(c) for c in ALL) + "))),\n"
        "consts AS (SELECT \"column\" FROM refl GROUP BY 1 HAVING COUNT(DISTINCT value) + "
        "MAX(CASE WHEN value IS NULL THEN 1 ELSE 0 END) <= 1)")


def _long(batch: str, cols: list[str], typ: str) -> str:
    sel = ", ".join(f"CAST({q(c)} AS {typ}) AS {q(c)}" for c in cols)
    inl = ", ".join(q(c) for c in cols)
    return (f"SELECT 'ref' AS side, \"column\", value FROM (SELECT {sel} FROM ref) UNPIVOT INCLUDE NULLS (value FOR \"column\" IN ({inl})) "
            f"UNION ALL SELECT 'cur', \"column\", value FROM (SELECT {sel} FROM {batch}) UNPIVOT INCLUDE NULLS (value FOR \"column\" IN ({inl}))")


def batch_ctes(b: str) -> str:
    """Per-batch CTEs: frequency tables, JS, Wasserstein/KS, chi², column drift."""
    return f""",
fn_{b} AS (SELECT "column", value, COUNT(*) FILTER (WHERE side = 'ref') AS n_ref, COUNT(*) FILTER (WHERE side = 'cur') AS n_cur
  FROM ({_long(b, NUM, 'DOUBLE')}) WHERE "column" NOT IN (SELECT "column" FROM consts) GROUP BY 1, 2),
fc_{b} AS (SELECT "column", value, COUNT(*) FILTER (WHERE side = 'ref') AS n_ref, COUNT(*) FILTER (WHERE side = 'cur') AS n_cur
  FROM ({_long(b, CATS, 'VARCHAR')}) WHERE "column" NOT IN (SELECT "column" FROM consts) GROUP BY 1, 2),
tn_{b} AS (SELECT "column", SUM(n_ref) AS rr, SUM(n_cur) AS rc, COALESCE(SUM(n_ref) FILTER (WHERE value IS NOT NULL), 0) AS tr,
  COALESCE(SUM(n_cur) FILTER (WHERE value IS NOT NULL), 0) AS tc, COUNT(value) AS nv, COUNT(*) AS k FROM fn_{b} GROUP BY 1),
tc_{b} AS (SELECT "column", SUM(n_ref) AS rr, SUM(n_cur) AS rc, COALESCE(SUM(n_ref) FILTER (WHERE value IS NOT NULL), 0) AS tr,
  COALESCE(SUM(n_cur) FILTER (WHERE value IS NOT NULL), 0) AS tc, COUNT(value) AS nv, COUNT(*) AS k FROM fc_{b} GROUP BY 1),
jsn_{b} AS (SELECT "column", CASE WHEN ANY_VALUE(gone) THEN 1 ELSE SQRT(GREATEST(SUM(CASE WHEN p > 0 THEN p * LN(p / m) ELSE 0 END + CASE WHEN qq > 0 THEN qq * LN(qq / m) ELSE 0 END) / 2, 0)) END AS js
  FROM (SELECT f."column", (tr > 0) <> (tc > 0) AS gone, n_ref / rr AS p, n_cur / rc AS qq, (n_ref / rr + n_cur / rc) / 2 AS m FROM fn_{b} f JOIN tn_{b} USING ("column")) GROUP BY 1),
jsc_{b} AS (SELECT "column", CASE WHEN ANY_VALUE(gone) THEN 1 ELSE SQRT(GREATEST(SUM(CASE WHEN p > 0 THEN p * LN(p / m) ELSE 0 END + CASE WHEN qq > 0 THEN qq * LN(qq / m) ELSE 0 END) / 2, 0)) END AS js
  FROM (SELECT f."column", (tr > 0) <> (tc > 0) AS gone, n_ref / rr AS p, n_cur / rc AS qq, (n_ref / rr + n_cur / rc) / 2 AS m FROM fc_{b} f JOIN tc_{b} USING ("column")) GROUP BY 1),
cdf_{b} AS (SELECT f."column", value, tr, tc, SUM(n_ref) OVER w / NULLIF(tr, 0) AS fr, SUM(n_cur) OVER w / NULLIF(tc, 0) AS fcur,
  LEAD(value) OVER w AS nxt FROM fn_{b} f JOIN tn_{b} USING ("column") WHERE value IS NOT NULL WINDOW w AS (PARTITION BY f."column" ORDER BY value)),
sd_{b} AS (SELECT "column", STDDEV_POP(value) AS sdr FROM ({_long(b, NUM, 'DOUBLE')}) WHERE side = 'ref' AND value IS NOT NULL GROUP BY 1),
wk_{b} AS (SELECT c."column", CASE WHEN ANY_VALUE((tr > 0) <> (tc > 0)) THEN 1 ELSE SUM(CASE WHEN nxt IS NOT NULL THEN ABS(fr - fcur) * (nxt - value) ELSE 0 END) / GREATEST(ANY_VALUE(sdr), 0.001) END AS w,
  CASE WHEN ANY_VALUE((tr > 0) <> (tc > 0)) THEN 1 ELSE MAX(ABS(fr - fcur)) END AS ks FROM cdf_{b} c JOIN sd_{b} USING ("column") GROUP BY 1),
chi_{b} AS (SELECT f."column", ANY_VALUE(rr + rc) * (SUM(n_ref * n_ref / (rr * (n_ref + n_cur)) + n_cur * n_cur / (rc * (n_ref + n_cur))) - 1) AS chi2
  FROM fc_{b} f JOIN tc_{b} USING ("column") GROUP BY 1),
cd_{b} AS (SELECT t."column", CASE WHEN nv > 5 THEN 'wasserstein' ELSE 'jensenshannon' END AS method,
  CASE WHEN nv > 5 THEN w ELSE js END AS score FROM tn_{b} t JOIN jsn_{b} USING ("column") LEFT JOIN wk_{b} USING ("column")
  UNION ALL SELECT "column", 'jensenshannon', js FROM jsc_{b}),
ds_{b} AS (SELECT COUNT(*) FILTER (WHERE score >= 0.1) AS drifted, COUNT(*) AS n_columns,
  COUNT(*) FILTER (WHERE score >= 0.1) / COUNT(*) AS share FROM cd_{b}),
psi_{b} AS ({_psi(b)})"""


def _psi(b: str) -> str:
    top = [c for c in TOP]
    sel = ", ".join(f"CAST({q(c)} AS VARCHAR) AS {q(c)}" for c in top)
    inl = ", ".join(q(c) for c in top)
    num_top = [c for c in top if c not in CAT]
    edges = " UNION ALL ".join(
        f"SELECT {lit(c)} AS \"column\", list_sort(list_distinct(quantile_cont(CAST({q(c)} AS DOUBLE), "
        f"[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM ref" for c in num_top)
    return (f"SELECT \"column\", SUM((c - r) * LN(c / r)) AS psi FROM (SELECT l.\"column\", "
            f"GREATEST(n_ref / SUM(n_ref) OVER (PARTITION BY l.\"column\"), 1e-6) AS r, "
            f"GREATEST(n_cur / SUM(n_cur) OVER (PARTITION BY l.\"column\"), 1e-6) AS c FROM (SELECT \"column\", v, "
            f"COUNT(*) FILTER (WHERE side = 'ref') AS n_ref, COUNT(*) FILTER (WHERE side = 'cur') AS n_cur FROM ("
            f"SELECT side, x.\"column\", CASE WHEN nd > 10 AND x.\"column\" IN ({', '.join(lit(c) for c in num_top)}) "
            f"THEN 'bin:' || CAST(len(list_filter(e[2:len(e) - 1], lambda t: t <= CAST(value AS DOUBLE))) AS VARCHAR) "
            f"ELSE value END AS v FROM (SELECT 'ref' AS side, \"column\", value FROM (SELECT {sel} FROM ref) UNPIVOT "
            f"(value FOR \"column\" IN ({inl})) UNION ALL SELECT 'cur', \"column\", value FROM (SELECT {sel} FROM {b}) "
            f"UNPIVOT (value FOR \"column\" IN ({inl}))) x JOIN (SELECT \"column\", COUNT(DISTINCT value) AS nd FROM "
            f"(SELECT {sel} FROM ref) UNPIVOT (value FOR \"column\" IN ({inl})) GROUP BY 1) d ON x.\"column\" = d.\"column\" "
            f"LEFT JOIN ({edges}) eg ON x.\"column\" = eg.\"column\" "
            f"WHERE x.\"column\" NOT IN (SELECT \"column\" FROM consts)) GROUP BY 1, 2) l) GROUP BY 1")


ALL_CTES = BASE + batch_ctes("control") + batch_ctes("shifted")
VANISHED_CTES = BASE + batch_ctes("vanished")


def _both(select_tpl: str) -> str:
    return " UNION ALL ".join(select_tpl.format(b=b) for b in ("control", "shifted"))


_NUM_TOP = [c for c in TOP if c not in CAT]
_CAT_TOP = [c for c in TOP if c in CAT]
SQL["psi_numeric"] = with_enc(_both(
    "SELECT \"column\" AS feature, " + rn("psi", 4) + " AS psi, '{b}' AS batch FROM psi_{b} WHERE \"column\" IN ("
    + ", ".join(lit(c) for c in _NUM_TOP) + ")"), ALL_CTES)
SQL["psi_categorical"] = with_enc(_both(
    "SELECT \"column\" AS feature, " + rn("psi", 4) + " AS psi, '{b}' AS batch FROM psi_{b} WHERE \"column\" IN ("
    + ", ".join(lit(c) for c in _CAT_TOP) + ")"), ALL_CTES)
SQL["top_feature_psi"] = with_enc(_both(
    "SELECT \"column\" AS feature, " + rn("psi", 4) + " AS psi, '{b}' AS batch FROM psi_{b}"), ALL_CTES)
SQL["wasserstein"] = with_enc(_both(
    "SELECT \"column\", " + r6("score") + " AS score, score >= 0.1 AS drifted, '{b}' AS batch FROM cd_{b} "
    "WHERE method = 'wasserstein'"), ALL_CTES)
SQL["jensen_shannon"] = with_enc(_both(
    "SELECT \"column\", " + r6("score") + " AS score, score >= 0.1 AS drifted, '{b}' AS batch FROM cd_{b} "
    "WHERE method = 'jensenshannon'"), ALL_CTES)
SQL["ks_statistic"] = with_enc(_both("SELECT \"column\", " + r6("ks") + " AS ks, '{b}' AS batch FROM wk_{b}"),
                               ALL_CTES)
SQL["chi2_statistic"] = with_enc(_both("SELECT \"column\", " + r6("chi2") + " AS chi2, '{b}' AS batch FROM chi_{b}"),
                                 ALL_CTES)
SQL["drift_share"] = with_enc(_both(
    "SELECT drifted, n_columns, " + r6("share") + " AS share, share >= 0.1 AS dataset_drift, '{b}' AS batch FROM ds_{b}"),
    ALL_CTES)


def _ap(b: str) -> str:
    return (f"(SELECT CASE WHEN P > 0 AND N > 0 THEN SUM(pos / P * tp / (tp + fp)) END FROM (SELECT pos, "
            f"SUM(pos) OVER (ORDER BY s DESC) AS tp, SUM(neg) OVER (ORDER BY s DESC) AS fp, SUM(pos) OVER () AS P, "
            f"SUM(neg) OVER () AS N FROM (SELECT prediction AS s, SUM(target) AS pos, COUNT(*) - SUM(target) AS neg "
            f"FROM {b} GROUP BY 1)) GROUP BY P, N)")


def _decision(b: str) -> str:
    hot = (f"(SELECT string_agg(\"column\" || '=' || printf('%.2f', {rn('psi', 2)}), ', ' ORDER BY psi DESC, \"column\") "
           f"FROM psi_{b} WHERE psi > 0.2)")
    share = f"(SELECT share FROM ds_{b})"
    ap = _ap(b)
    r1 = f"CASE WHEN {share} > 0.1 THEN 'drifted columns: ' || printf('%.3f', {rn(share, 3)}) || ' of all, at most 0.1 allowed' END"
    r2 = f"CASE WHEN {hot} IS NOT NULL THEN 'watched features with PSI over 0.2: ' || {hot} END"
    r3 = f"CASE WHEN {ap} < 0.15 THEN 'average precision: ' || printf('%.3f', {rn(ap, 3)}) || ', at least 0.15 wanted' END"
    n = " + ".join(f"CAST(({r}) IS NOT NULL AS INTEGER)" for r in (r1, r2, r3))
    return (f"SELECT ({n}) > 0 AS trigger, CAST({n} AS INTEGER) AS n_reasons, concat_ws('; ', {r1}, {r2}, {r3}) "
            f"AS reasons, '{b}' AS batch")


SQL["retrain_decision"] = with_enc(_decision("control") + " UNION ALL " + _decision("shifted"), ALL_CTES)
SQL["score_means"] = with_enc(
    "SELECT batch, " + rn("AVG(prediction)", 4) + " AS mean_score FROM (SELECT 'baseline' AS batch, prediction FROM ref "
    "UNION ALL SELECT 'control', prediction FROM control UNION ALL SELECT 'shifted', prediction FROM shifted) GROUP BY 1",
    BASE)
SQL["what_if_shift"] = with_enc("SELECT encounter_id, " + ", ".join(SHIFTED) + ", prediction FROM shifted", BASE)
SQL["drift_vanished"] = with_enc("SELECT \"column\", method, " + r6("score") + " AS score, score >= 0.1 AS drifted FROM cd_vanished", VANISHED_CTES)
SQL["stream_drift"] = SQL["retrain_decision"]
_facts = lambda cols, kind: (
    "SELECT \"column\", '" + kind + "' AS kind, COUNT(*) AS \"rows\", COUNT(*) - COUNT(value) AS missing, COUNT(DISTINCT value) AS n_values, "
    + (r6("STDDEV_POP(value)") if kind == "numeric" else "CAST(NULL AS DOUBLE)") + " AS std, "
    + ("CAST(CASE WHEN COUNT(DISTINCT value) > 10 THEN GREATEST(len(list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) - 2, 0) "
       "ELSE 0 END AS INTEGER)" if kind == "numeric" else "0") + " AS n_edges FROM (" + _long("ref", cols, "DOUBLE" if kind == "numeric" else "VARCHAR")
    + ") WHERE side = 'ref' GROUP BY 1")
SQL["reference_snapshot"] = with_enc(_facts(NUM, "numeric") + " UNION ALL " + _facts(CATS, "category"), BASE)

# p-values: Kolmogorov's series, and the incomplete gamma function's power series
_GQ = ("CASE WHEN {x} <= 0 THEN 1.0 ELSE GREATEST(0.0, 1.0 - list_sum(list_transform(range(0, 3000), lambda i: "
       "EXP({a} * LN({x}) - {x} + i * LN({x}) - lgamma({a} + i + 1))))) END")


def _tests(b: str) -> str:
    few = (f"(SELECT f.*, rr, rc, k FROM fn_{b} f JOIN tn_{b} USING (\"column\") WHERE nv <= 5 UNION ALL "
           f"SELECT \"column\", CAST(value AS VARCHAR), n_ref, n_cur, rr, rc, k FROM fc_{b} f JOIN tc_{b} USING (\"column\"))").replace(
        "SELECT f.*", "SELECT f.\"column\", CAST(value AS VARCHAR) AS value, n_ref, n_cur")
    lam = "(SQRT(tr * tc / (tr + tc)) * ks)"
    k_sf = (f"CASE WHEN {lam} <= 0.05 THEN 1.0 ELSE LEAST(1.0, GREATEST(0.0, 2 * list_sum(list_transform(range(1, 200), "
            f"lambda i: CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END * EXP(-2.0 * i * i * {lam} * {lam}))))) END")
    return (f"SELECT \"column\", 'ks' AS method, ks AS statistic, {k_sf} AS p FROM wk_{b} JOIN tn_{b} USING (\"column\") WHERE nv > 5 "
            f"UNION ALL SELECT \"column\", 'z', z, {_GQ.format(a='0.5', x='(z * z / 2)')} FROM (SELECT \"column\", "
            f"(c / rc - r / rr) / SQRT((r + c) / (rr + rc) * (1 - (r + c) / (rr + rc)) * (1.0 / rr + 1.0 / rc)) AS z FROM (SELECT \"column\", "
            f"arg_max(n_ref, COALESCE(value, '')) AS r, arg_max(n_cur, COALESCE(value, '')) AS c, ANY_VALUE(rr) AS rr, ANY_VALUE(rc) AS rc "
            f"FROM {few} WHERE k = 2 GROUP BY 1)) "
            f"UNION ALL SELECT \"column\", 'chi2', chi2, CASE WHEN k > 1 THEN {_GQ.format(a='((k - 1) / 2)', x='(chi2 / 2)')} ELSE 1.0 END FROM ("
            f"SELECT \"column\", ANY_VALUE(k) AS k, ANY_VALUE(rr + rc) * (SUM(n_ref * n_ref / (rr * (n_ref + n_cur)) + n_cur * n_cur / (rc * (n_ref + n_cur))) - 1) AS chi2 "
            f"FROM {few} WHERE k <> 2 GROUP BY 1)")


SQL["drift_p_values"] = with_enc(" UNION ALL ".join(
    f"SELECT '{b}' AS batch, \"column\", method, {rn('statistic', 4)} AS statistic, {rn('p', 4)} AS p_value, p < 0.05 AS drifted FROM ({_tests(b)})"
    for b in ("control", "shifted")), ALL_CTES)
SQL["drift_validation"] = with_enc(
    "SELECT c.share >= 0.1 AS control_drift, s.share >= 0.1 AS shifted_drift, k.n_caught, k.n_shifted_features, "
    "k.prediction_drift, NOT (c.share >= 0.1) AND s.share >= 0.1 AS detector_pass FROM ds_control c, ds_shifted s, "
    "(SELECT COUNT(*) FILTER (WHERE score >= 0.1 AND \"column\" IN (" + ", ".join(lit(c) for c in SHIFTED) + ")) AS n_caught, "
    "COUNT(*) FILTER (WHERE \"column\" IN (" + ", ".join(lit(c) for c in SHIFTED) + ")) AS n_shifted_features, "
    "BOOL_OR(score >= 0.1 AND \"column\" = 'prediction') AS prediction_drift FROM cd_shifted) k", ALL_CTES)
