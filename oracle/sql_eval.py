"""Oracle SQL: splits, joins, ranking/threshold metrics and fairness."""
from __future__ import annotations

from .enc import with_enc
from .sql import SQL, clean_cte, r6, raw_pipeline_cte
from .sql_core import RAW_EDA

THR = 0.091046
_MID = "(TRY_CAST(regexp_extract(age, '\\[(\\d+)-', 1) AS INTEGER) + 5)"
SPLIT = (clean_cte(with_score=True) + ",\n"
         "sp AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY target ORDER BY md5('42:' || "
         "CAST(encounter_id AS VARCHAR))) <= CEIL(COUNT(*) OVER (PARTITION BY target) * 0.2) "
         "THEN 'test' ELSE 'train' END AS split FROM clean),\n"
         f"t AS (SELECT encounter_id, target AS label, score, '[' || CAST({_MID} - 5 AS VARCHAR) || '-' || "
         f"CAST({_MID} + 5 AS VARCHAR) || ')' AS age_10yr, CASE WHEN {_MID} < 30 THEN '[0-30)' "
         f"WHEN {_MID} < 60 THEN '[30-60)' WHEN {_MID} >= 60 THEN '[60-100)' END AS age_coarse, gender, race "
         "FROM sp WHERE split = 'test')")
CURVE = (SPLIT + ",\n"
         "ties AS (SELECT score, CAST(SUM(label) AS BIGINT) AS pos, CAST(COUNT(*) - SUM(label) AS BIGINT) AS neg "
         "FROM t WHERE score IS NOT NULL GROUP BY score),\n"
         "tot AS (SELECT SUM(pos) AS P, SUM(neg) AS N FROM ties),\n"
         "cv AS (SELECT score, pos, neg, SUM(pos) OVER (ORDER BY score DESC) AS tp, "
         "SUM(neg) OVER (ORDER BY score DESC) AS fp, P, N FROM ties, tot),\n"
         "cur AS (SELECT *, tp / (tp + fp) AS precision, CASE WHEN P > 0 THEN CAST(tp AS DOUBLE) / P END AS recall, "
         "CASE WHEN N > 0 THEN CAST(fp AS DOUBLE) / N END AS fpr, (tp + fp) / (P + N) AS flag_rate FROM cv)")


def _r(cols: list[str]) -> str:
    return ", ".join(f"{r6(c)} AS {c}" for c in cols)


SQL["stratified_split"] = with_enc("SELECT encounter_id, target, split FROM sp", SPLIT)
SQL["stratified_folds"] = with_enc(
    "SELECT encounter_id, target, CAST((ROW_NUMBER() OVER (PARTITION BY target ORDER BY md5('42:' || "
    "CAST(encounter_id AS VARCHAR))) - 1) % 5 AS INTEGER) AS fold FROM clean", clean_cte(with_score=True))
SQL["sample_n"] = with_enc(
    "SELECT encounter_id, patient_nbr FROM raw ORDER BY md5('42:' || CAST(encounter_id AS VARCHAR)) LIMIT 3000",
    raw_pipeline_cte())
SQL["random_heldout"] = with_enc(
    "SELECT encounter_id, patient_nbr, target = 1 AS was_readmitted_30d FROM sp WHERE split = 'test' "
    "ORDER BY md5('7:' || CAST(encounter_id AS VARCHAR)) LIMIT 1", SPLIT)
SQL["heldout_semi"] = with_enc(
    "SELECT * FROM raw WHERE encounter_id IN (SELECT encounter_id FROM sp WHERE split = 'test')", SPLIT)
SQL["patient_intersect"] = with_enc(
    "SELECT patient_nbr FROM rs WHERE NOT is_test INTERSECT SELECT patient_nbr FROM rs WHERE is_test",
    RAW_EDA + ",\nrs AS (SELECT patient_nbr, ROW_NUMBER() OVER (ORDER BY md5('42:' || CAST(encounter_id AS VARCHAR)))"
    " > FLOOR((SELECT COUNT(*) FROM raw_eda) * 0.8) AS is_test FROM raw_eda)")
SQL["label_feedback_join"] = with_enc(
    "SELECT t.encounter_id, t.score, CAST(COALESCE(r.readmitted = '<30', FALSE) AS TINYINT) AS label "
    "FROM t JOIN raw r ON t.encounter_id = r.encounter_id", SPLIT)
SQL["split_anti"] = with_enc(
    "SELECT encounter_id, target FROM clean WHERE encounter_id NOT IN "
    "(SELECT encounter_id FROM sp WHERE split = 'test')", SPLIT)

# ---------------------------------------------------------------- metrics
SQL["pr_curve"] = with_enc(
    "SELECT " + _r(["threshold", "precision", "recall"]) + " FROM (SELECT score AS threshold, precision, recall "
    "FROM cur UNION ALL SELECT NULL, 1.0, 0.0)", CURVE)
_RANK = ("rk AS (SELECT CASE WHEN P > 0 AND N > 0 THEN SUM(pos / P * precision) END AS average_precision, "
         "CASE WHEN P > 0 AND N > 0 THEN SUM(pos * (N - fp + neg * 0.5)) / (P * N) END AS roc_auc, "
         "CAST(P AS DOUBLE) / (P + N) AS prevalence, CAST(P + N AS BIGINT) AS n, CAST(P AS BIGINT) AS positives "
         "FROM cur GROUP BY P, N)")
SQL["average_precision"] = with_enc(
    "SELECT " + _r(["average_precision", "prevalence"]) + ", n, positives FROM rk", CURVE + ",\n" + _RANK)
SQL["roc_curve"] = with_enc(
    "SELECT threshold, " + _r(["fpr", "tpr"]) + " FROM (SELECT score AS threshold, fpr, recall AS tpr FROM cur "
    "UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0)", CURVE)
SQL["roc_auc"] = with_enc("SELECT " + _r(["roc_auc"]) + " FROM rk", CURVE + ",\n" + _RANK)
SQL["brier"] = with_enc(f"SELECT {r6('AVG((score - label) * (score - label))')} AS brier FROM t", SPLIT)
SQL["recall_at_precision"] = with_enc(
    f"SELECT {r6('GREATEST(0.0, COALESCE(MAX(recall) FILTER (WHERE precision >= 0.3), 0.0))')} AS recall_at_precision, "
    "CAST(0.3 AS DOUBLE) AS target_precision FROM cur", CURVE)


def _sens(targets: list[float], src: str = "cur", groups: str = "") -> str:
    g = (groups + ", ") if groups else ""
    gs = ("".join(f"h.{x.strip()}, " for x in groups.split(","))) if groups else ""
    on = " AND ".join(f"h.{x.strip()} = c.{x.strip()}" for x in groups.split(",")) if groups else "TRUE"
    parts = []
    for tr in targets:
        parts.append(
            f"SELECT {gs}CAST({tr} AS DOUBLE) AS target_recall, COALESCE(h.thr, 0.0) AS threshold, "
            f"CASE WHEN h.thr IS NULL THEN lo.precision ELSE c.precision END AS precision, "
            f"CASE WHEN h.thr IS NULL THEN lo.recall ELSE c.recall END AS recall, "
            f"CASE WHEN h.thr IS NULL THEN 1.0 ELSE c.flag_rate END AS flag_rate "
            f"FROM (SELECT {g}MAX(score) FILTER (WHERE recall >= {tr}) AS thr FROM {src} {'GROUP BY ' + groups if groups else ''}) h "
            f"LEFT JOIN {src} c ON {on} AND c.score = h.thr "
            f"JOIN (SELECT {g}arg_min(precision, score) AS precision, arg_min(recall, score) AS recall FROM {src} "
            f"{'GROUP BY ' + groups if groups else ''}) lo ON " + (
                " AND ".join(f"lo.{x.strip()} = h.{x.strip()}" for x in groups.split(",")) if groups else "TRUE"))
    return " UNION ALL ".join(parts)


SQL["threshold_for_recall"] = with_enc(
    "SELECT target_recall, " + _r(["threshold", "precision", "recall", "flag_rate"]) + f" FROM ({_sens([0.5])})", CURVE)
SQL["threshold_sensitivity"] = with_enc(
    "SELECT target_recall, " + _r(["threshold", "precision", "recall", "flag_rate"])
    + f" FROM ({_sens([0.4, 0.5, 0.6])})", CURVE)
_CONF = ("SELECT COUNT(*) FILTER (WHERE NOT f AND label = 0) AS tn, COUNT(*) FILTER (WHERE f AND label = 0) AS fp, "
         "COUNT(*) FILTER (WHERE NOT f AND label = 1) AS fn, COUNT(*) FILTER (WHERE f AND label = 1) AS tp, "
         "COUNT(*) AS n FROM (SELECT label, score >= {thr} AS f FROM t)")
_CONF_OUT = ("SELECT tn, fp, fn, tp, " + r6("CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END") + " AS precision, "
             + r6("CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END") + " AS recall, "
             + r6("(tp + fp) / n") + " AS flag_rate")
SQL["operating_point"] = with_enc(
    _CONF_OUT + ", " + r6("thr") + " AS threshold, " + r6("(tp + fp) / n * 50") + " AS alerts_per_day FROM ("
    + _CONF.format(thr="(SELECT threshold FROM th)") + "), th", CURVE + f",\nth AS (SELECT threshold AS thr, threshold FROM ({_sens([0.5])}))")
SQL["confusion"] = with_enc(_CONF_OUT + " FROM (" + _CONF.format(thr="0.5") + ")", SPLIT)
SQL["reliability_curve"] = with_enc(
    "SELECT CAST(bin AS INTEGER) AS bin, " + r6("AVG(score)") + " AS mean_predicted, "
    + r6("AVG(CAST(label AS DOUBLE))") + " AS fraction_positive, COUNT(*) AS count FROM (SELECT score, label, "
    "len(list_filter(e, lambda x: x < score)) AS bin FROM t, (SELECT quantile_cont(score, [0.1, 0.2, 0.3, 0.4, "
    "0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM t)) GROUP BY bin", SPLIT)
SQL["tripwire"] = with_enc("SELECT " + _r(["roc_auc"]) + ", roc_auc > 0.75 AS tripped FROM rk", CURVE + ",\n" + _RANK)

# ---------------------------------------------------------------- fairness
_ATTRS = ["age_10yr", "age_coarse", "gender", "race"]
SLICES = (SPLIT + ",\nsl AS (SELECT label AS y, score, attribute, level FROM (SELECT label, score, "
          + ", ".join(f"CAST({a} AS VARCHAR) AS {a}" for a in _ATTRS) + " FROM t) UNPIVOT INCLUDE NULLS "
          "(level FOR attribute IN (" + ", ".join(_ATTRS) + ")))")
BYG = (f"byg AS (SELECT attribute, level, support, p / support AS prevalence, CASE WHEN p > 0 THEN tp / p ELSE 0.0 END "
       "AS recall, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, (tp + fp) / support AS flag_rate, "
       "CASE WHEN n > 0 THEN fp / n ELSE 0.0 END AS fpr, support < 100 AS low_support FROM (SELECT attribute, level, "
       f"COUNT(*) AS support, COUNT(*) FILTER (WHERE y = 1) AS p, COUNT(*) FILTER (WHERE score >= {THR} AND y = 1) AS tp, "
       f"COUNT(*) FILTER (WHERE score >= {THR} AND y = 0) AS fp, COUNT(*) FILTER (WHERE y = 0) AS n FROM sl GROUP BY 1, 2))")
SQL["fairness_by_group"] = with_enc(
    "SELECT attribute, level, support, " + _r(["prevalence", "recall", "precision", "flag_rate", "fpr"])
    + ", low_support FROM byg", SLICES + ",\n" + BYG)
GCURVE = (SLICES + ",\ngties AS (SELECT attribute, level, score, SUM(y) AS pos, COUNT(*) - SUM(y) AS neg FROM sl "
          "WHERE score IS NOT NULL GROUP BY 1, 2, 3),\n"
          "gtot AS (SELECT attribute, level, SUM(pos) AS P, SUM(neg) AS N FROM gties GROUP BY 1, 2),\n"
          "gcur AS (SELECT g.*, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp, P, N FROM gties g JOIN gtot USING "
          "(attribute, level) WINDOW w AS (PARTITION BY attribute, level ORDER BY score DESC)),\n"
          "gc AS (SELECT *, tp / (tp + fp) AS precision, CASE WHEN P > 0 THEN tp / P END AS recall, "
          "(tp + fp) / (P + N) AS flag_rate FROM gcur)")
SQL["fairness_rank_metrics"] = with_enc(
    "SELECT attribute, level, " + _r(["average_precision", "roc_auc"]) + " FROM (SELECT attribute, level, "
    "CASE WHEN ANY_VALUE(P) > 0 AND ANY_VALUE(N) > 0 THEN SUM(pos / P * precision) END AS average_precision, "
    "CASE WHEN ANY_VALUE(P) > 0 AND ANY_VALUE(N) > 0 THEN SUM(pos * (N - fp + neg * 0.5)) / (ANY_VALUE(P) * ANY_VALUE(N)) END "
    "AS roc_auc FROM gc GROUP BY 1, 2)", GCURVE)
SQL["fairness_disparity"] = with_enc(
    "SELECT attribute, " + _r(["demographic_parity_diff", "equalized_odds_diff", "recall_gap", "flag_rate_gap",
                               "overall_recall", "overall_flag_rate"]) + " FROM (SELECT attribute, "
    "MAX(flag_rate) - MIN(flag_rate) AS demographic_parity_diff, GREATEST(MAX(recall) - MIN(recall), MAX(fpr) - MIN(fpr)) "
    "AS equalized_odds_diff, MAX(recall) - MIN(recall) AS recall_gap, MAX(flag_rate) - MIN(flag_rate) AS flag_rate_gap "
    f"FROM byg GROUP BY 1), (SELECT COUNT(*) FILTER (WHERE score >= {THR} AND label = 1) / GREATEST(COUNT(*) FILTER "
    f"(WHERE label = 1), 1) AS overall_recall, AVG(CAST(score >= {THR} AS DOUBLE)) AS overall_flag_rate FROM t)",
    SLICES + ",\n" + BYG)
SQL["review_routing"] = with_enc(
    f"SELECT encounter_id, CASE WHEN score BETWEEN 0.07 AND 0.12 THEN 'review' WHEN score < {THR} AND age_10yr IN "
    "('[40-50)', '[50-60)') THEN 'escalate' ELSE 'standard' END AS routing, CASE WHEN COALESCE(b.low_support, FALSE) "
    "THEN 'lower' ELSE 'normal' END AS confidence FROM t LEFT JOIN (SELECT level, low_support FROM byg WHERE "
    "attribute = 'race') b ON COALESCE(CAST(t.race AS VARCHAR), 'null') = b.level", SLICES + ",\n" + BYG)
SQL["group_thresholds"] = with_enc(
    "SELECT attribute, level, target_recall, " + _r(["threshold", "precision", "recall", "flag_rate"])
    + f" FROM ({_sens([0.5], 'gc', 'attribute, level')})",
    GCURVE.replace("FROM sl WHERE", "FROM sl WHERE attribute = 'age_coarse' AND"))
