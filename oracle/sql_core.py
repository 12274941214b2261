"""Oracle SQL: sources, data quality, cleaning, dedup, features."""
from __future__ import annotations

from cohort_spark import constants as C

from .enc import with_enc
from .sql import SQL, clean_cte, icd9_bucket_sql, icd9_chapter_sql, r6, raw_pipeline_cte, rn

EDA_TOKENS = ["?", "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
              "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan",
              "null"]
THR = 0.091046


def q(c: str) -> str:
    return f'"{c}"'


def lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def in_list(vals) -> str:
    return "(" + ", ".join(lit(v) for v in vals) + ")"


def is_string(c: str) -> bool:
    return c not in C.KEY_COLS and c not in C.INT_RANGES


def raw_eda_cte() -> str:
    cols = []
    for c in C.RAW_COLUMNS:
        if is_string(c):
            cols.append(f"CASE WHEN {q(c)} IN {in_list(EDA_TOKENS)} THEN NULL ELSE {q(c)} END AS {q(c)}")
        else:
            cols.append(q(c))
    cols.append("score")
    return "raw_eda AS (SELECT " + ", ".join(cols) + " FROM enc)"


def map_case(expr: str, mapping: dict, default: str | None) -> str:
    parts = " ".join(f"WHEN {k} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {expr} {parts} ELSE {lit(default) if default is not None else 'NULL'} END"


def feat_select(src: str, keep: str = "target") -> str:
    """Featurization of a clean-shaped relation ``src`` as SQL."""
    cols = []
    drop = set(C.DIAG_COLS) | {"age", "admission_type_id", "admission_source_id",
                               "discharge_disposition_id"}
    clean_cols = [c for c in C.RAW_COLUMNS if c not in C.DROPPED_IN_CLEANING and c != "readmitted"]
    for c in clean_cols:
        if c in drop:
            continue
        if c in C.MODEL_DRUGS:
            cols.append(f"CAST({map_case(q(c), {lit(k): v for k, v in C.DRUG_ORDINAL.items()}, None)}"
                        f" AS TINYINT) AS {q(c)}")
        else:
            cols.append(q(c))
    cols.append(keep)
    b = {d: icd9_bucket_sql(d) for d in C.DIAG_COLS}
    for d in C.DIAG_COLS:
        cols.append(f"{b[d]} AS {d}_bucket")
    cols.append(f"CAST(({b['diag_1']}) = 'Diabetes' AS TINYINT) AS diabetes_primary")
    cols.append("CAST(" + " + ".join(f"CAST(({b[d]}) = 'Diabetes' AS INTEGER)" for d in C.DIAG_COLS)
                + " AS TINYINT) AS n_diabetes_diag")
    cols.append("CAST(" + " + ".join(f"CAST(COALESCE({q(d)} IN ('Up','Down'), FALSE) AS INTEGER)"
                                     for d in C.MODEL_DRUGS) + " AS TINYINT) AS n_med_changes")
    cols.append("CAST(" + " + ".join(f"CAST(COALESCE({q(d)} <> 'No', FALSE) AS INTEGER)"
                                     for d in C.MODEL_DRUGS) + " AS TINYINT) AS n_meds_used")
    cols.append("CAST(COALESCE(A1Cresult IN ('>7','>8','Norm'), FALSE) AS TINYINT) AS a1c_measured")
    cols.append("CAST(COALESCE(max_glu_serum IN ('>200','>300','Norm'), FALSE) AS TINYINT) AS glu_measured")
    cols.append("CASE WHEN A1Cresult IN ('>7','>8') AND COALESCE(change = 'Ch', FALSE) THEN 'high_changed' "
                "WHEN A1Cresult IN ('>7','>8') THEN 'high_not_changed' "
                "WHEN A1Cresult = 'Norm' THEN 'normal' ELSE 'no_test' END AS a1c_state")
    cols.append("CAST(number_outpatient + number_emergency + number_inpatient AS INTEGER) AS service_utilization")
    cols.append("CAST(number_inpatient >= 2 AS TINYINT) AS inpatient_ge_2")
    mid = "(TRY_CAST(regexp_extract(age, '\\[(\\d+)-', 1) AS INTEGER) + 5)"
    cols.append(f"CAST({mid} AS SMALLINT) AS age_midpoint")
    cols.append(f"CASE WHEN {mid} < 30 THEN '[0-30)' WHEN {mid} < 60 THEN '[30-60)' WHEN {mid} >= 60 THEN '[60-100)' END AS age_bucket")
    cols.append(map_case("admission_type_id", C.ADMISSION_TYPE_GROUP, "Unknown") + " AS admission_type_grp")
    cols.append(map_case("admission_source_id", C.ADMISSION_SOURCE_GROUP, "Unknown") + " AS admission_source_grp")
    cols.append(map_case("discharge_disposition_id", C.DISCHARGE_DISPOSITION_GROUP, "Unknown")
                + " AS discharge_disposition_grp")
    cols.append("CAST(COALESCE(discharge_disposition_id IN (1, 6, 8), FALSE) AS TINYINT) AS discharged_home")
    return "SELECT " + ",\n  ".join(cols) + f" FROM {src}"


FEAT_CTE = clean_cte() + ",\nfeat AS (" + feat_select("clean") + ")"
RAW = raw_pipeline_cte()
RAW_EDA = raw_eda_cte()
LITERAL = "lit AS (SELECT * EXCLUDE (score) FROM enc)"

# ====================================================================== sources
SQL["scan_sentinel_null"] = with_enc("SELECT * FROM raw", RAW)
SQL["scan_eda_null"] = with_enc("SELECT * FROM raw_eda", RAW_EDA)
SQL["scan_pruned"] = "SELECT o_orderkey AS encounter_id, o_custkey AS patient_nbr FROM orders"


def _decode(c: str) -> str:
    m = C.ID_DECODERS[c]
    return (f"CASE WHEN {c} IS NULL THEN NULL ELSE COALESCE({map_case(c, m, None)}, "
            f"'Unknown code ' || CAST({c} AS VARCHAR)) END AS {c}_label")


SQL["decode_ids"] = with_enc(
    "SELECT encounter_id, admission_type_id, discharge_disposition_id, admission_source_id, "
    + ", ".join(_decode(c) for c in C.ADMINISTRATIVE_ID_COLS) + " FROM raw", RAW)

# ====================================================================== quality


def _violation_sql(kind, c, vals=None, lo=None, hi=None):
    c = q(c)
    if kind == "in_set":
        return f"{c} IS NOT NULL AND {c} NOT IN {in_list(vals)}"
    if kind == "between":
        return f"{c} IS NOT NULL AND NOT ({c} BETWEEN {lo} AND {hi})"
    return f"{c} IS NULL"


def raw_checks():
    out = [("in_set", C.TARGET_RAW, C.READMITTED_VALUES, None, None),
           ("not_null", "gender", None, None, None)]
    for c, vals in C.CATEGORICAL_VALUES.items():
        out.append(("in_set", c, list(vals) + (["?"] if c in C.NULLABLE else []), None, None))
    for c, (lo, hi) in C.INT_RANGES.items():
        out.append(("between", c, None, lo, hi))
    for d in C.ALL_DRUGS:
        out.append(("in_set", d, C.DRUG_VALUES, None, None))
    return out


def _check_rows(src: str, kind_filter=None) -> str:
    checks = [c for c in raw_checks() if kind_filter is None or c[0] == kind_filter]
    aggs = ", ".join(
        f"CAST(SUM(CASE WHEN {_violation_sql(k, c, v, lo, hi)} THEN 1 ELSE 0 END) AS BIGINT) AS v{i}"
        for i, (k, c, v, lo, hi) in enumerate(checks))
    rows = " UNION ALL ".join(
        f"SELECT {lit(k)} AS \"check\", {lit(c)} AS \"column\", v{i} AS n_unexpected, v{i} = 0 AS success FROM a"
        for i, (k, c, v, lo, hi) in enumerate(checks))
    return f"a AS (SELECT {aggs} FROM {src}), chk AS ({rows})"


for _kind in ("in_set", "not_null", "between"):
    SQL[f"dq_{_kind}"] = with_enc('SELECT "column", n_unexpected, success FROM chk',
                                  LITERAL + ",\n" + _check_rows("lit", _kind))

SQL["dq_columns_match"] = with_enc(
    "SELECT 'columns_match' AS \"check\", CAST(0 AS BIGINT) AS n_unexpected, TRUE AS success "
    "FROM (SELECT COUNT(*) AS n FROM lit)", LITERAL)
SQL["dq_row_count"] = with_enc("SELECT COUNT(*) AS n_rows, COUNT(*) >= 1 AS success FROM lit",
                               LITERAL)
SQL["dq_unique"] = with_enc(
    "SELECT 'patient_nbr' AS \"column\", CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_unexpected, "
    "COALESCE(SUM(n), 0) = 0 AS success FROM (SELECT patient_nbr, COUNT(*) AS n FROM feat "
    "WHERE patient_nbr IS NOT NULL GROUP BY patient_nbr HAVING COUNT(*) > 1)", FEAT_CTE)
SQL["dq_mean_between"] = with_enc(
    f"SELECT m AS mean, m BETWEEN 0.08 AND 0.12 AS success FROM "
    f"(SELECT {r6('AVG(CAST(target AS DOUBLE))')} AS m FROM feat)", FEAT_CTE)


def _suite_rows(src: str, suite: str) -> str:
    """(check label, success) rows of the full raw suite over ``src``."""
    checks = raw_checks()
    aggs = ", ".join(
        f"SUM(CASE WHEN {_violation_sql(k, c, v, lo, hi)} THEN 1 ELSE 0 END) AS v{i}"
        for i, (k, c, v, lo, hi) in enumerate(checks))
    rows = [f"SELECT {lit(suite)} AS suite, 'columns_match:table' AS label, TRUE AS ok",
            f"SELECT {lit(suite)}, 'row_count:table', (SELECT COUNT(*) FROM {src}) >= 1"]
    rows += [f"SELECT {lit(suite)}, {lit(k + ':' + c)}, v{i} = 0 FROM a_{suite}"
             for i, (k, c, v, lo, hi) in enumerate(checks)]
    return f"a_{suite} AS (SELECT {aggs} FROM {src}), rows_{suite} AS ({' UNION ALL '.join(rows)})"


def _processed_rows() -> str:
    vals = [("in_set:target", "target IS NOT NULL AND target NOT IN (0, 1)"),
            ("in_set:a1c_state", f"a1c_state IS NOT NULL AND a1c_state NOT IN {in_list(C.A1C_STATE_VALUES)}"),
            ("in_set:age_bucket", f"age_bucket IS NOT NULL AND age_bucket NOT IN {in_list(C.AGE_BUCKET_VALUES)}")]
    vals += [(f"in_set:{c}", f"{c} IS NOT NULL AND {c} NOT IN {in_list(C.DIAG_BUCKETS)}")
             for c in ("diag_1_bucket", "diag_2_bucket", "diag_3_bucket")]
    vals += [(f"not_null:{c}", f"{c} IS NULL") for c in C.ENGINEERED_FEATURES]
    aggs = ", ".join(f"SUM(CASE WHEN {v} THEN 1 ELSE 0 END) AS p{i}" for i, (_, v) in enumerate(vals))
    rows = ["SELECT 'processed' AS suite, 'column_count:table' AS label, TRUE AS ok",
            "SELECT 'processed', 'row_count:table', (SELECT COUNT(*) FROM feat) >= 1",
            "SELECT 'processed', 'unique:patient_nbr', (SELECT COUNT(*) FROM (SELECT patient_nbr "
            "FROM feat WHERE patient_nbr IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)) = 0",
            "SELECT 'processed', 'mean_between:target', (SELECT AVG(CAST(target AS DOUBLE)) "
            "BETWEEN 0.08 AND 0.12 FROM feat)"]
    rows += [f"SELECT 'processed', {lit(lbl)}, p{i} = 0 FROM a_p" for i, (lbl, _) in enumerate(vals)]
    return f"a_p AS (SELECT {aggs} FROM feat), rows_processed AS ({' UNION ALL '.join(rows)})"


_REPORT = ("SELECT suite, COUNT(*) AS evaluated, COUNT(*) FILTER (WHERE ok) AS successful, "
           "COALESCE(string_agg(CASE WHEN NOT ok THEN label END, ',' ORDER BY CASE WHEN NOT ok THEN label END), '') AS failed, "
           "COUNT(*) = COUNT(*) FILTER (WHERE ok) AS success FROM {rows} GROUP BY suite")

SQL["dq_suite_report"] = with_enc(
    _REPORT.format(rows="(SELECT * FROM rows_raw UNION ALL SELECT * FROM rows_processed)"),
    FEAT_CTE + ",\n" + LITERAL + ",\n" + _suite_rows("lit", "raw") + ",\n" + _processed_rows())
SQL["dq_injected_bad"] = with_enc(
    _REPORT.format(rows="rows_raw"),
    LITERAL + ",\nbad AS (SELECT * REPLACE (CASE WHEN encounter_id = (SELECT MIN(encounter_id) "
    "FROM lit) THEN 'Martian' ELSE gender END AS gender) FROM lit),\n" + _suite_rows("bad", "raw"))


def contract_fields():
    fields = {}
    for c, vals in C.CATEGORICAL_VALUES.items():
        fields[c] = ("categorical", list(vals), c in C.NULLABLE, None, None)
    for d in C.MODEL_DRUGS:
        fields[d] = ("categorical", list(C.DRUG_VALUES), False, None, None)
    for c in C.STRING_FIELDS:
        fields[c] = ("string", None, c in C.NULLABLE, None, None)
    for c, (lo, hi) in C.INT_RANGES.items():
        fields[c] = ("integer", None, False, lo, hi)
    return sorted(fields.items())


def _field_reason_sql(name, spec):
    typ, allowed, nullable, lo, hi = spec
    c = q(name)
    missing = f"({c} IS NULL OR CAST({c} AS VARCHAR) = '?')"
    out = []
    if not nullable:
        out.append(f"CASE WHEN {missing} THEN '{name}: missing' END")
    if typ == "categorical":
        out.append(f"CASE WHEN NOT {missing} AND {c} NOT IN {in_list(allowed)} THEN '{name}: value not allowed' END")
    elif typ == "integer":
        out.append(f"CASE WHEN NOT {missing} AND NOT ({c} BETWEEN {lo} AND {hi}) THEN '{name}: out of range' END")
    return out


def _contract_table_sql():
    rows, aggs = [], []
    for i, (name, spec) in enumerate(contract_fields()):
        typ, allowed, nullable, lo, hi = spec
        al = lit("|".join(allowed)) if allowed else "''"
        rows.append(f"SELECT {lit(name)} AS field, {lit(typ)} AS type, {al} AS allowed, "
                    f"{str(nullable).upper()} AS nullable, CAST({lo if lo is not None else 'NULL'} AS INTEGER) AS min, "
                    f"CAST({hi if hi is not None else 'NULL'} AS INTEGER) AS max, n{i} AS n_violations FROM a")
        reasons = _field_reason_sql(name, spec)
        cond = " OR ".join(f"({r}) IS NOT NULL" for r in reasons) or "FALSE"
        aggs.append(f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS n{i}")
    return with_enc(" UNION ALL ".join(rows), LITERAL + f",\na AS (SELECT {', '.join(aggs)} FROM lit)")


SQL["contract_table"] = _contract_table_sql()

_REASONS = []
for _name, _spec in contract_fields():
    _REASONS += _field_reason_sql(_name, _spec)
_REASONS += ["CASE WHEN gender = 'Unknown/Invalid' THEN 'gender: not scoreable' END",
             "CASE WHEN discharge_disposition_id IN (11,13,14,19,20,21) THEN "
             "'discharge_disposition_id: expired/hospice' END"]
_NREASONS = " + ".join(f"CAST(({r}) IS NOT NULL AS INTEGER)" for r in _REASONS)
SQL["contract_reject_reasons"] = with_enc(
    f"SELECT encounter_id, ({_NREASONS}) = 0 AS accepted, CAST({_NREASONS} AS INTEGER) AS n_reasons, "
    f"concat_ws('; ', {', '.join(_REASONS)}) AS reasons FROM lit", LITERAL)

_ALLOWED = "[" + ", ".join(lit(n) for n, _ in contract_fields()) + "]"
SQL["contract_extra_fields"] = with_enc(
    f"SELECT encounter_id, array_to_string(x, ',') AS extra_fields, len(x) > 0 AS rejected FROM "
    f"(SELECT encounter_id, list_sort(list_filter(json_keys(to_json(l)), lambda k: NOT list_contains({_ALLOWED}, k))) AS x "
    f"FROM lit l)", LITERAL)

SQL["normalize_missing"] = with_enc(
    "SELECT " + ", ".join(
        (f"CASE WHEN TRIM({q(c)}) <> '' AND TRIM({q(c)}) <> '?' THEN {q(c)} END AS {q(c)}"
         if is_string(c) else q(c)) for c in C.RAW_COLUMNS) + " FROM lit", LITERAL)

_KEPT_CLEAN = ("kept_clean AS (SELECT * EXCLUDE (weight, examide, citoglipton) REPLACE ("
               "CASE WHEN A1Cresult = 'None' THEN 'NotMeasured' ELSE A1Cresult END AS A1Cresult, "
               "CASE WHEN max_glu_serum = 'None' THEN 'NotMeasured' ELSE max_glu_serum END AS max_glu_serum, "
               "COALESCE(payer_code, 'Unknown') AS payer_code, "
               "COALESCE(medical_specialty, 'Unknown') AS medical_specialty, "
               "COALESCE(race, 'Unknown') AS race) FROM kept)")
_GUARD_FEATS = [c for c in C.RAW_COLUMNS if c not in C.DROPPED_IN_CLEANING + C.KEY_COLS
                + ["readmitted", "age", "admission_type_id", "admission_source_id",
                   "discharge_disposition_id"] + C.DIAG_COLS] + [
    "diag_1_bucket", "diag_2_bucket", "diag_3_bucket", "diabetes_primary", "n_diabetes_diag",
    "n_med_changes", "n_meds_used", "a1c_measured", "glu_measured", "a1c_state",
    "service_utilization", "inpatient_ge_2", "age_midpoint", "age_bucket", "admission_type_grp",
    "admission_source_grp", "discharge_disposition_grp", "discharged_home"]
_GUARD_LIST = ", ".join(f"CASE WHEN {q(c)} IS NULL THEN {lit(c)} END" for c in _GUARD_FEATS)
SQL["null_feature_guard"] = with_enc(
    f"SELECT encounter_id, concat_ws(',', {_GUARD_LIST}) AS null_features, "
    f"concat_ws(',', {_GUARD_LIST}) = '' AS scoreable FROM kf",
    clean_cte() + ",\n" + _KEPT_CLEAN + ",\nkf AS (" + feat_select("kept_clean", "readmitted") + ")")

# ====================================================================== cleaning
_GENDER_OK = "COALESCE(gender IN ('Male','Female'), FALSE)"
_DISP_BAD = "COALESCE(discharge_disposition_id IN (11,13,14,19,20,21), FALSE)"
SQL["filter_gender"] = with_enc(f"SELECT * FROM raw WHERE {_GENDER_OK}", RAW)
SQL["filter_disposition"] = with_enc(f"SELECT * FROM raw WHERE NOT {_DISP_BAD}", RAW)
SQL["lab_not_measured"] = with_enc(
    "SELECT encounter_id, CASE WHEN A1Cresult = 'None' THEN 'NotMeasured' ELSE A1Cresult END AS A1Cresult, "
    "CASE WHEN max_glu_serum = 'None' THEN 'NotMeasured' ELSE max_glu_serum END AS max_glu_serum FROM raw", RAW)
SQL["fill_unknown"] = with_enc(
    "SELECT encounter_id, " + ", ".join(f"COALESCE({c}, 'Unknown') AS {c}" for c in C.MISSING_AS_UNKNOWN)
    + " FROM raw", RAW)
SQL["binary_target"] = with_enc(
    "SELECT encounter_id, readmitted, CAST(COALESCE(readmitted = '<30', FALSE) AS TINYINT) AS target FROM raw",
    RAW)
SQL["clean_report"] = with_enc(f"""
SELECT (SELECT COUNT(*) FROM raw) AS rows_raw,
  (SELECT COUNT(*) FROM raw WHERE NOT {_GENDER_OK}) AS rows_dropped_bad_gender,
  (SELECT COUNT(*) FROM raw WHERE {_GENDER_OK} AND {_DISP_BAD}) AS rows_dropped_expired_hospice,
  (SELECT COUNT(*) FROM kept) AS rows_after_discharge_filter,
  (SELECT COUNT(*) FROM clean) AS rows_after_first_encounter_dedup,
  (SELECT COUNT(*) FROM clean) AS rows_final,
  47 AS cols_final,
  (SELECT {rn('AVG(CAST(target AS DOUBLE))', 4)} FROM clean) AS pos_rate,
  (SELECT COUNT(DISTINCT patient_nbr) FROM clean) AS unique_patients
""", clean_cte())

_CLEAN_COLS = [c for c in C.RAW_COLUMNS if c not in C.DROPPED_IN_CLEANING + C.KEY_COLS + ["readmitted"]]
SQL["role_split"] = with_enc(" UNION ALL ".join(
    f"SELECT {lit(c)} AS \"column\", {lit('categorical' if is_string(c) else 'numeric')} AS role, COUNT({q(c)}) AS n_present FROM clean"
    for c in _CLEAN_COLS), clean_cte())

_ZV = [c for c in C.RAW_COLUMNS if c not in C.KEY_COLS]
SQL["zero_variance_columns"] = with_enc(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT {lit(c)} AS \"column\", (CASE WHEN c{i} = 0 THEN 0 WHEN lo{i} = hi{i} THEN 1 ELSE 2 END "
        f"+ CASE WHEN c{i} < n THEN 1 ELSE 0 END) <= 1 AS constant FROM a" for i, c in enumerate(_ZV))
    + ")", RAW + ",\na AS (SELECT COUNT(*) AS n, " + ", ".join(
        f"COUNT({q(c)}) AS c{i}, MIN({q(c)}) AS lo{i}, MAX({q(c)}) AS hi{i}" for i, c in enumerate(_ZV))
    + " FROM raw)")

SQL["topk_other"] = with_enc(
    "SELECT encounter_id, CASE WHEN lvl IN (SELECT lvl FROM top) THEN lvl ELSE '«other»' END AS level FROM lv",
    RAW_EDA + ",\nlv AS (SELECT encounter_id, COALESCE(medical_specialty, '«missing»') AS lvl FROM raw_eda),\n"
    "top AS (SELECT lvl FROM lv GROUP BY lvl ORDER BY COUNT(*) DESC, lvl LIMIT 30)")
SQL["missing_flags"] = with_enc(
    "SELECT encounter_id, " + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in C.NULLABLE)
    + " FROM raw", RAW)

# ====================================================================== dedup
_RAW_NO_SCORE = ", ".join(q(c) for c in C.RAW_COLUMNS)
SQL["first_encounter_coalesce"] = with_enc(f"SELECT {_RAW_NO_SCORE} FROM dedup", clean_cte("coalesce"))
SQL["first_encounter_row"] = with_enc(f"SELECT {_RAW_NO_SCORE} FROM dedup", clean_cte("row"))

# ====================================================================== features
SQL["icd9_bucket"] = with_enc(
    "SELECT encounter_id, " + ", ".join(f"{icd9_bucket_sql(c)} AS {c}_bucket" for c in C.DIAG_COLS)
    + " FROM raw", RAW)
SQL["icd9_chapter"] = with_enc(
    "SELECT encounter_id, " + ", ".join(f"{icd9_chapter_sql(c)} AS {c}_chapter" for c in C.DIAG_COLS)
    + " FROM raw_eda", RAW_EDA)


def _feat_subset(cols):
    return with_enc("SELECT encounter_id, " + ", ".join(q(c) for c in cols) + " FROM feat", FEAT_CTE)


SQL["diagnosis_features"] = _feat_subset(["diag_1_bucket", "diag_2_bucket", "diag_3_bucket",
                                          "diabetes_primary", "n_diabetes_diag"])
SQL["med_counts"] = _feat_subset(["n_med_changes", "n_meds_used"])
SQL["drug_ordinal"] = _feat_subset(C.MODEL_DRUGS)
SQL["lab_flags"] = _feat_subset(["a1c_measured", "glu_measured"])
SQL["a1c_state"] = _feat_subset(["a1c_state"])
SQL["utilization"] = _feat_subset(["service_utilization", "inpatient_ge_2"])
SQL["age_features"] = _feat_subset(["age_midpoint", "age_bucket"])
SQL["admin_groups"] = _feat_subset(["admission_type_grp", "admission_source_grp",
                                    "discharge_disposition_grp", "discharged_home"])
SQL["featurize_full"] = with_enc("SELECT * FROM feat", FEAT_CTE)
SQL["age_ordinal"] = with_enc(
    "SELECT encounter_id, age, CAST(" + map_case("age", {lit(a): i for i, a in enumerate(C.AGE_ORDER)}, None)
    + " AS INTEGER) AS age_ordinal FROM raw", RAW)
_FAM = {c: f for f, cols in C.COLUMN_FAMILY.items() for c in cols}
SQL["column_family"] = with_enc(" UNION ALL ".join(
    f"SELECT {lit(c)} AS \"column\", {lit(_FAM.get(c, 'Other'))} AS family, COUNT({q(c)}) AS n_present FROM raw" for c in C.RAW_COLUMNS + ["score"]), RAW)

_SCORED = RAW + ",\nsc AS (SELECT encounter_id, score, CAST(COALESCE(readmitted = '<30', FALSE) AS TINYINT) AS label, race FROM raw)"
SQL["risk_band"] = with_enc(
    f"SELECT encounter_id, CASE WHEN score >= {THR} THEN 'HIGH' WHEN score >= 0.05 THEN 'MODERATE' "
    f"ELSE 'LOW' END AS band FROM sc", _SCORED)
SQL["verdict"] = with_enc(
    f"SELECT encounter_id, CASE WHEN score >= {THR} AND label = 1 THEN 'TP' WHEN score < {THR} AND label = 0 "
    f"THEN 'TN' WHEN score >= {THR} AND label = 0 THEN 'FP' ELSE 'FN' END AS verdict FROM sc", _SCORED)
SQL["score_flag"] = with_enc(
    f"SELECT encounter_id, {r6('score')} AS probability, score >= {THR} AS flag FROM sc", _SCORED)
_INPUTS = ", ".join(q(n) for n, _ in contract_fields())
SQL["audit_json"] = with_enc(
    f"SELECT encounter_id, md5(CAST(encounter_id AS VARCHAR)) AS request_id, encounter_id AS \"at\", 'readmission' AS model_name, 'staging' AS alias, "
    f"'none' AS calibration_method, 'session' AS load_source, CAST({THR} AS DOUBLE) AS threshold, {r6('score')} AS probability, score >= {THR} AS flag, "
    f"ROUND(encounter_id % 1000 / 8, 2) AS latency_ms, {_INPUTS} FROM enc")

# request lines with their planted faults
_SENT = {"time_in_hospital": ("encounter_id % 17 = 3", "time_in_hospital: wrong type"), "gender": ("encounter_id % 29 = 6", "gender: missing"),
         "race": ("encounter_id % 37 = 8", "race: wrong type")}
_TOLD = []
for _name, _spec in contract_fields():
    _own = _field_reason_sql(_name, _spec)
    _first = "COALESCE(" + ", ".join(_own) + ")" if _own else "NULL"
    _TOLD.append(f"CASE WHEN {_SENT[_name][0]} THEN '{_SENT[_name][1]}' ELSE {_first} END" if _name in _SENT else _first)
_TOLD += ["CASE WHEN gender = 'Unknown/Invalid' AND encounter_id % 29 <> 6 THEN 'gender: not scoreable' END",
          "CASE WHEN discharge_disposition_id IN (11,13,14,19,20,21) THEN 'discharge_disposition_id: expired/hospice' END",
          "CASE WHEN encounter_id % 19 = 4 THEN 'ssn: unknown field' END"]
_VERDICTS = (f"SELECT encounter_id, reasons = '' AS accepted, reasons FROM (SELECT encounter_id, CASE WHEN encounter_id % 23 = 5 THEN "
             f"'request: not a JSON object' ELSE concat_ws('; ', {', '.join(_TOLD)}) END AS reasons FROM lit)")
SQL["request_verdicts"] = with_enc(_VERDICTS, LITERAL)
SQL["stream_verdicts"] = with_enc(f"SELECT *, accepted AS audited FROM ({_VERDICTS})", LITERAL)

SQL["feature_report"] = with_enc(
    "SELECT (SELECT COUNT(*) FROM clean) AS rows_in, 47 AS cols_in, COUNT(*) AS rows_out, 58 AS cols_out, "
    "16 AS n_categorical, 39 AS n_numeric, " + rn("AVG(CAST(target AS DOUBLE))", 4) + " AS pos_rate, "
    "TRUE AS patient_nbr_present, TRUE AS target_present, "
    "COUNT(DISTINCT patient_nbr) = COUNT(patient_nbr) AS patient_nbr_unique FROM feat", FEAT_CTE)

SQL["stage_gate_report"] = with_enc(
    "SELECT r.suite, r.evaluated, r.successful, r.failed, r.success, (SELECT COUNT(*) FROM feat) AS rows_written FROM ("
    + _REPORT.format(rows="(SELECT * FROM rows_raw UNION ALL SELECT * FROM rows_processed)") + ") r",
    FEAT_CTE + ",\n" + LITERAL + ",\n" + _suite_rows("lit", "raw") + ",\n" + _processed_rows())
