"""Jobs: sources, data quality, cleaning, dedup and feature functions."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import columns as FC
from ..functions.columns import col
from ..functions.icd9 import bucket_icd9, icd9_chapter
from ..operators import clean as CL
from ..operators import quality as Q
from ..operators import requests as RQ
from ..sources import dimensions as D
from ..sources.readers import normalize_missing, read_parquet
from ..functions.columns import round_half_up
from ..session import materialize
from .catalog import R6, cleaned, encounter_view, featurized, memo_plan, raw, register

R4 = lambda c: round_half_up(c, 4)

OPERATING_THRESHOLD = 0.091046   # published operating point of the lead model


# ====================================================================== sources
@register("scan_sentinel_null")
def scan_sentinel_null(spark, sf_dir):
    """Pipeline missing mode: only ``?`` is null; lab ``None`` stays a level."""
    return raw(spark, sf_dir, "pipeline")


@register("scan_eda_null")
def scan_eda_null(spark, sf_dir):
    """Profiling missing mode: ``?`` and NA spellings (``None``) are null."""
    return raw(spark, sf_dir, "eda")


@register("scan_pruned")
def scan_pruned(spark, sf_dir):
    """Two-column Parquet scan; Catalyst prunes the other columns at the reader."""
    df = read_parquet(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_custkey"])
    return df.select(F.col("o_orderkey").alias("encounter_id"),
                     F.col("o_custkey").alias("patient_nbr"))


@register("decode_ids")
def decode_ids(spark, sf_dir):
    df = raw(spark, sf_dir).select("encounter_id", *C.ADMINISTRATIVE_ID_COLS)
    return D.decode_ids(df)


# ====================================================================== quality
def _raw_literal(spark, sf_dir):
    """The raw table read literally (``?`` kept as a string)."""
    return raw(spark, sf_dir, "literal").drop("score")


@register("dq_columns_match")
def dq_columns_match(spark, sf_dir):
    t = Q.run_suite(_raw_literal(spark, sf_dir), [Q.Check("columns_match", values=C.RAW_COLUMNS)],
                    "raw")
    return t.select("check", "n_unexpected", "success")


@register("dq_row_count")
def dq_row_count(spark, sf_dir):
    df = _raw_literal(spark, sf_dir)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("success", F.col("n_rows") >= 1)


def _checks(spark, sf_dir, kind):
    checks = [c for c in Q.raw_suite() if c.name == kind]
    return (Q.run_suite(_raw_literal(spark, sf_dir), checks, "raw")
            .select("column", "n_unexpected", "success"))


@register("dq_in_set")
def dq_in_set(spark, sf_dir):
    return _checks(spark, sf_dir, "in_set")


@register("dq_not_null")
def dq_not_null(spark, sf_dir):
    return _checks(spark, sf_dir, "not_null")


@register("dq_between")
def dq_between(spark, sf_dir):
    return _checks(spark, sf_dir, "between")


@register("dq_unique")
def dq_unique(spark, sf_dir):
    t = Q.run_suite(featurized(spark, sf_dir), [Q.Check("unique", "patient_nbr")], "processed")
    return t.select("column", "n_unexpected", "success")


@register("dq_mean_between")
def dq_mean_between(spark, sf_dir):
    df = featurized(spark, sf_dir)
    return df.agg(R6(F.avg(F.col(C.TARGET).cast("double"))).alias("mean")).withColumn(
        "success", F.col("mean").between(*C.POS_RATE_RANGE))


@register("dq_suite_report")
def dq_suite_report(spark, sf_dir):
    raw_t = Q.run_suite(_raw_literal(spark, sf_dir), Q.raw_suite(), "raw")
    proc_t = Q.run_suite(featurized(spark, sf_dir), Q.processed_suite(), "processed")
    return Q.suite_report(raw_t.unionByName(proc_t))


@register("dq_injected_bad")
def dq_injected_bad(spark, sf_dir):
    bad = Q.inject_bad_row(_raw_literal(spark, sf_dir), "gender", "Martian")
    return Q.suite_report(Q.run_suite(bad, Q.raw_suite(), "raw"))


@register("contract_table")
def contract_table(spark, sf_dir):
    """Contract fields with the number of raw rows violating each field's rules."""
    df = _raw_literal(spark, sf_dir)
    aggs = []
    for f in Q.contract_fields():
        reasons = Q.field_reasons([f])[:-2]   # field rules only, not semantic rejects
        bad = F.lit(False)
        for r in reasons:
            bad = bad | r.isNotNull()
        aggs.append(F.struct(F.lit(f["field"]).alias("field"),
                             F.sum(bad.cast("long")).alias("n_violations")))
    counts = df.agg(F.array(*aggs).alias("a")).select(F.explode("a").alias("r")).select("r.*")
    ct = Q.contract_table(spark).select(
        "field", "type", F.array_join(F.coalesce("allowed", F.array()), "|").alias("allowed"),
        "nullable", "min", "max")
    return ct.join(counts, "field", "left")


@register("contract_reject_reasons")
def contract_reject_reasons(spark, sf_dir):
    df = Q.reject_reasons(_raw_literal(spark, sf_dir))
    return df.select("encounter_id", "accepted", F.size("reasons").alias("n_reasons"),
                     F.array_join("reasons", "; ").alias("reasons"))


@register("contract_extra_fields")
def contract_extra_fields(spark, sf_dir):
    """Raw rows shaped as JSON request records; keys outside the contract are extras."""
    df = encounter_view(spark, sf_dir).drop("score")
    js = F.to_json(F.struct(*[col(c) for c in df.columns]))
    allowed = [f["field"] for f in Q.contract_fields()]
    found = df.select("encounter_id", Q.extra_fields(js, allowed).alias("extra"))
    # written: the wide rows run as methods the JVM compiles, and the keys are read once
    return materialize(found.select("encounter_id", F.array_join("extra", ",").alias("extra_fields"), (F.size("extra") > 0).alias("rejected")), "extra-fields")


@register("normalize_missing")
def normalize_missing_job(spark, sf_dir):
    return normalize_missing(_raw_literal(spark, sf_dir))


@register("null_feature_guard")
def null_feature_guard(spark, sf_dir):
    """Featurize every filtered raw row (no dedup) and list null features per row."""
    df = CL.filter_disposition(CL.filter_gender(raw(spark, sf_dir).drop("score")))
    df = FC.engineer_features(CL.clean_columns(df))
    feats = [c for c in df.columns if c not in C.KEY_COLS + [C.TARGET_RAW]]
    g = Q.null_feature_guard(df, feats)
    return g.select("encounter_id", F.array_join("null_features", ",").alias("null_features"),
                    "scoreable")


# ====================================================================== cleaning
@register("filter_gender")
def filter_gender(spark, sf_dir):
    return CL.filter_gender(raw(spark, sf_dir))


@register("filter_disposition")
def filter_disposition(spark, sf_dir):
    return CL.filter_disposition(raw(spark, sf_dir))


@register("lab_not_measured")
def lab_not_measured(spark, sf_dir):
    df = raw(spark, sf_dir)
    return df.select("encounter_id", *[CL.lab_not_measured(F.col(c)).alias(c)
                                       for c in C.LAB_COLS])


@register("fill_unknown")
def fill_unknown(spark, sf_dir):
    df = raw(spark, sf_dir)
    return df.select("encounter_id", *[F.coalesce(F.col(c), F.lit("Unknown")).alias(c)
                                       for c in C.MISSING_AS_UNKNOWN])


@register("binary_target")
def binary_target(spark, sf_dir):
    df = raw(spark, sf_dir)
    return df.select("encounter_id", "readmitted",
                     CL.binary_target(F.col("readmitted")).alias(C.TARGET))


@register("clean_report")
def clean_report(spark, sf_dir):
    return CL.clean_report(raw(spark, sf_dir).drop("score"))


@register("role_split")
def role_split(spark, sf_dir):
    return CL.role_split(cleaned(spark, sf_dir))


@register("zero_variance_columns")
def zero_variance_columns(spark, sf_dir):
    return CL.zero_variance_columns(raw(spark, sf_dir).drop("score"))


@register("topk_other")
def topk_other(spark, sf_dir):
    df = raw(spark, sf_dir, "eda").select("encounter_id", "medical_specialty")
    return CL.topk_other(df, "medical_specialty", C.TOP_LEVELS, out="level").select(
        "encounter_id", "level")


@register("missing_flags")
def missing_flags(spark, sf_dir):
    df = raw(spark, sf_dir).select("encounter_id", *C.NULLABLE)
    return CL.missing_flags(df, C.NULLABLE).drop(*C.NULLABLE)


# ====================================================================== dedup
def _kept(spark, sf_dir):
    return CL.filter_disposition(CL.filter_gender(raw(spark, sf_dir).drop("score")))


@register("first_encounter_coalesce")
def first_encounter_coalesce(spark, sf_dir):
    return CL.first_encounter(_kept(spark, sf_dir), "coalesce")


@register("first_encounter_row")
def first_encounter_row(spark, sf_dir):
    return CL.first_encounter(_kept(spark, sf_dir), "row")


# ====================================================================== features
@register("icd9_bucket")
def icd9_bucket(spark, sf_dir):
    df = raw(spark, sf_dir)
    return df.select("encounter_id", *[bucket_icd9(F.col(c)).alias(f"{c}_bucket")
                                       for c in C.DIAG_COLS])


@register("icd9_chapter")
def icd9_chapter_job(spark, sf_dir):
    df = raw(spark, sf_dir, "eda")
    return df.select("encounter_id", *[icd9_chapter(F.col(c)).alias(f"{c}_chapter")
                                       for c in C.DIAG_COLS])


def _feature_subset(spark, sf_dir, fn, cols):
    return fn(cleaned(spark, sf_dir)).select("encounter_id", *[col(c) for c in cols])


@register("diagnosis_features")
def diagnosis_features(spark, sf_dir):
    return _feature_subset(spark, sf_dir, FC.add_diagnosis_features,
                           ["diag_1_bucket", "diag_2_bucket", "diag_3_bucket",
                            "diabetes_primary", "n_diabetes_diag"])


@register("med_counts")
def med_counts(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    return df.select("encounter_id", FC.n_med_changes().alias("n_med_changes"),
                     FC.n_meds_used().alias("n_meds_used"))


@register("drug_ordinal")
def drug_ordinal(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    return df.select("encounter_id", *[FC.drug_ordinal(col(d)).alias(d) for d in C.MODEL_DRUGS])


@register("lab_flags")
def lab_flags(spark, sf_dir):
    return _feature_subset(spark, sf_dir, FC.add_lab_features, ["a1c_measured", "glu_measured"])


@register("a1c_state")
def a1c_state(spark, sf_dir):
    return _feature_subset(spark, sf_dir, FC.add_lab_features, ["a1c_state"])


@register("utilization")
def utilization(spark, sf_dir):
    return _feature_subset(spark, sf_dir, FC.add_utilization_features,
                           ["service_utilization", "inpatient_ge_2"])


@register("age_features")
def age_features(spark, sf_dir):
    return _feature_subset(spark, sf_dir, FC.add_demographic_features,
                           ["age_midpoint", "age_bucket"])


@register("admin_groups")
def admin_groups(spark, sf_dir):
    return _feature_subset(spark, sf_dir, FC.add_demographic_features,
                           ["admission_type_grp", "admission_source_grp",
                            "discharge_disposition_grp", "discharged_home"])


@register("featurize_full")
def featurize_full(spark, sf_dir):
    return featurized(spark, sf_dir)


@register("feature_report")
def feature_report(spark, sf_dir):
    """Feature-stage report: rows/columns in and out, role counts, positive
    rate (4 dp) and key uniqueness, from one aggregation per side."""
    from ..operators.clean import role_split
    clean_df, feat = cleaned(spark, sf_dir), featurized(spark, sf_dir)
    roles = {r.role: r.n for r in role_split(feat).groupBy("role").agg(F.count(F.lit(1)).alias("n")).collect()}
    ins = clean_df.agg(F.count(F.lit(1)).alias("rows_in"))
    outs = feat.agg(F.count(F.lit(1)).alias("rows_out"),
                    R4(F.avg(F.col(C.TARGET).cast("double"))).alias("pos_rate"),
                    (F.countDistinct("patient_nbr") == F.count("patient_nbr")).alias("patient_nbr_unique"))
    from ..operators.common import attach_row
    return attach_row(ins, outs).select(
        "rows_in", F.lit(len(clean_df.columns)).alias("cols_in"), "rows_out",
        F.lit(len(feat.columns)).alias("cols_out"),
        F.lit(roles.get("categorical", 0)).alias("n_categorical"),
        F.lit(roles.get("numeric", 0)).alias("n_numeric"), "pos_rate",
        F.lit("patient_nbr" in feat.columns).alias("patient_nbr_present"),
        F.lit(C.TARGET in feat.columns).alias("target_present"), "patient_nbr_unique")


@register("age_ordinal")
def age_ordinal(spark, sf_dir):
    df = raw(spark, sf_dir)
    return df.select("encounter_id", "age", FC.age_ordinal(F.col("age")).alias("age_ordinal"))


@register("column_family")
def column_family(spark, sf_dir):
    """Family of every column of the raw table (default ``Other``) and its rows with a value."""
    df = raw(spark, sf_dir)
    families = {c: f for f, cols in C.COLUMN_FAMILY.items() for c in cols}
    return CL.labelled_counts(df, {c: families.get(c, "Other") for c in df.columns}, "family")


def _scored(spark, sf_dir):
    df = raw(spark, sf_dir)
    return df.select("encounter_id", "score", CL.binary_target(F.col("readmitted")).alias("label"))


@register("risk_band")
def risk_band(spark, sf_dir):
    df = _scored(spark, sf_dir)
    return df.select("encounter_id", FC.risk_band(F.col("score"), OPERATING_THRESHOLD).alias("band"))


@register("verdict")
def verdict(spark, sf_dir):
    df = _scored(spark, sf_dir)
    flag = F.col("score") >= OPERATING_THRESHOLD
    return df.select("encounter_id", FC.verdict(flag, F.col("label")).alias("verdict"))


@register("score_flag")
def score_flag(spark, sf_dir):
    df = _scored(spark, sf_dir)
    prob, flag = FC.score_flag(F.col("score"), OPERATING_THRESHOLD)
    return df.select("encounter_id", prob.alias("probability"), flag.alias("flag"))


#: The registered audit's model block (fixed values of this library).
AUDITED_MODEL = {"name": "readmission", "version": "1", "alias": "staging", "threshold": OPERATING_THRESHOLD,
                 "calibration_method": "none", "load_source": "session"}


@register("audit_json")
def audit_json(spark, sf_dir):
    """The whole audit line of every encounter (F26), read back: id, model block, the 44 inputs as
    sent, output, latency."""
    df = raw(spark, sf_dir, "literal")
    prob, flag = FC.score_flag(F.col("score"), OPERATING_THRESHOLD)
    inputs = [f["field"] for f in Q.contract_fields()]
    line = RQ.audit_record(F.md5(F.col("encounter_id").cast("string")), F.timestamp_seconds(F.col("encounter_id")), AUDITED_MODEL, inputs,
                           prob, flag, None, F.col("encounter_id") % 1000 / 8)
    kinds = dict(df.dtypes)
    sent = ", ".join(f"`{c}`: {kinds[c]}" for c in inputs)
    back = F.from_json(line, "request_id string, timestamp timestamp, model struct<name: string, version: string, alias: string, threshold: double, "
                       f"calibration_method: string, load_source: string>, inputs struct<{sent}>, "
                       "output struct<readmission_probability: double, flag: boolean>, latency_ms double")
    df = df.select("encounter_id", back.alias("r"))
    return df.select("encounter_id", "r.request_id", F.unix_seconds("r.timestamp").alias("at"), F.col("r.model.name").alias("model_name"), "r.model.alias",
                     "r.model.calibration_method", "r.model.load_source", F.col("r.model.threshold").alias("threshold"),
                     F.col("r.output.readmission_probability").alias("probability"), "r.output.flag", "r.latency_ms", "r.inputs.*")


@memo_plan
def request_lines(spark, sf_dir):
    """``request_text`` of the written encounter table (written: requests arrive as files)."""
    return materialize(request_text(raw(spark, sf_dir, "literal")), "request-lines")


def request_text(df):
    """Encounters as raw request lines, some of them broken in ways the contract tells apart."""
    k = F.col("encounter_id")
    sent = {f["field"]: col(f["field"]).cast("string") for f in Q.contract_fields()}
    text = {f["field"] for f in Q.contract_fields() if f["type"] != "integer"}
    said = {c: F.coalesce(F.concat(F.lit('"'), v, F.lit('"')) if c in text else v, F.lit("null")) for c, v in sent.items()}
    said["time_in_hospital"] = F.when(k % 17 == 3, F.lit('"abc"')).otherwise(said["time_in_hospital"])
    said["gender"] = F.when(k % 29 == 6, F.lit("null")).otherwise(said["gender"])
    said["num_medications"] = F.when(k % 31 == 7, F.concat(F.lit('"'), said["num_medications"], F.lit('"'))).otherwise(said["num_medications"])
    said["race"] = F.when(k % 37 == 8, F.lit("5")).otherwise(said["race"])
    pairs = [F.concat(F.lit(f'"{c}": '), v) for c, v in said.items()]
    pairs.append(F.when(k % 19 == 4, F.lit('"ssn": "1"')))
    body = F.concat_ws(", ", F.concat(F.lit('"request_id": "'), k.cast("string"), F.lit('"')), *pairs)
    line = F.concat(F.lit("{"), body, F.when(k % 23 == 5, F.lit("")).otherwise(F.lit("}")))
    return df.select("encounter_id", line.alias("value"))


@register("request_verdicts")
def request_verdicts(spark, sf_dir):
    """Contract verdicts on raw request lines (V12-V14): wrong types, unknown keys, missing values
    and lines that are no JSON object are told apart."""
    v = RQ.check_requests(request_lines(spark, sf_dir))
    # written: a filter on the verdict would be pushed into the rules again, a copy a reference
    return materialize(v.select("encounter_id", "accepted", F.array_join("reasons", "; ").alias("reasons")), "request-verdicts")


@register("stage_gate_report")
def stage_gate_report(spark, sf_dir):
    """Run the staged batch (raw suite gate -> clean -> features -> processed
    suite gate), writing each stage as Parquet in the checkpoint folder."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from .stages import run_stages
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stages-{uuid.uuid4().hex[:8]}"
    status = run_stages(_raw_literal(spark, sf_dir), out)
    return spark.read.json(f"{out}/status/*").select(
        "suite", "evaluated", "successful", "failed", "success").join(
        status.select("suite", "rows_written"), "suite")
