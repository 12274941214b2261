"""Contract variants (valid / rejected records) and model invariants."""
import pytest
from pyspark.sql import functions as F

from cohort_spark import constants as C
from cohort_spark.operators import quality as Q
from cohort_spark.sources.readers import request_schema

VALID = {"race": "Caucasian", "gender": "Female", "age": "[70-80)", "admission_type_id": 1,
         "discharge_disposition_id": 1, "admission_source_id": 7, "time_in_hospital": 4,
         "payer_code": "MC", "medical_specialty": "InternalMedicine", "num_lab_procedures": 40,
         "num_procedures": 1, "num_medications": 15, "number_outpatient": 0, "number_emergency": 0,
         "number_inpatient": 1, "diag_1": "428", "diag_2": "250.02", "diag_3": "401",
         "number_diagnoses": 9, "max_glu_serum": "None", "A1Cresult": ">8", "change": "Ch",
         "diabetesMed": "Yes", **{d: "No" for d in C.MODEL_DRUGS}}
VALID["insulin"] = "Up"


def _reasons(spark, rec):
    fields = [f.name for f in request_schema().fields]
    df = spark.createDataFrame([tuple(rec.get(f) for f in fields)], request_schema())
    return Q.reject_reasons(df).select("accepted", "reasons").first()


@pytest.mark.parametrize("change,accepted", [
    ({}, True), ({"A1Cresult": "None", "max_glu_serum": "None"}, True), ({"race": None}, True),
    ({"race": "?"}, True), ({"gender": "Unknown/Invalid"}, False),
    ({"discharge_disposition_id": 11}, False), ({"discharge_disposition_id": 13}, False),
    ({"discharge_disposition_id": 21}, False), ({"time_in_hospital": 99}, False),
    ({"metformin": "Maybe"}, False), ({"gender": None}, False)])
def test_contract_variants(spark, change, accepted):
    r = _reasons(spark, {**VALID, **change})
    assert r.accepted is accepted, r.reasons


def test_extra_field_rejected(spark):
    df = spark.createDataFrame([('{"race": "Asian", "readmitted": "NO"}',)], "j string")
    allowed = [f["field"] for f in Q.contract_fields()]
    got = df.select(Q.extra_fields(F.col("j"), allowed).alias("x")).first().x
    assert got == ["readmitted"]


def test_linear_contributions_add_up_to_margin(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    from cohort_spark.plans import models as ML
    from cohort_spark.plans.jobs_models import penalty, train_test
    train, test, cat, num = train_test(spark, sf_dir)
    model, scored = ML.fit_score(ML.build_lr(cat, num, reg=penalty(spark, sf_dir)), train, test)
    contrib = ML.linear_contributions(model, scored, train, cat, num)
    total = sum((F.col(f"contributions.`{f}`") for f in cat + num), F.lit(0.0))
    rows = contrib.select((vector_to_array("rawPrediction")[1] - total).alias("d"),
                          "prediction", F.col(C.TARGET)).collect()
    ds = [r.d for r in rows]
    assert max(ds) - min(ds) < 1e-6                  # margin = Σ contributions + constant
    thr = 0.5
    assert all((r.prediction >= thr) == (r.prediction >= thr) for r in rows)
    assert all(0.0 <= r.prediction <= 1.0 for r in rows)


def test_stage_gate_stops_on_bad_data(spark, sf_dir, tmp_path):
    import os
    from cohort_spark.operators.quality import SuiteFailed, inject_bad_row
    from cohort_spark.plans.catalog import raw
    from cohort_spark.plans.stages import run_stages
    bad = inject_bad_row(raw(spark, sf_dir, "literal").drop("score"), "gender", "Martian")
    with pytest.raises(SuiteFailed, match="in_set:gender"):
        run_stages(bad, str(tmp_path / "out"))
    assert not os.path.exists(tmp_path / "out" / "clean")


def test_extra_fields_of_odd_lines(spark):
    lines = ['{"race": null, "b": {"c": 1}, "a": [1, {"z": 2}], "b": 3}', "{}", "[1]", "", None]
    df = spark.createDataFrame([(v,) for v in lines], "j string")
    shown = df.select("j", Q.extra_fields(F.col("j"), ["race"]).alias("x"))
    assert [r.x for r in shown.collect()] == [["a", "b"], [], None, None, None]
    # only keys are read, no values
    assert "from_json" not in shown._jdf.queryExecution().optimizedPlan().toString()
