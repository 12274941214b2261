"""Plans of steps that failed on larger tables."""
from pyspark.sql import functions as F

from cohort_spark.operators import requests as RQ
from cohort_spark.operators import split as S
from cohort_spark.operators.quality import contract_fields
from cohort_spark.session import small_methods


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_growing_sides_are_not_broadcast(spark):
    rows = spark.range(10).select(F.col("id").alias("k"), F.when(F.col("id") < 4, "test").otherwise("train").alias("split"))
    held, rest = S.heldout_rows(rows, rows, "k"), S.train_minus_test(rows, rows.where("split = 'test'"), "k")
    for df, n in ((held, 4), (rest, 6)):
        assert "Broadcast" not in plan_of(df)
        assert df.count() == n


def test_label_feedback_broadcasts_no_outcomes(spark, monkeypatch):
    import cohort_spark.plans.catalog  # noqa: F401  the job modules load through it
    from cohort_spark.plans import jobs_eval as J
    preds = spark.createDataFrame([(1, 0.5), (2, 0.7)], "encounter_id long, score double")
    rows = spark.createDataFrame([(1, "<30"), (2, "NO"), (3, "NO")], "encounter_id long, readmitted string")
    monkeypatch.setattr(J, "test_scores", lambda spark, sf_dir: preds)
    monkeypatch.setattr(J, "raw", lambda spark, sf_dir: rows)
    df = J.label_feedback_join(spark, "")
    assert "Broadcast" not in plan_of(df)
    assert sorted((r.encounter_id, r.label) for r in df.collect()) == [(1, 1), (2, 0)]


def test_request_values_are_read_once(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        df = RQ.check_requests(spark.createDataFrame([("{}",)], "value string")).select("reasons")
        assert df._jdf.queryExecution().optimizedPlan().toString().count("schema_of_variant") <= 2 * len(contract_fields())
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_lines_that_are_no_objects(spark):
    lines = ["", " ", "[1]", "3", '"{}"', "null", "{", "{} x", ' \n{"a": 1}', "{}", None]
    df = RQ.check_requests(spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string"))
    kept = {r.i for r in df.where(F.col("reasons")[0] != RQ.NOT_AN_OBJECT).select("i").collect()}
    parsed = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string").where(
        F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"))
    assert kept == {r.i for r in parsed.select("i").collect()} and {8, 9} <= kept


def test_written_stages_split_wide_methods(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with small_methods(spark):
        assert spark.conf.get(name) == "8000"
    assert spark.conf.get(name) == before
