"""Edge tables for the scalar functions, dedup modes, Wilson and Cramér's V."""
import math

import pytest
from pyspark.sql import functions as F

from cohort_spark.functions.columns import wilson_ci
from cohort_spark.functions.icd9 import bucket_icd9, icd9_chapter
from cohort_spark.operators import assoc as A
from cohort_spark.operators import clean as CL

PIPELINE = {
    None: "Missing", "": "Other", "?": "Other", " 428 ": "Circulatory", "250": "Diabetes",
    "250.83": "Diabetes", "2500": "Diabetes", "V45": "Other", "v45": "Other", "E909": "Other",
    "785": "Circulatory", "785.9": "Circulatory", "139.9": "Other", "1000": "Other",
    "abc": "Other", "4d": "Other", "1_0": "Other", "-5": "Other", "800": "Injury",
    "999.9": "Injury", "710": "Musculoskeletal", "580": "Genitourinary", "788": "Genitourinary",
    "140": "Neoplasms", "460": "Respiratory", "786": "Respiratory", "520": "Digestive",
    "787": "Digestive",
}
PROFILING = {
    None: "Missing", "": "Missing", "?": "Missing", "nan": "Missing", "None": "Missing",
    " 428 ": "Circulatory", "250": "Diabetes", "250.83": "Diabetes", "2500": "Other",
    "V45": "Other", "v45": "Other", "E909": "Other", "e1": "Other", "785": "Circulatory",
    "139.9": "Other", "1000": "Other", "abc": "Other", "4d": "Other", "-5": "Other",
    "999": "Injury", "239.5": "Neoplasms",
}


@pytest.mark.parametrize("fn,table", [(bucket_icd9, PIPELINE), (icd9_chapter, PROFILING)])
def test_icd9_mappers(spark, fn, table):
    df = spark.createDataFrame([(k,) for k in table], "code string")
    got = {r.code: r.b for r in df.select("code", fn(F.col("code")).alias("b")).collect()}
    assert got == table


def test_first_encounter_modes(spark):
    rows = [(1, 2, None, "x"), (1, 3, "Asian", "y"), (2, 5, "Other", None), (2, 4, None, None),
            (None, 9, "Asian", "z")]
    df = spark.createDataFrame(rows, "patient_nbr long, encounter_id long, race string, s string")
    co = {r.patient_nbr: r for r in CL.first_encounter(df, "coalesce").collect()}
    rw = {r.patient_nbr: r for r in CL.first_encounter(df, "row").collect()}
    assert set(co) == {1, 2} and set(rw) == {1, 2}           # null key dropped
    assert co[1].race == "Asian" and co[1].encounter_id == 2 and co[1].s == "x"
    assert rw[1].race is None and rw[1].s == "x"
    assert co[2].race == "Other" and co[2].encounter_id == 4 and co[2].s is None


def _wilson(k, n, z=1.96):
    if n == 0:
        return 0.0, 0.0
    p = k / n
    d = 1 + z * z / n
    c = (p + z * z / (2 * n)) / d
    h = z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / d
    return max(0.0, c - h), min(1.0, c + h)


def test_wilson_edges(spark):
    cases = [(0, 0), (0, 10), (10, 10), (3, 10), (1, 1000)]
    df = spark.createDataFrame(cases, "k long, n long")
    lo, hi = wilson_ci(F.col("k"), F.col("n"))
    for r in df.select("k", "n", lo.alias("lo"), hi.alias("hi")).collect():
        elo, ehi = _wilson(r.k, r.n)
        assert r.lo == pytest.approx(elo, abs=1e-12) and r.hi == pytest.approx(ehi, abs=1e-12)


def test_cramers_v_cases(spark):
    indep = [("a", 0)] * 25 + [("a", 1)] * 25 + [("b", 0)] * 25 + [("b", 1)] * 25
    perfect = [("a", 1)] * 50 + [("b", 0)] * 50
    one_row = [("a", 0)] * 10 + [("a", 1)] * 5
    for rows, want in [(indep, 0.0), (perfect, 1.0), (one_row, 0.0)]:
        df = spark.createDataFrame(rows, "x string, readmitted_30d int")
        v = A.cramers_v_table(A.categorical_cells(df, ["x"])).first().cramers_v
        assert v == pytest.approx(want, abs=1e-12)


def test_missing_modes(spark, tmp_path):
    from cohort_spark.sources.readers import apply_missing_mode
    df = spark.createDataFrame([("?", "None", "x"), ("NA", "Norm", "")], "a string, b string, c string")
    lit = apply_missing_mode(df, "literal").collect()
    pipe = apply_missing_mode(df, "pipeline").collect()
    eda = apply_missing_mode(df, "eda").collect()
    assert lit[0].a == "?" and pipe[0].a is None and pipe[0].b == "None"
    assert eda[0].b is None and eda[1].a is None and pipe[1].a == "NA"
