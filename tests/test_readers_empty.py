"""An empty CSV field is an empty string when read literally, missing in the other modes; ages."""
from pyspark.sql import functions as F

from cohort_spark import constants as C
from cohort_spark.functions.columns import age_bucket
from cohort_spark.sources.readers import read_raw_csv


def test_empty_fields(spark, tmp_path):
    row = {c: "1" for c in C.RAW_COLUMNS} | {"payer_code": "", "race": '""', "time_in_hospital": ""}
    (tmp_path / "raw.csv").write_text(",".join(C.RAW_COLUMNS) + "\n" + ",".join(row[c] for c in C.RAW_COLUMNS) + "\n")
    got = {m: read_raw_csv(spark, f"{tmp_path}/raw.csv", m).first() for m in ("literal", "pipeline", "eda")}
    assert (got["literal"].payer_code, got["literal"].race, got["literal"].time_in_hospital) == ("", "", None)
    assert got["pipeline"].payer_code == "" and got["eda"].payer_code is None and got["literal"].encounter_id == 1


def test_null_age_has_no_bucket(spark):
    df = spark.createDataFrame([(None,), (29,), (30,), (60,)], "a int")
    assert [r[0] for r in df.select(age_bucket(F.col("a"))).collect()] == [None, "[0-30)", "[30-60)", "[60-100)"]
