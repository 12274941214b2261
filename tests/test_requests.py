"""Raw requests: every kind of refusal, and a scoring stream that neither loses nor doubles a
request when it dies between its outputs or its audit fails."""
import json

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohort_spark.operators import requests as RQ
from cohort_spark.operators.quality import contract_fields
from cohort_spark.streaming.queries import Scoring, ScoringSink, scoring_stream

FIELDS = {f["field"]: f for f in contract_fields()}


def good(**change):
    """A request that the contract accepts, with changes; a change to ``...`` leaves the key out."""
    r = {n: (f["allowed"][0] if f["allowed"] else f["min"] if f["type"] == "integer" else "250.83") for n, f in FIELDS.items()}
    r |= {"gender": "Female", "discharge_disposition_id": 1, "age": "[60-70)", **change}
    return json.dumps({k: v for k, v in r.items() if v is not ...})


def reasons(spark, *lines):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, value string")
    return [r["reasons"] for r in RQ.check_requests(df).orderBy("i").collect()]


CASES = [
    (good(), []),
    (good(request_id="r1"), []),
    (good(time_in_hospital="abc"), ["time_in_hospital: wrong type"]),
    (good(time_in_hospital=2.5), ["time_in_hospital: wrong type"]),
    (good(time_in_hospital=[3]), ["time_in_hospital: wrong type"]),
    (good(time_in_hospital=3.0), []),
    (good(time_in_hospital=" 3 "), []),
    (good(time_in_hospital=10 ** 25), ["time_in_hospital: out of range"]),
    (good(time_in_hospital=99), ["time_in_hospital: out of range"]),
    (good(time_in_hospital=None), ["time_in_hospital: missing"]),
    (good(time_in_hospital=...), ["time_in_hospital: missing"]),
    (good(gender="?"), ["gender: missing"]),
    (good(gender=1), ["gender: wrong type"]),
    (good(gender="X"), ["gender: value not allowed"]),
    (good(gender="Unknown/Invalid"), ["gender: not scoreable"]),
    (good(discharge_disposition_id=11), ["discharge_disposition_id: expired/hospice"]),
    (good(payer_code="?", medical_specialty=None, race=...), []),
    (good(diag_1=250), ["diag_1: wrong type"]),
    (good(readmitted="NO", aaa=None), ["aaa: unknown field", "readmitted: unknown field"]),
    (good(**{"glyburide-metformin": "maybe"}), ["glyburide-metformin: value not allowed"]),
    ("{", [RQ.NOT_AN_OBJECT]), ("[1]", [RQ.NOT_AN_OBJECT]), ('"x"', [RQ.NOT_AN_OBJECT]), ("null", [RQ.NOT_AN_OBJECT]),
    ('{"gender": "Male", "gender": "Female"}', [RQ.NOT_AN_OBJECT]), (None, [RQ.NOT_AN_OBJECT]),
    (good(time_in_hospital="abc", gender=..., extra=1), ["gender: missing", "time_in_hospital: wrong type", "extra: unknown field"]),
]


def test_reasons(spark):
    assert reasons(spark, *[line for line, _ in CASES]) == [want for _, want in CASES]


def test_empty_request_misses_every_required_field(spark):
    got, = reasons(spark, "{}")
    assert got == [f"{n}: missing" for n, f in sorted(FIELDS.items()) if not f["nullable"]]


def test_typed_columns_and_ids(spark):
    line = good(time_in_hospital="3", num_medications=4.0, payer_code=7)
    row = RQ.check_requests(spark.createDataFrame([(line, 1)], "value string, accepted_by int")).first()
    assert (row["time_in_hospital"], row["num_medications"], row["payer_code"]) == (3, 4, None) and len(row["request_id"]) == 32
    assert RQ.check_requests(spark.createDataFrame([], "value string")).count() == 0


class Model:
    def transform(self, df):
        return df.withColumn("probability", array_to_vector(F.array(F.lit(0.25), F.lit(0.75))))


def send(spark, source, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(source)


def outputs(spark, sink):
    scored = [r["request_id"] for r in spark.read.parquet(f"{sink}/scored").collect()]
    rejected = [r["request_id"] for r in spark.read.parquet(f"{sink}/rejected").collect()]
    audit = [json.loads(r["value"]) for r in spark.read.text(f"{sink}/audit").collect()] if "audit" else []
    return sorted(scored), sorted(rejected), audit


def test_three_outputs_of_one_read(spark, tmp_path):
    source, sink = f"{tmp_path}/in", f"{tmp_path}/out"
    scoring = Scoring(Model(), 0.5, {"name": "m", "version": 3, "alias": "staging", "calibration_method": "none", "load_source": "test"})
    for part in range(2):  # a second start takes up the new lines only
        send(spark, source, good(request_id=f"a{part}", payer_code="?"), good(request_id=f"b{part}", time_in_hospital="abc"), "{broken", "")
        query, _ = scoring_stream(spark, source, scoring, sink)
        query.awaitTermination()
    scored, rejected, audit = outputs(spark, sink)
    assert scored == ["a0", "a1"] and [r for r in rejected if r.startswith("b")] == ["b0", "b1"] and len(rejected) == 4
    assert sorted(a["request_id"] for a in audit) == scored
    one = audit[0]
    assert set(one) == {"request_id", "timestamp", "model", "inputs", "output", "latency_ms"} and set(one["inputs"]) == set(FIELDS)
    assert one["inputs"]["payer_code"] == "?" and one["inputs"]["time_in_hospital"] == FIELDS["time_in_hospital"]["min"]
    assert one["model"] == {"name": "m", "version": "3", "alias": "staging", "threshold": 0.5, "calibration_method": "none", "load_source": "test"}
    assert one["output"] == {"readmission_probability": 0.75, "flag": True, "top_factors": None} and one["latency_ms"] >= 0


@pytest.mark.parametrize("dies", ["write_scored", "write_rejected"])
def test_death_between_outputs(spark, tmp_path, dies):
    source, sink = f"{tmp_path}/in", f"{tmp_path}/out"

    class Dying(ScoringSink):
        pass

    def write(self, judged, batch_id):
        getattr(ScoringSink, dies)(self, judged, batch_id)
        raise RuntimeError("killed")  # after this output, before the next

    setattr(Dying, dies, write)
    send(spark, source, good(request_id="a"), good(request_id="b", gender=...))
    query, _ = scoring_stream(spark, source, Scoring(Model(), 0.5), sink, of=Dying)
    with pytest.raises(Exception, match="killed"):
        query.awaitTermination()
    send(spark, source, good(request_id="c"))
    query, _ = scoring_stream(spark, source, Scoring(Model(), 0.5), sink)
    query.awaitTermination()
    scored, rejected, audit = outputs(spark, sink)
    assert (scored, rejected, sorted(a["request_id"] for a in audit)) == (["a", "c"], ["b"], ["a", "c"])


def test_failing_audit_does_not_stop_scoring(spark, tmp_path):
    source, sink = f"{tmp_path}/in", f"{tmp_path}/out"

    class NoAudit(ScoringSink):
        def write_audit(self, judged, batch_id):
            raise OSError("disk full")

    send(spark, source, good(request_id="a"))
    query, out = scoring_stream(spark, source, Scoring(Model(), 0.5), sink, of=NoAudit)
    query.awaitTermination()
    assert out.audit_failures == 1
    assert [r["request_id"] for r in spark.read.parquet(f"{sink}/scored").collect()] == ["a"]


def test_null_features_are_refused(spark):
    df = spark.createDataFrame([("r", [], True, None, 1), ("s", [], True, 2, 1)], "request_id string, reasons array<string>, accepted boolean, f1 int, f2 int")
    got = {r["request_id"]: (r["accepted"], r["reasons"]) for r in RQ.guard_features(df, ["f1", "f2"]).collect()}
    assert got == {"r": (False, ["unscoreable: null features f1"]), "s": (True, [])}
