"""Readers, sinks, model bundle and the remaining streaming queries."""
import json
import os
import uuid

from pyspark.sql import functions as F

from cohort_spark import constants as C
from cohort_spark.sources.readers import read_raw_csv, read_records_json


def test_csv_reader_missing_modes(spark, tmp_path):
    header = ",".join(C.RAW_COLUMNS)
    row = {c: "1" for c in C.RAW_COLUMNS}
    row.update(race="?", A1Cresult="None", max_glu_serum=">200", weight="?", payer_code="MC")
    p = tmp_path / "raw.csv"
    p.write_text(header + "\n" + ",".join(row[c] for c in C.RAW_COLUMNS) + "\n")
    lit = read_raw_csv(spark, str(p), "literal").first()
    pipe = read_raw_csv(spark, str(p), "pipeline").first()
    eda = read_raw_csv(spark, str(p), "eda").first()
    assert lit.race == "?" and pipe.race is None and pipe.A1Cresult == "None"
    assert eda.A1Cresult is None and eda.payer_code == "MC" and pipe.encounter_id == 1


def test_json_records_keep_raw_line(spark, tmp_path):
    p = tmp_path / "r.jsonl"
    p.write_text(json.dumps({"race": "Asian", "time_in_hospital": 3, "readmitted": "NO"}) + "\n")
    r = read_records_json(spark, str(p)).first()
    assert r.race == "Asian" and r.time_in_hospital == 3 and "readmitted" in r._raw


def test_model_bundle_round_trip(spark, sf_dir, tmp_path):
    from cohort_spark.plans import models as ML
    from cohort_spark.plans.jobs_models import penalty, train_test
    train, test, cat, num = train_test(spark, sf_dir)
    model, scored = ML.fit_score(ML.build_lr(cat, num, reg=penalty(spark, sf_dir)), train, test)
    path = str(tmp_path / "bundle")
    ML.save_bundle(model, 0.091046, path, {"calibration_method": "none"})
    loaded, meta = ML.load_bundle(spark, path)
    again = ML.positive_probability(loaded.transform(test))
    a = {r.encounter_id: r.prediction for r in scored.select("encounter_id", "prediction").collect()}
    b = {r.encounter_id: r.prediction for r in again.select("encounter_id", "prediction").collect()}
    assert meta["threshold"] == 0.091046 and a == b


def test_label_feedback_stream_join(spark, tmp_path):
    from cohort_spark.streaming.queries import label_feedback_stream
    pdir, ldir = tmp_path / "p", tmp_path / "l"
    spark.createDataFrame([("a", "2024-01-01 00:00:00", 0.3), ("b", "2024-01-02 00:00:00", 0.7)],
                          "request_id string, pred_ts string, readmission_probability double") \
        .withColumn("pred_ts", F.to_timestamp("pred_ts")).write.parquet(str(pdir))
    spark.createDataFrame([("a", "2024-01-10 00:00:00", 1), ("b", "2024-03-30 00:00:00", 0)],
                          "request_id string, label_ts string, label int") \
        .withColumn("label_ts", F.to_timestamp("label_ts")).write.parquet(str(ldir))
    preds = spark.readStream.schema(spark.read.parquet(str(pdir)).schema).parquet(str(pdir))
    labels = spark.readStream.schema(spark.read.parquet(str(ldir)).schema).parquet(str(ldir))
    name = "fb_" + uuid.uuid4().hex[:6]
    q = (label_feedback_stream(preds, labels, "30 days").writeStream.format("memory").queryName(name)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.table(name).collect()
    assert [r.request_id for r in rows] == ["a"]      # b's label came after 30 days


def test_drift_per_batch_and_audit(spark, sf_dir, tmp_path):
    from cohort_spark.plans import jobs_drift as JD
    from cohort_spark.streaming.queries import audit_sink, drift_per_batch
    ref, cols = JD.reference(spark, sf_dir), JD.monitored(spark, sf_dir)
    src = tmp_path / "batch"
    JD.batches(spark, sf_dir)["shifted"].select(*cols).write.parquet(str(src))
    stream = spark.readStream.schema(spark.read.parquet(str(src)).schema).parquet(str(src))
    out = str(tmp_path / "verdicts")
    drift_per_batch(stream, ref, cols, out).awaitTermination()
    v = spark.read.parquet(out).collect()
    assert len(v) >= 1 and all(r.trigger for r in v)
    # audit: a replayed request id is written once
    adir = tmp_path / "req"
    spark.createDataFrame([("r1", 0.2), ("r1", 0.2), ("r2", 0.9)], "request_id string, p double") \
        .write.parquet(str(adir))
    scored = (spark.readStream.schema("request_id string, p double").parquet(str(adir))
              .withColumn("request_ts", F.current_timestamp()))
    apath = str(tmp_path / "audit")
    audit_sink(scored, apath).awaitTermination()
    ids = sorted(r.request_id for r in spark.read.json(apath).collect())
    assert ids == ["r1", "r2"]


def test_audit_restart_keeps_new_requests(spark, tmp_path):
    from cohort_spark.streaming.queries import audit_sink
    src, log = str(tmp_path / "requests"), str(tmp_path / "audit")

    def run(ids):
        spark.createDataFrame([(i, 0.5) for i in ids], "request_id string, p double").write.mode("append").parquet(src)
        scored = (spark.readStream.schema("request_id string, p double").parquet(src)
                  .withColumn("request_ts", F.current_timestamp()))
        audit_sink(scored, log).awaitTermination()
        return sorted(r.request_id for r in spark.read.json(log).collect())

    assert run(["a", "b"]) == ["a", "b"]
    # started again: new requests arrive, the replayed one is not written twice
    assert run(["b", "c", "d"]) == ["a", "b", "c", "d"]
