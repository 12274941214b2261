"""Stream results equal their batch twins; sessions equal session_window."""
from pyspark.sql import functions as F

import __spark_entry__ as E
from cohort_spark.plans.jobs_stream import events
from cohort_spark.streaming import windows as W


def test_stream_rates_equal_batch(spark, sf_dir):
    q = E.queries()
    batch = q["rate_tumbling"](spark, sf_dir).withColumn(
        "window_start", F.col("window_start").cast("timestamp")).withColumn(
        "window_end", F.col("window_end").cast("timestamp"))
    stream = q["stream_rates"](spark, sf_dir)
    assert batch.exceptAll(stream).count() == 0 and stream.exceptAll(batch).count() == 0


def test_sessions_equal_session_window(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    ours = W.sessions(ev, "user_id", 1800).select("user_id", "session_start", "session_end", "n_events")
    sw = (ev.groupBy("user_id", F.session_window("ts", "30 minutes").alias("s"))
          .agg(F.count(F.lit(1)).alias("n_events"))
          .select("user_id", F.col("s.start").alias("session_start"),
                  F.col("s.end").alias("session_end"), "n_events"))
    assert ours.exceptAll(sw).count() == 0 and sw.exceptAll(ours).count() == 0


def test_scoring_stream_accepts_contract_rows(spark, sf_dir):
    q = E.queries()
    scored = q["stream_scoring"](spark, sf_dir)
    accepted = q["request_verdicts"](spark, sf_dir).where("accepted").count()
    rows = scored.collect()
    assert len(rows) == accepted
    assert all(0.0 <= r.readmission_probability <= 1.0 and r.n_factors == 6 for r in rows)


def test_stream_drift_verdicts_equal_batch_rule(spark, sf_dir):
    q = E.queries()
    streamed = {r.batch: r.reasons for r in q["stream_drift"](spark, sf_dir).collect()}
    batch = {r.batch: r.reasons for r in q["retrain_decision"](spark, sf_dir).collect()}
    assert streamed == batch and set(batch) == {"control", "shifted"}
