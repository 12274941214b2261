"""Boundary rules of drift, retrain and alerting."""
from pyspark.sql import functions as F

from cohort_spark.operators import drift as DR
from cohort_spark.streaming import windows as W


def test_share_boundary_is_drift_but_not_retrain(spark):
    cd = spark.createDataFrame([("c%d" % i, 0.5 if i == 0 else 0.0) for i in range(10)],
                               "column string, score double").withColumn("drifted", F.col("score") >= 0.1)
    s = DR.drift_summary(cd)
    row = s.first()
    assert row.share == 0.1 and row.dataset_drift is True
    psis = spark.createDataFrame([("f", 0.2)], "column string, psi double")
    ap = spark.createDataFrame([(0.15,)], "new_data_prauc double")
    dec = DR.retrain_decision(s, psis, ap).first()
    assert dec.trigger is False and dec.n_reasons == 0


def test_retrain_reasons_sorted_by_psi(spark):
    s = spark.createDataFrame([(0.2,)], "share double")
    psis = spark.createDataFrame([("a", 0.3), ("b", 0.9), ("c", 0.1)], "column string, psi double")
    dec = DR.retrain_decision(s, psis).first()
    assert dec.trigger and dec.reasons.startswith("drifted columns: 0.200 of all, at most 0.1 allowed; watched features with PSI over 0.2: ")
    assert dec.reasons.endswith("b=0.90, a=0.30")


def test_psi_identical_is_zero_and_shift_positive(spark):
    ref = spark.createDataFrame([(i % 20,) for i in range(400)], "x int")
    same = DR.psi(ref, ref, ["x"]).first().psi
    shifted = DR.psi(ref, ref.select((F.col("x") + 10).alias("x")), ["x"]).first().psi
    assert abs(same) < 1e-12 and shifted > 0.2


def test_alert_hold_and_gap_boundary(spark):
    ws = spark.createDataFrame([("2024-01-01 00:00:00", 1.0), ("2024-01-01 01:00:00", 0.0),
                                ("2024-01-01 02:00:00", 1.0), ("2024-01-01 03:00:00", 1.0),
                                ("2024-01-01 04:00:00", 1.0)], "t string, v double") \
        .select(F.to_timestamp("t").alias("window_start"), "v")
    a = W.alert_for_duration(ws, F.col("v") > 0.5, 3600, 2).collect()
    assert len(a) == 1 and a[0].n_windows == 3
    ev = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 00:30:00",),
                                ("2024-01-01 01:00:01",)], "t string").select(F.to_timestamp("t").alias("ts"))
    g = W.gap_detection(ev, 1800).collect()
    assert len(g) == 1 and g[0].gap_seconds == 1801.0     # exactly 30 min is not a gap
