"""Drift on a written snapshot: vanished and new columns, nulls as a level, merged references,
scores that follow the shift, and p-values against published tables."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_spark.functions.pvalues import chi2_sf, gamma_q, kolmogorov_sf, normal_two_sided
from cohort_spark.functions.scorecard import MONITORED
from cohort_spark.operators import drift as DR
from cohort_spark.operators import snapshot as SN

COLS = ["num", "few", "cat", "batch"]  # a monitored column may be named as the batch label


def frame(spark, n, seed=0, **change):
    rng = np.random.default_rng(seed)
    data = {"num": rng.normal(10, 3, n).round(2).tolist(), "few": rng.integers(0, 3, n).tolist(), "cat": rng.choice(["a", "b", "c"], n).tolist(),
            "batch": rng.choice(["x", "y"], n).tolist()}
    data.update(change)
    rows = list(zip(*[[None if v is None or v != v else t(v) for v in data[c]] for c, t in zip(COLS, (float, int, str, str))]))
    return spark.createDataFrame(rows, "num double, few int, cat string, batch string")


def drifts(ref, cur, columns=COLS):
    j, snap = DR.compare(ref, cur, columns)
    return {r["column"]: r for r in DR.column_drift(j, snap.facts).collect()}


@pytest.fixture(scope="module")
def ref(spark):
    return frame(spark, 400).cache()


def test_same_rows_do_not_drift(spark, ref):
    got = drifts(ref, ref)
    assert {c: (r["method"], r["score"], r["drifted"]) for c, r in got.items()} == {
        "num": ("wasserstein", 0.0, False), **{c: ("jensenshannon", 0.0, False) for c in COLS[1:]}}


@pytest.mark.parametrize("lost", ["null", "missing", "nan"])
def test_vanished_columns_drift(spark, ref, lost):
    if lost == "missing":
        cur = ref.drop("num", "cat")
    elif lost == "nan":
        cur = ref.withColumns({"num": F.lit(float("nan")), "cat": F.lit(None).cast("string")})
    else:
        cur = ref.withColumns({"num": F.lit(None).cast("double"), "cat": F.lit(None).cast("string")})
    got = drifts(ref, cur)
    assert [(got[c]["score"], got[c]["drifted"]) for c in ("num", "cat")] == [(1.0, True)] * 2
    assert not got["few"]["drifted"] and not got["batch"]["drifted"]
    new = drifts(cur if lost != "missing" else ref.withColumns({"num": F.lit(None).cast("double"), "cat": F.lit(None).cast("string")}), ref)
    assert [(new[c]["score"], new[c]["drifted"]) for c in ("num", "cat")] == [(1.0, True)] * 2
    j, snap = DR.compare(ref, cur, COLS)
    share = DR.drift_summary(DR.column_drift(j, snap.facts)).first()
    assert (share["drifted"], share["n_columns"], share["dataset_drift"]) == (2, 4, True)
    tests = {r["column"]: r for r in DR.drift_tests(j, snap.facts).collect()}
    assert tests["num"]["statistic"] == 1.0 and tests["num"]["drifted"] and tests["cat"]["drifted"]


def test_half_null_category_drifts_and_no_value_at_all_does_not(spark, ref):
    half = ref.withColumn("cat", F.when(F.col("num") > 10, F.col("cat")))
    assert drifts(ref, half)["cat"]["drifted"]
    none = ref.withColumns({"num": F.lit(None).cast("double"), "cat": F.lit(None).cast("string")})
    got = drifts(none, none)
    assert [(got[c]["score"], got[c]["drifted"]) for c in ("num", "cat")] == [(0.0, False)] * 2


def test_empty_batch_has_no_verdict(spark, ref):
    assert drifts(ref, ref.limit(0)) == {}


def test_distances_match_numpy(spark, ref):
    cur = frame(spark, 250, seed=3, num=np.random.default_rng(3).normal(11, 4, 250).round(1).tolist())
    a, b = (np.array([r["num"] for r in d.collect()]) for d in (ref, cur))
    grid = np.unique(np.concatenate([a, b]))
    fa, fb = (np.searchsorted(np.sort(x), grid, side="right") / len(x) for x in (a, b))
    want = float((np.abs(fa - fb)[:-1] * np.diff(grid)).sum() / a.std())
    j, snap = DR.compare(ref, cur, COLS)
    got = {r["column"]: r for r in DR.wasserstein_ks(j, snap.facts).collect()}["num"]
    assert got["wasserstein_norm"] == pytest.approx(want, rel=1e-9) and got["ks"] == pytest.approx(np.abs(fa - fb).max(), rel=1e-12)


def test_merged_snapshot_is_the_snapshot_of_all_rows(spark, ref, tmp_path):
    more = frame(spark, 300, seed=9, cat=["z"] * 300)
    a, b = SN.take_snapshot(ref, COLS, f"{tmp_path}/a"), SN.take_snapshot(more, COLS, f"{tmp_path}/b")
    merged, whole = SN.merge_snapshots(a, b, f"{tmp_path}/m"), SN.take_snapshot(ref.unionByName(more), COLS, f"{tmp_path}/w")
    assert sorted(merged.freq.select("column", "value", "n").collect(), key=str) == sorted(whole.freq.select("column", "value", "n").collect(), key=str)
    for x, y in zip(sorted(merged.facts.collect()), sorted(whole.facts.collect())):
        assert x["column"] == y["column"] and x["n_values"] == y["n_values"] and x["edges"] == y["edges"]
        assert x["std"] == y["std"] or x["std"] == pytest.approx(y["std"], rel=1e-12)
    again = SN.read_snapshot(spark, f"{tmp_path}/m")
    assert again.kinds() == {"num": "numeric", "few": "numeric", "cat": "category", "batch": "category"}


def test_shifted_batch_is_scored_again(spark, sf_dir):
    from cohort_spark.plans import jobs_drift as JD
    means = {r["batch"]: r["mean_score"] for r in JD.score_means(spark, sf_dir).collect()}
    assert means["shifted"] > means["control"] + 0.05
    control = JD.batches(spark, sf_dir)["control"]
    assert MONITORED(control.drop("prediction")).select("encounter_id", "prediction").exceptAll(control.select("encounter_id", "prediction")).count() == 0


def test_p_values_of_published_tables(spark):
    def value(c):
        return spark.range(1).select(c.alias("v")).first()["v"]

    # Kolmogorov's limit: critical values of the usual tables
    for x, p in ((1.2238478702170825, 0.10), (1.3580986393225507, 0.05), (1.6276236115189504, 0.01), (1.9494746066165, 0.001)):
        assert value(kolmogorov_sf(F.lit(x))) == pytest.approx(p, abs=1e-6)
    assert value(kolmogorov_sf(F.lit(0.0))) == 1.0 and value(kolmogorov_sf(F.lit(0.5))) == pytest.approx(0.9639452436, abs=1e-6)
    # chi-squared: upper 5 % and 1 % points
    for df, x, p in ((1, 3.841458820694124, 0.05), (2, 5.991464547107979, 0.05), (10, 18.307038053275146, 0.05), (30, 50.892181311517092, 0.01), (100, 124.34211340400408, 0.05)):
        assert value(chi2_sf(F.lit(x), F.lit(df))) == pytest.approx(p, abs=1e-6)
    for z, p in ((1.959963984540054, 0.05), (-2.5758293035489004, 0.01), (0.0, 1.0)):
        assert value(normal_two_sided(F.lit(z))) == pytest.approx(p, abs=1e-6)
    for a, x in ((0.5, 0.3), (0.5, 4.0), (3.0, 2.0), (7.5, 9.0)):  # both branches
        grid = np.linspace(0, x, 400001)[1:]
        f = np.exp((a - 1) * np.log(grid) - grid - math.lgamma(a))
        if a >= 1:
            assert value(gamma_q(F.lit(a), F.lit(x))) == pytest.approx(1 - np.trapezoid(f, grid), abs=1e-6)
        else:
            assert value(gamma_q(F.lit(a), F.lit(x))) == pytest.approx(math.erfc(math.sqrt(x)), abs=1e-9)
