"""Tree contributions against Shapley's sum over all subsets, and the ranking of features."""
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohort_spark import constants as C
from cohort_spark.plans import jobs_models as JM
from cohort_spark.plans import models as ML
from cohort_spark.plans import treeshap as TS


@pytest.fixture(scope="module")
def fitted(spark):
    data = [(i, int((i * 7 % 5 == 0) or (i % 3 == 1 and i % 11 > 6)), "abc"[i % 3], float(i % 11), float(i * 13 % 17)) for i in range(200)]
    rows = spark.createDataFrame(data, f"encounter_id long, {C.TARGET} int, c string, x double, y double").cache()
    return ML.fit_weighted(ML.build_gbt(["c"], ["x", "y"], max_iter=3, depth=4, max_bins=32), rows), rows


def value(tree, x, known, i=0):
    """Mean prediction of ``tree`` when only the features in ``known`` are told."""
    p, w, left, right, split = tree[i]
    if split is None:
        return p
    f, by_level, at = split
    if f in known:
        return value(tree, x, known, left if (x[f] in at if by_level else x[f] <= at[0]) else right)
    return sum(tree[c][1] / w * value(tree, x, known, c) for c in (left, right))


def test_contributions_are_shapley_values(spark, fitted):
    model, rows = fitted
    trees = TS.trees_of(model, spark)
    assert len(trees) == 3 and any(n[4] and n[4][1] for t in trees for n in t.values()) and any(n[4] and not n[4][1] for t in trees for n in t.values())
    got = model.transform(rows.limit(40)).select(vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p")).collect()
    x = np.array([r.x for r in got])
    phi = TS.Explainer(trees)(x)
    for row, mine in zip(x, phi):
        want = np.zeros(3)
        for f in range(3):
            others = [g for g in range(3) if g != f]
            for size in range(3):
                for s in combinations(others, size):
                    gain = sum(value(t, row, {*s, f}) - value(t, row, set(s)) for t in trees)
                    want[f] += factorial(size) * factorial(2 - size) / 6 * gain
        assert mine == pytest.approx(want, abs=1e-9)
    # they add up to the log-odds
    base = sum(value(t, x[0], set()) for t in trees)
    assert phi.sum(axis=1) + base == pytest.approx([np.log(r.p / (1 - r.p)) for r in got], abs=1e-9)
    means = {r.feature: r.mean_abs_shap for r in TS.mean_abs(model, rows.where("encounter_id < 0").unionByName(rows.limit(40)), ["c", "x", "y"]).collect()}
    assert [means[f] for f in ("c", "x", "y")] == pytest.approx(np.abs(phi).mean(axis=0))


def test_global_importance_ranks_both_models(spark, fitted, monkeypatch):
    model, rows = fitted
    lr, scored = ML.fit_score(ML.build_lr(["c"], ["x", "y"], reg=0.01), rows, rows)
    monkeypatch.setattr(JM, "train_test", lambda spark, sf_dir: (rows, rows, ["c"], ["x", "y"]))
    monkeypatch.setattr(JM, "baseline", lambda spark, sf_dir: (lr, scored))
    monkeypatch.setattr(JM, "boosted", lambda spark, sf_dir: (model, ML.positive_probability(model.transform(rows))))
    got = JM.global_importance(spark, "rows").collect()
    assert [r.shap_rank for r in got] == [1, 2, 3] and sorted(r["rank"] for r in got) == [1, 2, 3]
    shap = [r.mean_abs_shap for r in got]
    assert shap == sorted(shap, reverse=True) and shap[0] > 0
    linear = [r.mean_abs_contribution for r in sorted(got, key=lambda r: r["rank"])]
    assert linear == sorted(linear, reverse=True)
    tied = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("n", None), ("z", 2.0)], "feature string, v double")
    assert [r.feature for r in ML.ranked(tied, "v", "k").orderBy("k").collect()] == ["z", "a", "b", "n"]


def test_workers_need_no_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle
    trees = [{0: (0.0, 4.0, 1, 2, (0, False, [0.5])), 1: (-1.0, 1.0, -1, -1, None), 2: (1.0, 3.0, -1, -1, None)}]
    (tmp_path / "code").write_bytes(cloudpickle.dumps((TS.Explainer, trees)))
    told = subprocess.run([sys.executable, "-c", "import numpy as np; from pyspark import cloudpickle; e, t = cloudpickle.load(open('code', 'rb')); print(e(t)(np.array([[0.0], [1.0]])).tolist())"],
                          cwd=tmp_path, capture_output=True, text=True, env={}, timeout=120)
    assert told.stdout.strip() == "[[-1.5], [0.5]]", told.stderr
