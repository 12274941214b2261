"""Ranking metrics against brute force; edge cases of the threshold rules."""
import random

import pytest
from pyspark.sql import functions as F

from cohort_spark.operators import fairness as FA
from cohort_spark.operators import metrics as M


def _bruteforce(rows):
    ys = [y for y, _ in rows]
    P = sum(ys)
    N = len(ys) - P
    thr = sorted({s for _, s in rows}, reverse=True)
    ap, prev_r = 0.0, 0.0
    for t in thr:
        tp = sum(1 for y, s in rows if s >= t and y == 1)
        fp = sum(1 for y, s in rows if s >= t and y == 0)
        r = tp / P
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    u = 0.0
    for y1, s1 in rows:
        if y1 != 1:
            continue
        for y0, s0 in rows:
            if y0 == 0:
                u += 1.0 if s1 > s0 else (0.5 if s1 == s0 else 0.0)
    return ap, u / (P * N)


def test_ap_and_auc_with_ties(spark):
    rnd = random.Random(3)
    rows = [(int(rnd.random() < 0.3), round(rnd.random(), 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, s double")
    got = M.ranking_metrics(df, "y", "s").first()
    ap, auc = _bruteforce(rows)
    assert got.average_precision == pytest.approx(ap, abs=1e-12)
    assert got.roc_auc == pytest.approx(auc, abs=1e-12)


def test_all_ties_and_one_class(spark):
    ties = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.5), (1, 0.5)], "y int, s double")
    r = M.ranking_metrics(ties, "y", "s").first()
    assert r.roc_auc == pytest.approx(0.5) and r.average_precision == pytest.approx(0.5)
    one = spark.createDataFrame([(0, 0.1), (0, 0.9)], "y int, s double")
    r = M.ranking_metrics(one, "y", "s").first()
    assert r.average_precision is None and r.roc_auc is None


def test_recall_at_unreachable_precision_is_zero(spark):
    df = spark.createDataFrame([(0, 0.9), (0, 0.8), (1, 0.1)], "y int, s double")
    assert M.recall_at_precision(df, "y", "s", 0.9).first().recall_at_precision == 0.0


def test_threshold_for_recall_picks_highest(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.2), (1, 0.1)], "y int, s double")
    rows = {r.target_recall: r for r in M.thresholds_for_recall(df, "y", "s", [0.3, 0.6, 1.0]).collect()}
    assert rows[0.3].threshold == 0.9 and rows[0.6].threshold == 0.7 and rows[1.0].threshold == 0.1


def test_group_without_positives_has_zero_recall(spark):
    df = spark.createDataFrame([("a", 0, 0.9), ("a", 0, 0.1), ("b", 1, 0.9), ("b", 0, 0.2)],
                               "g string, y int, s double")
    g = {r.level: r for r in FA.by_group(df, ["g"], "y", "s", 0.5).collect()}
    assert g["a"].recall == 0.0 and g["b"].recall == 1.0
    d = FA.disparities(df, ["g"], "y", "s", 0.5).first()
    assert d.recall_gap == 1.0
