"""Scale lint of every registered job's physical plan: no Cartesian or
nested-loop joins (no pairs are ever formed) and no row-at-a-time Python."""
import pytest

from cohort_spark.plans.catalog import QUERIES

ROWS_ONLY = {"score_lr", "score_gbt", "oof_scores", "cv_fold_metrics", "hyper_search",
             "calibration_delta", "calibrated_ensemble", "model_comparison", "top_factors",
             "global_importance", "stream_scoring"}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ROWS_ONLY))
def test_plan_has_no_pair_joins(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [p for p in FORBIDDEN if p in plan]


def test_scan_prunes_columns(spark, sf_dir):
    plan = QUERIES["scan_pruned"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
