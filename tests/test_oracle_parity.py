"""Every registered job with a SQL twin equals its DuckDB oracle at sf0.001."""
import pytest

import __spark_entry__ as E
from cohort_spark.plans.catalog import QUERIES
from oracle.sql import SQL
from tests.parity import compare, duck

KEYS = sorted(SQL)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", KEYS)
def test_matches_oracle(spark, sf_dir, con, name):
    ok, msg = compare(spark, name, QUERIES[name], SQL[name], sf_dir, con, check_types=True)
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["bucket", "n", "positives", "rate", "ci_low", "ci_high"]


def test_every_key_has_sql_or_is_declared_rows_only():
    rows_only = {"score_lr", "score_gbt", "oof_scores", "cv_fold_metrics", "hyper_search",
                 "calibration_delta", "calibrated_ensemble", "model_comparison", "top_factors",
                 "global_importance", "stream_rates", "stream_scoring", "stream_drift"}
    missing = set(QUERIES) - set(SQL) - rows_only
    assert not missing, missing
