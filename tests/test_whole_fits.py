"""The registered model jobs run the whole counts: trials, folds and trees."""
import inspect

import pytest
from pyspark.sql import functions as F

from cohort_spark.plans import jobs_models as JM
from cohort_spark.plans import models as ML
from cohort_spark.plans import tuning as TU


@pytest.fixture
def two_rows(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 0, 0.5, 0), (2, 1, 0.7, 1)], "encounter_id long, target int, x double, fold int")
    monkeypatch.setattr(JM, "train_test", lambda spark, sf_dir: (rows, rows, [], ["x"]))
    return rows


def test_the_boosted_model_has_all_its_trees(spark, two_rows, monkeypatch):
    asked = []
    monkeypatch.setattr(ML, "fit_weighted", lambda pipeline, rows: asked.append(pipeline.getStages()[-1].getMaxIter()) or pipeline)
    monkeypatch.setattr(ML, "positive_probability", lambda scored: scored)
    monkeypatch.setattr(ML.Pipeline, "transform", lambda self, rows: rows, raising=False)
    JM.boosted(spark, "two-rows")
    assert asked == [500]


def test_the_search_runs_all_trials_of_both_families(spark, two_rows, monkeypatch):
    asked, real = {}, inspect.signature(TU.search)

    def search(*args, **settings):
        given = real.bind(*args, **settings)
        given.apply_defaults()
        a = given.arguments
        name = a["family"].name
        asked[name] = (TU.TRIALS[name] if a["trials"] is None else a["trials"], a["trees"], a["k"])
        return a["train"].select(F.lit(name).alias("family"))

    monkeypatch.setattr(TU, "search", search)
    assert sorted(r.family for r in JM.hyper_search(spark, "two-rows").distinct().collect()) == ["gbt", "lr"]
    assert asked == {"lr": (50, 500, 5), "gbt": (40, 500, 5)}
