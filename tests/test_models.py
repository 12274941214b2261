"""Cross-fitting, class weights of the rows at hand, and the search's draws."""
import hashlib
import json
import math

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohort_spark import constants as C
from cohort_spark.operators import split as S
from cohort_spark.plans import models as ML
from cohort_spark.plans import tuning as TU


class Remembering:
    """A pipeline whose model scores a row 0.9 if it was fitted on it, else by the row's own x."""

    def __init__(self, fits):
        self.fits = fits

    def fit(self, rows):
        ids = [r["encounter_id"] for r in rows.select("encounter_id").collect()]
        weights = {r[C.TARGET]: r["weight"] for r in rows.select(C.TARGET, "weight").distinct().collect()}
        self.fits.append((set(ids), weights))
        fits = set(ids)

        class Model:
            def transform(self, df):
                p = F.when(F.col("encounter_id").isin(*fits), 0.9).otherwise(F.col("x"))
                return df.withColumns({"probability": array_to_vector(F.array(1 - p, p)), "rawPrediction": array_to_vector(F.array(-F.log(p / (1 - p)), F.log(p / (1 - p))))})

        return Model()


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, int(i * 7 % 5 == 0), 0.05 + 0.4 * ((i * 13) % 10) / 10 + 0.2 * int(i * 7 % 5 == 0)) for i in range(200)]
    df = spark.createDataFrame(data, f"encounter_id long, {C.TARGET} int, x double")
    return S.stratified_folds(df, "encounter_id", C.TARGET, 5).cache()


def test_no_calibrator_sees_rows_of_its_base_model(rows):
    fits = []
    for (base, held), j in zip(ML.cross_fit(lambda: Remembering(fits), rows), range(5)):
        got = held.collect()
        assert {r["encounter_id"] for r in got}.isdisjoint(fits[j][0]) and all(r["prediction"] != 0.9 for r in got)
        assert {r["fold"] for r in got} == {j}
    assert set().union(*(ids for ids, _ in fits)) == set(range(200))


def test_weights_are_those_of_the_fitted_rows(rows):
    fits = []
    list(ML.cross_fit(lambda: Remembering(fits), rows))
    by_id = {r["encounter_id"]: r[C.TARGET] for r in rows.collect()}
    for ids, weights in fits:
        n = {y: sum(by_id[i] == y for i in ids) for y in (0, 1)}
        assert weights == {y: pytest.approx(len(ids) / (2 * n[y])) for y in (0, 1)}


def test_calibration_end_to_end(rows):
    fits = []
    train = rows.where("encounter_id < 160")
    test = rows.where("encounter_id >= 160")
    dev, val = train.where("encounter_id % 4 <> 0"), train.where("encounter_id % 4 = 0")
    table, chosen, scores = ML.calibrate(lambda: Remembering(fits), train, dev, val, test)
    got = {(r["split"], r["model"]): r for r in table.collect()}
    assert set(got) == {("val", "raw"), ("val", "isotonic"), ("val", "sigmoid"), ("test", "raw"), ("test", chosen)}
    assert got["val", chosen]["brier"] == min(got["val", m]["brier"] for m in ML.CALIBRATORS) and got["test", chosen]["chosen"]
    assert got["test", chosen]["brier"] < got["test", "raw"]["brier"]  # x understates the risk it orders
    ids = {r["encounter_id"] for r in test.collect()}
    assert {r["encounter_id"] for r in scores.collect()} == ids and all(ids.isdisjoint(f) for f, _ in fits)
    assert len(fits) == 1 + 5 + 1 + 5


def test_draws_can_be_told_alone():
    for family in (TU.LR, TU.GBT):
        for trial in (0, 7, 49):
            p = family.params(trial, 42)
            for name, space in family.space.items():
                u = int(hashlib.md5(f"42:{family.name}:{trial}:{name}".encode()).hexdigest()[:12], 16) / 2 ** 48
                if isinstance(space, TU.Real) and space.log:
                    assert p[name] == pytest.approx(space.low * (space.high / space.low) ** u) and space.low <= p[name] <= space.high
                elif isinstance(space, TU.Choice):
                    assert p[name] in space.values
                else:
                    assert space.low <= p[name] <= space.high
    assert TU.TRIALS == {"lr": 50, "gbt": 40} and TU.TREES == 500
    draws = [TU.draw(42, "lr", t, "c") for t in range(2000)]
    assert abs(sum(draws) / 2000 - 0.5) < 0.03 and len(set(draws)) == 2000


def test_search_refits_the_best_and_scores_test_once(spark, rows):
    fits = []
    family = TU.Family("lr", {"c": TU.Real(1e-3, 1e2, log=True), "weights": TU.Choice(("balanced", "sqrt_balanced"))},
                       lambda cat, num, n, p: Remembering(fits))
    table = TU.search(family, rows.where("encounter_id < 160"), rows.where("encounter_id >= 160"), [], ["x"], trials=3).collect()
    assert [json.loads(r["params"])["c"] for r in table] == [pytest.approx(math.exp(math.log(1e-3) + TU.draw(C.SPLIT_SEED, "lr", t, "c") * math.log(1e5))) for t in range(3)]
    best = [r for r in table if r["best"]]
    assert len(best) == 1 and best[0]["cv_ap"] == max(r["cv_ap"] for r in table) and best[0]["test_ap"] is not None
    assert all(r["test_ap"] is None for r in table if not r["best"])
    assert len(fits) == 3 * 5 + 1 and fits[-1][0] == set(range(160))


def test_penalty_is_that_of_a_summed_loss():
    assert ML.lr_penalty(1000) == 1e-3 and ML.lr_penalty(500, 2.0) == 1e-3


@pytest.fixture(scope="module")
def levelled(spark):
    # fold 0 alone holds the level z
    data = [(i, int(i * 7 % 5 == 0), ["a", "b", "c"][i % 3] if i % 50 else "z", float(i % 11), i % 5) for i in range(200)]
    return spark.createDataFrame(data, f"encounter_id long, {C.TARGET} int, c string, x double, fold int").cache()


def test_a_classifier_is_given_features_that_are_kept(levelled, monkeypatch):
    from pyspark.ml.classification import LogisticRegression
    given, fit = [], LogisticRegression._fit

    def spy(self, rows):
        given.append((set(rows.columns), rows.storageLevel.useMemory, rows.storageLevel.useDisk))
        return fit(self, rows)

    monkeypatch.setattr(LogisticRegression, "_fit", spy)
    ML.fit_weighted(ML.build_lr(["c"], ["x"], reg=0.01), levelled)
    assert given == [({C.TARGET, "weight", "features"}, True, True)]


def test_rows_encoded_once_give_what_each_fold_s_own_levels_give(levelled, monkeypatch):
    from pyspark.ml.feature import StringIndexer
    own = {r["encounter_id"]: r["prediction"] for r in ML.oof_predict(lambda: ML.build_lr(["c"], ["x"], reg=0.01), levelled).collect()}
    fits, fit = [], StringIndexer._fit
    monkeypatch.setattr(StringIndexer, "_fit", lambda self, rows: fits.append(1) or fit(self, rows))
    rows = ML.encoded(ML.lr_encoder(["c"], ["x"]).fit(levelled), levelled)
    got = {r["encounter_id"]: r["prediction"] for r in ML.oof_predict(lambda: ML.lr_on_encoded(["c"], reg=0.01), rows).collect()}
    assert len(fits) == 1 and got.keys() == own.keys() and len(got) == 200
    assert all(got[k] == pytest.approx(own[k], abs=1e-9) for k in own)


def test_search_indexes_levels_once_a_family(levelled, monkeypatch):
    from pyspark.ml.feature import StringIndexer
    fits, fit = [], StringIndexer._fit
    monkeypatch.setattr(StringIndexer, "_fit", lambda self, rows: fits.append(1) or fit(self, rows))
    table = TU.search(TU.LR, levelled.where("encounter_id < 160"), levelled.where("encounter_id >= 160"), ["c"], ["x"], trials=1).collect()
    assert len(fits) == 1 and len(table) == 1 and table[0]["test_ap"] is not None
