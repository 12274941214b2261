"""Spark ML models: preprocessing + classifier pipelines, class weights,
out-of-fold predictions, random hyper-parameter search, calibration, a
calibrated fold ensemble, persistence with the operating threshold, and
comparison tables.

Every fit is a distributed Spark ML job; the driver only orchestrates the k
fits of a fold loop.  Training inputs are checkpointed before loops so a lost
executor recomputes from the checkpoint, not from the raw tables.
"""
from __future__ import annotations

import json
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import metrics as M
from ..operators.clean import zero_variance_columns
from ..session import cut_lineage, small_methods

NON_FEATURES = set(C.KEY_COLS) | {C.TARGET, "score", "prediction", "split", "fold", "weight"}


def feature_roles(train: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """(categorical, numeric, dropped): string columns are categorical; columns
    constant on TRAIN are dropped (decided on train only)."""
    feats = [c for c in train.columns if c not in NON_FEATURES]
    dropped = [r.column for r in zero_variance_columns(train.select(*[F.col(f"`{c}`") for c in feats]),
                                                       exclude=()).where("constant").collect()]
    types = dict(train.dtypes)
    keep = [c for c in feats if c not in dropped]
    cat = [c for c in keep if types[c] == "string"]
    num = [c for c in keep if c not in cat]
    return cat, num, dropped


def with_class_weights(df: DataFrame, label: str = C.TARGET, mode: str = "balanced") -> DataFrame:
    """``weight`` = n / (2·n_class) (balanced) or its square root; the class
    table has two rows, so it is broadcast."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    from ..operators.common import attach_row
    w = attach_row(counts, total).withColumn("weight", F.col("_n") / (F.lit(2.0) * F.col("_nc")))
    if mode == "sqrt_balanced":
        w = w.withColumn("weight", F.sqrt("weight"))
    return df.join(F.broadcast(w.select(label, "weight")), label)


def lr_penalty(n_rows: int, c: float = 1.0) -> float:
    """Spark's ``regParam`` for an inverse penalty strength ``c``: the loss is a mean here and a
    sum there, with class weights that add up to the rows."""
    return 1.0 / (c * max(n_rows, 1))


def fit_weighted(pipeline: Pipeline, rows: DataFrame, mode: str = "balanced") -> PipelineModel:
    """Fit with class weights taken from the very ``rows`` the model is fitted on (a fold's own).

    A classifier reads its features several times before it keeps them in its own form: they are
    computed once, by code that the JVM compiles, and kept (memory, then disk) while it is fitted."""
    rows = with_class_weights(rows.drop("weight"), mode=mode)
    if not isinstance(pipeline, Pipeline):
        return pipeline.fit(rows)
    *before, last = pipeline.getStages()
    with small_methods(rows.sparkSession):
        prepared = Pipeline(stages=before).fit(rows)
        ready = prepared.transform(rows).select(last.getLabelCol(), "weight", last.getFeaturesCol()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = last.fit(ready)
        finally:
            ready.unpersist()
    return PipelineModel(stages=[*prepared.stages, model])


def _idx(c: str) -> str:
    return f"{c}__idx"


def _indexer(cat: list[str]) -> list:
    return [StringIndexer(inputCols=cat, outputCols=[_idx(c) for c in cat], handleInvalid="keep", stringOrderType="alphabetAsc")] if cat else []


def lr_encoder(cat: list[str], num: list[str]) -> Pipeline:
    """One-hot levels (unknown ones -> all-zero) as ``_oh`` and raw numerics as ``_num``.  Fitted
    once on all rows that folds are cut from, it serves every fold's model: a level that a fold's
    rows lack has a slot of zeros, whose penalised coefficient is 0, as if it were unknown."""
    stages = _indexer(cat)
    if cat:
        stages.append(OneHotEncoder(inputCols=[_idx(c) for c in cat], outputCols=[f"{c}__oh" for c in cat], dropLast=True))
        stages.append(VectorAssembler(inputCols=[f"{c}__oh" for c in cat], outputCol="_oh"))
    stages.append(VectorAssembler(inputCols=num, outputCol="_num", handleInvalid="keep"))
    return Pipeline(stages=stages)


def lr_on_encoded(cat: list[str], weight_col: str | None = "weight", reg: float = 0.0, elastic_net: float = 0.0,
                  max_iter: int = 2000, tol: float = 1e-4) -> Pipeline:
    """Standardised numerics + LR on rows of ``lr_encoder``.  ``max_iter`` is a bound
    (each L-BFGS iteration is one Spark job); fits stop at ``tol`` long before."""
    lr = LogisticRegression(featuresCol="features", labelCol=C.TARGET, maxIter=max_iter, tol=tol,
                            regParam=reg, elasticNetParam=elastic_net, standardization=False)
    if weight_col:
        lr.setWeightCol(weight_col)
    return Pipeline(stages=[StandardScaler(inputCol="_num", outputCol="_num_s", withMean=True, withStd=True),
                            VectorAssembler(inputCols=(["_oh"] if cat else []) + ["_num_s"], outputCol="features"), lr])


def build_lr(cat: list[str], num: list[str], **settings) -> Pipeline:
    """``lr_encoder`` and ``lr_on_encoded`` (its settings) in one: levels, means and deviations are
    those of the rows it is fitted on."""
    return Pipeline(stages=lr_encoder(cat, num).getStages() + lr_on_encoded(cat, **settings).getStages())


def gbt_encoder(cat: list[str], num: list[str]) -> Pipeline:
    """Indexed categoricals (no one-hot) + numerics as ``features``; also for folds, where a level
    that a fold's rows lack is an index without rows, as the one kept for unknown levels is."""
    return Pipeline(stages=[*_indexer(cat), VectorAssembler(inputCols=[_idx(c) for c in cat] + num, outputCol="features",
                                                            handleInvalid="keep")])


def gbt_on_encoded(weight_col: str | None = "weight", max_iter: int = 500, depth: int = 6, step: float = 0.05, max_bins: int = 128,
                   subsample: float = 0.8, seed: int = C.SPLIT_SEED) -> Pipeline:
    """Gradient-boosted trees on rows of ``gbt_encoder``."""
    gbt = GBTClassifier(featuresCol="features", labelCol=C.TARGET, maxIter=max_iter, maxDepth=depth,
                        stepSize=step, subsamplingRate=subsample, maxBins=max_bins, seed=seed)
    if weight_col:
        gbt.setWeightCol(weight_col)
    return Pipeline(stages=[gbt])


def build_gbt(cat: list[str], num: list[str], **settings) -> Pipeline:
    """``gbt_encoder`` and ``gbt_on_encoded`` (its settings) in one."""
    return Pipeline(stages=gbt_encoder(cat, num).getStages() + gbt_on_encoded(**settings).getStages())


def encoded(encoder: PipelineModel, rows: DataFrame) -> DataFrame:
    """Key, target, fold (if any) and encoded columns of ``rows``, checkpointed: what the fits of a
    fold loop read, in the partitions and order of ``rows``."""
    out = encoder.transform(rows)
    keep = [c for c in ("encounter_id", C.TARGET, "fold", "_oh", "_num", "features") if c in out.columns]
    with small_methods(rows.sparkSession):
        return cut_lineage(out.select(*keep))


def positive_probability(scored: DataFrame, out: str = "prediction") -> DataFrame:
    return scored.withColumn(out, vector_to_array("probability")[1])


def margin(scored: DataFrame, out: str = "margin") -> DataFrame:
    return scored.withColumn(out, vector_to_array("rawPrediction")[1])


def fit_score(pipeline: Pipeline, train: DataFrame, test: DataFrame) -> tuple[PipelineModel, DataFrame]:
    model = fit_weighted(pipeline, train)
    return model, positive_probability(model.transform(test))


def oof_predict(make_pipeline, train: DataFrame, k: int = C.N_FOLDS, fold_col: str = "fold") -> DataFrame:
    """Out-of-fold probabilities: fold j is scored by a model fit on the others."""
    parts = []
    for j in range(k):
        model = fit_weighted(make_pipeline(), train.where(F.col(fold_col) != j))
        parts.append(positive_probability(model.transform(train.where(F.col(fold_col) == j))))
    keep = [c for c in parts[0].columns if not c.endswith(("__idx", "__oh")) and c not in
            ("_oh", "_num", "_num_s", "features", "rawPrediction", "probability")]
    return reduce(lambda a, b: a.unionByName(b), [p.select(*[F.col(f"`{c}`") for c in keep])
                                                  for p in parts])


def fold_metrics(oof: DataFrame, fold_col: str = "fold") -> DataFrame:
    """Per-fold AP / ROC-AUC (their mean is the CV objective; pooled differs)."""
    return M.ranking_metrics(oof, C.TARGET, "prediction", [fold_col])


# ------------------------------------------------------------------ calibration
def fit_platt(cal: DataFrame, margin_col: str = "margin", label: str = C.TARGET):
    """Sigmoid calibration: a one-feature logistic regression on the margin."""
    va = VectorAssembler(inputCols=[margin_col], outputCol="_cal_f")
    lr = LogisticRegression(featuresCol="_cal_f", labelCol=label, regParam=0.0,
                            probabilityCol="_cal_prob", rawPredictionCol="_cal_raw",
                            predictionCol="_cal_pred")
    return Pipeline(stages=[va, lr]).fit(cal)


def fit_isotonic(cal: DataFrame, score_col: str = "prediction", label: str = C.TARGET):
    """Isotonic calibration of the probability (non-decreasing step function)."""
    va = VectorAssembler(inputCols=[score_col], outputCol="_cal_f")
    iso = IsotonicRegression(featuresCol="_cal_f", labelCol=label, predictionCol="_cal_pred")
    return Pipeline(stages=[va, iso]).fit(cal)


def apply_calibrator(model, scored: DataFrame, method: str, out: str = "calibrated") -> DataFrame:
    t = model.transform(scored)
    if method == "sigmoid":
        t = t.withColumn(out, vector_to_array("_cal_prob")[1])
    else:
        t = t.withColumn(out, F.least(F.greatest(F.col("_cal_pred"), F.lit(0.0)), F.lit(1.0)))
    return t.drop("_cal_f", "_cal_prob", "_cal_raw", "_cal_pred")


CALIBRATORS = {"isotonic": fit_isotonic, "sigmoid": fit_platt}


def cross_fit(make_pipeline, rows: DataFrame, k: int = C.N_FOLDS, fold_col: str = "fold"):
    """k pairs (base model, its held-out fold scored by it): no base model has seen the rows that
    its calibrator will be fitted on."""
    for j in range(k):
        base = fit_weighted(make_pipeline(), rows.where(F.col(fold_col) != j))
        yield base, margin(positive_probability(base.transform(rows.where(F.col(fold_col) == j))))


def calibrated_ensembles(make_pipeline, rows: DataFrame, scored: DataFrame, methods: list[str], k: int = C.N_FOLDS,
                         fold_col: str = "fold", key: str = "encounter_id") -> dict[str, DataFrame]:
    """Per method, ``scored`` rows with ``prediction``: the mean over k pairs of the calibrated
    probabilities.  A base model is fitted once for all methods."""
    parts: dict[str, list[DataFrame]] = {m: [] for m in methods}
    for base, held in cross_fit(make_pipeline, rows, k, fold_col):
        held = held.select(C.TARGET, "margin", "prediction").persist()
        raw = margin(positive_probability(base.transform(scored))).select(key, F.col(C.TARGET), "margin", "prediction")
        for m in methods:
            calibrator = CALIBRATORS[m](held)
            parts[m].append(apply_calibrator(calibrator, raw, m, "calibrated").select(key, C.TARGET, "calibrated"))
        held.unpersist()
    return {m: reduce(DataFrame.unionByName, ps).groupBy(key, C.TARGET).agg(F.avg("calibrated").alias("prediction")) for m, ps in parts.items()}


def calibrate(make_pipeline, train: DataFrame, dev: DataFrame, val: DataFrame, test: DataFrame,
              save=lambda df, name: df) -> tuple[DataFrame, str, DataFrame]:
    """Cross-fitted calibration end to end (M8-M11, E14): (table, chosen method, test scores).

    Both methods are fitted as pairs on ``dev`` (with folds) and compared on ``val`` with a raw
    model of all dev rows; the method of the lowest Brier score is refitted on all of ``train``
    and scores ``test`` once, beside a raw model of all train rows.  ``save`` writes a frame that
    is read more than once."""
    on_val = {"raw": positive_probability(fit_weighted(make_pipeline(), dev).transform(val)).select("encounter_id", C.TARGET, "prediction")}
    on_val |= calibrated_ensembles(make_pipeline, dev, val, list(CALIBRATORS))
    on_val = {m: save(df, f"val-{m}") for m, df in on_val.items()}
    first = comparison_table([metric_row(df, m) for m, df in on_val.items()], "raw")
    briers = {r["model"]: r["brier"] for r in first.select("model", "brier").collect()}  # three rows
    chosen = choose_calibrator({m: briers[m] for m in CALIBRATORS})
    raw = positive_probability(fit_weighted(make_pipeline(), train).transform(test)).select("encounter_id", C.TARGET, "prediction")
    on_test = {"raw": save(raw, "test-raw"), chosen: save(calibrated_ensembles(make_pipeline, train, test, [chosen])[chosen], "test-calibrated")}
    last = comparison_table([metric_row(df, m) for m, df in on_test.items()], "raw")
    table = first.withColumn("split", F.lit("val")).unionByName(last.withColumn("split", F.lit("test")))
    return table.withColumn("chosen", F.col("model") == chosen), chosen, on_test[chosen]


def choose_calibrator(briers: dict[str, float]) -> str:
    """Lowest Brier wins; ties keep the first listed."""
    best = None
    for name, b in briers.items():
        if best is None or b < briers[best]:
            best = name
    return best


# ------------------------------------------------------------------ persistence
def save_bundle(model: PipelineModel, threshold: float, path: str, meta: dict | None = None) -> None:
    """Model and its operating threshold travel together: the pipeline plus a
    one-row sidecar table."""
    from pyspark.sql import SparkSession
    model.write().overwrite().save(f"{path}/model")
    info = {"threshold": float(threshold), **(meta or {})}
    SparkSession.getActiveSession().createDataFrame([(json.dumps(info, sort_keys=True),)], "meta string") \
        .write.mode("overwrite").json(f"{path}/meta")


def load_bundle(spark, path: str) -> tuple[PipelineModel, dict]:
    model = PipelineModel.load(f"{path}/model")
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    return model, meta


def metric_row(scored: DataFrame, name: str, label: str = C.TARGET, score: str = "prediction") -> DataFrame:
    """One row: model, AP, ROC-AUC, recall@P0.30, Brier."""
    rm = M.ranking_metrics(scored, label, score).select("average_precision", "roc_auc")
    rp = M.recall_at_precision(scored, label, score).select("recall_at_precision")
    br = M.brier(scored, label, score)
    from ..operators.common import attach_row
    return attach_row(attach_row(rm, rp), br).withColumn("model", F.lit(name))


def comparison_table(rows: list[DataFrame], baseline: str) -> DataFrame:
    """Union of metric rows with deltas against ``baseline`` (a one-row join)."""
    u = reduce(lambda a, b: a.unionByName(b), rows)
    base = u.where(F.col("model") == baseline).select(
        *[F.col(c).alias(f"_b_{c}") for c in ("average_precision", "roc_auc", "brier")])
    from ..operators.common import attach_row
    j = attach_row(u, base)
    return j.select("model", "average_precision", "roc_auc", "recall_at_precision", "brier",
                    *[(F.col(c) - F.col(f"_b_{c}")).alias(f"delta_{c}")
                      for c in ("average_precision", "roc_auc", "brier")])


# ------------------------------------------------------------------ explanations
def linear_explainer(model: PipelineModel, train: DataFrame, cat: list[str], num: list[str]):
    """scored rows -> rows with ``contributions``: exact contributions of a linear model on the
    margin scale, coef_j · (x_j − mean_j) per assembled slot, summed per original feature (one-hot
    slots of a categorical add up).  Means come from the training rows, once; coefficients are a
    bounded literal vector (one per slot)."""
    coef = model.stages[-1].coefficients.toArray().tolist()
    with small_methods(train.sparkSession):
        means = model.transform(train).agg(Summarizer.mean(F.col("features")).alias("m")).first()["m"]
    means = means.toArray().tolist() if means is not None else [None] * len(coef)
    # slot -> original feature, from the one-hot sizes (alphabetical labels + dropped unknown)
    indexed = [s for s in model.stages if s.__class__.__name__ == "StringIndexerModel"]
    sizes = [(c, len(labels)) for c, labels in zip(cat, indexed[0].labelsArray if indexed else [])] + [(c, 1) for c in num]
    assert sum(n for _, n in sizes) == len(coef), (sizes, len(coef))

    def explain(scored: DataFrame) -> DataFrame:
        x, at, parts = vector_to_array("features"), 0, []
        for name, size in sizes:
            terms = [(x[at + i] - F.lit(means[at + i])) * F.lit(coef[at + i]) for i in range(size)]
            parts.append((reduce(lambda a, b: a + b, terms) if terms else F.lit(0.0)).alias(name))
            at += size
        return scored.withColumn("contributions", F.struct(*parts))

    return explain


def linear_contributions(model: PipelineModel, scored: DataFrame, train: DataFrame,
                         cat: list[str], num: list[str]) -> DataFrame:
    """``linear_explainer`` applied to ``scored``."""
    return linear_explainer(model, train, cat, num)(scored)


def top_factors(contrib: DataFrame, features: list[str], k: int = C.TOP_K_FACTORS) -> DataFrame:
    """Top-k factors per row by |contribution|: feature, value, contribution
    (4 dp), direction; ties by feature name."""
    items = F.array(*[F.struct(
        F.lit(f).alias("feature"), F.col(f"`{f}`").cast("string").alias("value"),
        F.col(f"contributions.`{f}`").alias("contribution")) for f in features])
    ranked = F.array_sort(items, lambda a, b: F.when(F.abs(a["contribution"]) > F.abs(b["contribution"]), -1)
                          .when(F.abs(a["contribution"]) < F.abs(b["contribution"]), 1)
                          .when(a["feature"] < b["feature"], -1)
                          .when(a["feature"] > b["feature"], 1).otherwise(0))
    top = F.transform(F.slice(ranked, 1, k), lambda s: F.struct(
        s["feature"].alias("feature"), s["value"].alias("value"),
        F.round(s["contribution"], 4).alias("contribution"),
        F.when(s["contribution"] > 0, "increases").otherwise("decreases").alias("direction")))
    return contrib.withColumn("top_factors", top)


def global_importance(contrib: DataFrame, features: list[str]) -> DataFrame:
    """Mean |contribution| per feature, ranked (one aggregation, then a sort
    of one row per feature)."""
    one = contrib.agg(*[F.avg(F.abs(F.col(f"contributions.`{f}`"))).alias(f"i{i}")
                        for i, f in enumerate(features)])
    long = one.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"i{i}").alias("mean_abs_contribution"))
        for i, f in enumerate(features)])).alias("r")).select("r.*")
    return ranked(long, "mean_abs_contribution", "rank")


def ranked(importance: DataFrame, by: str, rank: str) -> DataFrame:
    """``rank`` of features from the largest ``by``, ties by name (one row per feature)."""
    order = Window.orderBy(F.col(by).desc_nulls_last(), "feature")
    return importance.withColumn(rank, F.row_number().over(order))
