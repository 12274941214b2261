"""Jobs: drift between the training reference and a control / shifted batch,
and the retrain decision (monitoring plan).

The reference is a written snapshot (``reference_snapshot``); every job reads one table that joins
the snapshot with the batches, written once a session.  Both batches are scored after their last
change, so the shifted one carries the scores of its shifted columns."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import round_half_up
from ..functions.scorecard import MONITORED
from ..operators import drift as DR
from ..operators import metrics as M
from ..operators import snapshot as SN
from ..session import materialize, shared_folder
from .catalog import memo_plan, register
from .jobs_eval import split_cohort

BATCHES = ("control", "shifted")
#: Columns that the third batch of ``drift_vanished`` has lost.
VANISHED = ("medical_specialty", "number_inpatient", "time_in_hospital", "prediction")


@memo_plan
def scored_split(spark, sf_dir):
    """The split cohort with the scorecard's ``prediction`` (written once)."""
    return materialize(MONITORED(split_cohort(spark, sf_dir).drop("score")), "scored-split")


@memo_plan
def reference(spark, sf_dir):
    """Snapshot of the train split: features and prediction."""
    train = scored_split(spark, sf_dir).where(F.col("split") == "train")
    feats = [c for c in train.columns if c not in C.KEY_COLS + [C.TARGET, "split"]]
    return SN.take_snapshot(train, feats, shared_folder(spark, "reference"))


@memo_plan
def batches(spark, sf_dir):
    """control = test split; shifted = control after the what-if projection, scored again."""
    control = scored_split(spark, sf_dir).where(F.col("split") == "test")
    return {"control": control, "shifted": MONITORED(DR.shifted(control, "encounter_id"))}


@memo_plan
def monitored(spark, sf_dir):
    """Columns with more than one level on the reference (the others are no model inputs)."""
    return reference(spark, sf_dir).varying()


@memo_plan
def joined(spark, sf_dir):
    """The one table all statistics are read from."""
    return materialize(DR.joint(reference(spark, sf_dir), batches(spark, sf_dir), monitored(spark, sf_dir)), "drift-joint")


@memo_plan
def drifted_columns(spark, sf_dir):
    return materialize(DR.column_drift(joined(spark, sf_dir), reference(spark, sf_dir).facts), "drift-columns")


def _top(spark, sf_dir):
    cols = monitored(spark, sf_dir)
    return [c for c in C.TOP_SHAP_FEATURES if c in cols]


def _psi(spark, sf_dir, kind: str | None = None):
    ref = reference(spark, sf_dir)
    kinds = ref.kinds()
    pick = [c for c in _top(spark, sf_dir) if kind in (None, kinds[c])]
    return DR.rounded_psi(DR.psi_of(joined(spark, sf_dir), ref.facts, pick))


@register("reference_snapshot")
def reference_snapshot(spark, sf_dir):
    """The facts of the written reference."""
    facts = reference(spark, sf_dir).facts
    return facts.select("column", "kind", "rows", "missing", "n_values", round_half_up(F.col("std"), 6).alias("std"),
                        F.size(F.coalesce("edges", F.array().cast("array<double>"))).alias("n_edges"))


@register("psi_numeric")
def psi_numeric(spark, sf_dir):
    return _psi(spark, sf_dir, SN.NUMERIC)


@register("psi_categorical")
def psi_categorical(spark, sf_dir):
    return _psi(spark, sf_dir, SN.CATEGORY)


@register("top_feature_psi")
def top_feature_psi(spark, sf_dir):
    return _psi(spark, sf_dir)


def _by_method(spark, sf_dir, method):
    return (drifted_columns(spark, sf_dir).where(F.col("method") == method)
            .select("batch", "column", round_half_up(F.col("score"), 6).alias("score"), "drifted"))


@register("wasserstein")
def wasserstein(spark, sf_dir):
    return _by_method(spark, sf_dir, "wasserstein")


@register("jensen_shannon")
def jensen_shannon(spark, sf_dir):
    return _by_method(spark, sf_dir, "jensenshannon")


@register("ks_statistic")
def ks_statistic(spark, sf_dir):
    w = DR.wasserstein_ks(joined(spark, sf_dir), reference(spark, sf_dir).facts)
    return w.select("batch", "column", round_half_up(F.col("ks"), 6).alias("ks"))


@register("chi2_statistic")
def chi2_statistic(spark, sf_dir):
    return DR.chi2_statistic(joined(spark, sf_dir)).select("batch", "column", round_half_up(F.col("chi2"), 6).alias("chi2"))


@register("drift_p_values")
def drift_p_values(spark, sf_dir):
    """Small-sample rule (D5): KS, z-test of proportions or χ² per column, with p-values."""
    t = DR.drift_tests(joined(spark, sf_dir), reference(spark, sf_dir).facts)
    return t.select("batch", "column", "method", round_half_up(F.col("statistic"), 4).alias("statistic"),
                    round_half_up(F.col("p_value"), 4).alias("p_value"), "drifted")


@register("drift_share")
def drift_share(spark, sf_dir):
    s = DR.drift_summary(drifted_columns(spark, sf_dir))
    return s.select("batch", "drifted", "n_columns", round_half_up(F.col("share"), 6).alias("share"), "dataset_drift")


@register("drift_vanished")
def drift_vanished(spark, sf_dir):
    """Column drift of a control batch that has lost four columns: two all null, two not there."""
    control = batches(spark, sf_dir)["control"]
    types = dict(control.dtypes)
    lost = control.withColumns({c: F.lit(None).cast(types[c]) for c in VANISHED[:2]}).drop(*VANISHED[2:])
    ref = reference(spark, sf_dir)
    j = materialize(DR.joint(ref, {"vanished": lost}, monitored(spark, sf_dir)), "drift-vanished")
    return DR.column_drift(j, ref.facts).select("column", "method", round_half_up(F.col("score"), 6).alias("score"), "drifted")


def _decisions(spark, sf_dir, labelled: bool = True):
    ref = reference(spark, sf_dir)
    share = DR.drift_summary(drifted_columns(spark, sf_dir))
    psis = DR.psi_of(joined(spark, sf_dir), ref.facts, _top(spark, sf_dir))
    ap = [M.ranking_metrics(df, C.TARGET, "prediction").select(F.lit(name).alias("batch"), F.col("average_precision").alias("new_data_prauc"))
          for name, df in batches(spark, sf_dir).items()] if labelled else []
    return DR.retrain_decision(share, psis, reduce(DataFrame.unionByName, ap) if ap else None)


@register("retrain_decision")
def retrain_decision(spark, sf_dir):
    return _decisions(spark, sf_dir)


@register("score_means")
def score_means(spark, sf_dir):
    parts = {"baseline": scored_split(spark, sf_dir).where(F.col("split") == "train"), **batches(spark, sf_dir)}
    u = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("batch"), "prediction") for name, df in parts.items()])
    return u.groupBy("batch").agg(round_half_up(F.avg("prediction"), 4).alias("mean_score"))


@register("what_if_shift")
def what_if_shift(spark, sf_dir):
    return batches(spark, sf_dir)["shifted"].select("encounter_id", *DR.SHIFTED_FEATURES, "prediction")


@register("drift_validation")
def drift_validation(spark, sf_dir):
    """Control must stay silent and the shifted batch must fire; also how many of the deliberately
    shifted features the detector flags, and whether the prediction drifts with them."""
    d = drifted_columns(spark, sf_dir)
    share = F.count_if("drifted") / F.count(F.lit(1))
    s = d.groupBy("batch").agg((share >= C.DRIFT_SHARE).alias("fires"))
    side = lambda name: F.bool_or(F.when(F.col("batch") == name, F.col("fires")))
    verdict = s.agg(side("control").alias("control_drift"), side("shifted").alias("shifted_drift"))
    mine = d.where(F.col("batch") == "shifted")
    caught = mine.agg(F.count_if(F.col("drifted") & F.col("column").isin(*DR.SHIFTED_FEATURES)).alias("n_caught"),
                      F.count_if(F.col("column").isin(*DR.SHIFTED_FEATURES)).alias("n_shifted_features"),
                      F.bool_or(F.col("drifted") & (F.col("column") == "prediction")).alias("prediction_drift"))
    from ..operators.common import attach_row
    return attach_row(verdict, caught).withColumn("detector_pass", ~F.col("control_drift") & F.col("shifted_drift"))


@register("stream_drift")
def stream_drift(spark, sf_dir, files_per_batch: int = 4):
    """Structured Streaming run of the monitoring rule: the control and the shifted batch arrive as
    files (``files_per_batch`` each, written in that order); each micro-batch is checked against
    the written snapshot by ``foreachBatch`` (column drift, dataset drift, retrain rule)."""
    from ..streaming.queries import drift_per_batch
    cols, both = monitored(spark, sf_dir), batches(spark, sf_dir)
    base = shared_folder(spark, "drift-stream")
    for name in BATCHES:
        both[name].select(*cols, C.TARGET).repartition(files_per_batch).write.mode("append").parquet(f"{base}/src")
    schema = spark.read.parquet(f"{base}/src").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{base}/src")
    drift_per_batch(stream, reference(spark, sf_dir), cols, f"{base}/out", label=C.TARGET).awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    name = F.element_at(F.array(*[F.lit(b) for b in BATCHES]), (F.col("batch_id") + 1).cast("int"))
    return out.select("trigger", "n_reasons", "reasons", name.alias("batch"))
