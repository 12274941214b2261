"""Jobs: splits, joins, ranking/threshold metrics and fairness slices.

The scored cohort is the cleaned, first-encounter table with each patient's
first-encounter ``score`` carried through cleaning; metrics are computed on
its stratified test split, as a model would be scored once on held-out data.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import age_band_10yr
from ..operators import clean as CL
from ..operators import fairness as FA
from ..operators import metrics as M
from ..operators import split as S
from ..operators.assoc import hash_row_split
from ..operators.common import attach_row
from .catalog import features_scored, memo_plan, raw, register
from .jobs_core import OPERATING_THRESHOLD

ATTRS = ["age_10yr", "age_coarse", "gender", "race"]


@memo_plan
def scored_cohort(spark, sf_dir):
    """Featurized cohort (one row per patient) with its first-encounter score
    (the written feature stage)."""
    return features_scored(spark, sf_dir)


@memo_plan
def split_cohort(spark, sf_dir):
    return S.stratified_split(scored_cohort(spark, sf_dir), "encounter_id", C.TARGET)


@memo_plan
def test_scores(spark, sf_dir):
    # the split goes by key and label: only what the metrics read is split
    rows = scored_cohort(spark, sf_dir).select("encounter_id", C.TARGET, "score", "age_midpoint", "age_bucket", "gender", "race")
    t = S.stratified_split(rows, "encounter_id", C.TARGET).where(F.col("split") == "test")
    return t.select("encounter_id", F.col(C.TARGET).alias("label"), "score",
                    age_band_10yr(F.col("age_midpoint")).alias("age_10yr"),
                    F.col("age_bucket").alias("age_coarse"), "gender", "race")


# ====================================================================== splits / joins
@register("stratified_split")
def stratified_split(spark, sf_dir):
    return split_cohort(spark, sf_dir).select("encounter_id", C.TARGET, "split")


@register("stratified_folds")
def stratified_folds(spark, sf_dir):
    d = S.stratified_folds(scored_cohort(spark, sf_dir), "encounter_id", C.TARGET, C.N_FOLDS)
    return d.select("encounter_id", C.TARGET, "fold")


@register("sample_n")
def sample_n(spark, sf_dir):
    return S.sample_n(raw(spark, sf_dir).select("encounter_id", "patient_nbr"), "encounter_id", 3000)


@register("random_heldout")
def random_heldout(spark, sf_dir):
    test = split_cohort(spark, sf_dir).where(F.col("split") == "test")
    one = S.sample_n(test.select("encounter_id", "patient_nbr", C.TARGET), "encounter_id", 1, seed=7)
    return one.select("encounter_id", "patient_nbr",
                      (F.col(C.TARGET) == 1).alias("was_readmitted_30d"))


@register("heldout_semi")
def heldout_semi(spark, sf_dir):
    return S.heldout_rows(raw(spark, sf_dir), split_cohort(spark, sf_dir))


@register("patient_intersect")
def patient_intersect(spark, sf_dir):
    rows = raw(spark, sf_dir, "eda").select("encounter_id", "patient_nbr")
    s = hash_row_split(rows, "encounter_id")
    return S.shared_entities(s.where("NOT is_test"), s.where("is_test"), "patient_nbr")


@register("label_feedback_join")
def label_feedback_join(spark, sf_dir):
    """Held-out predictions joined to outcomes that arrive later (by encounter)."""
    preds = test_scores(spark, sf_dir).select("encounter_id", "score")
    outcomes = raw(spark, sf_dir).select("encounter_id", CL.binary_target(F.col("readmitted"))
                                         .alias("label"))
    # both sides grow; the size of compressed files would make the outcomes a broadcast
    return preds.join(outcomes.hint("merge"), "encounter_id", "inner")


@register("split_anti")
def split_anti(spark, sf_dir):
    cohort = scored_cohort(spark, sf_dir)
    test = split_cohort(spark, sf_dir).where(F.col("split") == "test")
    return S.train_minus_test(cohort, test, "encounter_id").select("encounter_id", C.TARGET)


# ====================================================================== metrics
@register("pr_curve")
def pr_curve(spark, sf_dir):
    return M.rounded(M.pr_curve(test_scores(spark, sf_dir), "label", "score"))


@register("average_precision")
def average_precision(spark, sf_dir):
    m = M.ranking_metrics(test_scores(spark, sf_dir), "label", "score")
    return M.rounded(m.select("average_precision", "prevalence", "n", "positives"))


@register("roc_curve")
def roc_curve(spark, sf_dir):
    return M.rounded(M.roc_curve(test_scores(spark, sf_dir), "label", "score"), skip=("threshold",))


@register("roc_auc")
def roc_auc(spark, sf_dir):
    return M.rounded(M.ranking_metrics(test_scores(spark, sf_dir), "label", "score").select("roc_auc"))


@register("brier")
def brier(spark, sf_dir):
    return M.rounded(M.brier(test_scores(spark, sf_dir), "label", "score"))


@register("recall_at_precision")
def recall_at_precision(spark, sf_dir):
    return M.rounded(M.recall_at_precision(test_scores(spark, sf_dir), "label", "score"))


@register("threshold_for_recall")
def threshold_for_recall(spark, sf_dir):
    return M.rounded(M.thresholds_for_recall(test_scores(spark, sf_dir), "label", "score",
                                             [C.TARGET_RECALL]))


@register("threshold_sensitivity")
def threshold_sensitivity(spark, sf_dir):
    return M.rounded(M.thresholds_for_recall(test_scores(spark, sf_dir), "label", "score",
                                             C.RECALL_TARGETS))


@register("operating_point")
def operating_point(spark, sf_dir):
    """Confusion counts at the recall-0.50 threshold, with alert volume per day."""
    t = test_scores(spark, sf_dir)
    thr = M.thresholds_for_recall(t, "label", "score", [C.TARGET_RECALL]).select("threshold")
    op = M.confusion_at(attach_row(t, thr), "label", "score", F.col("threshold"))
    return M.rounded(attach_row(op, thr).withColumn("alerts_per_day", F.col("flag_rate") * C.DISCHARGES_PER_DAY))


@register("confusion")
def confusion(spark, sf_dir):
    return M.rounded(M.confusion_at(test_scores(spark, sf_dir), "label", "score", 0.5))


@register("reliability_curve")
def reliability_curve(spark, sf_dir):
    return M.rounded(M.reliability_curve(test_scores(spark, sf_dir), "label", "score"))


@register("tripwire")
def tripwire(spark, sf_dir):
    m = M.ranking_metrics(test_scores(spark, sf_dir), "label", "score")
    return M.rounded(m.select("roc_auc", (F.col("roc_auc") > C.LEAKAGE_AUC).alias("tripped")))


# ====================================================================== fairness
@register("fairness_by_group")
def fairness_by_group(spark, sf_dir):
    return M.rounded(FA.by_group(test_scores(spark, sf_dir), ATTRS, "label", "score",
                                 OPERATING_THRESHOLD))


@register("fairness_rank_metrics")
def fairness_rank_metrics(spark, sf_dir):
    return M.rounded(FA.rank_metrics_by_group(test_scores(spark, sf_dir), ATTRS, "label", "score"))


@register("fairness_disparity")
def fairness_disparity(spark, sf_dir):
    return M.rounded(FA.disparities(test_scores(spark, sf_dir), ATTRS, "label", "score",
                                    OPERATING_THRESHOLD))


@register("review_routing")
def review_routing(spark, sf_dir):
    t = test_scores(spark, sf_dir)
    sup = FA.by_group(t, ["race"], "label", "score", OPERATING_THRESHOLD)
    r = FA.review_routing(t, "score", OPERATING_THRESHOLD, "age_10yr", "race", sup)
    return r.select("encounter_id", "routing", "confidence")


@register("group_thresholds")
def group_thresholds(spark, sf_dir):
    return M.rounded(FA.group_thresholds(test_scores(spark, sf_dir), "age_coarse", "label", "score"))
