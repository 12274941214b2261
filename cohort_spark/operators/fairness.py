"""Subgroup fairness slices at one global threshold (measure, not mitigate).

Sensitive attributes are unpivoted to ``(attribute, level)`` so every
attribute is sliced in the SAME aggregation; rank metrics per group reuse the
grouped tie table of ``metrics``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .metrics import ranking_metrics, thresholds_for_recall


def slices(df: DataFrame, attributes: list[str], label: str, score: str) -> DataFrame:
    """(attribute, level, y, score) -- one row per input row and attribute."""
    return (df.select(F.col(label).cast("int").alias("y"), F.col(score).cast("double").alias("score"),
                      *[F.col(f"`{a}`").cast("string").alias(a) for a in attributes])
            .unpivot(["y", "score"], attributes, "attribute", "level"))


def by_group(df: DataFrame, attributes: list[str], label: str, score: str,
             threshold: float, min_support: int = C.MIN_SUPPORT) -> DataFrame:
    """Per (attribute, level): support, prevalence, recall (0 without positives),
    precision (0 without flags), flag rate, FPR, low-support flag."""
    s = slices(df, attributes, label, score)
    flag = F.col("score") >= threshold
    y = F.col("y") == 1
    g = s.groupBy("attribute", "level").agg(
        F.count(F.lit(1)).alias("support"), F.count_if(y).alias("_p"),
        F.count_if(flag & y).alias("_tp"), F.count_if(flag & ~y).alias("_fp"),
        F.count_if(~y).alias("_n"))
    tp, fp, p, n = F.col("_tp"), F.col("_fp"), F.col("_p"), F.col("_n")
    return g.select(
        "attribute", "level", "support", (p / F.col("support")).alias("prevalence"),
        F.when(p > 0, tp / p).otherwise(F.lit(0.0)).alias("recall"),
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0)).alias("precision"),
        ((tp + fp) / F.col("support")).alias("flag_rate"),
        F.when(n > 0, fp / n).otherwise(F.lit(0.0)).alias("fpr"),
        (F.col("support") < min_support).alias("low_support"))


def rank_metrics_by_group(df: DataFrame, attributes: list[str], label: str, score: str) -> DataFrame:
    """Per (attribute, level): AP and ROC-AUC; null for one-class groups."""
    s = slices(df, attributes, label, score)
    return ranking_metrics(s, "y", "score", ["attribute", "level"]).select(
        "attribute", "level", "average_precision", "roc_auc")


def disparities(df: DataFrame, attributes: list[str], label: str, score: str,
                threshold: float) -> DataFrame:
    """Per attribute: demographic-parity difference (flag-rate max−min),
    equalized-odds difference (max of TPR gap and FPR gap), recall gap,
    flag-rate gap, and the overall recall and flag rate."""
    g = by_group(df, attributes, label, score, threshold)
    d = g.groupBy("attribute").agg(
        (F.max("flag_rate") - F.min("flag_rate")).alias("demographic_parity_diff"),
        F.greatest(F.max("recall") - F.min("recall"), F.max("fpr") - F.min("fpr"))
        .alias("equalized_odds_diff"),
        (F.max("recall") - F.min("recall")).alias("recall_gap"),
        (F.max("flag_rate") - F.min("flag_rate")).alias("flag_rate_gap"))
    flag = F.col(score) >= threshold
    y = F.col(label).cast("int") == 1
    overall = df.agg((F.count_if(flag & y) / F.greatest(F.count_if(y), F.lit(1))).alias("overall_recall"),
                     F.avg(flag.cast("double")).alias("overall_flag_rate"))
    from .common import attach_row
    return attach_row(d, overall)


def review_routing(df: DataFrame, score: str, threshold: float, age_col: str, race_col: str,
                   support: DataFrame, band=(0.07, 0.12)) -> DataFrame:
    """Route each scored row: borderline band -> clinician review; a no-flag in
    the 40-60 age band -> escalate; otherwise standard.  Rows whose race group
    has low support are marked lower-confidence (broadcast of a per-level
    table with one row per race level)."""
    s = F.col(score)
    mid_age = F.col(age_col).isin("[40-50)", "[50-60)")
    route = (F.when(s.between(*band), "review")
             .when((s < threshold) & mid_age, "escalate").otherwise("standard"))
    low = (support.where(F.col("attribute") == race_col)
           .select(F.col("level").alias("_lvl"), F.col("low_support").alias("_low")))
    j = df.join(F.broadcast(low), F.coalesce(F.col(race_col).cast("string"), F.lit("null")) ==
                F.col("_lvl"), "left")
    return (j.withColumn("routing", route)
            .withColumn("confidence", F.when(F.coalesce("_low", F.lit(False)), "lower")
                        .otherwise("normal"))
            .drop("_lvl", "_low"))


def group_thresholds(df: DataFrame, attribute: str, label: str, score: str,
                     target_recall: float = C.TARGET_RECALL) -> DataFrame:
    """Per-level threshold reaching the same recall (an option, off by default)."""
    s = slices(df, [attribute], label, score)
    return thresholds_for_recall(s, "y", "score", [target_recall], ["attribute", "level"])
