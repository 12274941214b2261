"""Ranking, calibration and threshold metrics on ``(label, score[, groups])``.

Everything starts from the tie table ``groupBy(groups, score) -> (pos, neg)``
(one row per distinct score), then running sums from the highest score down
(``ordered.running_totals``: bucketed, no single-task window).  From those:

* precision/recall and ROC points per distinct threshold,
* average precision as the STEP sum Σ ΔR·P (not the trapezoid area),
* ROC-AUC as Mann-Whitney with ties counted half.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import round_half_up
from .common import attach_row
from .ordered import quantiles, running_totals


def tie_table(df: DataFrame, label: str, score: str, groups: list[str] | None = None) -> DataFrame:
    groups = list(groups or [])
    y = F.col(label).cast("long")
    return (df.where(F.col(score).isNotNull())
            .groupBy(*groups, F.col(score).cast("double").alias("score"))
            .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")))


def curve(df: DataFrame, label: str, score: str, groups: list[str] | None = None) -> DataFrame:
    """Per group and distinct threshold t (predict positive when score >= t):
    tp, fp, precision, recall, fpr, plus group totals P, N."""
    groups = list(groups or [])
    ties = tie_table(df, label, score, groups)
    cum = running_totals(ties, F.col("score"), [F.col("score")],
                         {"tp": F.col("pos"), "fp": F.col("neg")}, groups, descending=True)
    totals = ties.groupBy(*groups).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = cum.join(F.broadcast(totals), groups, "inner") if groups else attach_row(cum, totals)
    return j.withColumns({
        "precision": F.col("tp") / (F.col("tp") + F.col("fp")),
        "recall": F.try_divide(F.col("tp").cast("double"), F.col("P")),
        "fpr": F.try_divide(F.col("fp").cast("double"), F.col("N")),
    })


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """All distinct-threshold points plus the end point (P=1, R=0, no threshold)."""
    c = curve(df, label, score).select(F.col("score").alias("threshold"), "precision", "recall")
    end = (df.agg(F.count(F.lit(1)).alias("_n"))
           .select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                   F.lit(0.0).alias("recall")))
    return c.unionByName(end)


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """All distinct-threshold points plus the start point (0, 0) at +inf."""
    c = curve(df, label, score).select(F.col("score").alias("threshold"), "fpr", F.col("recall").alias("tpr"))
    start = (df.agg(F.count(F.lit(1)).alias("_n"))
             .select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                     F.lit(0.0).alias("tpr")))
    return c.unionByName(start)


def ranking_metrics(df: DataFrame, label: str, score: str, groups: list[str] | None = None) -> DataFrame:
    """Per group: average precision (step rule), ROC-AUC (ties half), prevalence,
    n, positives.  AP/AUC are null when a group has one class only."""
    groups = list(groups or [])
    c = curve(df, label, score, groups)
    g = c.groupBy(*groups).agg(
        F.sum(F.try_divide(F.col("pos").cast("double"), F.col("P")) * F.col("precision")).alias("_ap"),
        F.sum(F.col("pos") * (F.col("N") - F.col("fp") + F.col("neg") * F.lit(0.5))).alias("_u"),
        F.first("P").alias("positives"), F.first("N").alias("negatives"))
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    return g.select(*groups,
                    F.when(both, F.col("_ap")).alias("average_precision"),
                    F.when(both, F.try_divide(F.col("_u"), F.col("positives") * F.col("negatives")))
                    .alias("roc_auc"),
                    F.try_divide(F.col("positives").cast("double"),
                                 F.col("positives") + F.col("negatives")).alias("prevalence"),
                    (F.col("positives") + F.col("negatives")).alias("n"),
                    F.col("positives").cast("long").alias("positives"))


def brier(df: DataFrame, label: str, score: str) -> DataFrame:
    d = F.col(score).cast("double") - F.col(label).cast("double")
    return df.agg(F.avg(d * d).alias("brier"))


def recall_at_precision(df: DataFrame, label: str, score: str,
                        target: float = C.TARGET_PRECISION) -> DataFrame:
    """Max recall over points with precision >= target; the end point (P=1, R=0)
    always qualifies, so the answer is 0 when the bar is never reached."""
    c = curve(df, label, score)
    return c.agg(F.greatest(F.lit(0.0), F.coalesce(
        F.max(F.when(F.col("precision") >= target, F.col("recall"))), F.lit(0.0)))
        .alias("recall_at_precision")).withColumn("target_precision", F.lit(target))


def thresholds_for_recall(df: DataFrame, label: str, score: str, targets: list[float],
                          groups: list[str] | None = None) -> DataFrame:
    """Per target recall: the HIGHEST threshold whose recall >= target, with
    precision, recall and flag rate there; (0.0, P, R at the lowest threshold)
    when none qualifies.  One aggregation over the curve (no cross join)."""
    groups = list(groups or [])
    c = curve(df, label, score, groups).withColumn(
        "flag_rate", (F.col("tp") + F.col("fp")) / (F.col("P") + F.col("N")))
    pt = F.struct("score", "precision", "recall", "flag_rate")
    aggs = [F.max_by(pt, F.when(F.col("recall") >= t, F.col("score"))).alias(f"h{i}")
            for i, t in enumerate(targets)]
    aggs.append(F.min_by(pt, F.col("score")).alias("low"))
    one = c.groupBy(*groups).agg(*aggs)
    rows = []
    for i, t in enumerate(targets):
        hit = F.col(f"h{i}").isNotNull()
        rows.append(F.struct(
            F.lit(t).alias("target_recall"),
            F.when(hit, F.col(f"h{i}.score")).otherwise(F.lit(0.0)).alias("threshold"),
            F.when(hit, F.col(f"h{i}.precision")).otherwise(F.col("low.precision")).alias("precision"),
            F.when(hit, F.col(f"h{i}.recall")).otherwise(F.col("low.recall")).alias("recall"),
            F.when(hit, F.col(f"h{i}.flag_rate")).otherwise(F.lit(1.0)).alias("flag_rate")))
    return one.select(*groups, F.explode(F.array(*rows)).alias("r")).select(*groups, "r.*")


def confusion_at(df: DataFrame, label: str, score: str, threshold: Column | float) -> DataFrame:
    """tn, fp, fn, tp, precision, recall, flag rate at ``score >= threshold``
    (zero-safe: 0 when a denominator is 0)."""
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    flag = F.col(score) >= thr
    y = F.col(label).cast("int") == 1
    g = df.agg(F.count_if(~flag & ~y).alias("tn"), F.count_if(flag & ~y).alias("fp"),
               F.count_if(~flag & y).alias("fn"), F.count_if(flag & y).alias("tp"),
               F.count(F.lit(1)).alias("_n"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return g.select(
        "tn", "fp", "fn", "tp",
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0)).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0)).alias("recall"),
        ((tp + fp) / F.col("_n")).alias("flag_rate"))


def reliability_curve(df: DataFrame, label: str, score: str, n_bins: int = 10) -> DataFrame:
    """Quantile bins of the score (interior edges by exact percentile); a score
    equal to an edge falls in the lower bin; only non-empty bins are reported."""
    probs = [i / n_bins for i in range(1, n_bins)]
    p = F.col(score).cast("double")
    edges = quantiles(df, [score], probs).select(F.col("q").alias("_e"))
    j = attach_row(df.select(p.alias("_p"), F.col(label).cast("double").alias("_y")), edges)
    b = F.size(F.filter("_e", lambda e: e < F.col("_p")))
    return (j.groupBy(b.alias("bin")).agg(F.avg("_p").alias("mean_predicted"),
                                          F.avg("_y").alias("fraction_positive"),
                                          F.count(F.lit(1)).alias("count")))


def rounded(df: DataFrame, digits: int = 6, skip: tuple = ()) -> DataFrame:
    """Round every double column half-up (display and oracle comparison)."""
    out = []
    for f, t in df.dtypes:
        c = F.col(f"`{f}`")
        out.append(round_half_up(c, digits).alias(f) if t == "double" and f not in skip else c)
    return df.select(out)
