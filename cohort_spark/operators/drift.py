"""Distribution drift between a reference snapshot and current batches, and the retrain
decision built on it.

``joint`` brings the snapshot (``snapshot.py``) and any number of named batches into ONE table
(batch, column, value, n_ref, n_cur) by one aggregation; every statistic is then an aggregation
over that table, for all batches at once:

* PSI over non-null values: numeric columns with > 10 reference values use reference deciles
  (outer edges ±inf, bins [a, b)); others use category shares; shares are clipped at 1e-6;
  PSI = Σ (c − r)·ln(c / r).
* Jensen–Shannon distance (natural log) on shares of all rows, null a level as any other.
* Normed Wasserstein: ∫|F_ref − F_cur| dx over merged values, divided by
  max(std_pop(ref), 0.001).
* KS statistic max|F_ref − F_cur| and χ² of the side × value table, with p-values; z-test of
  proportions for columns of two levels.

Method choice per column (large-sample rule): numeric with more than five distinct values over
both sides -> Wasserstein, else Jensen–Shannon; a column drifts when its score >= 0.1.  A column
with values on one side only scores 1 (it vanished, or it is new); one without any value scores
0.  Dataset drift: share >= 0.10.  Retrain: share > 0.10 OR any top-feature PSI > 0.20 OR
labelled PR-AUC < 0.15.  A batch without rows has no verdict.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import add_utilization_features, age_bucket, round_half_up
from ..functions.pvalues import chi2_sf, kolmogorov_sf, normal_two_sided
from ..session import shared_folder
from .ordered import running_totals
from .snapshot import CATEGORY, NUMERIC, Snapshot, frequencies, take_snapshot, with_numbers
from .split import hash_fraction

KEY = ["batch", "column"]


def joint(snapshot: Snapshot, batches: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
    """(batch, column, kind, value, x, n_ref, n_cur) and per batch and column the totals rows_ref,
    rows_cur (all rows), tot_ref, tot_cur (non-null), n_values (distinct, of both sides)."""
    kinds = {c: k for c, k in snapshot.kinds().items() if columns is None or c in columns}
    cur = with_numbers(frequencies(batches, kinds), kinds).select("batch", "column", "value", "x", F.lit(0).cast("long").alias("n_ref"), F.col("n").alias("n_cur"))
    ref = snapshot.freq.where(F.col("column").isin(*kinds)).select(
        F.explode(F.array(*[F.lit(b) for b in batches])).alias("batch"), "column", "value", "x", F.col("n").alias("n_ref"), F.lit(0).cast("long").alias("n_cur"))
    both = cur.unionByName(ref).groupBy("batch", "column", "value").agg(
        F.max("x").alias("x"), F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    held = F.col("value").isNotNull()
    totals = both.groupBy(*KEY).agg(
        F.sum("n_ref").alias("rows_ref"), F.sum("n_cur").alias("rows_cur"), F.sum(F.when(held, F.col("n_ref")).otherwise(0)).alias("tot_ref"),
        F.sum(F.when(held, F.col("n_cur")).otherwise(0)).alias("tot_cur"), F.count("value").alias("n_values")).where("rows_cur > 0")
    kind = F.create_map(*[F.lit(v) for p in kinds.items() for v in p])[F.col("column")]
    return both.join(F.broadcast(totals), KEY).withColumn("kind", kind)  # totals: one row a batch and column


def compare(ref: DataFrame, cur: DataFrame, columns: list[str], name: str = "current") -> tuple[DataFrame, Snapshot]:
    """``joint`` of two frames, through a snapshot of the first in the shared folder."""
    snapshot = take_snapshot(ref, columns, f"{shared_folder(ref.sparkSession, 'snapshot')}")
    return joint(snapshot, {name: cur}, columns), snapshot


def _one_sided() -> Column:
    return (F.max("tot_ref") > 0) != (F.max("tot_cur") > 0)


def jensen_shannon(j: DataFrame) -> DataFrame:
    """(batch, column, js, n_values): distance with natural log over all levels, null among them."""
    p, q = F.try_divide("n_ref", "rows_ref"), F.try_divide("n_cur", "rows_cur")
    m = (p + q) / 2
    term = (F.when(p > 0, p * F.log(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log(q / m)).otherwise(0.0))
    js = F.sqrt(F.greatest(F.sum(term) / 2, F.lit(0.0)))
    return j.groupBy(*KEY).agg(F.when(_one_sided(), 1.0).otherwise(F.coalesce(js, F.lit(0.0))).alias("js"), F.max("n_values").alias("n_values"))


def cdf_table(j: DataFrame) -> DataFrame:
    """Per batch, numeric column and merged value: F_ref, F_cur and the next value."""
    cum = running_totals(j.where((F.col("kind") == NUMERIC) & F.col("x").isNotNull()), F.col("x"), [F.col("x")],
                         {"c_ref": F.col("n_ref"), "c_cur": F.col("n_cur"), "pos": F.lit(1).cast("long")}, KEY)
    after = cum.select(*KEY, (F.col("pos") - 1).alias("pos"), F.col("x").alias("next_x"))
    return cum.join(after, [*KEY, "pos"], "left").withColumns(
        {"F_ref": F.try_divide("c_ref", "tot_ref"), "F_cur": F.try_divide("c_cur", "tot_cur")})


def wasserstein_ks(j: DataFrame, facts: DataFrame) -> DataFrame:
    """(batch, column, wasserstein_norm, ks, tot_ref, tot_cur) from the merged CDFs; both
    distances are 1 where one side has no value, null where neither has one."""
    t = cdf_table(j)
    diff = F.abs(F.col("F_ref") - F.col("F_cur"))
    g = t.groupBy(*KEY).agg(
        F.sum(F.when(F.col("next_x").isNotNull(), diff * (F.col("next_x") - F.col("x"))).otherwise(0.0)).alias("w1"),
        F.max(diff).alias("ks"), _one_sided().alias("gone"), F.max("tot_ref").alias("tot_ref"), F.max("tot_cur").alias("tot_cur"))
    g = g.join(F.broadcast(facts.select("column", "std")), "column")  # one row a column
    return g.select(*KEY, F.when(F.col("gone"), 1.0).otherwise(F.col("w1") / F.greatest(F.col("std"), F.lit(0.001))).alias("wasserstein_norm"),
                    F.when(F.col("gone"), 1.0).otherwise(F.col("ks")).alias("ks"), "tot_ref", "tot_cur")


def chi2_statistic(j: DataFrame) -> DataFrame:
    """(batch, column, chi2, levels) of the 2 x k (side x level) table of all rows, null among the
    levels, via n·(Σ o²/(r·c) − 1)."""
    n, tot = F.col("rows_ref") + F.col("rows_cur"), F.col("n_ref") + F.col("n_cur")
    s = (F.try_divide(F.col("n_ref") * F.col("n_ref"), F.col("rows_ref") * tot)
         + F.try_divide(F.col("n_cur") * F.col("n_cur"), F.col("rows_cur") * tot))
    return j.where(F.col("kind") == CATEGORY).groupBy(*KEY).agg((F.max(n) * (F.sum(s) - 1)).alias("chi2"), F.count(F.lit(1)).alias("levels"))


def proportion_z(j: DataFrame) -> DataFrame:
    """(batch, column, z) of columns with two levels: the share of the larger level by name,
    pooled under the null hypothesis."""
    two = j.groupBy(*KEY).agg(F.count(F.lit(1)).alias("levels"), F.max_by(F.struct("n_ref", "n_cur"), F.coalesce("value", F.lit(""))).alias("top"),
                              F.max("rows_ref").alias("rows_ref"), F.max("rows_cur").alias("rows_cur")).where("levels = 2")
    a, b = F.try_divide("top.n_ref", "rows_ref"), F.try_divide("top.n_cur", "rows_cur")
    pooled = (F.col("top.n_ref") + F.col("top.n_cur")) / (F.col("rows_ref") + F.col("rows_cur"))
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), F.col("rows_ref")) + F.try_divide(F.lit(1.0), F.col("rows_cur"))))
    return two.select(*KEY, F.try_divide(b - a, spread).alias("z"))


def drift_tests(j: DataFrame, facts: DataFrame, level: float = 0.05) -> DataFrame:
    """(batch, column, method, statistic, p_value, drifted): the small-sample rule.  Numeric columns
    with more than five values -> two-sample Kolmogorov–Smirnov, others with two levels -> z-test
    of proportions, with more -> χ²; a column drifts when p < ``level``.  A vanished column has
    statistic and p-value of its test, which then sees it (KS: distance 1)."""
    many = (F.col("kind") == NUMERIC) & (F.col("n_values") > 5)
    ks = wasserstein_ks(j.where(many), facts)
    n = F.greatest(F.col("tot_ref"), F.lit(1)) * F.greatest(F.col("tot_cur"), F.lit(1)) / F.greatest(F.col("tot_ref") + F.col("tot_cur"), F.lit(1))
    n = F.when((F.col("tot_ref") > 0) & (F.col("tot_cur") > 0), n).otherwise(F.col("tot_ref") + F.col("tot_cur"))
    ks = ks.select(*KEY, F.lit("ks").alias("method"), F.col("ks").alias("statistic"), kolmogorov_sf(F.sqrt(n) * F.col("ks")).alias("p_value"))
    few = j.where(~many).withColumn("kind", F.lit(CATEGORY))
    z = proportion_z(few).select(*KEY, F.lit("z").alias("method"), F.col("z").alias("statistic"), normal_two_sided(F.col("z")).alias("p_value"))
    chi = chi2_statistic(few).where("levels <> 2").select(
        *KEY, F.lit("chi2").alias("method"), F.col("chi2").alias("statistic"),
        F.when(F.col("levels") > 1, chi2_sf(F.col("chi2"), F.col("levels") - 1)).otherwise(1.0).alias("p_value"))
    return reduce(DataFrame.unionByName, (ks, z, chi)).withColumn("drifted", F.coalesce(F.col("p_value") < level, F.lit(False)))


def column_drift(j: DataFrame, facts: DataFrame, threshold: float = C.DRIFT_DISTANCE_THRESHOLD) -> DataFrame:
    """(batch, column, method, score, threshold, drifted) for every monitored column."""
    js = jensen_shannon(j)
    w = wasserstein_ks(j.where((F.col("kind") == NUMERIC) & (F.col("n_values") > 5)), facts).select(*KEY, "wasserstein_norm")
    out = js.join(w, KEY, "left")
    by_w = F.col("wasserstein_norm").isNotNull()
    return out.select(*KEY, F.when(by_w, "wasserstein").otherwise("jensenshannon").alias("method"),
                      F.coalesce("wasserstein_norm", "js").alias("score")).withColumns(
        {"threshold": F.lit(threshold), "drifted": F.col("score") >= F.lit(threshold)})


def psi_of(j: DataFrame, facts: DataFrame, columns: list[str], eps: float = C.PSI_EPS) -> DataFrame:
    """(batch, column, psi) over non-null values: reference deciles (left-closed bins, ±inf outer
    edges) where the snapshot has edges, the values themselves elsewhere."""
    f = j.where(F.col("column").isin(*columns) & F.col("value").isNotNull()).join(F.broadcast(facts.select("column", "edges")), "column")
    binned = F.concat(F.lit("bin:"), F.size(F.filter("edges", lambda e: e <= F.col("x"))).cast("string"))
    g = f.groupBy(*KEY, F.coalesce(binned, F.col("value")).alias("bin")).agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"), F.max("tot_ref").alias("tot_ref"), F.max("tot_cur").alias("tot_cur"))
    r = F.greatest(F.try_divide("n_ref", "tot_ref"), F.lit(eps))
    c = F.greatest(F.try_divide("n_cur", "tot_cur"), F.lit(eps))
    return g.groupBy(*KEY).agg(F.sum((c - r) * F.log(c / r)).alias("psi"))


def psi(ref: DataFrame, cur: DataFrame, columns: list[str]) -> DataFrame:
    """(column, psi) of two frames."""
    j, snapshot = compare(ref, cur, columns)
    return psi_of(j, snapshot.facts, columns).drop("batch")


def _groups(df: DataFrame) -> list[str]:
    return ["batch"] if "batch" in df.columns else []


def drift_summary(col_drift: DataFrame, share_threshold: float = C.DRIFT_SHARE) -> DataFrame:
    """(batch, drifted, n_columns, share, dataset_drift) -- share >= threshold."""
    return (col_drift.groupBy(*_groups(col_drift)).agg(F.count_if("drifted").alias("drifted"), F.count(F.lit(1)).alias("n_columns"))
            .withColumn("share", F.col("drifted") / F.col("n_columns"))
            .withColumn("dataset_drift", F.col("share") >= share_threshold))


def retrain_decision(share: DataFrame, psis: DataFrame, prauc: DataFrame | None = None) -> DataFrame:
    """Apply the retrain rule to every batch.  ``share`` has one row a batch with ``share``;
    ``psis`` is (batch, column, psi); ``prauc`` one row a batch with ``new_data_prauc`` (absent
    when no labels).  Reasons are ordered: share, hot PSI features sorted by PSI desc, PR-AUC.
    Frames of a single batch may do without the column ``batch``."""
    single = not _groups(share)
    named = lambda df: df.withColumn("batch", F.lit("")) if not _groups(df) else df
    hot = (named(psis).where(F.col("psi") > C.PSI_THRESHOLD).groupBy("batch")  # at most the watched features
           .agg(F.sort_array(F.collect_list(F.struct((-F.col("psi")).alias("k"), F.col("column"), F.col("psi")))).alias("h")))
    j = named(share).select("batch", "share").join(hot, "batch", "left")
    if prauc is not None:
        j = j.join(named(prauc).select("batch", "new_data_prauc"), "batch", "left")
    else:
        j = j.withColumn("new_data_prauc", F.lit(None).cast("double"))
    hot_txt = F.array_join(F.transform("h", lambda s: F.concat(
        s["column"], F.lit("="), F.format_string("%.2f", round_half_up(s["psi"], 2)))), ", ")
    reasons = F.array_compact(F.array(
        F.when(F.col("share") > C.DRIFT_SHARE, F.concat(
            F.lit("drifted columns: "), F.format_string("%.3f", round_half_up(F.col("share"), 3)),
            F.lit(f" of all, at most {C.DRIFT_SHARE} allowed"))),
        F.when(F.size("h") > 0, F.concat(F.lit(f"watched features with PSI over {C.PSI_THRESHOLD}: "),
                                         hot_txt)),
        F.when(F.col("new_data_prauc") < C.PRAUC_FLOOR, F.concat(
            F.lit("average precision: "), F.format_string("%.3f", round_half_up(F.col("new_data_prauc"), 3)),
            F.lit(f", at least {C.PRAUC_FLOOR} wanted")))))
    return j.select(*([] if single else ["batch"]), (F.size(reasons) > 0).alias("trigger"), F.size(reasons).alias("n_reasons"),
                    F.array_join(reasons, "; ").alias("reasons"))


@dataclass(frozen=True)
class Shift:
    """``column`` becomes ``value(column)`` in a ``fraction`` of the rows (by salted hash, so
    the same rows are hit each time)."""

    column: str
    value: Callable[[Column], Column]
    fraction: float = 1.0
    salt: str = ""


#: The registered scenario (fixed values).
SCENARIO = (
    Shift("number_inpatient", lambda c: c + 2),
    Shift("admission_type_grp", lambda c: F.lit("Emergency"), 0.30, "adm"),
    Shift("diag_1_bucket", lambda c: F.lit("Circulatory"), 0.40, "diag"),
    Shift("age_midpoint", lambda c: F.least(F.greatest(c + 20, F.lit(5)), F.lit(95))),
)
#: What the feature functions derive from a column.
FOLLOWERS = {"age_midpoint": ["age_bucket"], "number_inpatient": ["service_utilization", "inpatient_ge_2"]}
SHIFTED_FEATURES = sorted({c for s in SCENARIO for c in (s.column, *FOLLOWERS.get(s.column, []))})


def shifted(df: DataFrame, key: str, shifts: tuple[Shift, ...] = SCENARIO, seed: int = C.SPLIT_SEED) -> DataFrame:
    """A featurized batch under the given shift rules, in one projection; columns derived
    from a shifted one are computed again by the feature functions."""
    types = dict(df.dtypes)

    def after(s: Shift) -> Column:
        new = s.value(F.col(s.column)).cast(types[s.column])
        return new if s.fraction >= 1 else F.when(
            hash_fraction(key, f"{seed}-{s.salt}", s.fraction), new).otherwise(F.col(s.column))

    moved = {s.column: after(s) for s in shifts}
    out = df.withColumns(moved)
    if "number_inpatient" in moved:
        out = add_utilization_features(out)
    return out.withColumn("age_bucket", age_bucket(F.col("age_midpoint"))) if "age_midpoint" in moved else out


def rounded_psi(psis: DataFrame) -> DataFrame:
    return psis.select(*_groups(psis), F.col("column").alias("feature"), round_half_up(F.col("psi"), 4).alias("psi"))
