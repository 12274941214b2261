"""Named jobs over the driver tables: one entry per operator of the survey.

Each job takes ``(spark, sf_dir)`` and returns a DataFrame whose columns are
aliased to stable names.  Inputs are the driver tables or the encounter view
Spark derives from them, so every job's work grows with the tables.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import engineer_features, order_keys_first, round_half_up, wilson_ci
from ..functions.icd9 import bucket_icd9
from ..operators import clean as CL
from ..sources import encounter_facts, encounter_rows
from ..session import materialize
from ..sources.readers import apply_missing_mode

Job = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Job] = {}


def register(name: str):
    def deco(fn: Job) -> Job:
        QUERIES[name] = fn
        return fn
    return deco


R6 = lambda c: round_half_up(c, 6)  # noqa: E731  stable 6-decimal output


_PLANS: dict = {}


def memo_plan(fn):
    """Reuse a derived plan (a DataFrame object: a lazy plan, not cached data)
    per session and arguments, so jobs that share a view build it once."""
    def wrapper(spark: SparkSession, sf_dir: str, *args):
        key = (fn.__name__, spark.sparkContext.applicationId, sf_dir.rstrip("/"), args)
        if key not in _PLANS:
            _PLANS[key] = fn(spark, sf_dir, *args)
        return _PLANS[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


@memo_plan
def encounter_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encounter view derived from ``orders`` + ``lineitem``: its joined facts are written once
    per session, its columns computed from them where they are read.  A patient's rows lie together
    (a hot patient's are split), so the dedup combines them before its shuffle at any size."""
    facts = encounter_facts(spark, sf_dir).hint("rebalance", "p")
    return encounter_rows(materialize(facts, "encounter-facts"))


@memo_plan
def encounter_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encounter view with all its columns, written once per session as a Parquet table (the
    raw stage that the jobs on raw rows read)."""
    return materialize(encounter_view(spark, sf_dir), "encounters")


@memo_plan
def raw(spark: SparkSession, sf_dir: str, mode: str = "pipeline") -> DataFrame:
    """Encounter table in a missing mode (literal / pipeline / eda)."""
    return apply_missing_mode(encounter_table(spark, sf_dir), mode)


@memo_plan
def clean_scored(spark: SparkSession, sf_dir: str, dedup: str = "coalesce") -> DataFrame:
    """Clean stage (filters, first-encounter dedup, fills, target) carrying the
    encounter's ``score``; written once as a Parquet table like the
    pipeline's clean stage."""
    rows = apply_missing_mode(encounter_view(spark, sf_dir), "pipeline")
    return materialize(CL.clean(rows, dedup), f"clean-{dedup}")


@memo_plan
def cleaned(spark: SparkSession, sf_dir: str, dedup: str = "coalesce") -> DataFrame:
    """The 47-column clean table (a projection of the written clean stage)."""
    return clean_scored(spark, sf_dir, dedup).drop("score")


@memo_plan
def features_scored(spark: SparkSession, sf_dir: str, dedup: str = "coalesce") -> DataFrame:
    """Clean -> engineer features -> keys first, target last, plus ``score``;
    written once as a Parquet table like the pipeline's feature stage."""
    return materialize(order_keys_first(engineer_features(clean_scored(spark, sf_dir, dedup))),
                       f"features-{dedup}")


@memo_plan
def featurized(spark: SparkSession, sf_dir: str, dedup: str = "coalesce") -> DataFrame:
    """The 58-column feature table (a projection of the written feature stage)."""
    return features_scored(spark, sf_dir, dedup).drop("score")


# ====================================================================== flagship
@register("flagship_diag_rates")
def flagship_diag_rates(spark, sf_dir):
    """Readmission rate with Wilson CI per primary-diagnosis bucket, on the
    cleaned (filtered + first-encounter) cohort."""
    df = cleaned(spark, sf_dir).select(bucket_icd9(F.col("diag_1")).alias("bucket"),
                                       F.col(C.TARGET))
    agg = df.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"),
                                   F.sum(F.col(C.TARGET).cast("long")).alias("positives"))
    lo, hi = wilson_ci(F.col("positives"), F.col("n"))
    return agg.select("bucket", "n", "positives",
                      R6(F.col("positives") / F.col("n")).alias("rate"),
                      R6(lo).alias("ci_low"), R6(hi).alias("ci_high"))


# Job modules register themselves on import.
from . import jobs_core  # noqa: E402,F401
from . import jobs_profile  # noqa: E402,F401
from . import jobs_eval  # noqa: E402,F401
from . import jobs_drift  # noqa: E402,F401
from . import jobs_models  # noqa: E402,F401
from . import jobs_stream  # noqa: E402,F401
