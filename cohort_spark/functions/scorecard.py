"""A logistic scorecard as a Column expression: what a monitored batch is scored with, again after
every change to it.  Any function that adds ``prediction`` to a frame will do instead
(``model_scorer`` wraps a fitted pipeline); the registered monitoring jobs take the fixed
scorecard below, so that SQL can follow them."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import round_half_up

Scorer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Scorecard:
    """Log odds: ``intercept`` + points per unit of a number + points of a (column, level).
    A null number or level adds nothing."""

    intercept: float
    numbers: dict[str, float]
    levels: dict[tuple[str, str], float]

    def log_odds(self) -> Column:
        terms = [F.lit(points) * F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c, points in self.numbers.items()]
        terms += [F.when(F.col(c) == level, points).otherwise(0.0) for (c, level), points in self.levels.items()]
        return reduce(lambda a, b: a + b, terms, F.lit(self.intercept))

    def __call__(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``, to six decimals."""
        return df.withColumn("prediction", round_half_up(F.lit(1.0) / (F.lit(1.0) + F.exp(-self.log_odds())), 6))


#: The registered monitoring jobs' scorer (fixed values of this library).
MONITORED = Scorecard(
    -3.0, {"number_inpatient": 0.35, "age_midpoint": 0.01, "time_in_hospital": 0.03, "n_meds_used": 0.05},
    {("admission_type_grp", "Emergency"): 0.2, ("diag_1_bucket", "Circulatory"): 0.25})


def model_scorer(model) -> Scorer:
    """A fitted Spark ML pipeline as a scorer."""
    from pyspark.ml.functions import vector_to_array

    def score(df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c != "prediction"]
        out = model.transform(df.select(*[F.col(f"`{c}`") for c in kept]))
        return out.select(*[F.col(f"`{c}`") for c in kept], vector_to_array("probability")[1].alias("prediction"))

    return score
