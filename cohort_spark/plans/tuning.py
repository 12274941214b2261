"""Hyper-parameter search over both model families with shared folds (M6, M7).

Trials are drawn from continuous, logarithmic, integer and choice spaces by a hash of (seed,
family, trial, parameter), so any trial's parameters can be told without running the others, in
Python or SQL (``draw``).  A trial's objective is the mean of its folds' average precision; the
best trial of a family is refitted on all training rows and scores the test rows once.

``TRIALS``, ``TREES`` and the iterations of ``models.build_lr`` are what a full search takes; a
caller may ask for fewer.
"""
from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import metrics as M
from . import models as ML

#: Trials of a full search, by family, and trees of a boosted model.
TRIALS, TREES = {"lr": 50, "gbt": 40}, 500


def draw(seed: int, family: str, trial: int, name: str) -> float:
    """In [0, 1): the first 48 bits of md5('seed:family:trial:name')."""
    return int(hashlib.md5(f"{seed}:{family}:{trial}:{name}".encode()).hexdigest()[:12], 16) / 2 ** 48


@dataclass(frozen=True)
class Real:
    low: float
    high: float
    log: bool = False

    def at(self, u: float) -> float:
        if self.log:
            return math.exp(math.log(self.low) + u * (math.log(self.high) - math.log(self.low)))
        return self.low + u * (self.high - self.low)


@dataclass(frozen=True)
class Whole:
    low: int
    high: int

    def at(self, u: float) -> int:
        return self.low + int(u * (self.high - self.low + 1))


@dataclass(frozen=True)
class Choice:
    values: tuple

    def at(self, u: float):
        return self.values[int(u * len(self.values))]


@dataclass(frozen=True)
class Family:
    """A parameter space, what builds a pipeline from a draw: (cat, num, rows, params), and what
    encodes the rows of all trials and folds for it: (cat, num)."""

    name: str
    space: dict
    build: Callable[[list[str], list[str], int, dict], Pipeline]
    encoder: Callable[[list[str], list[str]], Pipeline] | None = None

    def params(self, trial: int, seed: int) -> dict:
        return {name: one.at(draw(seed, self.name, trial, name)) for name, one in self.space.items()}


def _lr(cat: list[str], num: list[str], n: int, p: dict) -> Pipeline:
    mix = {"l2": 0.0, "l1": 1.0}.get(p["penalty"], p["l1_ratio"])
    return ML.lr_on_encoded(cat, reg=ML.lr_penalty(n, p["c"]), elastic_net=mix, weight_col=None if p["weights"] == "none" else "weight", max_iter=1000, tol=1e-2)


def _gbt(cat: list[str], num: list[str], n: int, p: dict) -> Pipeline:
    return ML.gbt_on_encoded(max_iter=p["trees"], depth=p["depth"], step=p["step"], max_bins=p["bins"], subsample=p["subsample"])


LR = Family("lr", {"c": Real(1e-3, 1e2, log=True), "penalty": Choice(("l1", "l2", "elasticnet")), "l1_ratio": Real(0.0, 1.0),
                   "weights": Choice(("balanced", "none"))}, _lr, ML.lr_encoder)
GBT = Family("gbt", {"depth": Whole(4, 8), "step": Real(0.01, 0.3, log=True), "bins": Whole(128, 255), "subsample": Real(0.5, 1.0),
                     "weights": Choice(("balanced", "sqrt_balanced"))}, _gbt, ML.gbt_encoder)


def weighting(p: dict) -> str:
    return "balanced" if p["weights"] == "none" else p["weights"]


def search(family: Family, train: DataFrame, test: DataFrame, cat: list[str], num: list[str], trials: int | None = None,
           trees: int = TREES, seed: int = C.SPLIT_SEED, k: int = C.N_FOLDS) -> DataFrame:
    """One row a trial: family, trial, params (JSON), cv_ap, cv_auc, best; for the best also
    test_ap, test_auc and tripwire_ok.  ``train`` has folds and should be written already."""
    n = train.count()
    if family.encoder:
        encoder = family.encoder(cat, num).fit(train)
        train, test = ML.encoded(encoder, train), ML.encoded(encoder, test)
    rows = []
    for trial in range(TRIALS[family.name] if trials is None else trials):
        p = family.params(trial, seed) | ({"trees": trees} if family is GBT else {})
        folds = []
        for j in range(k):
            model = ML.fit_weighted(family.build(cat, num, n * (k - 1) // k, p), train.where(F.col("fold") != j), weighting(p))
            held = ML.positive_probability(model.transform(train.where(F.col("fold") == j)))
            folds.append(M.ranking_metrics(held, C.TARGET, "prediction").first())  # one row
        mean = [sum(f[c] or 0.0 for f in folds) / k for c in ("average_precision", "roc_auc")]
        rows.append((family.name, trial, p, *mean))
    best = max(rows, key=lambda r: (r[3], -r[1]))
    model = ML.fit_weighted(family.build(cat, num, n, best[2]), train, weighting(best[2]))
    final = M.ranking_metrics(ML.positive_probability(model.transform(test)), C.TARGET, "prediction").first()
    out = [(f, t, json.dumps(p, sort_keys=True), ap, auc, t == best[1], *((final["average_precision"], final["roc_auc"], final["roc_auc"] <= C.LEAKAGE_AUC)
                                                                           if t == best[1] else (None, None, None))) for f, t, p, ap, auc in rows]
    return train.sparkSession.createDataFrame(
        out, "family string, trial int, params string, cv_ap double, cv_auc double, best boolean, test_ap double, test_auc double, tripwire_ok boolean")
