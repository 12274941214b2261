"""Exact SHAP contributions of a boosted model on its log-odds margin (path-dependent: a feature that
is left out follows both branches, by the weight of the training rows that took them).

A leaf whose path tests d features adds to a row what depends only on which of the d the row
satisfies, so each leaf gets a table of 2**d rows that the rows are looked up in.  The trees are
bounded by the model; rows are worked on where they lie.
"""
from __future__ import annotations

import sys
from math import factorial

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import remove_folder, shared_folder

# workers get the code below with their task: they need not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def trees_of(model: PipelineModel, spark) -> list[dict]:
    """Per tree its nodes by id: (prediction, weight of training rows, left, right, split)."""
    path = shared_folder(spark, "trees")
    last = model.stages[-1]
    last.write().save(path)
    n = F.col("nodeData")
    rows = spark.read.parquet(f"{path}/data").select("treeID", n["id"].alias("id"), n["prediction"].alias("p"), n["impurityStats"][0].alias("w"),
                                                     n["leftChild"].alias("l"), n["rightChild"].alias("r"), n["split"].alias("s")).collect()
    remove_folder(spark, path)
    weights = list(last.treeWeights)
    trees: list[dict] = [{} for _ in weights]
    for r in rows:
        split = None if r.l < 0 else (r.s.featureIndex, r.s.numCategories >= 0, list(r.s.leftCategoriesOrThreshold))
        # the margin is half the log-odds
        trees[r.treeID][r.id] = (2.0 * weights[r.treeID] * r.p, r.w, r.l, r.r, split)
    return trees


def leaves_of(tree: dict) -> list[tuple]:
    """Per leaf: (value, {feature: share of rows that follow its tests}, {feature: [(node, goes left)]})."""
    out, todo = [], [(0, {}, {})]
    while todo:
        i, share, tests = todo.pop()
        value, weight, left, right, split = tree[i]
        if split is None:
            out.append((value, share, tests))
            continue
        f = split[0]
        for child, goes in ((left, True), (right, False)):
            part = tree[child][1] / weight if weight else 0.0
            todo.append((child, {**share, f: share.get(f, 1.0) * part}, {**tests, f: [*tests.get(f, []), (i, goes)]}))
    return out


def _tables(values: np.ndarray, z: np.ndarray) -> np.ndarray:
    """(leaves, 2**d, d) contributions of leaves with d features of shares ``z`` (leaves, d)."""
    n, d = z.shape
    held = (np.arange(2 ** d)[:, None] >> np.arange(d)) & 1
    size = np.array([factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)])
    out = np.empty((n, 2 ** d, d))
    for i in range(d):
        poly = np.zeros((n, 2 ** d, d))  # by the number of held features in a subset without i
        poly[:, :, 0] = 1.0
        for j in range(d):
            if j != i:
                more = poly * z[:, j][:, None, None]
                more[:, :, 1:] += poly[:, :, :-1] * held[:, j][None, :, None]
                poly = more
        out[:, :, i] = values[:, None] * (held[:, i][None, :] - z[:, i][:, None]) * (poly @ size)
    return out


class Explainer:
    """Contributions (rows, features) of rows given as a matrix of feature values."""

    def __init__(self, trees: list[dict]):
        self.trees = []
        for tree in trees:
            by_d: dict[int, list] = {}
            for value, share, tests in leaves_of(tree):
                if share:
                    by_d.setdefault(len(share), []).append((value, list(share), [share[f] for f in share], [tests[f] for f in share]))
            groups = [(_tables(np.array([x[0] for x in ls]), np.array([x[2] for x in ls])), [(x[1], x[3]) for x in ls]) for ls in by_d.values()]
            self.trees.append(({i: node[4] for i, node in tree.items() if node[4]}, groups))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(x.shape)
        for splits, groups in self.trees:
            left = {i: np.isin(x[:, f], at) if by_level else x[:, f] <= at[0] for i, (f, by_level, at) in splits.items()}
            for tables, leaves in groups:
                for table, (features, tests) in zip(tables, leaves):
                    mask = np.zeros(len(x), dtype=np.int64)
                    for bit, conditions in enumerate(tests):
                        holds = np.ones(len(x), dtype=bool)
                        for node, goes in conditions:
                            holds &= left[node] == goes
                        mask |= holds.astype(np.int64) << bit
                    out[:, features] += table[mask]
        return out


def mean_abs(model: PipelineModel, rows: DataFrame, features: list[str]) -> DataFrame:
    """feature, mean_abs_shap over ``rows`` (raw, or scored by ``model``), one row per slot of its vector."""
    trees = trees_of(model, rows.sparkSession)
    scored = rows if "features" in rows.columns else model.transform(rows)

    def sums(batches):
        explain = Explainer(trees)
        for batch in batches:
            if len(batch):
                got = np.abs(explain(np.stack(batch["x"].to_numpy()))).sum(axis=0)
                yield pd.DataFrame({"slot": np.arange(len(got), dtype=np.int32), "total": got, "n": len(batch)})

    parts = scored.select(vector_to_array("features").alias("x")).mapInPandas(sums, "slot int, total double, n long")
    means = parts.groupBy("slot").agg((F.sum("total") / F.sum("n")).alias("mean_abs_shap"))
    names = rows.sparkSession.createDataFrame(list(enumerate(features)), "slot int, feature string")
    return names.join(F.broadcast(means), "slot", "left").select("feature", "mean_abs_shap")
