"""Operator 1: toxicity by cumulative-link ordinal regression.

``P(grade <= j) = sigmoid(theta_j - w . x)``: one weight vector shared by all ordered
thresholds ``theta``, over sparse word-presence features.  Fitted in numpy on a bounded
sample of labelled rows (``sample`` rows: a third from the graded, the rest from grade
0, weighted back to the share each has among all labels).  Features are the words of at least
``min_docs`` sampled rows whose score statistic against the grade is significant
(``|z| >= min_z``).  A document's expected severity is ``sum_j j * P(grade = j)``.

``labels`` holds toxic 0/1 only, so the query grades toxic rows by evidence: 1, 2 or 3
by the terciles of how many different marker words (frequent in sampled toxic
rows, a tenth as frequent or less in clean ones) they hold.

Results for odd input: null and empty texts, or texts of unknown words, get the severity
of no evidence; rows with null or other-valued labels are not learned from; repeated
rows are scored each (of repeated labelled rows at most 2 ``sample`` are learned from); a doc_id labelled twice takes its larger label; without both classes
among the labels nothing is rejected (severity 0); an empty table gives no rows; further columns pass through.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, slices, table, tidy, working_for

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    """The different words of a text, lower-cased."""
    return set(WORD.findall(text.lower())) if text else set()


@dataclass
class Ordinal:
    """Shared weights by word, and ordered thresholds."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = (np.inf,)

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """P(grade = j) for scores w . x, one row each."""
        below = 1 / (1 + np.exp(-np.clip(np.array(self.thresholds)[None, :] - score[:, None], -60, 60)))
        below = np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1)
        return np.diff(below, axis=1)

    def score(self, words: set[str]) -> float:
        return math.fsum(self.weights[w] for w in self.weights.keys() & words)  # whatever the set's order


def chosen_features(flat: np.ndarray, of: np.ndarray, names: list[str], grades: np.ndarray, weight: np.ndarray,
                    min_docs: int, min_z: float, most: int) -> list[int]:
    """Words (``flat``, each in row ``of``) whose presence goes with the grade: |z| of the score statistic."""
    centred = grades - np.average(grades, weights=weight)
    n, s = np.bincount(flat, minlength=len(names)), np.bincount(flat, centred[of], len(names))
    z = s / np.sqrt(np.maximum(n, 1) * max(1e-12, float(np.average(centred ** 2, weights=weight))))
    strong = np.flatnonzero((n >= min_docs) & (np.abs(z) >= min_z))
    return sorted(strong.tolist(), key=lambda i: (-abs(z[i]), names[i]))[:most]


def flattened(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All rows' word numbers in turn, and the row of each."""
    return np.concatenate([*rows, np.zeros(0, np.int32)]), np.repeat(np.arange(len(rows)), [len(r) for r in rows])


def fit(rows: list[np.ndarray], names: list[str], grades: list[int], weight: list[float] | None = None, min_docs: int = 8,
        min_z: float = 8.0, most_features: int = 4096, ridge: float = 0.05, steps: int = 500) -> Ordinal:
    """Weighted maximum likelihood with a ridge on the weights, by Adam on the full sample.
    Rows are the numbers of their different words in ``names``."""
    y = np.array(grades)
    k = int(y.max(initial=0))
    if not k or len(set(grades)) < 2:
        return Ordinal()
    own = np.ones(len(y)) if weight is None else np.array(weight)
    flat, rid = flattened(rows)
    chosen = chosen_features(flat, rid, names, y.astype(float), own, min_docs, min_z, most_features)
    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))
    names, flat = [names[i] for i in chosen], place[flat]
    flat, rid = flat[flat >= 0], rid[flat >= 0]
    share = np.array([np.average(y <= j, weights=own) for j in range(k)]).clip(1e-4, 1 - 1e-4)
    start = np.log(share / (1 - share))
    # theta_0, then log gaps: the order holds by construction
    par = np.concatenate([np.zeros(len(names)), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v, total = np.zeros_like(par), np.zeros_like(par), own.sum()
    for step in range(1, steps + 1):
        w, gaps = par[:len(names)], np.exp(par[len(names) + 1:])
        theta = par[len(names)] + np.concatenate([[0.0], np.cumsum(gaps)])
        eta = np.bincount(rid, w[flat], len(rows))
        cdf = 1 / (1 + np.exp(-np.clip(theta[None, :] - eta[:, None], -40, 40)))
        cdf = np.concatenate([np.zeros((len(y), 1)), cdf, np.ones((len(y), 1))], axis=1)
        density = cdf * (1 - cdf)
        i = np.arange(len(y))
        p = np.maximum(cdf[i, y + 1] - cdf[i, y], 1e-12)
        hi, lo = own * density[i, y + 1] / p, own * density[i, y] / p  # of log p by its upper and lower threshold
        g_theta = np.array([hi[y == j].sum() - lo[y == j + 1].sum() for j in range(k)])
        g_w = np.bincount(flat, (lo - hi)[rid], len(names)) - ridge * w
        g = np.concatenate([g_w, [g_theta.sum()], np.cumsum(g_theta[::-1])[::-1][1:] * gaps]) / total
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        par = par + 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    w = par[:len(names)]
    theta = par[len(names)] + np.concatenate([[0.0], np.cumsum(np.exp(par[len(names) + 1:]))])
    return Ordinal({n: float(x) for n, x in zip(names, w)}, tuple(theta.tolist()))


def evidence_grades(rows: list[np.ndarray], names: list[str], toxic: list[int], least: float = 0.02) -> list[int]:
    """Grades 0 .. 3 from 0/1 labels, by different marker words (terciles)."""
    n1, n0 = max(1, sum(toxic)), max(1, len(toxic) - sum(toxic))
    flat, of = flattened(rows)
    one = np.bincount(flat, np.array(toxic, float)[of], len(names))
    zero = np.bincount(flat, minlength=len(names)) - one
    marks = (one >= 2) & (one / n1 >= least) & (zero / n0 <= 0.1 * one / n1)
    held = [int(marks[r].sum()) for r in rows]
    cuts = np.quantile([h for h, t in zip(held, toxic) if t] or [0], [1 / 3, 2 / 3])
    return [1 + int((h > cuts).sum()) if t else 0 for h, t in zip(held, toxic)]


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[list[np.ndarray], list[str], list[int], list[float]]:
    """Numbers of their different words, the words, 0/1 labels and weights of at most ``sample`` labelled rows."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = {1: sample // 3, 0: sample - sample // 3}
    pick = [known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(share[t]) for t in (0, 1)]
    few = F.broadcast(pick[0].unionByName(pick[1]))  # at most ``sample`` rows

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            yield pa.RecordBatch.from_pydict({
                "toxic": batch.column("toxic").cast(pa.int64()), "words": [" ".join(sorted(words_of(t.as_py()))) for t in batch.column("text")]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(few, "doc_id").select("toxic", "text")
    # a labelled doc_id may repeat without end: no more than 2 * sample of its rows, by hash
    got = rows.mapInArrow(tidy(words), "toxic long, words string").orderBy(F.xxhash64("words"), "words", "toxic").limit(2 * sample).collect()
    at: dict[str, int] = {}
    rows = [np.array([at.setdefault(w, len(at)) for w in r["words"].split()], np.int32) for r in got]
    toxic = [r["toxic"] for r in got]
    n = Counter(toxic)
    weight = [counts[t] / n[t] for t in toxic]
    scale = len(weight) / sum(weight) if weight else 1
    return rows, list(at), toxic, [w * scale for w in weight]


def train(docs: DataFrame, labels: DataFrame, sample: int = 6000) -> Ordinal:
    rows, names, toxic, weight = labelled_sample(docs, labels, sample)
    return fit(rows, names, evidence_grades(rows, names, toxic), weight) if len(set(toxic)) == 2 else Ordinal()


def score(docs: DataFrame, model: Ordinal, cut: float = 0.5) -> DataFrame:
    """``docs`` with severity (expected grade), p_toxic = P(grade >= 1), grade (the likeliest)
    and rejected (p_toxic >= ``cut``)."""

    @F.pandas_udf("severity double, p_toxic double, grade int")
    def graded(texts):
        import pandas as pd

        p = model.probabilities(np.array([model.score(words_of(t)) for t in texts], dtype=float))
        del texts
        working_for(trim=True)
        return pd.DataFrame({"severity": p @ np.arange(p.shape[1]), "p_toxic": 1 - p[:, 0], "grade": p.argmax(axis=1).astype("int32")})

    out = docs.withColumn("__grade", graded(F.col("text").cast("string")))
    return out.select(*[c for c in docs.columns if c not in ("severity", "p_toxic", "grade", "rejected")],
                      "__grade.severity", "__grade.p_toxic", "__grade.grade", (F.col("__grade.p_toxic") >= cut).alias("rejected"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, learned from ``labels``."""
    docs = documents(spark, sf_dir)
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select("doc_id", "severity", "p_toxic", "grade", "rejected")
