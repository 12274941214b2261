"""Operator 7: language by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of each run of letters and their combining marks (longer ones in
pieces of ``PIECE`` bytes, cut between characters, none dropped) forward and backward and labels every position; a
document's probabilities are the mean of its positions' over the whole text.  As
the state starts anew at every run, a run met again has the same labels: each worker keeps a
bounded table of their sums.  Trained in numpy by backpropagation through time with Adam
on a bounded sample: the first ``per_lang`` documents of each language by hash.

Results for odd input: null texts and texts without a letter give ``und`` with score 0; rows with
null lang are not learned from but labelled; rows with null doc_id are neither learned
from nor held out; ties go to the first language in order; without any labelled
document all is ``und``; repeated rows are each labelled; an empty table gives no rows; further
columns are ignored.
"""
from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents

PIECE = 24
MAX_KNOWN = 200_000


@lru_cache(maxsize=1)
def letters() -> re.Pattern:
    """Runs of letters with their combining marks; fractions, numerals and the like are none,
    though they are word characters of regular expressions."""
    def ranges(kinds: str, low: int, high: int) -> str:
        points = np.array([c for c in range(low, high) if unicodedata.category(chr(c))[0] in kinds])
        return "".join(f"{chr(r[0])}-{chr(r[-1])}" for r in np.split(points, np.flatnonzero(np.diff(points) > 1) + 1))

    # characters of the first plane are looked up in one table; the ranges beyond are tried there only
    near, more = ranges("L", 0, 0x10000), ranges("LM", 0, 0x10000)
    return re.compile(rf"(?:[{near}][{more}]*|(?=[\U00010000-\U0010ffff])[{ranges('L', 0x10000, 0x110000)}]+)+")


def pieces(run: str) -> list[bytes]:
    """The run's bytes in pieces of ``PIECE`` at most, cut between characters."""
    raw, out, at = run.encode("utf-8", "replace"), [], 0
    while at < len(raw):
        end = min(at + PIECE, len(raw))
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        out.append(raw[at:end])
        at = end
    return out


def padded(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (rows x longest) and which places are real."""
    n = np.array([len(r) for r in raw])
    out = np.zeros((len(raw), int(n.max())), dtype=np.int64)
    mask = np.arange(out.shape[1])[None, :] < n[:, None]
    out[mask] = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return out, mask


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class BiGru:
    """Weights by name: per direction ``x`` (256 x 3h: bytes' part of update, reset and candidate
    gates), ``u`` (h x 2h), ``c`` (h x h); ``out`` (2h x languages) and ``bias``."""

    def __init__(self, langs: list[str], hidden: int = 16, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.langs, self.h = langs, hidden
        self.w = {}
        for d in "fb":
            self.w[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * hidden))
            self.w[f"u{d}"] = rng.normal(0, hidden ** -0.5, (hidden, 2 * hidden))
            self.w[f"c{d}"] = rng.normal(0, hidden ** -0.5, (hidden, hidden))
        self.w["out"] = rng.normal(0, 0.2, (2 * hidden, len(langs)))
        self.w["bias"] = np.zeros(len(langs))
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States at every place (rows x places x h); places past a row's end leave its state."""
        n, t = x.shape
        h = np.zeros((n, self.h), dtype=np.float32)
        out = np.zeros((n, t, self.h), dtype=np.float32)
        for k in (range(t) if d == "f" else range(t - 1, -1, -1)):
            gx, on = self.w[f"x{d}"][x[:, k]], mask[:, k:k + 1]
            zr = sigmoid(gx[:, :2 * self.h] + h @ self.w[f"u{d}"])
            z, r = zr[:, :self.h], zr[:, self.h:]
            rh = r * h
            c = np.tanh(gx[:, 2 * self.h:] + rh @ self.w[f"c{d}"])
            new = np.where(on, z * h + (1 - z) * c, h)
            if keep is not None:
                keep.append((k, h, z, r, rh, c, on))
            h = out[:, k] = new
        return out

    def positions(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Language probabilities of every place."""
        runs = {d: [] if keep is not None else None for d in "fb"}
        both = np.concatenate([self._run(d, x, mask, runs[d]) for d in "fb"], axis=2)
        logits = both @ self.w["out"] + self.w["bias"]
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        if keep is not None:
            keep.update(runs, both=both)
        return p

    def gradient(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of all real places, and its gradient through time."""
        keep: dict = {}
        p = self.positions(x, mask, keep)
        n, t = x.shape
        real = mask.sum()
        mine = np.take_along_axis(p, np.broadcast_to(y[:, None, None], (n, t, 1)), axis=2)[..., 0]
        loss = -float((np.log(np.maximum(mine, 1e-12)) * mask).sum() / real)
        dl = p.copy()
        dl[np.arange(n)[:, None], np.arange(t)[None, :], y[:, None]] -= 1
        dl *= (mask / real)[..., None].astype(np.float32)
        both = keep["both"]
        g = {"out": both.reshape(-1, 2 * self.h).T @ dl.reshape(-1, dl.shape[2]), "bias": dl.sum(axis=(0, 1))}
        dboth = dl @ self.w["out"].T
        for i, d in enumerate("fb"):
            dh_out = dboth[:, :, i * self.h:(i + 1) * self.h]
            gx, gu, gc = np.zeros_like(self.w[f"x{d}"]), np.zeros_like(self.w[f"u{d}"]), np.zeros_like(self.w[f"c{d}"])
            carry = np.zeros((n, self.h), dtype=np.float32)
            for k, h, z, r, rh, c, on in reversed(keep[d]):
                dh = carry + dh_out[:, k]
                live = dh * on
                dc = live * (1 - z) * (1 - c * c)
                drh = dc @ self.w[f"c{d}"].T
                dz, dr = live * (h - c) * z * (1 - z), drh * h * r * (1 - r)
                dzr = np.concatenate([dz, dr], axis=1)
                np.add.at(gx, x[:, k], np.concatenate([dzr, dc], axis=1))
                gu += h.T @ dzr
                gc += rh.T @ dc
                carry = dh * ~on + live * z + drh * r + dzr @ self.w[f"u{d}"].T
            g |= {f"x{d}": gx, f"u{d}": gu, f"c{d}": gc}
        return loss, g

    def train(self, runs: list[bytes], y: np.ndarray, weight: np.ndarray, steps: int = 600, batch: int = 256,
              rate: float = 0.01, seed: int = 5) -> list[float]:
        """Adam over batches drawn by weight; returns the losses."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        p, losses = weight / weight.sum(), []
        for step in range(1, steps + 1):
            pick = rng.choice(len(runs), batch, p=p)
            x, mask = padded([runs[i] for i in pick])
            loss, g = self.gradient(x, mask, y[pick])
            losses.append(loss)
            for k in self.w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v2[k] = 0.999 * v2[k] + 0.001 * g[k] ** 2
                self.w[k] = self.w[k] - (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return losses

    def sums(self, runs: list[str], step: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Per run of letters: its positions' probabilities added up, and how many positions."""
        parts, of = [], []
        for i, run in enumerate(runs):
            for raw in pieces(run):
                parts.append(raw)
                of.append(i)
        total, count = np.zeros((len(runs), len(self.langs))), np.zeros(len(runs))
        order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
        for at in range(0, len(order), step):
            own = order[at:at + step]
            x, mask = padded([parts[i] for i in own])
            p = self.positions(x, mask) * mask[..., None]
            rows = np.array([of[i] for i in own])
            np.add.at(total, rows, p.sum(axis=1))
            np.add.at(count, rows, mask.sum(axis=1))
        return total, count


class Labeller:
    """Document probabilities, with a bounded table of runs already read."""

    def __init__(self, net: BiGru):
        self.net, self.row = net, {}
        self.total, self.count = np.zeros((0, len(net.langs))), np.zeros(0)

    def document_probabilities(self, texts: list[str | None]) -> Iterator[np.ndarray | None]:
        if len(self.row) > MAX_KNOWN:
            self.__init__(self.net)
        found = [letters().findall(t) if t else [] for t in texts]
        new = list(dict.fromkeys(w for ws in found for w in ws if w not in self.row))
        if new:
            total, count = self.net.sums(new)
            self.row.update(zip(new, range(len(self.row), len(self.row) + len(new))))
            self.total, self.count = np.concatenate([self.total, total]), np.concatenate([self.count, count])
        for ws in found:
            if not ws:
                yield None
                continue
            at = np.array([self.row[w] for w in ws])
            yield self.total[at].sum(axis=0) / self.count[at].sum()


def held_out() -> Column:
    """crc32 of the doc_id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, per_lang: int = 250, hidden: int = 16, steps: int = 600) -> BiGru | None:
    """Fit on at most ``per_lang`` documents of each language, none of them held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    may = rows.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = may.select("doc_id", "lang").withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_lang).select("doc_id", "lang")
    # at most per_lang rows of each language
    few = may.join(F.broadcast(ids.distinct()), ["doc_id", "lang"]).where(F.col("text").isNotNull()).select("lang", "text").collect()
    langs = sorted({r["lang"] for r in few})
    if not langs:
        return None
    seen: Counter = Counter()
    size: Counter = Counter()
    for r in sorted(few, key=lambda r: (r["lang"], r["text"])):
        for run, n in Counter(letters().findall(r["text"])).items():
            for raw in pieces(run):
                seen[raw, r["lang"]] += n
                size[r["lang"]] += n
    if not seen:
        return None
    net = BiGru(langs, hidden)
    if len(langs) > 1:
        keys = list(seen)
        weight = np.array([seen[k] ** 0.5 for k in keys])
        share = Counter()
        for k, w in zip(keys, weight):
            share[k[1]] += w
        net.train([k[0] for k in keys], np.array([langs.index(k[1]) for k in keys]),
                  np.array([w / share[k[1]] for k, w in zip(keys, weight)]), steps)
    return net


def predict(docs: DataFrame, net: BiGru | None) -> DataFrame:
    """doc_id, lang_pred and score of every row; reads the text alone."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Labeller(net) if net else None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column("text").to_pylist()
                p = list(known.document_probabilities(texts)) if known else [None] * len(texts)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "lang_pred": ["und" if x is None else net.langs[int(x.argmax())] for x in p],
                    "score": [0.0 if x is None else min(1.0, float(x.max())) for x in p]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(label, "doc_id long, lang_pred string, score double")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    docs = documents(spark, sf_dir)
    return predict(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
