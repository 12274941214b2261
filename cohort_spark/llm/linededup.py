"""Operator 5 (native): line dedup over levelled sorted runs of line hashes.

A line's key is the line without leading and trailing ``[\\x20\\x09-\\x0D]``, A-Z
lower-cased; it stands as two 64-bit hashes.  Documents come in batches, largest
doc_id first.  A run is a table bucketed and sorted by hash, one row per key:
documents that hold it (``n``) and, where the run has the key's first sighting,
the largest such doc_id (``keeper``).

``LineRuns.add`` merge-joins a batch's keys with every run on the shared bucketing
(no shuffle of the runs): keys that the anti join finds in none are new and get
their keeper; then the batch's own run is written to level 0.  ``fanout`` runs of a level are
compacted into one run of the next, so a key is rewritten once per level.
When all batches are in, keys held by ``min_docs`` documents or more are known with
their keeper, and every document loses the lines that are not its to keep.

Results for odd input: null or empty text is one empty line and stays empty; a
null doc_id counts as one document below all others; rows repeating a doc_id
count as one document, and each row keeps or loses lines on its own; an empty
table gives no rows; further columns pass through ``dedup_lines``.
"""
from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, documents, shuffle_width, stage

#: Stands for a null doc_id where documents are told apart.
NO_ID = -(1 << 63)
_H = ["h1", "h2"]


def hash_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc, th (hash of the text), h1, h2, at (places of the line) for every key of at least
    ``min_chars`` code points of every row."""
    lines = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("th"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("at", "line"))
    key = lines.withColumn("line", F.btrim("line", F.lit(BLANKS))).where(F.char_length("line") >= min_chars)
    key = key.withColumn("line", ascii_lower(F.col("line")))
    return key.select("doc", "th", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2"))


class LineRuns:
    """The levelled runs; tables in the shared warehouse."""

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = 2):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[str]] = [[]]

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        rows.repartition(self.buckets, *_H).write.bucketBy(self.buckets, *_H).sortBy(*_H).saveAsTable(name)
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(t) for level in self.levels for t in level]

    def add(self, keys: DataFrame) -> DataFrame:
        """Add a batch's keys (h1, h2, n, last: its largest doc_id); all earlier batches
        hold larger doc_ids.  Returns the batch's run: h1, h2, n, keeper (null: seen before)."""
        fresh = reduce(lambda df, run: df.join(run.select(*_H).hint("merge"), _H, "left_anti"), self.runs(), keys)
        seen = reduce(DataFrame.unionByName, [keys.join(run.select(*_H).hint("merge"), _H, "left_semi") for run in self.runs()]).distinct() if self.runs() else None
        own = fresh.select(*_H, "n", F.col("last").alias("keeper"))
        if seen is not None:
            own = own.unionByName(seen.select(*_H, "n", F.lit(None).cast("long").alias("keeper")))
        name = self._write(own)
        self.levels[0].append(name)
        self._compact()
        return self.spark.table(name) if name in self.levels[0] else None

    def _merged(self, tables: list[str]) -> DataFrame:
        rows = reduce(DataFrame.unionByName, [self.spark.table(t) for t in tables])
        return rows.groupBy(*_H).agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))

    def _compact(self) -> None:
        for k in range(len(self.levels) + 1):
            if k < len(self.levels) and len(self.levels[k]) >= self.fanout:
                if k + 1 == len(self.levels):
                    self.levels.append([])
                old, self.levels[k] = self.levels[k], []
                self.levels[k + 1].append(self._write(self._merged(old)))
                for t in old:
                    self.spark.sql(f"DROP TABLE {t}")

    def index(self) -> DataFrame:
        """h1, h2, n, keeper of every key of all batches."""
        return self._merged([t for level in self.levels for t in level])


def batch_edges(docs: DataFrame, batches: int) -> list[int]:
    """doc_ids that cut the table into about equal batches; a bounded list."""
    probs = [i / batches for i in range(1, batches)]
    got = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), probs, 1000).alias("q")).first()["q"]
    return sorted(set(got or []))


def decisions(docs: DataFrame, min_docs: int, min_chars: int, batches: int, fanout: int, salt: int) -> DataFrame:
    """doc, th, drops (sorted places of the lines to drop) for rows that lose lines."""
    spark = docs.sparkSession
    edges = batch_edges(docs, batches)
    number: Column = reduce(lambda c, e: c + (F.col("doc") > e).cast("int"), edges, F.lit(0))
    lines = stage(hash_lines(docs, min_chars).withColumn("batch", number), "line-hashes", ["batch"])
    runs = LineRuns(spark, shuffle_width(spark), fanout)
    for b in range(len(edges), -1, -1):
        keys = (lines.where(F.col("batch") == b).groupBy(*_H, "doc").agg(F.lit(1).alias("one"))
                .groupBy(*_H).agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("last")))
        runs.add(keys)
    often = runs.index().where(F.col("n") >= min_docs)
    # a key may be held by a third of all rows: its lines are dealt over ``salt`` partitions
    often = often.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    at = lines.withColumn("salt", F.pmod(F.xxhash64("doc", "th", "at"), F.lit(salt)).cast("int"))
    drop = at.join(often.select(*_H, "salt", "keeper"), [*_H, "salt"]).where(F.col("doc") != F.col("keeper"))
    return drop.groupBy("doc", "th").agg(F.array_sort(F.collect_set("at")).alias("drops"))


def dedup_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, batches: int = 4,
                fanout: int = 2, salt: int = 16) -> DataFrame:
    """Every row of ``docs`` with its kept lines as ``text`` (joined by a line feed), and
    n_lines (before), n_dropped.  Keys of at least ``min_chars`` code points held by at
    least ``min_docs`` documents stay only in the largest doc_id that holds them."""
    drops = decisions(docs.select("doc_id", "text"), min_docs, min_chars, batches, fanout, salt)
    rows = docs.withColumns({"__doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "__th": F.xxhash64("text")})
    drops = drops.select(F.col("doc").alias("__doc"), F.col("th").alias("__th"), F.col("drops").alias("__drops"))
    joined = rows.join(drops, ["__doc", "__th"], "left").withColumn("__lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    # what lies between two dropped lines stays: linear in the lines
    kept = F.expr("""flatten(transform(sequence(0, size(__drops)), i -> slice(__lines,
        if(i = 0, 0, __drops[greatest(i - 1, 0)] + 1) + 1,
        if(i = size(__drops), size(__lines), __drops[least(i, size(__drops) - 1)]) - if(i = 0, 0, __drops[greatest(i - 1, 0)] + 1))))""")
    out = joined.withColumns({
        "n_lines": F.size("__lines").cast("long"), "n_dropped": F.coalesce(F.size("__drops"), F.lit(0)).cast("long"),
        "text": F.when(F.col("__drops").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n"))})
    return out.select(*docs.columns, "n_lines", "n_dropped")


def op5_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, lines dropped and SHA-256 of what stays."""
    kept = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM rows),
keys AS (SELECT r, doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
often AS (SELECT k, max(doc_id) AS keeper FROM keys WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keys.*, often.k IS NOT NULL AND doc_id <> keeper AS gone FROM keys LEFT JOIN often USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
