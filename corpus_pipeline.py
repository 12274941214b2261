"""Corpus pipeline: toxicity filter, line dedup, near-duplicate removal, benchmark
decontamination and packing, each written as Parquet and read again by the next.

Every stage takes the documents that its predecessor kept; all but the last return the
columns of ``documents``.  Rows with null doc_id stay unless a stage rejects their own
text; null texts pass as empty from the line stage on; rows repeating doc_id and text
are one document of a near-duplicate group; an empty table passes through empty.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohort_spark.llm.common import documents, shared_path, table
from cohort_spark.llm.decontaminate import contaminated
from cohort_spark.llm.linededup import dedup_lines
from cohort_spark.llm.packing import pack, pieces_with_crc
from cohort_spark.llm.prefixes import join_components
from cohort_spark.llm.toxicity import score, train

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents whose grade is likelier above 0 than 0 go."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).where(~F.col("rejected")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: lines of 40 characters or more that five documents hold stay in one."""
    return dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each component (5-word shingles, similarity 0.8) the smallest doc_id stays."""
    found = join_components(docs, size=5, percent=80, stars=1)
    keeps = F.max((F.col("doc_id") == F.col("component_id")).cast("int"))
    losers = found.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(keeps.alias("keeps")).where("keeps = 0").select("doc_id")
    kept = docs.join(losers, "doc_id", "left_anti")
    same = Window.partitionBy("doc_id", "text").orderBy("source", "lang", "n_chars")
    return kept.withColumn("row", F.row_number().over(same)).where("row = 1").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold a benchmark item go, those without a doc_id by their text."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    named = found.where("doc_id IS NOT NULL").select("doc_id").distinct()
    nameless = found.where("doc_id IS NULL").select(F.col("text_hash").alias("__hash")).distinct()
    mine = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    return docs.join(named, "doc_id", "left_anti").join(nameless, mine == F.col("__hash"), "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: what is left, in sequences of at most 1024 ids; executors are full after four
    stages, so its workers remember fewer chunks."""
    return pieces_with_crc(pack(docs, table=300_000))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", packing)]

#: Model fitting and tokenising have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
