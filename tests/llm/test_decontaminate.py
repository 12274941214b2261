"""Operator 3: shared windows propose no pairs, documents without an id leave the corpus, and every
benchmark passage that stands in a document is found."""
import re

import numpy as np
import pyarrow.parquet as pq

import corpus_pipeline
from cohort_spark.llm import common, decontaminate

PREAMBLE = "read the whole passage below with care and then choose the one best answer to it"


def made_items(n, seed=0):
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}" for a in ("lor", "mep", "sul", "tir", "vok", "dan") for b in ("a", "en", "ish", "om", "uld", "ry", "est", "ing")]
    return [PREAMBLE + " " + " ".join(rng.choice(words, 20)) for _ in range(n)]


def test_shared_windows_propose_no_pairs(spark, monkeypatch):
    written = {}
    stage = decontaminate.stage

    def counted(df, name, *a):
        out = stage(df, name, *a)
        written[name] = out.count()
        return out

    monkeypatch.setattr(decontaminate, "stage", counted)
    items = made_items(200)
    docs = [(i, PREAMBLE + f" said number {i}") for i in range(300)] + [(1000, "so " + items[7]), (1001, items[9]), (None, items[9])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df, bench).collect()}
    assert got == {(1000, 7), (1001, 9), (None, 9)}
    assert written["bench-candidates"] <= 10 and written["bench-hits"] < len(docs)


def test_documents_without_id_leave_the_pipeline(spark, sf_dir):
    item = common.table(spark, sf_dir, "benchmark").where("length(text) > 80").first()["text"]
    rows = [(None, "a " + item, "en", "s", 1), (None, "nothing of the kind", "en", "s", 1), (None, None, "en", "s", 1), (5, item, "en", "s", 1), (6, "clean words", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {(r["doc_id"], r["text"]) for r in corpus_pipeline.decontamination(spark, df, sf_dir).collect()}
    assert kept == {(None, "nothing of the kind"), (None, None), (6, "clean words")}


def test_every_passage_in_a_document_is_found(spark, sf_dir):
    texts = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    items = pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist()
    plain = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    held = {(d["doc_id"], i["item_id"]) for d in texts for i in items if plain(i["text"]) and plain(i["text"]) in plain(d["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.op3_decontaminate(spark, sf_dir).collect()}
    assert held and held <= got


def test_long_and_repeated_texts(spark):
    item = made_items(1, 3)[0]
    far = "filler words go on and on " * 20000
    rows = [(1, far + item), (2, item), (2, item), (3, far)]
    bench = spark.createDataFrame([(1, item), (1, item), (2, item)], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["kind"]) for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect())
    assert got == [(d, i, "exact") for d in (1, 2) for i in (1, 2)]
