"""Nulls, ties, repeated rows, empty tables, long texts and clashing column names."""
import zlib

import numpy as np

import corpus_pipeline
from cohort_spark.llm import jaccard, langid, rabitq, tokens, toxicity, warc

CLASH = "doc_id long, text string, lang string, lang_pred string, score string, held_out int, `key` string, h int, n int, c int, low int, severity string, rejected int, grade string"


def clash(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", "x", 1, "x", 1, 1, 1, 1, "x", 1, "x") for i, t, g in rows], CLASH)


def test_letters_are_letters():
    assert [langid.letters().findall(t) for t in ("½ ² Ⅷ ① 12 _", "हिन्दी", "été x2")] == [[], ["हिन्दी"], ["été", "x"]]
    for run in ("é" * 40, "日本語" * 20, "a" * 100):
        cut = langid.pieces(run)
        assert b"".join(cut).decode() == run and all(len(p) <= langid.PIECE and p.decode() for p in cut)


def test_language_odd_input(spark):
    texts = {"en": "the house is on the hill and they see it", "de": "das haus steht auf dem berg und sie sehen es"}
    rows = [(i, texts[g], g) for i in range(0, 60) for g in [("en", "de")[i % 2]]]
    odd = [(100, None, "en"), (101, "", None), (102, "½ ² 12 !", "en"), (None, texts["de"], None), (103, texts["en"], None), (103, texts["en"], None), (104, texts["de"] * 4000, None)]
    docs = clash(spark, rows + odd)
    net = langid.train(docs, per_lang=20, hidden=8, steps=150)
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(docs, net).collect()]
    assert len(got) == len(rows) + len(odd)
    by = {}
    for i, lang, s in got:
        by.setdefault(i, set()).add((lang, round(s, 6)))
    assert all(by[i] == {("und", 0.0)} for i in (100, 101, 102)) and len(by[103]) == 1
    assert {next(iter(by[i]))[0] for i in (103,)} == {"en"} and {next(iter(by[i]))[0] for i in (104, None)} == {"de"}
    assert langid.predict(clash(spark, []), net).count() == 0 and langid.train(clash(spark, [])) is None
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}
    held = {r["doc_id"]: r["h2"] for r in docs.select("doc_id", langid.held_out().alias("h2")).collect()}
    assert all(held[i] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(60)) and held[None] is False


def test_jaccard_odd_input(spark):
    assert jaccard.join_components(clash(spark, [])).count() == 0
    rows = [(1, "a b c d e f", "x"), (2, "a b c d e f", None), (2, "a b c d e f", None), (3, None, None), (4, "", None), (5, "only two", None), (6, "ONLY  two", None), (None, "a b c d e f", None)]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join_components(clash(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 4, 1), (2, 4, 1), (2, 4, 1), (3, 0, 3), (4, 0, 4), (5, 1, 5), (6, 1, 5), (None, 4, 1)], key=str)


def test_search_with_clashing_columns(spark):
    rng = np.random.default_rng(2)
    rows = [(i, list(map(float, rng.standard_normal(4))), 1, "c", 0.5, "q") for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, cell string, score double, rep string")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in rabitq.search(df, k=3, every=20).collect()}
    x = np.array([r[1] for r in rows])
    for q in (0, 20, 40):
        s = x @ x[q]
        s[q] = -np.inf
        assert [got[q, r] for r in (1, 2, 3)] == np.lexsort((np.arange(50), -s))[:3].tolist()


def test_warc_repeated_ids_and_long_payload(spark, tmp_path):
    long = "<p>" + "x" * 3_000_000
    rows = [(1, "http://a/", "s" * 1200), (1, "http://a/", "s" * 1200), (2, "http://b/", "s" * 1200), (3, None, long), (4, "http://c/", None)]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, record_type int, refers_to string")
    assert warc.write_warc(pages, f"{tmp_path}/w") >= 1
    out = warc.read_warc(spark, f"{tmp_path}/w")
    got = sorted(r["type"] if "type" in out.columns else r["record_type"] for r in out.collect())
    assert len(got) == len(rows) and got.count("revisit") == 2 and got.count("response") == 3


def test_toxicity_long_and_repeated_rows(spark):
    docs = [(i, "vile awful slur " * 3 if i % 3 == 0 else "calm kind words here", None) for i in range(90)]
    docs += [(0, "vile awful slur " * 3, None)] * 3 + [(500, "calm kind words here " * 30000 + " vile awful slur", None), (501, None, None)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    df = clash(spark, docs)
    scored = toxicity.score(df, toxicity.train(df, labels))
    rows = scored.collect()
    assert len(rows) == len(docs) and scored.columns.count("severity") == 1
    assert all(r["rejected"] == (r["doc_id"] % 3 == 0) for r in rows if r["doc_id"] < 90)
    assert len({r["severity"] for r in rows if r["doc_id"] == 0}) == 1 and not [r for r in rows if r["doc_id"] == 501][0]["rejected"]


def test_pipeline_odd_input(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    filler = "this line is long enough to be counted as a line that repeats often\n"
    rows = [(i, filler + f"own words of document number {i} stand here and nowhere else at all", "en", "s", None) for i in range(8)]
    rows += [(8, None, None, None, None), (9, "", None, None, 0), (None, "a text without any id", "en", None, 3), (10, "w " * 50000, "en", "s", 1), (10, "w " * 50000, "en", "s", 1)]
    docs, counts = spark.createDataFrame(rows, schema), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), schema)
        counts.append((name, docs.count()))
        assert docs.columns == corpus_pipeline.COLUMNS
    kept = docs.collect()
    assert dict(counts)["line_dedup"] == dict(counts)["toxicity"] == len(rows)
    assert sum(filler.strip() in (r["text"] or "") for r in kept) == 1  # the shared line stays in the largest doc_id
    assert {r["doc_id"] for r in kept} >= {*range(8), None, 10} and sum(r["doc_id"] == 10 for r in kept) == 1
    pieces = corpus_pipeline.packing(spark, docs, sf_dir).collect()
    enc = tokens.encoder(tokens.default_vocabulary())
    assert sum(p["length"] for p in pieces) == sum(len(enc.raw(r["text"] or "")) // 4 + 1 for r in kept)
    none = spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0, name
