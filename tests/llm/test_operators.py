"""Training-data operators against brute force, round trips and SQL, on odd input."""
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from cohort_spark.llm import bitpack, decontaminate, htmltext, jaccard, langid, linededup, packing, prefixes, rabitq, tokens, toxicity, warc
from tests.parity import compare, duck

SF = "/root/testdata/sf0.001"
LONG = "a shared line that is well over forty characters long, yes"
ROWS = [(1, None, "x"), (2, "", "x"), (None, "null id text here now " + LONG, "x"), (3, f"first\n{LONG}\nlast ", None), (4, f"  {LONG.upper()}\t\nb", "x"),
        (5, LONG, "x"), (6, LONG + "\n" + LONG, "x"), (7, f"é à\n{LONG}", "x"), (8, f"{LONG} ", "x"), (8, f"{LONG} ", "x"), (9, "word " * 30000, "x"), (10, "same text twice over", "x"),
        (11, "same text twice over", "x"), (12, "<|endoftext|> don't  stop now\r\n\n 12.5%", "x")]
SCHEMA = "doc_id long, text string, source string, rank int, h long, at int, salt int, `key` long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0, 0, 0, 0, 0) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- tokens and operator 6
@pytest.mark.parametrize("text", [r[1] or "" for r in ROWS] + ["a.b,c 's I'll  x y 　z", "Ünï,cödé. ñ½²\x1cq", " ", "\n\n a"])
def test_chunks_encode_as_the_whole_text(text):
    enc = tokens.encoder(tokens.default_vocabulary())
    assert enc.encode(text) == enc.raw(text)


@pytest.mark.parametrize("bits", [1, 3, 8, 15, 16, 17, 31, 32])
def test_pack_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1003).astype(np.uint32)
    data = bitpack.pack(ids, bits)
    assert len(data) == -(-1003 * bits // 8)
    assert (bitpack.unpack(data, 1003, bits) == ids).all()


def test_bitpack_files(spark, docs, empty, tmp_path):
    vocab = tokens.default_vocabulary()
    out = bitpack.read_documents(bitpack.write_ids(docs, f"{tmp_path}/ids", block_ids=64)).collect()
    enc = tokens.encoder(vocab)
    want, start = [], 0
    for i, text, _ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.append(np.frombuffer(enc.raw(text or ""), "<u4"), 2).astype("<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, out), key=lambda r: r[1]) == want
    assert bitpack.read_documents(bitpack.write_ids(empty, f"{tmp_path}/none")).count() == 0


# ---- operator 4
def test_packing_holds_every_id_once(spark, docs, empty):
    enc = tokens.encoder(tokens.default_vocabulary())
    got = packing.pack(docs, capacity=128).collect()
    by_row, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_row[r["uid"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert len(by_row) == len(ROWS)
    texts = Counter((i, enc.raw(t or "") + b"\0\0\0\0") for i, t, _ in ROWS)
    assert Counter((ps[0]["doc_id"], b"".join(bytes(p["ids"]) for p in sorted(ps, key=lambda p: p["start"]))) for ps in by_row.values()) == texts
    for ps in by_sequence.values():
        ps.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in ps] == [sum(q["length"] for q in ps[:k]) for k in range(len(ps))]
        assert sum(p["length"] for p in ps) <= 128
    assert packing.pack(empty).count() == 0


def test_column_generation_is_close_to_the_bound():
    h = dict(Counter(np.random.default_rng(0).integers(1, 100, 5000).tolist()))
    plan, left = packing.rounded(packing.column_generation(h, 100), h, 99)
    rows, sequences = packing.slot_rows(plan, left, 100)
    assert sequences <= 1.02 * sum(w * n for w, n in h.items()) / 100 + 1
    assert sum(r[2] - r[1] for r in rows) == 5000


# ---- operator 5
def brute_lines(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(linededup.ascii_lower.__globals__["UPPER"], linededup.ascii_lower.__globals__["LOWER"]))
    held = defaultdict(set)
    no = linededup.NO_ID
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                held[key(line)].add(no if i is None else i)
    out = []
    for i, t, _ in rows:
        ls = (t or "").split("\n")
        kept = [x for x in ls if not (len(held.get(key(x), ())) >= 5 and max(held[key(x)]) != (no if i is None else i))]
        out.append((i, len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_line_dedup(spark, docs, empty):
    got = linededup.dedup_lines(docs, batches=4)
    assert set(docs.columns) <= set(got.columns)
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in got.collect()]
    assert sorted(got, key=str) == brute_lines(ROWS)
    assert linededup.dedup_lines(empty).count() == 0


@pytest.mark.parametrize("name", ["op5_linededup", "op10_warc"])
def test_sql_twins(spark, name):
    from cohort_spark.llm.queries import QUERIES, SQL
    ok, why = compare(spark, name, QUERIES[name], SQL[name], SF, duck(SF), check_types=True)
    assert ok, why


# ---- operator 9
def brute_components(rows, size, percent):
    rows = [(i, jaccard.shingles(t, size)) for i, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    sets = [set(s.tolist()) for _, s in rows]
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(k)].append(i)
    return sorted(((i, len(sets[k]), min(ids[find(k)], default=None) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str)


def test_jaccard_components(spark, docs):
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 500, 60)]
    rows = [(r[0], r[1]) for r in ROWS]
    for k in range(60):  # a group of near copies, edited more and more
        words = list(base)
        for at in rng.integers(0, 60, 1 + k // 15):
            words[at] = f"x{rng.integers(0, 30)}"
        rows.append((100 + k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for size, percent in ((3, 90), (5, 80)):
        got = sorted(map(tuple, jaccard.join_components(df, size, percent).collect()), key=str)
        assert got == brute_components(rows, size, percent)


def test_prefix_join_of_the_pipeline(spark, docs):
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 500, 60)]
    rows = [(r[0], r[1]) for r in ROWS]
    for k in range(60):
        words = list(base)
        for at in rng.integers(0, 60, 1 + k // 15):
            words[at] = f"x{rng.integers(0, 30)}"
        rows.append((100 + k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, prefixes.join_components(df, 5, 80, stars=1).collect()), key=str)
    assert got == brute_components(rows, 5, 80)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(8)
    for percent in (90, 80, 50, 95):
        for n in [*range(1, 40), 60, 150, 151, 400, 1300]:
            for _ in range(6):
                a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                gone = int(rng.integers(0, jaccard.may_differ(n, percent) + 1))  # up to all that may differ, by loss or by exchange
                new = int(rng.integers(0, gone + 1))
                kept = a[:n - (gone - new)] if gone else a
                b = np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, new, dtype=np.uint64)]))
                a = np.unique(a)
                both = len(np.intersect1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both) and both < max(len(a), len(b)):
                    assert np.intersect1d(jaccard.signatures(a, percent), jaccard.signatures(b, percent)).size, (percent, len(a), len(b))


def test_jaccard_common_phrases_and_wide_groups(spark, monkeypatch):
    """What is carried on is near copies, not all that holds a common phrase; a group of copies edited
    apart from each other takes few rounds, also cut into blocks."""
    rng = np.random.default_rng(5)
    phrases = [" ".join(f"w{x}" for x in rng.integers(0, 300, 6)) for _ in range(50)]
    rows = [(k, " ".join(phrases[x] for x in rng.integers(0, 50, 20))) for k in range(300)]
    base = [f"v{x}" for x in rng.integers(0, 5000, 120)]
    for k in range(80):
        words = list(base)
        for at in rng.integers(0, 120, 1 + k % 5):
            words[at] = f"x{rng.integers(0, 5000)}"
        rows.append((1000 + k, " ".join(words)))
    staged, write = [], jaccard.stage

    def kept(df, name, *rest):
        out = write(df, name, *rest)
        staged.append((name, out.count()))
        return out

    monkeypatch.setattr(jaccard, "stage", kept)
    monkeypatch.setattr(jaccard, "BLOCK", 10, raising=False)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard.join_components(df).collect()), key=str) == brute_components(rows, 3, 90)
    assert max(n for name, n in staged if name == "jaccard-shared") < 6 * len(rows)
    assert sum(name == "jaccard-links" for name, _ in staged) <= 2


# ---- operator 3
ITEM = "Alice has 12 apples and gives 5 of them to her friend Bob near the old river bridge. How many apples does Alice keep for 3 days?"


def test_decontamination(spark, empty):
    other = ITEM.replace("12", "77").replace("5 of", "9 of").replace("Bob", "Dan")
    clash = ITEM.replace("does Alice keep", "does Eve keep").replace("Alice has", "then Alice has")
    rows = [(1, ITEM), (2, "so " + other + " yes"), (3, None), (4, ""), (None, ITEM), (5, "nothing of the kind is here " * 20), (6, ITEM), (7, "x " * 5)]
    df = spark.createDataFrame([(i, t, 1, "n") for i, t in rows], "doc_id long, text string, n int, slots string")
    bench = spark.createDataFrame([(9, ITEM, 0), (8, None, 0), (None, ITEM, 0)], "item_id long, text string, place int")
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.contaminated(df, bench).collect()}
    assert got == {(1, 9): "exact", (2, 9): "reparameterised", (6, 9): "exact", (None, 9): "exact"}
    swapped = spark.createDataFrame([(1, clash)], "doc_id long, text string")
    rows = decontaminate.contaminated(swapped, bench, coverage=0.95).collect()
    assert not rows  # Alice stands for two names
    assert decontaminate.contaminated(empty, bench).count() == 0


SHORT = "The cat sat down. What did it see then? If it saw a bird, the bird flew off. The cat ran home. What was left? If any, a feather."


def test_decontamination_whatever_else_the_document_says(spark):
    before = "He read: The end of it, What a day and If only, as they say. "
    rows = [(1, before + SHORT), (2, SHORT), (3, SHORT.replace("What was", "Who was").replace("The cat", "My cat").replace("If", "When")),
            (4, before + SHORT.lower()), (5, before + SHORT.replace(". ", ", "))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(9, SHORT), (8, SHORT.lower().replace(". ", ", "))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (round(r["coverage"], 2), r["kind"]) for r in decontaminate.contaminated(df, bench).collect()}
    assert got[1, 9] == got[2, 9] == got[4, 9] == got[1, 8] == got[2, 8] == got[4, 8] == (1.0, "exact")
    assert (3, 9) not in got and (3, 8) not in got  # other words are no other names


def test_decontamination_of_windows_full_of_slots(spark):
    sums = "12 + 35 = 47, 8 + 9 = 17, 5 + 6 = 11, 1 + 2 = 3, 60 + 7 = 67"
    people = "the guests were Ann, Bob, Cid, Dan, Eve, Flo, Gus, Hal, Ida, Jon and Kim"
    loan = ("a loan of 700 is paid back over some years and so of the 700 a part is left at the end of each year while the bank keeps 3 of each hundred "
            "and the same again for the next loan of 700 that is taken")
    two = "take 3 red balls and put them with 5 green balls in one old bag and draw some"
    items = [(1, sums), (2, people), (3, loan), (4, two)]
    docs = [(10, "Look: " + sums + " so"), (20, "He said that " + people + "."), (21, people.replace("Dan", "Zoe").replace("Jon", "Lou")),
            (30, loan.replace("the 700", "the 800")), (40, two.replace("3", "4").replace("5", "4")), (50, "1 2 3 4 5 6 7 8 9 10 " * 5)]
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got.pop((21, 2), None) in (None, "reparameterised")
    assert got == {(10, 1): "exact", (20, 2): "exact", (30, 3): "reparameterised", (40, 4): "reparameterised"}


# ---- operator 1
def test_toxicity(spark, empty):
    rng = np.random.default_rng(1)
    vocab = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(600):
        words = list(rng.choice(vocab, 40))
        toxic = i % 5 == 0
        if toxic:
            words += list(rng.choice(["vile", "foul", "nasty", "awful"], 1 + i % 3))
        rows.append((i, " ".join(words), 0.0))
        labels.append((i, int(toxic)))
    labels += [(3, None), (None, 1), (4, 7)]
    rows += [(1000, None, 0.0), (1001, "", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, severity double")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, lab)
    assert list(model.thresholds) == sorted(model.thresholds)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i]["rejected"] == (i % 5 == 0) for i in range(600))
    assert not got[1000]["rejected"] and got[1000]["severity"] == got[1001]["severity"]
    assert toxicity.score(empty, model).count() == 0
    assert not any(r["rejected"] for r in toxicity.score(docs, toxicity.train(docs, lab.where("toxic = 0"))).collect())


# ---- operator 7
def test_gradient_through_time():
    net = langid.BiGru(["a", "b"], hidden=3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, mask = langid.padded([b"abc", b"zq", b"hello"])
    y = np.array([0, 1, 1])
    _, g = net.gradient(x, mask, y)
    for name, at in (("uf", (1, 2)), ("cb", (0, 1)), ("xf", (97, 4)), ("out", (2, 1))):
        old = net.w[name][at]
        net.w[name][at] = old + 1e-4
        up = net.gradient(x, mask, y)[0]
        net.w[name][at] = old - 1e-4
        down = net.gradient(x, mask, y)[0]
        net.w[name][at] = old
        assert abs((up - down) / 2e-4 - g[name][at]) < 1e-4


def test_language_held_out_accuracy(spark, empty):
    from cohort_spark.llm.common import documents
    docs = documents(spark, "/root/testdata/sf0.01")
    got = langid.op7_langid(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()
    odd = spark.createDataFrame([(1, None, "en"), (2, "12 !?", None), (None, "the and of", "en")], "doc_id long, text string, lang string")
    assert {r["doc_id"]: r["lang_pred"] for r in langid.predict(odd, langid.BiGru(["en"])).collect()} == {1: "und", 2: "und", None: "en"}
    assert langid.train(odd.where("lang is null")) is None


# ---- operator 8
def test_main_text():
    page = """<html><head><title>No</title><style>p{}</style></head><body><header>Site</header><nav><a href=x>Menu</a></nav>
        <div class="cookie-notice">We use cookies.</div><article><header><h1>T &amp; U</h1></header><p>One,  two.<p>Three<br>four &eacute;
        <script>var x = "</p>";</script></article><div id="comments"><p>I disagree, strongly.</p></div><form><p>Name</p></form><footer>c</footer>"""
    assert htmltext.main_text(page) == "T & U\nOne, two.\nThree four é"
    assert [htmltext.main_text(x) for x in (None, "", "<p>", "<!-- x", "<a <b")][:4] == [""] * 4


@pytest.mark.parametrize("attributes", [
    'style="overflow:hidden"', 'style="color:red;--display:none"', 'style="display:none;display:block"', "title='a role=banner b'", 'data-role="banner"', 'data-hidden="1"',
    "data-id=sidebar", 'alt="Hidden gems"', 'title="class = sidebar"', "href=/hidden-falls", 'aria-hidden="false"', 'x="1"data-class="ad"'])
def test_words_in_other_attributes_switch_nothing_off(attributes):
    assert htmltext.main_text(f"<article><h1>T</h1><div {attributes}><p>One, two.</p></div></article>") == "T\nOne, two."
    assert htmltext.main_text(f"<article><p>One <a {attributes}>two</a> three.</p></article>") == "One two three."


@pytest.mark.parametrize("attributes", ["hidden", 'hidden=""', "HIDDEN", 'aria-hidden="true"', "role=banner", 'x="1"role=\'banner\'', 'alt="a" class="b sidebar"',
                                        "id = comments", 'style="color:red; Display : none"', "style='display:none!important;display:block'"])
def test_attributes_that_switch_off(attributes):
    assert htmltext.main_text(f"<article><h1>T</h1><div {attributes}><p>One, two.</p></div><p>Three.</p></article>") == "T\nThree."


def test_fallback_keeps_every_block_of_the_container():
    long = "A sentence of some length, with marks, that goes on for a good while. " * 20
    rest = ["Short item", "Cell", "Said so", "Far heading"]
    inner = (f"<h1>Title</h1><p>{long}</p><p>{long}</p><section><table><tr><td>{rest[1]}</td></tr></table><ul><li>{rest[0]}</li></ul>"
             f"<blockquote>{rest[2]}</blockquote><h4>{rest[3]}</h4></section><p>{long}</p>")
    page = f"<body><nav>Menu</nav><div>{inner}</div><div><ul><li><a href=x>Elsewhere</a></li></ul></div></body>"
    said = " ".join(long.split())
    assert htmltext.main_text(page) == "\n".join(["Title", said, said, rest[1], rest[0], rest[2], rest[3], said])


def test_fallback_of_a_single_block_takes_its_parent():
    long = "A sentence of some length, with marks, that goes on for a good while. " * 40
    assert htmltext.main_text(f"<body><div><h1>T</h1><p>{long}</p></div><div><h2>E</h2></div></body>", 1.0) == "T\n" + " ".join(long.split())


def test_pages_keep_every_article(spark):
    got = {r["page_id"]: r["text"] for r in htmltext.op8_htmltext(spark, SF).collect()}
    for i, page in duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall():
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        import html
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[i] == "\n".join(x for x in want if x)


# ---- operator 10
def test_warc_odd_rows_and_skipping(spark, tmp_path):
    big = "x" * 1500
    pages = spark.createDataFrame([(1, "u1", big), (2, None, big), (3, "u3", None), (4, "u4", "short"), (5, "u5", "short"), (None, "n", big)],
                                  "page_id long, url string, html string")
    warc.write_warc(pages, f"{tmp_path}/w")
    got = warc.read_warc(spark, f"{tmp_path}/w")
    rows = {r["record_id"]: r for r in got.collect()}
    assert {k: v["record_type"] for k, v in rows.items()} == {
        "<urn:page:1>": "revisit", "<urn:page:2>": "response", "<urn:page:3>": "response", "<urn:page:4>": "response", "<urn:page:5>": "response", "": "revisit"}
    assert rows["<urn:page:1>"]["payload_bytes"] == 1500 and rows["<urn:page:1>"]["refers_to"] == "<urn:page:2>"
    assert got.where("record_type = 'revisit'").count() == 2
    import io
    data = warc.member(warc.record({"WARC-Type": "revisit"}, b"a" * 10)) + warc.member(warc.record({"WARC-Type": "response"}, b"b" * 200000))
    s = warc.Stream(io.BytesIO(data), len(data))
    assert [b for _, b in s.records(lambda h: h["warc-type"] == "revisit")] == [b"a" * 10] and s.skipped == 1
    plain = warc.record({"WARC-Type": "revisit"}, b"a") + warc.record({"WARC-Type": "response"}, b"bb")
    assert [b for _, b in warc.Stream(io.BytesIO(plain), len(plain)).records(lambda h: True)] == [b"a", b"bb"]
    warc.write_warc(pages.limit(0), f"{tmp_path}/none")
    assert warc.read_warc(spark, f"{tmp_path}/none").count() == 0


# ---- operator 2
def test_search_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 16)).astype("f4")
    x[100:220] = x[100]  # a hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] + [1.0] * 15), (1004, [1.0] * 3), (None, [1.0] * 16), (20, x[20].tolist())]
    got = rabitq.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), cells=8, sample=64, block=64, group=8).collect()
    lists = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        lists[r["query_id"]].append(r)
    assert sorted(lists) == list(range(0, 400, 20))
    hit = 0
    y = x.astype(float)
    for q, rs in lists.items():
        s = y @ y[q]
        s[q] = -np.inf
        top = np.lexsort((np.arange(400), -np.round(s, 9)))[:20]
        assert [r["rank"] for r in rs] == list(range(1, 21))
        assert all(abs(r["score"] - s[r["vec_id"]]) < 1e-9 for r in rs)
        hit += len({r["vec_id"] for r in rs} & set(top.tolist()))
    assert hit >= 0.9 * 20 * 20
    assert rabitq.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# ---- the pipeline
def test_pipeline_stages(spark):
    import corpus_pipeline as P
    docs = P.documents(spark, SF)
    before = docs.count()
    for name, stage in P.STAGES:
        path = P.shared_path(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == P.COLUMNS and docs.count() <= before
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == before


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(4)
    for edges in ([], [(1, 2)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 30)] + [(100 + k, 100 + 2 * k) for k in range(1, 30)],
                  [tuple(map(int, rng.integers(0, 60, 2))) for _ in range(50)]):
        root = {}

        def find(a):
            while root.setdefault(a, a) != a:
                a = root[a]
            return a

        for a, b in edges:
            if a != b:
                low, high = sorted((find(a), find(b)))
                root[high] = low
        got = {r["key"]: r["low"] for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {k: find(k) for k in root}
