"""Operator 12 against a plain tree on the driver."""
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cohort_spark.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, grp string, pos int, block string, digest string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r):
    return H(*["-" if r[k] is None else f"{len(str(r[k]).encode())}:{r[k]}" for k in merkle.FIELDS])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    for level in levels[:-1]:
        first = i - i % 3
        yield level[first:i], level[i + 1:first + 3]
        i //= 3


def brute(rows):
    groups, out = defaultdict(list), []
    for r in rows:
        groups[r["source"]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in groups[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    for j, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            way = [*path(trees[s], i), *path(top, j)]
            told = dict(r)
            if r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                told["text"] = r["text"].replace("\n", "")
            folded = leaf(told)
            for left, right in way:
                folded = H(*left, folded, *right)
            out.append((r["doc_id"], leaf(r), trees[s][-1][0], top[-1][0], H(*[x for a, b in way for x in a + b]), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def proved(docs, height):
    manifest = merkle.build_manifest(merkle.document_leaves(docs), ["doc_id", "digest"], height)
    found = merkle.prove(manifest, manifest.leaves.select("grp", "pos", "doc_id", "claimed"), ["doc_id"], height).collect()
    return sorted([(r["doc_id"], r["leaf"].hex(), r["subroot"].hex(), r["root"].hex(), H(r["siblings"].hex()), r["folded"].hex(),
                    r["folded"] == r["root"]) for r in found], key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*[r[k] for k in ("doc_id", "source", "lang", "n_chars", "text")], "g", 1, "b", "d") for r in rows], SCHEMA)


# ids that repeat with other texts, null ids, sources and texts, a hot source, a source of exactly 27 rows, repeated rows
ROWS = [{"doc_id": i % 97 if i % 13 else None, "source": [None, "a", "", "é", "\U0001f600"][i % 5] if i % 2 else "hot", "lang": None, "n_chars": i % 3,
         "text": [None, "", "x\ny", "z\n" * 3000][i % 4]} for i in range(300)]
ROWS += [{"doc_id": i, "source": "cube", "lang": "en", "n_chars": None, "text": f"{i}\n"} for i in range(27)] + [ROWS[3]] * 40


@pytest.mark.parametrize("height", [1, 2, 3, 6])
def test_manifest(spark, height):
    assert proved(frame(spark, ROWS), height) == brute(ROWS)


def test_manifest_small(spark):
    assert proved(frame(spark, []), 6) == []
    for rows in (ROWS[:1], ROWS[:2], ROWS[3:4] * 5):
        assert proved(frame(spark, rows), 2) == brute(rows)


@pytest.mark.parametrize("levels", range(1, 8))
def test_layout_is_a_permutation(levels):
    places = np.concatenate(merkle.addresses(levels))
    assert sorted(places.tolist()) == list(range(merkle.nodes_of(levels)))
    assert merkle.addresses(levels)[-1][0] == 0


def test_layout_keeps_halves_together():
    # of seven levels the top four stand first, every bottom subtree of three in one run
    top = np.concatenate(merkle.addresses(7)[3:])
    assert sorted(top.tolist()) == list(range(merkle.nodes_of(4)))
    leaves = merkle.addresses(7)[0].reshape(-1, 9)
    roots = merkle.addresses(7)[2]
    assert ((leaves > roots[:, None]) & (leaves < roots[:, None] + merkle.nodes_of(3))).all()


def test_positions(spark, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 3)
    rows = [(None if i % 3 == 0 else i % 2, i % 7, "same") for i in range(200)]
    placed = merkle.positions(spark.createDataFrame(rows, "g int, k int, t string"), "g", ["k"]).collect()
    by = defaultdict(list)
    for r in sorted(placed, key=lambda r: r["pos"]):
        by[r["g"]].append((r["pos"], r["k"]))
    for g, found in by.items():
        assert [p for p, _ in found] == list(range(len(found)))
        assert [k for _, k in found] == sorted(k for a, k, _ in rows if a == g)


def test_query(spark, sf_dir):
    rows = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, merkle.op12_merkle(spark, sf_dir).collect()), key=str) == brute(rows)
