"""Operator 11 against numpy on integer vectors, on odd input and bad conditions."""
import numpy as np
import pytest

from cohort_spark.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, n int, component int, x string"
DIM = 12


def rows_of(matrix):
    return [(i, list(map(float, r)), 0, 0, "x") for i, r in enumerate(matrix)]


def brute(vectors):
    """n, deviations, centred rows, and variances of the fit list by a direct SVD."""
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x}), dtype=object)
    n, total = len(fit), fit.sum(axis=0)
    deviation = [int(sum(int(c) ** 2 for c in r)) for r in x * n - total]
    centre = lambda m: (m * n - total).astype(float) / n
    variance = np.zeros(x.shape[1])
    found = np.linalg.svd(centre(fit), compute_uv=False) ** 2 / n
    variance[:len(found)] = found
    return n, deviation, centre(x), centre(fit), variance


RNG = np.random.default_rng(5)
ODD = [(900, None, 1, 1, "x"), (901, [float("nan")] * DIM, 1, 1, "x"), (902, [None] * DIM, 1, 1, "x"), (903, [float("inf")] + [0.0] * (DIM - 1), 1, 1, "x"),
       (904, [], 1, 1, "x"), (905, [1.0, 2.0], 1, 1, "x"), (None, [0.25] * DIM, 1, 1, "x"), (907, [0.25] * DIM, 1, 1, "x"), (907, [0.25] * DIM, 1, 1, "x")]
THREE = RNG.integers(-5, 5, (300, 3)).astype(float)
CASES = {
    "odd": rows_of(RNG.standard_normal((200, DIM))) + ODD,
    "scales": rows_of(RNG.standard_normal((400, DIM)) * 10.0 ** np.arange(0, 6, 0.5)),
    "one_strong": rows_of(RNG.standard_normal((400, 1)) * 1e6 + RNG.standard_normal((400, DIM)) / 2),
    "rank_3": rows_of(np.hstack([THREE, THREE, np.ones((300, DIM - 6))])),
    "few_rows": rows_of(RNG.standard_normal((6, DIM))),
    "huge": rows_of(RNG.standard_normal((50, DIM)) * 1e12),
}


@pytest.mark.parametrize("name", CASES)
def test_whitening(spark, name):
    rows = CASES[name]
    used = [r for r in rows if r[1] and len(r[1]) == DIM and all(c is not None and np.isfinite(c) for c in r[1])]
    n, deviation, every, fit, variance = brute([r[1] for r in used])
    white, model = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    got = white.collect()
    keep = len(model.variance)
    assert keep == {"rank_3": 3, "few_rows": 5}.get(name, DIM)
    assert model.n == n and len(got) == len(used)
    key = lambda p: (p[0] is None, p[0] or 0, str(p[1]))
    want = [(r[0], d if d < 2 ** 63 else None) for r, d in zip(used, deviation)]
    assert sorted(((r["vec_id"], r["deviation"]) for r in got), key=key) == sorted(want, key=key)
    assert np.allclose(model.variance, variance[:keep], rtol=1e-8)
    assert np.allclose(model.explained, variance[:keep] / variance.sum(), rtol=1e-8)
    assert model.identity_error < 1e-7
    turned = fit @ (model.components / np.sqrt(model.variance))
    assert np.abs(turned.T @ turned / n - np.eye(keep)).max() < 1e-7
    by_id = {r["vec_id"]: r["whitened"] for r in got}
    for r, c in zip(used, every):
        assert np.allclose(by_id[r[0]], c @ (model.components / np.sqrt(model.variance)), rtol=1e-9, atol=1e-7)


def test_whitening_without_variance(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty)[0].count() == 0
    assert whitening.whiten(spark.createDataFrame(rows_of(np.ones((9, DIM))), SCHEMA))[0].count() == 0


def test_whitening_query(spark, sf_dir):
    out = whitening.op11_whitening(spark, sf_dir)
    assert out.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
                          ("explained", "double"), ("identity_error", "double")]
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    n, deviation, every, fit, variance = brute([r["embedding"] for r in table])
    got = {}
    for r in out.collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(got) == len(table) and all(sorted(g) == list(range(1, 17)) for g in got.values())
    for r, d in zip(table, deviation):
        own = got[r["vec_id"]]
        assert {x["deviation"] for x in own.values()} == {d} and {x["n"] for x in own.values()} == {n}
        assert np.allclose([own[k]["explained"] for k in range(1, 17)], variance[:16] / variance.sum(), rtol=1e-9)
        assert own[1]["identity_error"] < 1e-9
    # whitened columns are uncorrelated with variance 1 over the fit list
    ids = {}
    for r, c in zip(table, every):
        ids.setdefault(tuple(c), r["vec_id"])
    w = np.array([[got[i][k]["whitened"] for k in range(1, 17)] for i in ids.values()])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(16)).max() < 1e-9
