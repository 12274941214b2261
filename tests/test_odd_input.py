"""Null labels, all-null columns, large means, and a cluster without a shared folder."""
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_spark import session
from cohort_spark.functions.columns import pearson_pairs
from cohort_spark.operators.split import stratified_split


def test_correlation_with_a_large_mean(spark):
    x = np.random.default_rng(0).standard_normal(2000)
    y = 0.7 * x + 0.7 * np.random.default_rng(1).standard_normal(2000)
    df = spark.createDataFrame([(float(a) + 1e9, float(b) + 1e9) for a, b in zip(x, y)], "a double, b double")
    got = pearson_pairs(df, [("a", "b")], None).first()["corr"]
    assert abs(got - np.corrcoef(x, y)[0, 1]) < 1e-5


def test_split_keeps_rows_without_label(spark):
    df = spark.createDataFrame([(i, None if i == 4 else i % 2) for i in range(5)], "id long, y int")
    assert stratified_split(df, "id", "y").count() == 5


def test_cluster_without_a_shared_folder_raises():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None,
                              getConf=lambda: SimpleNamespace(get=lambda k, d=None: d))
    fake = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(fake)


def test_correlations_with_nulls_take_the_rows_of_the_pair(spark):
    from cohort_spark.functions.columns import safe_corr
    rng = np.random.default_rng(2)
    rows = [tuple(None if rng.random() < 0.3 else float(v) for v in rng.integers(0, 9, 3)) + (0.1, None if i % 2 else float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, c double, flat double, d double")
    pairs = [(p, q) for i, p in enumerate(df.columns) for q in df.columns[i + 1:]]
    got = {(r.a, r.b): r["corr"] for r in pearson_pairs(df, pairs, None).collect()}
    want = df.agg(*[safe_corr(F.col(p), F.col(q)).alias(f"{p}|{q}") for p, q in pairs]).first().asDict()
    assert len(got) == len(pairs)
    for (p, q), r in got.items():
        assert r == pytest.approx(want[f"{p}|{q}"], abs=1e-12) if "flat" not in (p, q) else r is None


def test_correlations_keep_a_few_sums_a_pair(spark):
    """Three moments a pair and null mask kept a row's cost at hundreds of updates."""
    cols = [f"c{i}" for i in range(10)]
    df = spark.range(10).select(*[(F.col("id") * (i + 1) % 7).alias(c) for i, c in enumerate(cols)])
    pairs = [(p, q) for i, p in enumerate(cols) for q in cols[i + 1:]]
    plan = pearson_pairs(df, pairs)._jdf.queryExecution().optimizedPlan().toString()
    assert "covar_pop" not in plan and "stddev_pop" not in plan


def test_basics_expand_no_row_and_deciles_read_rows_once(spark, tmp_path, monkeypatch):
    from cohort_spark.operators import profile as PR
    made, cut = [], session.cut_lineage
    monkeypatch.setattr(session, "cut_lineage", lambda df: made.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df))
    rows = [(i, i // 3, float(i % 7) if i % 11 else None, None if i % 13 == 0 else "<30" if i % 4 == 0 else "NO") for i in range(200)]
    df = PR.add_binary_target(spark.createDataFrame(rows, "encounter_id long, patient_nbr long, time_in_hospital double, readmitted string"))
    basics = {r["column"]: (r["n"], r["n_missing"], r["n_unique"]) for r in PR.column_basics(df).collect()}
    assert basics == {"encounter_id": (200, 0, 200), "patient_nbr": (200, 0, 67), "time_in_hospital": (200, 19, 7)}
    assert PR.column_basics(df) is PR.column_basics(df) and not any("gid" in p for p in made)
    got = PR.decile_rates(df, ["time_in_hospital"])
    assert "readmitted" not in got._jdf.queryExecution().optimizedPlan().toString()  # bins come from the counted values
    bins = got.collect()
    assert sum(r["count"] for r in bins) == 181
    first = next(r for r in bins if r["bin"] == 1)
    mine = [r for r in rows if r[2] is not None and r[2] <= first["right"]]
    assert first["positive_rate"] == pytest.approx(sum(r[3] == "<30" for r in mine) / len(mine), abs=1e-5)
