"""Upserted monitoring tables: equal to batch over restarts and replays; the quantile sketch
within its bound; exact percentiles against numpy."""
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_spark.streaming import windows as W
from cohort_spark.streaming.queries import MONITORS, monitor_stream
from cohort_spark.streaming.upsert import UpsertTable

SCHEMA = "ts timestamp, user_id long, event_type string, value double"
T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def made_events(spark, start, n, seed):
    rng = np.random.default_rng(seed)
    rows = [(T0 + timedelta(seconds=start + int(s)), int(u), str(rng.choice(["view", "error"])), float(v))
            for s, u, v in zip(np.sort(rng.integers(0, 40000, n)), rng.integers(0, 5, n), rng.lognormal(3, 2, n))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("name", sorted(MONITORS))
def test_monitor_equals_batch_over_restarts(spark, tmp_path, name):
    source, parts = f"{tmp_path}/in", [made_events(spark, 39000 * k, 400, k) for k in range(3)]
    for part in parts:  # windows that straddle the parts are upserted
        part.coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema(SCHEMA).parquet(source)
        query, table = monitor_stream(name, events, f"{tmp_path}/out", watermark="1 hour")
        query.awaitTermination()
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    batch = MONITORS[name][0](every)
    assert batch.exceptAll(table.read()).count() == 0 and table.read().exceptAll(batch).count() == 0


def test_upsert_replay_compaction_and_vacuum(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, v int").schema
    table = UpsertTable(spark, f"{tmp_path}/t", schema, ["k"], compact_every=2)
    assert table.read().count() == 0
    batch = lambda *rows: spark.createDataFrame(list(rows), schema)
    rows = lambda: {(r.k, r.v) for r in table.read().collect()}
    table.write_batch(batch(("a", 1), (None, 1)), 0)
    table.write_batch(batch(("b", 1)), 1)
    assert rows() == {("a", 1), ("b", 1), (None, 1)} and table._folders() == {"base": [1], "delta": [0, 1]}
    table.write_batch(batch(("b", 1)), 1)  # replayed after a failure
    table.write_batch(batch(("a", 2), (None, 2)), 2)
    assert rows() == {("a", 2), ("b", 1), (None, 2)}
    table.write_batch(batch(("c", 5)), 3)
    table.vacuum(keep_bases=1)
    assert table._folders() == {"base": [3], "delta": []}
    assert rows() == {("a", 2), ("b", 1), ("c", 5), (None, 2)}
    (tmp_path / "t" / "delta=4").mkdir()  # a batch that died before it was whole
    assert rows() == {("a", 2), ("b", 1), ("c", 5), (None, 2)}


@pytest.mark.parametrize("accuracy", [0.005, 0.05])
def test_sketch_is_within_its_bound(spark, accuracy):
    rng = np.random.default_rng(1)
    values = {0: rng.lognormal(0, 3, 3001), 1: -rng.lognormal(0, 1, 500), 2: np.zeros(7), 3: np.array([5.0]), 4: rng.lognormal(1, 1, 2)}
    rows = [(T0 + timedelta(days=d), 1, "view", float(v)) for d, vs in values.items() for v in vs] + [(T0, 1, "view", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    bins = W.value_bins(df, accuracy=accuracy)
    halves = W.value_bins(df.where(F.hash("value") % 2 == 0), accuracy=accuracy).unionByName(W.value_bins(df.where(F.hash("value") % 2 != 0), accuracy=accuracy))
    for sketch in (bins, halves):  # merged sketches are the sketch of the union
        got = sorted(W.bin_percentiles(sketch, accuracy).collect())
        for r, vs in zip(got, values.values()):
            assert r.n == len(vs)
            for mine, p in ((r.p50, 50), (r.p95, 95)):
                assert abs(mine - np.percentile(vs, p)) <= accuracy * abs(np.percentile(vs, p)) * (1 + 1e-9) + 1e-12


def test_exact_percentiles(spark):
    rng = np.random.default_rng(2)
    values = {0: rng.lognormal(0, 3, 2000), 1: rng.integers(0, 4, 999).astype(float), 2: np.array([7.0])}
    rows = [(T0 + timedelta(days=d), 1, "view", float(v)) for d, vs in values.items() for v in vs]
    rows += [(T0, 1, "view", None), (T0 + timedelta(days=3), 1, "view", None)]
    got = sorted(W.latency_percentiles(spark.createDataFrame(rows, SCHEMA)).collect())
    assert [r.n for r in got] == [2001, 999, 1, 1] and got[3].p50 is None
    for r, vs in zip(got, values.values()):
        assert np.allclose([r.p50, r.p95], np.percentile(vs, [50, 95]), rtol=1e-12)
