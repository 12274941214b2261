"""Alert hold, silences and absence as streams: equal to their batch twins over a restart, and
told when nothing comes at all."""
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from cohort_spark.streaming import alerts as A
from cohort_spark.streaming import windows as W

SCHEMA = "ts timestamp, user_id long, event_type string, value double"
ABSENCE = "key string, state string, silent_since timestamp, n_events bigint"
T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def made_events():
    """Five-minute events over two days: hours of errors, silences of an hour and more, one hot user."""
    out = []
    for i in range(0, 2 * 24 * 60, 5):
        t = T0 + timedelta(minutes=i, seconds=i % 7)
        hour = i // 60
        if hour in (5, 6, 20, 21, 22, 40) or i % 60 in (20, 25) and hour % 3 == 0:
            continue  # silence
        kind = "error" if hour in (2, 3, 4, 10, 12, 13, 30, 31) and i % 60 < 30 else "view"
        out.append((t, 1 if i % 10 else i % 3, kind, float(i % 90)))
    return out


@pytest.fixture(scope="module")
def halves(spark, tmp_path_factory):
    """Source folders: the first day, the second day, and a mark far ahead that ends every window."""
    base = tmp_path_factory.mktemp("events")
    rows = made_events()
    cut = T0 + timedelta(hours=21, minutes=30)
    end = [(T0 + timedelta(days=30), -1, A.MARK, 0.0)]
    parts = [[r for r in rows if r[0] < cut], [r for r in rows if r[0] >= cut], end]
    paths = []
    for i, part in enumerate(parts):
        paths.append(f"{base}/{i}")
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(paths[-1])
    return paths, spark.createDataFrame(rows, SCHEMA)


def copy_in(spark, path, source):
    spark.read.schema(SCHEMA).parquet(path).coalesce(1).write.mode("append").parquet(source)


def run_over_restarts(spark, halves, source, out, of):
    """The stream started anew for each folder that arrives, on one checkpoint."""
    for path in halves[0]:
        copy_in(spark, path, source)
        events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source).withWatermark("ts", "10 minutes")
        A.start(of(A.without_marks(events)), out).awaitTermination()
    return spark.read.parquet(out)


def test_alert_hold_equals_batch_over_restarts(spark, halves, tmp_path):
    rules = [A.Rule("errors", F.col("error_share") > 0.05, 2), A.Rule("all_errors", F.col("error_share") > 0.35, 3)]
    got = run_over_restarts(spark, halves, f"{tmp_path}/in", f"{tmp_path}/out", lambda e: A.alert_stream(A.error_share_windows(e, 3600), rules, 3600)).collect()
    for rule in rules:
        want = W.alert_for_duration(W.error_share(halves[1], "1 hour"), rule.condition, 3600, rule.hold).collect()
        resolved = [(r.breach_start, r.breach_last, r.n_windows, r.firing_from) for r in got if r.rule == rule.name and r.state == "resolved"]
        assert sorted(resolved) == sorted((r.breach_start, r.breach_last, r.n_windows, r.firing_from) for r in want)
        firing = sorted((r.breach_start, r.firing_from) for r in got if r.rule == rule.name and r.state == "firing")
        assert firing == sorted((r.breach_start, r.firing_from) for r in want) and want


@pytest.mark.parametrize("key", [None, "user_id"])
def test_gaps_equal_batch_over_restarts(spark, halves, tmp_path, key):
    by = F.col(key) if key else None
    got = run_over_restarts(spark, halves, f"{tmp_path}/in", f"{tmp_path}/out", lambda e: A.gap_stream(e, 1800, by)).collect()
    want = W.gap_detection(halves[1], 1800, [key] if key else []).collect()
    resolved = sorted((r.key, r.prev_ts, r.ts, r.gap_seconds) for r in got if r.state == "resolved")
    assert resolved == sorted((str(r[key]) if key else "", r.prev_ts, r.ts, r.gap_seconds) for r in want) and want
    # told once each, at last event + gap, and once more for the silence that never ends
    firing = sorted((r.key, r.prev_ts) for r in got if r.state == "firing")
    keys = {k for k, *_ in resolved}
    assert len(firing) == len(set(firing)) == len(resolved) + len({k for k, _ in firing}) and keys <= {k for k, _ in firing}
    assert all(r.firing_at == r.prev_ts + timedelta(seconds=1800) for r in got)


def test_batch_gaps_and_sessions_by_plain_loop(spark, halves):
    rows = made_events()
    by_user = {}
    for t, u, _, _ in rows:
        by_user.setdefault(u, []).append(t)
    gaps, sessions = [], []
    for u, ts in by_user.items():
        start, n = ts[0], 1
        for a, b in zip(ts, ts[1:]):
            if (b - a).total_seconds() > 1800:
                gaps.append((u, a, b))
            if (b - a).total_seconds() >= 1800:
                sessions.append((u, start, n))
                start, n = b, 0
            n += 1
        sessions.append((u, start, n))
    utc = lambda t: t.astimezone(timezone.utc)
    got = [(r.user_id, utc(r.prev_ts), utc(r.ts)) for r in W.gap_detection(halves[1], 1800, ["user_id"]).collect()]
    assert sorted(got) == sorted(gaps)
    got = [(r.user_id, utc(r.session_start), r.n_events) for r in W.sessions(halves[1]).collect()]
    assert sorted(got) == sorted(sessions)


def test_absence_when_nothing_comes(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.createDataFrame([], SCHEMA).write.parquet(source)
    expected = spark.createDataFrame([("a",), ("b",)], "key string")

    def query():
        events = spark.readStream.schema(SCHEMA).parquet(source)
        return A.start(A.absence_stream(events, F.col("event_type"), 2, expected), out, processingTime="1 second")

    def until(states):
        for _ in range(60):
            time.sleep(1)
            rows = {(r.key, r.state) for r in spark.read.schema(ABSENCE).parquet(out).collect()} if (tmp_path / "out").exists() else set()
            if states <= rows:
                return rows
        raise AssertionError(f"{states} not in {rows}")

    q = query()
    spark.createDataFrame([(T0, 1, "c", 0.0)], SCHEMA).write.mode("append").parquet(source)
    try:
        # a and b never sent anything, c fell silent
        assert until({("a", "firing"), ("b", "firing"), ("c", "firing")}) == {("a", "firing"), ("b", "firing"), ("c", "firing")}
    finally:
        q.stop()
    q = query()  # the state is that of the first run
    spark.createDataFrame([(T0, 1, "a", 0.0)], SCHEMA).write.mode("append").parquet(source)
    try:
        until({("a", "resolved")})
    finally:
        q.stop()
    rows = spark.read.schema(ABSENCE).parquet(out).collect()
    assert sum(r.key == "b" and r.state == "firing" for r in rows) == 1
    assert sum(r.key == "a" and r.state == "resolved" for r in rows) == 1
