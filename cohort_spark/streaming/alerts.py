"""Alert rules and absence as Structured Streaming: keyed state with timers.

* ``alert_stream`` -- the "for:" of an alert rule.  Windows come from a watermarked aggregation
  (one row a window and rule); a processor per rule keeps the open breach, says ``firing`` when
  the condition has held for ``hold`` consecutive windows and ``resolved`` when a window does not
  breach or, by an event-time timer, when the next window holds no event at all.
* ``gap_stream`` -- silences in event time.  Segments (one row a key and bucket) come from a
  watermarked aggregation; a processor per key says ``firing`` at last event + gap, by timer if
  nothing has come by the end of that bucket, and ``resolved`` with the gap's length when events go on.
* ``absence_stream`` -- silences by the clock, also of keys that never sent anything: the keys to
  expect are the initial state, every event puts the key's processing-time timer off.

``resolved`` rows equal the batch twins of ``windows.py`` (``alert_for_duration``,
``gap_detection``).  All state lives in the checkpoint (RocksDB), so a query started again goes
on with its open breaches and timers.  State is one row a rule or key.  Rows later than the
watermark are dropped, as everywhere in append mode.  Null keys are a key as any other.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from .windows import ERROR_TYPE, segments

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Keyed state with timers needs the RocksDB store; set where the submit names none."""
    name = "spark.sql.streaming.stateStore.providerClass"
    if not str(spark.conf.get(name, "")).endswith("RocksDBStateStoreProvider"):
        spark.conf.set(name, STORE)


@dataclass(frozen=True)
class Rule:
    """``condition`` over the window columns must hold for ``hold`` windows in a row."""
    name: str
    condition: Column
    hold: int


SECOND = 1_000_000  # processors count time in microseconds


class HoldProcessor(StatefulProcessor):
    """State of a rule: start and length of the open breach, and its last window."""

    def __init__(self, seconds: int, holds: dict[str, int]):
        self.width, self.holds = seconds * SECOND, holds

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "start bigint, last bigint, n int")

    def _timers_off(self) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)

    def _close(self, rule: str) -> Iterator[Row]:
        if self.open.exists():
            start, last, n = self.open.get()
            self.open.clear()
            if n >= self.holds[rule]:
                yield self._row(rule, "resolved", start, last, n)

    def _row(self, rule: str, state: str, start: int, last: int, n: int) -> Row:
        return Row(rule=rule, state=state, breach_start=start, breach_last=last, n_windows=n,
                   firing_from=start + (self.holds[rule] - 1) * self.width)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rule = key[0]
        # as many rows as windows ended in this micro-batch
        for at, breached in sorted((r.window_start, r.breached) for r in rows):
            if self.open.exists() and at > self.open.get()[1] + self.width:
                yield from self._close(rule)  # windows without events lie between
            if not breached:
                yield from self._close(rule)
                continue
            start, _, n = self.open.get() if self.open.exists() else (at, at, 0)
            self.open.update((start, at, n + 1))
            if n + 1 == self.holds[rule]:
                yield self._row(rule, "firing", start, at, n + 1)
        self._timers_off()
        if self.open.exists():  # the next window should be over by then
            until = (self.open.get()[1] + 2 * self.width) // 1000
            if until <= timerValues.getCurrentWatermarkInMs():
                yield from self._close(rule)
            else:
                self.handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._close(key[0])

    def close(self) -> None:
        pass


class GapProcessor(StatefulProcessor):
    """State of a key: its last event and whether its silence has been told."""

    def __init__(self, gap_seconds: int, bucket_seconds: int):
        self.gap, self.bucket = gap_seconds * SECOND, bucket_seconds * SECOND

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ts bigint, told boolean")

    def _row(self, key, state: str, since: int, until: int | None) -> Row:
        return Row(key=key, state=state, prev_ts=since, firing_at=since + self.gap, ts=until,
                   gap_seconds=None if until is None else (until - since) / SECOND)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # as many rows as buckets of this key ended in this micro-batch
        for first, last in sorted((r.first, r.last) for r in rows):
            if self.last.exists():
                since, told = self.last.get()
                if first > since + self.gap:
                    if not told:
                        yield self._row(key[0], "firing", since, None)
                    yield self._row(key[0], "resolved", since, first)
            self.last.update((last, False))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        since, _ = self.last.get()
        # an event that ends the silence in time is known when its bucket is over
        known = ((since + self.gap) // self.bucket + 1) * self.bucket // 1000
        if known <= timerValues.getCurrentWatermarkInMs():
            self.last.update((since, True))
            yield self._row(key[0], "firing", since, None)
        else:
            self.handle.registerTimer(known)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        since, told = self.last.get()
        if not told:
            self.last.update((since, True))
            yield self._row(key[0], "firing", since, None)

    def close(self) -> None:
        pass


class AbsenceProcessor(StatefulProcessor):
    """State of a key: the clock when its last event was read and its events so far."""

    def __init__(self, seconds: float):
        self.seconds = seconds

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at bigint, n bigint, told boolean")

    def _row(self, key, state: str, at: int, n: int) -> Row:
        return Row(key=key, state=state, silent_since=at * 1000, n_events=n)

    def _wait(self, now: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(now + int(self.seconds * 1000))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        now = timerValues.getCurrentProcessingTimeInMs()
        self.seen.update((now, 0, False))
        self._wait(now)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now, came = timerValues.getCurrentProcessingTimeInMs(), sum(1 for _ in rows)
        at, n, told = self.seen.get() if self.seen.exists() else (now, 0, False)
        if told:
            yield self._row(key[0], "resolved", at, n)
        self.seen.update((now, n + came, False))
        self._wait(now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at, n, told = self.seen.get()
        if not told:
            self.seen.update((at, n, True))
            yield self._row(key[0], "firing", at, n)

    def close(self) -> None:
        pass


def _timestamps(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.timestamp_micros(c) for c in columns})


#: An event of this type far ahead in time ends every open window of a bounded run.
MARK = "mark"


def without_marks(events: DataFrame) -> DataFrame:
    """The events less the marks, which have moved the watermark by then: a condition on the event
    time stays above the watermark, one on the type alone would be pushed below it."""
    return events.where((F.col("event_type") != MARK) | F.col("event_type").isNull() | F.col("ts").isNull())


def rule_windows(events: DataFrame, width_seconds: int, **aggregates: Column) -> DataFrame:
    """One row a window of a watermarked stream: window_start and the given aggregates."""
    g = events.groupBy(F.window("ts", f"{width_seconds} seconds").alias("w")).agg(*[a.alias(n) for n, a in aggregates.items()])
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *aggregates)


def alert_stream(windows: DataFrame, rules: list[Rule], width_seconds: int) -> DataFrame:
    """``windows`` (see ``rule_windows``) of a stream -> firing and resolved rows of every rule."""
    use_state_store(windows.sparkSession)
    told = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.coalesce(r.condition, F.lit(False)).alias("breached")) for r in rules]))
    rows = windows.select("window_start", told.alias("r")).select(F.unix_micros("window_start").alias("window_start"), "r.rule", "r.breached")
    schema = "rule string, state string, breach_start bigint, breach_last bigint, n_windows int, firing_from bigint"
    processor = HoldProcessor(width_seconds, {r.name: r.hold for r in rules})
    out = rows.groupBy("rule").transformWithState(processor, schema, "append", "eventTime")
    return _timestamps(out, "breach_start", "breach_last", "firing_from")


def error_share_windows(events: DataFrame, width_seconds: int = 3600) -> DataFrame:
    """Windows with error_share, as the batch ``error_share``."""
    w = rule_windows(events, width_seconds, n_total=F.count(F.lit(1)), n_error=F.count_if(F.col("event_type") == ERROR_TYPE))
    return w.withColumn("error_share", F.col("n_error") / F.greatest(F.col("n_total"), F.lit(1)))


def gap_stream(events: DataFrame, max_gap_seconds: int = 1800, key: Column | None = None, bucket_seconds: int | None = None) -> DataFrame:
    """Silences of a watermarked stream, per ``key`` (of all events when None).  A silence is told
    up to ``bucket_seconds`` (a sixth of the gap) and the watermark's delay after ``firing_at``."""
    bucket = bucket_seconds or max(1, max_gap_seconds // 6)
    use_state_store(events.sparkSession)
    keyed = events.withColumn("key", F.lit("") if key is None else key.cast("string"))
    seg = segments(keyed, ["key"], bucket).select("key", F.unix_micros("first").alias("first"), F.unix_micros("last").alias("last"))
    schema = "key string, state string, prev_ts bigint, firing_at bigint, ts bigint, gap_seconds double"
    out = seg.groupBy("key").transformWithState(GapProcessor(max_gap_seconds, bucket), schema, "append", "eventTime")
    return _timestamps(out, "prev_ts", "firing_at", "ts")


def absence_stream(events: DataFrame, key: Column, seconds: float, expected: DataFrame) -> DataFrame:
    """Keys that send nothing for ``seconds`` of clock time; ``expected`` (one column ``key``)
    are watched from the start, so one that never sends is told as well."""
    use_state_store(events.sparkSession)
    keyed = events.select(key.cast("string").alias("key"))
    first = expected.select(F.col("key").cast("string").alias("key")).distinct().withColumn("n", F.lit(0)).groupBy("key")
    schema = "key string, state string, silent_since bigint, n_events bigint"
    out = keyed.groupBy("key").transformWithState(AbsenceProcessor(seconds), schema, "append", "processingTime", initialState=first)
    return _timestamps(out, "silent_since")


def start(rows: DataFrame, path: str, checkpoint: str | None = None, **trigger):
    """Append ``rows`` to a Parquet table with the checkpoint beside it."""
    from .queries import checkpoint_beside
    return (rows.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint or checkpoint_beside(path)).trigger(**(trigger or {"availableNow": True})).start())
