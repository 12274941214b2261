"""Monitoring windows over an event table ``(ts, user_id, event_type, value)``.

Each function is written once against a DataFrame, so the same code serves a
batch table and (where noted) a streaming frame with a watermark.  Event-type
plays the handler, ``error`` the 5xx status and ``value`` the latency.

Ordered operations over time (gaps, sessions, alert holds) never order events: those of one
key and time bucket become one segment (first, last, count) by a map-side combined aggregation,
segments are ordered per key and day, and a table of one row per key and day supplies what is
carried in from earlier days.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import group_quantiles

ERROR_TYPE = "error"


def rate_tumbling(df: DataFrame, width: str = "1 hour", seconds: int = 3600) -> DataFrame:
    """Events per type per tumbling window and the per-second rate."""
    g = df.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "event_type", "n", (F.col("n") / F.lit(float(seconds))).alias("rate_per_sec"))


def rate_sliding(df: DataFrame, width: str = "1 hour", slide: str = "15 minutes",
                 seconds: int = 3600) -> DataFrame:
    """Same over sliding windows (each event counts in width/slide windows)."""
    g = (df.groupBy(F.window("ts", width, slide).alias("w"), "event_type")
         .agg(F.count(F.lit(1)).alias("n")))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "event_type", "n", (F.col("n") / F.lit(float(seconds))).alias("rate_per_sec"))


PERCENTILES = (0.5, 0.95)


def latency_percentiles(df: DataFrame, width: str = "1 day") -> DataFrame:
    """p50 / p95 of ``value`` per window (T4), exact: from a (window, value, count) table and its
    running counts, so no buffer grows with the values of a window.  A window of null values has
    null percentiles."""
    w = df.select(F.window("ts", width)["start"].alias("window_start"), "value")
    n = w.groupBy("window_start").agg(F.count(F.lit(1)).alias("n"))
    q = group_quantiles(w, ["window_start"], "value", list(PERCENTILES)).select(F.col("window_start").alias("_w"), "q")
    return (n.join(q, F.col("window_start") == F.col("_w"), "left")
            .select("window_start", F.col("q")[0].alias("p50"), F.col("q")[1].alias("p95"), "n"))


def value_bins(df: DataFrame, width: str = "1 day", accuracy: float = 0.005) -> DataFrame:
    """(window_start, side, bin, n): a mergeable quantile sketch of ``value`` per window.

    Bins grow by gamma = (1 + accuracy) / (1 - accuracy), so a bin's middle is within
    ``accuracy`` (relative) of each of its values; ``side`` is -1, 0 or 1 by sign, 2 for NaN.
    Counts of equal bins add, in any order: the state of a stream is one row a window and bin,
    some ln(largest / smallest) / (2 accuracy) a window however many events it has."""
    v, gamma = F.col("value").cast("double"), (1 + accuracy) / (1 - accuracy)
    size = F.least(F.abs(v), F.lit(1.7e308))  # infinite values count with the largest
    side = F.when(F.isnan(v), 2).when(v > 0, 1).when(v < 0, -1).otherwise(0)
    index = F.when(side.isin(-1, 1), F.ceil(F.log(size) / F.lit(math.log(gamma)))).otherwise(0).cast("int")
    g = df.where(v.isNotNull()).groupBy(F.window("ts", width).alias("w"), side.alias("side"), index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("window_start"), "side", "bin", "n")


def bin_percentiles(bins: DataFrame, accuracy: float = 0.005, probs: tuple[float, ...] = PERCENTILES) -> DataFrame:
    """(window_start, p50, p95, n) of ``value_bins``: each percentile (linear interpolation between
    two order statistics, each taken as its bin's middle) within ``accuracy`` of the exact one
    where both have one sign, of the larger of the two else."""
    gamma = (1 + accuracy) / (1 - accuracy)
    middle = F.when(F.col("side") == 2, F.lit(float("nan"))).otherwise(F.col("side") * F.pow(F.lit(gamma), F.col("bin")) * F.lit(2 / (1 + gamma)))
    upto = Window.partitionBy("window_start").orderBy("_x")  # rows of one window: its bins
    b = bins.groupBy("window_start", "side", "bin").agg(F.sum("n").alias("n")).withColumn("_x", middle)
    b = b.withColumns({"_upto": F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, 0)), "_all": F.sum("n").over(Window.partitionBy("window_start"))})
    at = [F.lit(p) * (F.col("_all") - 1) for p in probs]
    pick = lambda i: F.max(F.when((i >= F.col("_upto") - F.col("n")) & (i < F.col("_upto")), F.col("_x")))
    g = b.groupBy("window_start").agg(F.max("_all").alias("n"), *[pick(F.floor(p)).alias(f"_l{i}") for i, p in enumerate(at)],
                                      *[pick(F.ceil(p)).alias(f"_h{i}") for i, p in enumerate(at)], *[F.max(p - F.floor(p)).alias(f"_f{i}") for i, p in enumerate(at)])
    q = [F.col(f"_l{i}") + F.col(f"_f{i}") * (F.col(f"_h{i}") - F.col(f"_l{i}")) for i in range(len(at))]
    return g.select("window_start", *[c.alias(f"p{round(100 * p)}") for c, p in zip(q, probs)], "n")


def error_share(df: DataFrame, width: str = "1 hour") -> DataFrame:
    """Error events / max(total, 1) per window (T5).  The denominator clamp is
    on the window COUNT (the dashboards clamp a per-second rate)."""
    g = df.groupBy(F.window("ts", width).alias("w")).agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(F.col("event_type") == ERROR_TYPE).alias("n_error"))
    return g.select(F.col("w.start").alias("window_start"), "n_total", "n_error",
                    (F.col("n_error") / F.greatest(F.col("n_total"), F.lit(1))).alias("error_share"))


def served_total(df: DataFrame, width: str = "1 day") -> DataFrame:
    """Successful (non-error) events per window and their running total."""
    return running_served(served(df, width))


def served(df: DataFrame, width: str = "1 day") -> DataFrame:
    """Successful (non-error) events per window."""
    g = (df.where(F.col("event_type") != ERROR_TYPE).groupBy(F.window("ts", width).alias("w"))
         .agg(F.count(F.lit(1)).alias("served")))
    return g.select(F.col("w.start").alias("window_start"), "served")


def running_served(served: DataFrame) -> DataFrame:
    """Running total over the per-window table (one row per window)."""
    w = Window.orderBy("window_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return served.withColumn("served_total", F.sum("served").over(w))


def alert_for_duration(windows: DataFrame, condition: Column, window_seconds: int,
                       hold: int) -> DataFrame:
    """Alert that fires when ``condition`` holds for ``hold`` consecutive
    windows (the "for:" of an alert rule), by gaps-and-islands (T7).

    Input: one row per window with ``window_start``.  Consecutive breaching
    windows share ``index - rank``; islands of length >= ``hold`` fire from
    their ``hold``-th window.
    """
    idx = (F.unix_timestamp("window_start") / F.lit(window_seconds)).cast("long")
    br = windows.where(condition).select("window_start", idx.alias("_i"))
    w = Window.orderBy("_i")   # over breaching windows only (one row per window)
    isl = br.withColumn("_g", F.col("_i") - F.row_number().over(w))
    g = isl.groupBy("_g").agg(F.min("window_start").alias("breach_start"),
                              F.max("window_start").alias("breach_last"),
                              F.count(F.lit(1)).alias("n_windows"))
    fire = F.col("breach_start") + F.make_interval(secs=F.lit((hold - 1) * window_seconds))
    return (g.where(F.col("n_windows") >= hold)
            .select("breach_start", "breach_last", "n_windows", fire.alias("firing_from")))


def _micros(ts: Column) -> Column:
    """Microseconds since the epoch for TIMESTAMP and TIMESTAMP_NTZ alike."""
    return F.unix_micros(ts.cast("timestamp"))


def segments(df: DataFrame, keys: list[str], width_seconds: int) -> DataFrame:
    """(keys, bucket_start, first, last, n): the events of one key in one time bucket.

    An associative summary, combined map-side, so a key with most of the events costs one
    row a bucket and task.  Where ``width_seconds`` is no more than a gap or session timeout,
    no silence of that length lies inside a bucket, and the segments decide everything.  On a
    stream with a watermark each segment is emitted once, when its bucket is over."""
    g = df.groupBy(*keys, F.window("ts", f"{width_seconds} seconds").alias("w")).agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"))
    return g.select(*keys, F.col("w.start").alias("bucket_start"), "first", "last", "n")


def _day(ts: Column) -> Column:
    return F.floor(F.unix_timestamp(ts) / F.lit(86400)).cast("long")


def previous_segment(seg: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``prev_last``, the last event before each segment of its key (of all when ``keys`` is
    empty), and ``_day``.  Ordered per (keys, day); the first segment of a day takes the last
    event of the nearest earlier day, from a table of one row per key and day."""
    d = seg.withColumn("_day", _day(F.col("bucket_start")))
    days = d.groupBy(*keys, "_day").agg(F.max("last").alias("_last"))
    days = days.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_day"))).drop("_last")
    days = days.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_day").alias("_d"), "_carry")
    d = d.withColumn("_lag", F.lag("last").over(Window.partitionBy(*keys, "_day").orderBy("bucket_start")))
    match = F.col("_day") == F.col("_d")
    for i, k in enumerate(keys):
        match = match & F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}"))
    return d.join(days, match, "left").withColumn("prev_last", F.coalesce("_lag", "_carry")).select(*seg.columns, "_day", "prev_last")


def gap_detection(df: DataFrame, max_gap_seconds: int = 1800, keys: list[str] | None = None) -> DataFrame:
    """Silences: consecutive events more than ``max_gap_seconds`` apart."""
    keys = keys or []
    d = previous_segment(segments(df, keys, max_gap_seconds), keys)
    gap = _micros(F.col("first")) - _micros(F.col("prev_last"))
    return (d.where(F.col("prev_last").isNotNull() & (gap > F.lit(max_gap_seconds * 1_000_000)))
            .select(*keys, F.col("prev_last").alias("prev_ts"), F.col("first").alias("ts"), (gap / F.lit(1e6)).alias("gap_seconds")))


def sessions(df: DataFrame, key: str = "user_id", gap_seconds: int = 1800) -> DataFrame:
    """Activity sessions per key: a new session starts after ``gap_seconds`` of silence.
    Equals ``session_window(ts, gap)``; folded from segments, ordered per (key, day), with the
    sessions of earlier days carried in from a table of one row per key and day."""
    d = previous_segment(segments(df, [key], gap_seconds), [key])
    gap = _micros(F.col("first")) - _micros(F.col("prev_last"))
    d = d.withColumn("_new", (F.col("prev_last").isNull() | (gap >= F.lit(gap_seconds * 1_000_000))).cast("int"))
    before = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = d.groupBy(key, "_day").agg(F.sum("_new").alias("_n"))
    days = days.select(F.col(key).alias("_k"), F.col("_day").alias("_d"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    upto = Window.partitionBy(key, "_day").orderBy("bucket_start").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_run", F.sum("_new").over(upto)).join(days, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_day") == F.col("_d")))
    g = d.groupBy(key, (F.col("_off") + F.col("_run")).alias("session")).agg(
        F.min("first").alias("session_start"), F.max("last").alias("_last"), F.sum("n").alias("n_events"))
    return g.select(key, "session_start",
                    (F.col("_last") + F.make_interval(secs=F.lit(gap_seconds))).alias("session_end"), "n_events")


def score_histogram(df: DataFrame, width: str = "1 day", bin_width: float = 50.0,
                    n_bins: int = 10) -> DataFrame:
    """Distribution of ``value`` per window in fixed-width bins (last bin open)."""
    b = F.least(F.floor(F.col("value") / F.lit(bin_width)), F.lit(n_bins - 1)).cast("int")
    g = df.groupBy(F.window("ts", width).alias("w"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("window_start"), "bin", "n")
