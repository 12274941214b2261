"""Oracle SQL: monitoring windows over ``events``."""
from __future__ import annotations

import math

from .sql import SQL, r6

SQL["rate_tumbling"] = (
    "SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, time_bucket(INTERVAL '1 hour', ts) + "
    "INTERVAL '1 hour' AS window_end, event_type, COUNT(*) AS n, " + r6("COUNT(*) / 3600.0")
    + " AS rate_per_sec FROM events GROUP BY 1, 2, 3")
SQL["rate_sliding"] = (
    "SELECT ws AS window_start, ws + INTERVAL '1 hour' AS window_end, event_type, COUNT(*) AS n, "
    + r6("COUNT(*) / 3600.0") + " AS rate_per_sec FROM (SELECT ts, event_type, UNNEST([b, b - INTERVAL '15 minutes', "
    "b - INTERVAL '30 minutes', b - INTERVAL '45 minutes']) AS ws FROM (SELECT ts, event_type, "
    "time_bucket(INTERVAL '15 minutes', ts) AS b FROM events)) WHERE ts >= ws AND ts < ws + INTERVAL '1 hour' "
    "GROUP BY 1, 2, 3")
SQL["latency_percentiles"] = (
    "SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, " + r6("quantile_cont(value, 0.5)") + " AS p50, "
    + r6("quantile_cont(value, 0.95)") + " AS p95, COUNT(*) AS n FROM events GROUP BY 1")
SQL["error_share"] = (
    "SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, COUNT(*) AS n_total, "
    "COUNT(*) FILTER (WHERE event_type = 'error') AS n_error, "
    + r6("COUNT(*) FILTER (WHERE event_type = 'error') / GREATEST(COUNT(*), 1)") + " AS error_share "
    "FROM events GROUP BY 1")
SQL["served_total"] = (
    "SELECT window_start, served, CAST(SUM(served) OVER (ORDER BY window_start) AS BIGINT) AS served_total FROM ("
    "SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, COUNT(*) AS served FROM events "
    "WHERE event_type <> 'error' GROUP BY 1)")
SQL["alert_for_duration"] = (
    "SELECT MIN(window_start) AS breach_start, MAX(window_start) AS breach_last, COUNT(*) AS n_windows, "
    "MIN(window_start) + INTERVAL '1 hour' AS firing_from FROM (SELECT window_start, "
    "CAST(epoch(window_start) / 3600 AS BIGINT) - ROW_NUMBER() OVER (ORDER BY window_start) AS g FROM ("
    "SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, COUNT(*) FILTER (WHERE event_type = 'error') "
    "/ GREATEST(COUNT(*), 1) AS s FROM events GROUP BY 1) WHERE s > 0.05) GROUP BY g HAVING COUNT(*) >= 2")
SQL["gap_detection"] = (
    "SELECT prev_ts, ts, " + r6("(epoch_us(ts) - epoch_us(prev_ts)) / 1000000.0") + " AS gap_seconds FROM "
    "(SELECT ts, LAG(ts) OVER (ORDER BY ts) AS prev_ts FROM events) WHERE prev_ts IS NOT NULL AND "
    "epoch_us(ts) - epoch_us(prev_ts) > 1800000000")
SQL["session_activity"] = (
    "SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL '1800 seconds' AS session_end, "
    "COUNT(*) AS n_events FROM (SELECT user_id, ts, SUM(nw) OVER (PARTITION BY user_id ORDER BY ts "
    "ROWS UNBOUNDED PRECEDING) AS sid FROM (SELECT user_id, ts, CASE WHEN LAG(ts) OVER (PARTITION BY user_id "
    "ORDER BY ts) IS NULL OR epoch_us(ts) - epoch_us(LAG(ts) OVER (PARTITION BY user_id ORDER BY ts)) >= "
    "1800000000 THEN 1 ELSE 0 END AS nw FROM events)) GROUP BY user_id, sid")
SQL["score_histogram"] = (
    "SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, CAST(LEAST(FLOOR(value / 50.0), 9) AS INTEGER) "
    "AS bin, COUNT(*) AS n FROM events GROUP BY 1, 2")

# the streaming runs of the same windows
for _stream, _batch in {"stream_rates": "rate_tumbling", "stream_error_share": "error_share", "stream_served_total": "served_total",
                        "stream_histogram": "score_histogram", "stream_alerts": "alert_for_duration", "stream_gaps": "gap_detection"}.items():
    SQL[_stream] = SQL[_batch]

# the sketch takes every value as the middle of its bin; bins grow by gamma
_gamma = (1 + 0.005) / (1 - 0.005)
_middle = (f"CASE WHEN isnan(value) THEN value WHEN value = 0 THEN 0.0e0 ELSE sign(value) * "
           f"pow({_gamma!r}e0, CEIL(LN(LEAST(ABS(value), 1.7e308)) / {math.log(_gamma)!r}e0)) * {2 / (1 + _gamma)!r}e0 END")
SQL["stream_percentiles"] = (
    "SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, " + r6("quantile_cont(x, 0.5)") + " AS p50, " + r6("quantile_cont(x, 0.95)")
    + f" AS p95, COUNT(*) AS n FROM (SELECT ts, {_middle} AS x FROM events WHERE value IS NOT NULL) GROUP BY 1")
