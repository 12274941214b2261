"""Jobs: monitoring windows over ``events`` (batch twins of the streaming
queries), plus streaming runs checked on rows."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import round_half_up
from ..sources import read_table
from ..sources.readers import apply_missing_mode
from ..streaming import alerts as AL
from ..streaming import windows as W
from .catalog import memo_plan, register


def events(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")


def _r(df, cols):
    return df.select(*[round_half_up(F.col(c), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("rate_tumbling")
def rate_tumbling(spark, sf_dir):
    return _r(W.rate_tumbling(events(spark, sf_dir)), ["rate_per_sec"])


@register("rate_sliding")
def rate_sliding(spark, sf_dir):
    return _r(W.rate_sliding(events(spark, sf_dir)), ["rate_per_sec"])


@register("latency_percentiles")
def latency_percentiles(spark, sf_dir):
    return _r(W.latency_percentiles(events(spark, sf_dir)), ["p50", "p95"])


@register("error_share")
def error_share(spark, sf_dir):
    return _r(W.error_share(events(spark, sf_dir)), ["error_share"])


@register("served_total")
def served_total(spark, sf_dir):
    return W.served_total(events(spark, sf_dir))


@register("alert_for_duration")
def alert_for_duration(spark, sf_dir):
    """Error share > 5 % held for 2 consecutive hourly windows."""
    w = W.error_share(events(spark, sf_dir), "1 hour")
    return W.alert_for_duration(w, F.col("error_share") > 0.05, 3600, 2)


@register("gap_detection")
def gap_detection(spark, sf_dir):
    """Silences longer than 30 minutes between consecutive events."""
    return _r(W.gap_detection(events(spark, sf_dir), 1800), ["gap_seconds"])


@register("session_activity")
def session_activity(spark, sf_dir):
    return W.sessions(events(spark, sf_dir), "user_id", 1800)


@register("score_histogram")
def score_histogram(spark, sf_dir):
    return W.score_histogram(events(spark, sf_dir))


# ---------------------------------------------------------------- streaming runs
def event_stream(spark, sf_dir, mark: bool = False):
    """The events file as a stream; with ``mark`` one more event far ahead ends every window."""
    schema = events(spark, sf_dir).schema
    # a file stream source watches a directory or glob; the glob names the table file
    src = (spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
           .select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value"))
    if not mark:
        return src
    last = events(spark, sf_dir).agg((F.max("ts").cast("timestamp") + F.expr("INTERVAL 30 DAYS")).alias("ts"))
    path = fresh_folder(spark, "mark")
    last.select("ts", F.lit(None).cast("long").alias("user_id"), F.lit(AL.MARK).alias("event_type"), F.lit(None).cast("double").alias("value")).write.parquet(path)
    return src.unionByName(spark.readStream.schema(src.schema).parquet(path))


def fresh_folder(spark, name):
    import uuid

    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:8]}"


def monitored(spark, sf_dir, name, **settings):
    """The table that a monitoring stream over the whole events file leaves."""
    from ..streaming.queries import monitor_stream
    query, table = monitor_stream(name, event_stream(spark, sf_dir), fresh_folder(spark, name), **settings)
    query.awaitTermination()
    return table.read()


@register("stream_rates")
def stream_rates(spark, sf_dir):
    """Structured Streaming run of ``rate_tumbling``: hourly counts per type, upserted."""
    return _r(monitored(spark, sf_dir, "rates"), ["rate_per_sec"])


@register("stream_error_share")
def stream_error_share(spark, sf_dir):
    """Structured Streaming run of ``error_share``."""
    return _r(monitored(spark, sf_dir, "error_share"), ["error_share"])


@register("stream_served_total")
def stream_served_total(spark, sf_dir):
    """Structured Streaming run of ``served_total``: the running total is read off the upserted windows."""
    return W.running_served(monitored(spark, sf_dir, "served"))


@register("stream_histogram")
def stream_histogram(spark, sf_dir):
    """Structured Streaming run of ``score_histogram``."""
    return monitored(spark, sf_dir, "histogram")


@register("stream_percentiles")
def stream_percentiles(spark, sf_dir):
    """Structured Streaming run of ``latency_percentiles`` by the quantile sketch (0.5 % off at most)."""
    return _r(W.bin_percentiles(monitored(spark, sf_dir, "value_bins")), ["p50", "p95"])


def appended(spark, rows, name):
    """What a stream in append mode leaves."""
    path = fresh_folder(spark, name)
    AL.start(rows, path).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


@register("stream_alerts")
def stream_alerts(spark, sf_dir):
    """Structured Streaming run of ``alert_for_duration``: breaches that are over, told by keyed state and timers."""
    marked = AL.without_marks(event_stream(spark, sf_dir, mark=True).withWatermark("ts", "10 minutes"))
    rules = [AL.Rule("error_share", F.col("error_share") > 0.05, 2)]
    out = appended(spark, AL.alert_stream(AL.error_share_windows(marked, 3600), rules, 3600), "alerts")
    return out.where("state = 'resolved'").select("breach_start", "breach_last", F.col("n_windows").cast("long").alias("n_windows"), "firing_from")


@register("stream_gaps")
def stream_gaps(spark, sf_dir):
    """Structured Streaming run of ``gap_detection``: silences that ended."""
    marked = AL.without_marks(event_stream(spark, sf_dir, mark=True).withWatermark("ts", "10 minutes"))
    out = appended(spark, AL.gap_stream(marked, 1800), "gaps")
    return _r(out.where("state = 'resolved'").select("prev_ts", "ts", "gap_seconds"), ["gap_seconds"])


@memo_plan
def scored_requests(spark, sf_dir):
    """Run the scoring stream over all request lines: the folder of its outputs.  The lines are
    written once, as the files that arrive, straight from the encounter view."""
    from ..streaming.queries import Scoring, scoring_stream, write_request_files
    from . import models as ML
    from .catalog import encounter_view
    from .jobs_core import AUDITED_MODEL, OPERATING_THRESHOLD, request_text
    from .jobs_models import baseline, train_test

    train, _, cat, num = train_test(spark, sf_dir)
    model, _ = baseline(spark, sf_dir)
    contributions = ML.linear_explainer(model, train, cat, num)
    scoring = Scoring(model, OPERATING_THRESHOLD, AUDITED_MODEL, lambda df: ML.top_factors(contributions(df), cat + num))
    source, sink = fresh_folder(spark, "requests"), fresh_folder(spark, "scoring")
    write_request_files(request_text(apply_missing_mode(encounter_view(spark, sf_dir), "literal")), source)
    scoring_stream(spark, source, scoring, sink, consume=True)[0].awaitTermination()
    return sink


@register("stream_scoring")
def stream_scoring(spark, sf_dir):
    """Structured Streaming run: raw request lines -> contract split -> cleaning -> features ->
    null-feature guard -> LR model -> probability, flag and factors.  Refused requests and the
    audit lines come from the same read (``stream_verdicts``)."""
    scored = spark.read.parquet(f"{scored_requests(spark, sf_dir)}/scored")
    return scored.select("request_id", "readmission_probability", "flag", F.size("top_factors").alias("n_factors"))


@register("stream_verdicts")
def stream_verdicts(spark, sf_dir):
    """What the scoring stream did with every request: scored and audited, or refused with reasons."""
    sink = scored_requests(spark, sf_dir)
    audit = spark.read.text(f"{sink}/audit").select(F.get_json_object("value", "$.request_id").alias("id"), F.lit(True).alias("audited"))
    scored = spark.read.parquet(f"{sink}/scored").select("request_id", F.lit("").alias("reasons"))
    refused = spark.read.parquet(f"{sink}/rejected").select(
        # a line that is no object has no id of its own
        F.coalesce(F.regexp_extract("value", '"request_id": "([0-9]+)"', 1), "request_id").alias("request_id"), F.array_join("reasons", "; ").alias("reasons"))
    every = scored.unionByName(refused).join(audit.hint("merge"), F.col("request_id") == F.col("id"), "left")
    return every.select(F.col("request_id").cast("long").alias("encounter_id"), (F.col("reasons") == "").alias("accepted"), "reasons",
                        F.col("audited").isNotNull().alias("audited"))
