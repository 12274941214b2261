"""Structured Streaming queries.

* ``scoring_stream``: raw request lines -> contract split -> the SAME cleaning
  and feature transforms as batch -> null-feature guard -> model -> probability, flag and
  factors; scored, refused (with reasons) and audit records by ``foreachBatch`` from one read.
* ``audit_sink``: append-only audit records, de-duplicated by request id
  within a watermark, written with a checkpoint.
* ``monitor_stream``: rates, error share, served totals, value histogram and the quantile sketch
  per watermarked window, upserted by window into a table of the shared folder.
* ``label_feedback_stream``: stream-stream join of predictions with labels
  that arrive later (watermarks on both sides, bounded interval).
* ``drift_per_batch``: ``foreachBatch`` that evaluates drift + the retrain
  rule for every micro-batch against a fixed reference and appends verdicts.

Scored and refused records, the audit log and the drift verdicts keep their checkpoint beside their output
(or where the caller says), so a query started again goes on after the last
committed batch.  Queries into in-memory tables, which end with the session,
take a fresh folder in the session's checkpoint folder at each start.
"""
from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import engineer_features, score_flag
from ..operators.clean import clean_columns
from ..operators.quality import contract_fields
from ..operators.requests import audit_record, check_requests, guard_features
from ..session import ensure_checkpoint_dir, remove_folder, small_methods
from ..sources.readers import normalize_missing, request_schema
from . import windows as W
from .upsert import UpsertTable


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A fresh folder, for queries that do not outlive the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:8]}"


@dataclass(frozen=True)
class Scoring:
    """What the scoring stream scores with: a fitted model, its threshold and description, and
    (where there is one) what adds ``top_factors`` to scored rows."""

    model: object
    threshold: float
    about: dict = field(default_factory=dict)
    explain: Callable[[DataFrame], DataFrame] | None = None

    @staticmethod
    def checked(lines: DataFrame) -> DataFrame:
        """Every request with its typed ``inputs``, ``reasons`` and ``accepted`` by the contract."""
        c = check_requests(lines)
        return c.select(*lines.columns, "request_id", F.struct(*[F.col(f"`{f}`") for f in request_fields()]).alias("inputs"), "reasons", "accepted")

    def judged(self, checked: DataFrame) -> DataFrame:
        """``checked`` requests, the accepted ones with probability, flag and factors, or refused
        after all: the same cleaning and features as in batch, then the null-feature guard."""
        sent = checked.select("*", "inputs.*")
        cleaned = clean_columns(normalize_missing(sent, [f.name for f in request_schema().fields if f.dataType.simpleString() == "string"]))
        feats = engineer_features(cleaned.where("accepted"))
        guarded = guard_features(feats, [c for c in feats.columns if c not in KEEP])
        refused = guarded.where(~F.col("accepted"))
        scored = self.model.transform(guarded.where("accepted"))
        shown, flag = score_flag(vector_to_array("probability")[1], self.threshold)
        scored = scored.withColumns({"readmission_probability": shown, "flag": flag})
        scored = self.explain(scored) if self.explain else scored.withColumn("top_factors", F.lit(None).cast(FACTORS))
        keep = checked.columns
        out = ["readmission_probability", "flag", "top_factors"]
        blank = {"readmission_probability": F.lit(None).cast("double"), "flag": F.lit(None).cast("boolean"), "top_factors": F.lit(None).cast(FACTORS)}
        rest = checked.where(~F.col("accepted")).unionByName(refused.select(*keep)).withColumns(blank)
        return scored.select(*keep, *out).unionByName(rest)


FACTORS = "array<struct<feature:string,value:string,contribution:double,direction:string>>"
#: Columns that go through scoring untouched.
KEEP = ("value", "request_id", "arrived", "reasons", "accepted", "inputs")


def request_fields() -> list[str]:
    return [f["field"] for f in contract_fields()]


def checkpoint_beside(path: str) -> str:
    """The one checkpoint folder of a query that writes to ``path``."""
    return f"{path.rstrip('/')}-checkpoint"


class ScoringSink:
    """Three outputs of one read of every micro-batch: ``scored``, ``rejected`` (line and reasons)
    and ``audit`` (JSON lines).  Each is written to its own ``batch_id=N`` folder with overwrite, so a
    batch that died between two outputs is written again whole: no request twice or lost.  What a
    batch writes on the way to its outputs goes with the batch.  A
    failing audit is told and does not stop scoring; ``audit_failures`` counts it."""

    def __init__(self, scoring: Scoring, sink: str):
        self.scoring, self.sink, self.audit_failures = scoring, sink.rstrip("/"), 0

    def path(self, name: str, batch_id: int) -> str:
        return f"{self.sink}/{name}/batch_id={batch_id}"

    def write_scored(self, judged: DataFrame, batch_id: int) -> None:
        judged.where("accepted").select("request_id", "scored_at", "readmission_probability", "flag", "top_factors") \
            .write.mode("overwrite").parquet(self.path("scored", batch_id), compression="zstd")

    def write_rejected(self, judged: DataFrame, batch_id: int) -> None:
        judged.where(~F.col("accepted")).select("request_id", "scored_at", "value", "reasons") \
            .write.mode("overwrite").parquet(self.path("rejected", batch_id), compression="zstd")

    def write_audit(self, judged: DataFrame, batch_id: int) -> None:
        latency = F.unix_millis("scored_at") - F.unix_millis("arrived")
        scored = judged.where("accepted").select("*", "inputs.*")
        line = audit_record(F.col("request_id"), F.col("scored_at"), {**self.scoring.about, "threshold": self.scoring.threshold}, request_fields(),
                            F.col("readmission_probability"), F.col("flag"), F.col("top_factors"), latency)
        scored.select(line.alias("value")).write.mode("overwrite").text(self.path("audit", batch_id), compression="gzip")

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        # one read, one check and one scoring, each written; the three outputs are projections of them
        checked, judged = (f"{self.sink}/_work/{step}/batch_id={batch_id}" for step in ("checked", "judged"))
        spark = batch.sparkSession
        with small_methods(spark):
            self.scoring.checked(batch).write.mode("overwrite").parquet(checked, compression="zstd")
            scored = self.scoring.judged(spark.read.parquet(checked)).withColumn("scored_at", F.current_timestamp())
            # the line goes with a refusal only, its fields with an audit record only
            own = {"value": F.when(~F.col("accepted"), F.col("value")), "inputs": F.when(F.col("accepted"), F.col("inputs"))}
            scored.withColumns(own).write.mode("overwrite").parquet(judged, compression="zstd")
        remove_folder(spark, checked)
        rows = spark.read.parquet(judged)
        self.write_scored(rows, batch_id)
        self.write_rejected(rows, batch_id)
        try:
            self.write_audit(rows, batch_id)
        except Exception as failure:  # noqa: BLE001 -- whatever the sink raises, requests are answered
            self.audit_failures += 1
            logging.getLogger(__name__).warning("audit of batch %s failed: %s", batch_id, failure)
        remove_folder(spark, judged)


#: Lines of a file that ``write_request_files`` writes.
LINES_PER_FILE = 50_000


def write_request_files(lines: DataFrame, source_dir: str) -> None:
    """Write request lines (``value``) as compressed text files, one of which is a task's work."""
    with small_methods(lines.sparkSession):
        lines.select("value").write.option("maxRecordsPerFile", LINES_PER_FILE).text(source_dir, compression="gzip")


def request_lines(spark: SparkSession, source_dir: str, files: int | None = None, consume: bool = False) -> DataFrame:
    """Stream of raw request lines with the time their file arrived, at most ``files`` files (by
    default two a core, 32 at least) a batch; ``consume`` deletes files whose batch is done."""
    files = files or max(32, 2 * spark.sparkContext.defaultParallelism)
    source = spark.readStream.format("text").option("maxFilesPerTrigger", files)
    lines = (source.option("cleanSource", "delete") if consume else source).load(source_dir)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("arrived")).where(F.trim("value") != "")


def scoring_stream(spark: SparkSession, source_dir: str, scoring: Scoring, sink: str, trigger_available_now: bool = True,
                   of=ScoringSink, files: int | None = None, consume: bool = False):
    """Start the scoring query: JSON lines in ``source_dir`` -> ``scored``, ``rejected`` and
    ``audit`` below ``sink``, its checkpoint beside them; started again it takes up new lines only.
    The lines are taken in batches (``files`` and ``consume`` of ``request_lines``), so what is
    written on the way is that of one batch.  Returns (query, sink)."""
    out = of(scoring, sink)
    w = request_lines(spark, source_dir, files, consume).writeStream.foreachBatch(out.handle).option("checkpointLocation", checkpoint_beside(sink))
    return (w.trigger(availableNow=True) if trigger_available_now else w).start(), out


def audit_sink(scored: DataFrame, path: str, watermark: str = "10 minutes", checkpoint: str | None = None):
    """Append-only audit log; a replayed request id is written once, also by a
    query that was stopped and started again on the same ``path``."""
    dedup = scored.withWatermark("request_ts", watermark).dropDuplicatesWithinWatermark(["request_id"])
    return (dedup.writeStream.format("json").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint or checkpoint_beside(path)).trigger(availableNow=True).start())


#: What each monitoring stream keeps: window function of a watermarked stream, and its keys.
MONITORS = {
    "rates": (W.rate_tumbling, ["window_start", "window_end", "event_type"]),
    "error_share": (W.error_share, ["window_start"]),
    "served": (W.served, ["window_start"]),
    "histogram": (W.score_histogram, ["window_start", "bin"]),
    "value_bins": (W.value_bins, ["window_start", "side", "bin"]),
}


def monitor_stream(name: str, events: DataFrame, path: str, watermark: str = "10 minutes", **settings):
    """Start one of ``MONITORS`` over a stream of events: (query, table).

    Update mode: every micro-batch upserts the windows that changed into ``path`` by key, and the
    watermark drops the state of windows that are over; rows later than the watermark are
    dropped.  The table is whole after every batch, and a query started again goes on with it."""
    window, keys = MONITORS[name]
    rows = window(events.withWatermark("ts", watermark), **settings)
    table = UpsertTable(events.sparkSession, path, rows.schema, keys)
    return table.start(rows), table


def label_feedback_stream(preds: DataFrame, labels: DataFrame, max_delay: str = "30 days",
                          watermark: str = "1 day") -> DataFrame:
    """Predictions joined to outcomes that arrive up to ``max_delay`` later;
    state is bounded by the watermarks and the interval condition."""
    p = preds.withWatermark("pred_ts", watermark).alias("p")
    lab = labels.withWatermark("label_ts", watermark).alias("l")
    cond = ((F.col("p.request_id") == F.col("l.request_id"))
            & (F.col("l.label_ts") >= F.col("p.pred_ts"))
            & (F.col("l.label_ts") <= F.col("p.pred_ts") + F.expr(f"INTERVAL {max_delay}")))
    return p.join(lab, cond, "inner").select("p.request_id", "p.pred_ts", "p.readmission_probability",
                                             "l.label_ts", "l.label")


def drift_per_batch(stream: DataFrame, snapshot, columns: list[str], out_path: str,
                    label: str | None = None, checkpoint: str | None = None):
    """Evaluate column drift, dataset drift and the retrain rule for every micro-batch against a
    written reference ``snapshot`` (no reference row is read); with ``label`` the batch's average
    precision counts as well.  One verdict row per batch, written to its own ``batch_id=N``
    partition with overwrite, so a micro-batch replayed after a failure rewrites the same output
    (idempotent)."""
    from ..operators import drift as DR
    from ..operators import metrics as M
    from ..session import materialize

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        j = materialize(DR.joint(snapshot, {"batch": batch}, columns), f"drift-batch-{batch_id}")
        share = DR.drift_summary(DR.column_drift(j, snapshot.facts))
        psis = DR.psi_of(j, snapshot.facts, [c for c in C.TOP_SHAP_FEATURES if c in columns])
        ap = None if label is None else M.ranking_metrics(batch, label, "prediction").select(
            F.lit("batch").alias("batch"), F.col("average_precision").alias("new_data_prauc"))
        verdict = DR.retrain_decision(share, psis, ap).drop("batch")
        verdict.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    return (stream.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint or checkpoint_beside(out_path)).trigger(availableNow=True).start())
