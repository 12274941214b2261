"""The staged batch run: validate raw -> gate -> clean -> featurize ->
validate processed -> gate -> write.

Each stage boundary is a Parquet table (plus a JSON status table for each
suite), so a failed or restarted run resumes from written data, and a failed
suite stops the run before anything downstream is written.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import engineer_features, order_keys_first
from ..operators import clean as CL
from ..operators import quality as Q
from ..sources.readers import apply_missing_mode


def run_stages(raw_literal: DataFrame, out_dir: str, gate: bool = True) -> DataFrame:
    """Run the stages on a raw table read literally (``?`` kept); returns the
    status table (one row per suite) with the number of rows written."""
    raw_status = Q.suite_report(Q.run_suite(raw_literal, Q.raw_suite(), "raw"))
    raw_status.write.mode("overwrite").json(f"{out_dir}/status/raw")
    if gate:
        Q.gate(raw_status)
    clean = CL.clean(apply_missing_mode(raw_literal, "pipeline"))
    clean.write.mode("overwrite").parquet(f"{out_dir}/clean")
    feats = order_keys_first(engineer_features(raw_literal.sparkSession.read.parquet(f"{out_dir}/clean")))
    feats.write.mode("overwrite").parquet(f"{out_dir}/features")
    written = raw_literal.sparkSession.read.parquet(f"{out_dir}/features")
    proc_status = Q.suite_report(Q.run_suite(written, Q.processed_suite(), "processed"))
    proc_status.write.mode("overwrite").json(f"{out_dir}/status/processed")
    if gate:
        Q.gate(proc_status)
    n = written.agg(F.count(F.lit(1)).alias("rows_written"))
    from ..operators.common import attach_row
    return attach_row(raw_status.unionByName(proc_status), n)
