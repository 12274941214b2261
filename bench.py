"""Benchmark: headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each job is forced end to end with the ``noop`` sink (full computation, no
collect) and timed; prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_diag_rates",     # filters + dedup + ICD mapping + Wilson CI
    "clean_report",            # stepwise cleaning counts in one shuffle
    "featurize_full",          # full 58-column feature table
    "dq_suite_report",         # 45 + 28 checks, one aggregation pass per suite
    "level_stats",             # unpivot + level table + top-30
    "numeric_summary",         # exact percentiles + moments
    "feature_association",     # |r| + Cramér's V over all features
    "corr_spearman",           # rank tables via scalable running totals
    "leakage_overlap",         # exact hash split + semi join
    "roc_auc",                 # tie table + running totals
    "fairness_by_group",       # unpivoted attributes, one aggregate
    "drift_share",             # JS + Wasserstein over 55 columns, two batches
    "session_activity",        # bucketed sessionization
    "rate_sliding",            # sliding windows
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("COHORT_SPARK_MASTER", f"local[{cpus}]")
    os.environ.setdefault("COHORT_SPARK_PARTITIONS", str(max(8, int(cpus) * 2)))
    from cohort_spark import get_spark
    from cohort_spark.plans import catalog
    from cohort_spark.plans.catalog import QUERIES

    spark = get_spark()
    spark.sparkContext.setLogLevel("OFF")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    # warm-up: JVM class loading and the parquet footer cache, not timed
    QUERIES["scan_pruned"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    # the written stages that the jobs share, on a line of their own
    t0 = time.perf_counter()
    for stage in (catalog.encounter_table, catalog.clean_scored, catalog.features_scored):
        stage(spark, sf_dir)
    times["stage_writes"] = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
