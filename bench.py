"""Time the headline queries: one warm-up run each, then the median of BENCH_RUNS runs (default 1). Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from lendloom.session import local_session
from lendloom.workload.catalog import QUERIES

HEADLINE = (
    "lead_wide", "default_rate_by_segment", "ledger_rollup", "first_unreverted_payment", "running_applications", "prior_applicants",
    "interval_inquiries", "nearest_verification", "bot_to_human_response", "bureau_lookups", "xml_named_values", "xml_flatten",
    "employment_rollup", "value_shares", "numeric_summary", "chi_square", "missing_apply", "rare_apply", "target_encode", "roc_auc",
    "roc_curve", "quantile_bins", "feature_auc", "csv_round_trip", "request_json", "boosted_scores", "batch_score",
)


def seconds(build, spark, folder: str) -> float:
    started = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main(names) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cores=cores)
    timings = {}
    for name in names:
        seconds(QUERIES[name], spark, folder)
        timings[name] = round(statistics.median(seconds(QUERIES[name], spark, folder) for _ in range(runs)), 3)
        spark.catalog.clearCache()
    result = {
        "metric": "headline_total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "cores": cores, "spark": spark.version,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
