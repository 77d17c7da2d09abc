"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattloom.catalog import QUERIES
from wattloom.session import local_session

HEADLINE = [
    "bus_scan",
    "aligned_table",
    "on_periods_by_day",
    "daily_run_summary",
    "sampling_profile_user",
    "ema_scan",
    "past_means",
    "feature_table_sums",
    "clean_labels",
    "guarded_steps",
    "guard_calibration",
    "threshold_curve",
    "class_metrics",
    "daily_metrics",
    "leak_ood",
    "temp_lut",
    "drift_report",
    "split_month_days",
    "stage_summary",
    "two_stage_predictions",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "12g", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/events.parquet").count()
    took: dict[str, float] = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
        print(f"{name} {took[name]}", file=sys.stderr, flush=True)
    rows = spark.read.parquet(f"{sf}/events.parquet").count()
    users = spark.read.parquet(f"{sf}/events.parquet").select("user_id").distinct().count()
    spark.stop()
    total = round(sum(took.values()), 3)
    speed = {name: round(rows / sec) for name, sec in took.items()}
    line = {"metric": "headline queries, total", "value": total, "unit": "sec", "queries": took, "sf": sf, "rows": rows, "users": users, "rows_per_sec": speed}
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
