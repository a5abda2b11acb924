"""Time the headline queries and print one JSON line. Each result is computed in full and discarded."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from wattline.plans.catalog import QUERIES  # noqa: E402
from wattline.session import get_session  # noqa: E402

HEADLINE = (
    "sessions session_summary trips_across_files span_cluster rolling_stats rolling_sparse lags future_label "
    "window_features error_band collapse_duplicates resample_grid fill_linear fill_forward fault_flags "
    "pre_event_stats event_segments range_check null_rates time_reversals validation_report physics_columns "
    "regression_metrics group_metrics bucket_metrics error_distribution slice_metrics worst_rows histogram "
    "quantiles training_rows split_last_trips split_shuffled micro_trip_filter constant_report daily_stats "
    "drift_baseline psi_sample ks_test drift_report streamed_trips fit_predict"
).split()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        "bench",
        master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/events.parquet").groupBy("user_id").count().collect()  # start the engine
    times = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
