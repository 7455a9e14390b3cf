"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of given tables, BENCH_CPUS the local threads, BENCH_RUNS the
timed runs per query after one warm-up (the median counts). Results are written in full to a
sink that discards them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plantwatch.catalog.queries import plain_queries  # noqa: E402
from plantwatch.session import build_session  # noqa: E402

HEADLINES = (
    "telemetry_clean",
    "device_features_hourly",
    "device_health_dashboard",
    "failure_labels",
    "predictive_maintenance_features",
    "maintenance_analytics",
    "expect_telemetry",
    "failures_before_install",
    "device_time_points",
    "reading_type_moments",
    "describe_value",
    "hist_value_by_type",
    "device_summary",
    "headline_kpis",
    "stratified_split",
    "roc_auc_temperature",
    "ml_clipped",
    "ml_robust_scaled",
    "stream_ml_features",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        f"local[{cpus}]",
        "plantwatch-bench",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = plain_queries()
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        timings = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            known[name](spark, folder).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timings[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
