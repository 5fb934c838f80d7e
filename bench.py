"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times (default 3); the
median counts. Results are written to the no-op sink, so every row and column is
computed and none reaches the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from headway.plans.queries import QUERIES  # noqa: E402
from headway.session import local_session  # noqa: E402

HEADLINE = (
    "trip_keys", "snapshot_explode", "headway_by_hour", "bus_counts_two_level", "stop_metrics_actual",
    "stop_metrics_compare", "trip_duration_compare", "long_metric_pack", "reused_trip_split",
    "weighted_median_rt", "summary_by_rt", "buses_per_hour_wait", "expand_schedule", "schedule_merge",
    "feed_version_dedupe", "clean_pings", "ping_candidates", "match_legs", "interpolate_stops",
    "leg_times", "nearest_stop_points", "area_counts_buffer", "coverage_share", "reach_budgets",
    "qc_trips", "ping_gap", "trip_reconciliation", "append_merge",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, os.environ.get("BENCH_MEMORY", "8g"))
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
