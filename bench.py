"""Time the headline queries on one machine and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each query runs once to warm up, then BENCH_RUNS times; the median counts. Results go to the
no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterline.session import local_session  # noqa: E402
from meterline.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "all_rides",
    "filter_box",
    "filter_prefix",
    "max_timestamp",
    "count_cells",
    "run_rate",
    "run_rate_direct",
    "exact_turnover",
    "turnover_panes",
    "latest_points",
    "pickup_points",
    "route_messages",
    "ride_trails",
    "heat_weights",
    "flag_duplicates",
    "feed_health",
    "bundle_average",
    "ride_completeness",
    "stream_count_cells",
    "stream_turnover_panes",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus))
    times: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
