"""Time the headline queries: one warm-up, then the median of the runs.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores. Every result
column is computed, into Spark's ``noop`` sink. Prints one line of JSON.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from streamwatch.registry.queries import QUERIES  # noqa: E402
from streamwatch.session import build_session  # noqa: E402

RUNS = {
    "parse_events": 3,
    "window_stats": 3,
    "window_stats_large": 3,
    "zscore_anomalies": 3,
    "zscore_by_key": 3,
    "zscore_split_join": 3,
    "zscore_large": 3,
    "iqr_anomalies": 3,
    "iqr_large": 3,
    "data_drift_large": 3,
    "prediction_drift": 3,
    "performance_by_window": 3,
    "monitor_all": 3,
    "linear_scores": 3,
    "isolation_scores": 3,
    "forest_scores": 1,
    "stream_zscore": 1,
    "stream_monitor": 1,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name, runs in RUNS.items():
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)

    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
