"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_RUNS     runs per query, of which the median counts (default 3)
    BENCH_QUERIES  comma-separated names, or "all" (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clicklake.plans import load  # noqa: E402

HEADLINES = [
    "sessionize", "sessionize_hot", "session_next_window", "gap_sessions", "label_sessions", "window_totals",
    "lag_timestamp", "lag_timestamp_hot", "back_navigation", "count_by_category", "page_category", "geo_range_join",
    "geo_range_join_large", "geo_mobility", "geo_breakdown", "client_time", "ua_enrich", "distinct_ua",
    "registration_report", "profile_column", "profile_histogram", "profile_weekday", "distinct_per_column",
    "outlier_sigma", "lag_growth", "template_fill", "join_left", "join_full", "join_semi", "pivot_mod",
    "sorted_export", "stream_sessionize",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    queries = load().queries
    wanted = os.environ.get("BENCH_QUERIES", ",".join(HEADLINES))
    names = list(queries) if wanted == "all" else wanted.split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("clicklake-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clicklake-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    spark.stop()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "runs": runs,
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
