"""Times the headline queries and prints one JSON line.

Each query runs ``WARMUPS`` times untimed and ``RUNS`` times timed into a sink that
discards its rows; the smallest time counts, plan building included.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fieldseason.plans import queries as registered  # noqa: E402

WARMUPS, RUNS = 1, 2

HEADLINE = (
    "bronze_report", "value_counts_wide", "duplicate_count", "station_inventory",
    "upsert_replace", "upsert_keep",
    "pool_medians", "silver_weather", "silver_all_stations", "silver_validation_all_stations",
    "crop_records", "optimal_mix",
    "season_long_all_stations", "season_weather", "season_weather_all_stations",
    "melt_metrics", "summary_stats", "season_table", "export_daily", "refresh",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fieldseason-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered.registry()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(WARMUPS + RUNS):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[WARMUPS:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
