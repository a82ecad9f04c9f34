"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query is written to the noop sink: once to warm up, then RUNS times, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from wakeline.queries import QUERIES

HEADLINE = (
    "demux_position",
    "clean_position",
    "clean_static",
    "trip_segments",
    "trip_rollup",
    "trip_incremental_merge",
    "ship_latest_state",
    "metadata_scd2",
    "ping_mart",
    "trip_mart",
    "live_ships_asof",
    "live_latest_by_key",
    "ports_geohash",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        took = []
        for _ in range(RUNS + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(took[1:]), 3)
        print(name, seconds[name], file=sys.stderr)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
