"""Times the headline queries and prints one JSON line.

Each query runs twice in one session; the second run counts, so that JVM warm-up and code
generation do not drown the work. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` select data and cores.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from tickloom.suite import QUERIES  # noqa: E402

HEADLINE = [
    "parse_records",
    "candles",
    "candles_colocated",
    "candles_unique_ids",
    "candles_dedup",
    "candles_gapfilled",
    "late_ticks",
    "live_candles",
    "readiness_trigger",
    "readiness_by_session",
    "subscription_audit",
    "klines_json_to_candles",
    "klines_csv_to_candles",
    "klines_zip_to_candles",
    "same_day_candles",
    "download_plan",
    "catalog_upsert",
    "append_candles",
    "stream_candles",
    "stream_candles_gapfilled",
    "stream_candles_gapfilled_skewed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tickloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        for _ in range(2):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
