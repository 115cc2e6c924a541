"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores. Every query is run whole into
Spark's no-op sink, twice, and the faster run counts; the first one also warms the JVM.
"""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fareflow.plans.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "flight_fare_summary",
    "route_fare_summary",
    "route_fare_rollup",
    "canonical_history",
    "ml_training_rows",
    "dataset_profile",
    "quality_summary",
    "live_clean",
    "live_dedup",
    "route_price_summary",
    "airline_price_summary",
    "price_windows_sliding",
    "route_price_current",
    "search_response_flatten",
    "itinerary_from_legs",
    "active_paths",
    "stream_clean",
    "stream_gold_refresh",
    "price_baseline_nearest",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fareflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names: tuple[str, ...] = HEADLINE) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    seconds = {n: round(min(timed(spark, n, sf_dir) for _ in range(2)), 3) for n in names}
    spark.stop()
    report = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main(tuple(sys.argv[1:]) or HEADLINE)
