"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local cores. Each query runs
twice in a row and the second run counts; results are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from plazaflow.plans.queries import QUERIES

HEADLINE = (
    "feed_envelope_explode",
    "generated_mentions",
    "timetable_semijoin_cascade",
    "silver_bikes",
    "silver_delays",
    "silver_disruptions",
    "silver_supply",
    "silver_mentions",
    "line_reliability",
    "station_services",
    "transit_capacity",
    "csd_activity",
    "mobility_vs_activity",
    "training_features",
    "persistence_baseline",
    "category_examples",
    "duplicate_keys",
    "stream_ingest",
    "model_metrics",
)


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    spark.catalog.clearCache()
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name, folder)
        times[name] = round(seconds(spark, name, folder), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
