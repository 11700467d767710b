"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is built and run to the end into a discarding sink, so every output row is computed.
The time of a query is the better of two runs; building the plan is part of it.
"""

from __future__ import annotations

import json
import os
import time

from tripkit.session import build_session
from workload import catalog

QUERIES = [
    "trips_per_year", "od_matrix_zone", "top10_od_borough", "clean_top10_od_borough", "median_fare_per_year",
    "service_summary", "yearly_market_share", "monthly_share", "service_cosine", "norm_payment", "dq_stats_by_year",
    "dq_clean_filter", "dq_report", "zone_lookup_join", "weather_join", "nearest_neighbor", "within_distance_left",
    "spacetime_join", "closest_event_in_window", "union_aligned", "partitioned_roundtrip", "rolling_stats_batch",
    "engineer_features", "balanced_sample", "classification_metrics",
]

# Longer jobs, run once and reported apart from the sum: loads, a stream, training batch by batch.
JOBS = ["incremental_write", "load_written_again", "stream_rolling_avg", "incremental_classifier"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog()
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    seconds = {}
    for name in QUERIES:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    jobs = {}
    for name in JOBS:
        start = time.perf_counter()
        queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        jobs[name] = round(time.perf_counter() - start, 3)
    clean_rate = round(lines / seconds["dq_clean_filter"])
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "jobs": jobs,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "lineitem_rows": lines,
                "clean_filter_rows_per_sec": clean_rate,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
