"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the number of cores. Each
query is run to its last row; the time is the better of two runs, except for
the iterative fits, which run once.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from seriesflow.catalog.queries import QUERIES

HEADLINE = [
    "load_series", "prep_report", "data_quality_report", "chrono_index_long", "split_raw_users",
    "lag_features_users", "feature_table", "feature_table_lineitem", "feature_table_long",
    "scaler_transform_long", "window_arrays_long", "supervised_rows", "baseline_suite",
    "baseline_suite_users", "baseline_suite_lineitem", "baseline_suite_long", "leaderboard",
    "high_error_review_users", "run_summary", "sink_features", "sink_summary_json",
    "feature_table_skewed", "baseline_suite_skewed", "high_error_review_skewed",
]
FITS = ["learned_forecast_users", "leaderboard_learned"]


def _seconds(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("seriesflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        times[name] = round(min(_seconds(spark, name, folder) for _ in range(2)), 3)
    for name in FITS:
        times[name] = round(_seconds(spark, name, folder), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
