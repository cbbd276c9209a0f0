"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query runs
once to warm up and then BENCH_RUNS times; its time is the median, from
building the plan to the last row of the result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from packetloom.plans.queries import QUERIES

HEADLINES = [
    "window_predictions",
    "window_alerts",
    "file_summary",
    "file_summary_split_keys",
    "record_predictions",
    "record_index",
    "row_cap_per_window",
    "parse_numeric_text",
    "clean_category_text",
    "numeric_parse_ratio",
    "coerce_types",
    "drop_empty_constant",
    "column_profile",
    "profile_compare",
    "describe_probability",
    "align_contract",
    "dedup_rows",
    "window_documents",
    "records_explode",
    "confusion_metrics",
    "ranking_areas",
    "choose_threshold_f1",
    "stratified_split",
    "impute_median",
    "rare_categories",
    "baseline_calibration",
    "dashboard_indicators",
    "upsert_latest",
    "csv_round_trip",
    "gapped_windows",
    "stream_window_scoring",
    "stream_packet_windows",
    "train_and_score",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("packetloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        # Streams and training start many jobs; one run tells enough.
        heavy = name.startswith(("stream_", "train_"))
        times = []
        for turn in range(1 if heavy else runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if heavy or turn > 0:
                times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)
    result = {
        "metric": "total_seconds_of_headline_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
