"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    threads of the local master (default: all)
BENCH_QUERIES names separated by commas (default: the list below)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from wearline.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "features_train",
    "features_test",
    "features_window10",
    "features_window40",
    "features_window1000",
    "features_multi_run",
    "features_modes_left_join",
    "features_21_sensors",
    "features_split_engines",
    "rul_labels_orders",
    "sensor_text_roundtrip",
    "truth_ordinal",
    "key_violations",
    "orphan_orders",
    "upsert_runs",
    "metrics_summary",
    "metrics_by_run",
    "min_max_scale",
    "stratified_hold_out",
    "modes_of_fixed_centres",
    "modes_fitted",
    "train_rf",
    "train_lr",
    "predict_invariants",
]


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wearline-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # One untimed run loads classes and starts the executor threads.
    run(names[0])
    seconds = {}
    for name in names:
        start = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
