"""Time the headline queries; print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs to
the end, its rows into the no-op sink: twice, the second run timed, so that the
numbers are those of a session that has compiled its code. Training runs once.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tabcycle.queries import QUERIES

HEADLINES = [
    "survey_features",
    "one_hot_segment",
    "ordinal_priority",
    "regex_all",
    "split_orders",
    "split_orders_exactly",
    "wide_one_hot",
    "apply_cutoff",
    "model_scores_log",
    "roc_auc_scores",
    "cutoff_scores",
    "choose_cutoff",
    "metric_pivot",
    "js_drift",
    "ks_drift",
    "drift_log",
    "chi_square",
    "f_test",
    "feature_log",
    "chi_square_wide",
    "saved_model",
    "experiment",
]
ONCE = {"saved_model", "experiment"}


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        if name not in ONCE:
            run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
