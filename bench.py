"""Time headline queries; prints one JSON line.

Settings: BENCH_SF_DIR (folder of parquet tables) and BENCH_CPUS.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = (
    "all_rule_issues",
    "clean_rows",
    "issue_summary",
    "column_profile",
    "evaluation_report",
    "seed_dirty_rows",
    "exact_sample",
    "feature_stats",
    "iforest_scores",
    "knn_of_rows_with_gaps",
    "knn_leave_one_out",
    "neighbor_suggestions",
    "fuzzy_suggest_gestalt",
    "fix_auto",
    "full_pipeline",
)


def main() -> None:
    from cellsift.plans import tables, workloads

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cellsift-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # The tables are a few megabytes: keep all cores busy all the same.
        .config("spark.sql.files.maxPartitionBytes", "2m")
        .config("spark.sql.files.openCostInBytes", "64k")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The seeded files are the input of the detection queries.
    tables.seeded_files(spark, folder)
    timings = {}
    registered = workloads.registered()
    for name in HEADLINE:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
