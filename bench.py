"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  table folder, default /root/testdata/sf0.1
BENCH_CPUS    local cores, default all
BENCH_RUNS    timed runs per query after one warm-up, default 3; the median counts
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from packedts.plans import queries as q  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "decode_points",
    "decode_ints",
    "search_files",
    "search_files_pruned",
    "search_files_indexed",
    "count_points",
    "row_count",
    "time_range",
    "promoted_tags",
    "dedupe_points",
    "dedupe_sliced",
    "write_day_partitioned",
    "write_fanout",
    "header_profile",
    "decode_compact_names",
    "decode_without_broadcast",
    "decode_dense",
    "decode_dense_append",
    "search_dense",
    "search_dense_pruned",
    "search_dense_indexed",
)
# Cells of 3600 points, 60 points for each event.
DENSE = ("decode_dense", "decode_dense_append")


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    q.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("packedts-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="packedts-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    q.cells_path(spark, SF_DIR)
    q.uids_path(spark, SF_DIR)
    prepare = time.perf_counter() - start

    timings = {}
    for name in HEADLINE:
        run(spark, name)
        timings[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 3)
    points = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total of the headline queries, median of the runs each",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": int(CPUS),
                "points": points,
                "dense_points": 60 * points,
                "dense_points_per_sec": {name: round(60 * points / timings[name]) for name in DENSE},
                "prepare_sec": round(prepare, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
