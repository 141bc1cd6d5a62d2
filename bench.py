"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the number of local cores. Every
query is run once to warm up, then three times in full (all rows and columns, into
the no-op sink); its median counts. The streaming query lands its files and runs
its micro-batches within one timed run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from accrue.plans.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
BATCH = [
    "late_drop",
    "asof_interval",
    "asof_union",
    "rate_lines_60s",
    "rate_lines_daily",
    "rate_lines_monthly",
    "certificates",
    "upsert_latest",
    "keyed_table_upsert",
    "qa_diff",
]
STREAM = ["stream_equals_batch"]


def timed(spark: SparkSession, name: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in BATCH:
        timed(spark, name)
        seconds[name] = round(statistics.median(timed(spark, name) for _ in range(3)), 3)
    for name in STREAM:
        seconds[name] = round(timed(spark, name), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": SF_DIR.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
