"""Times the headline queries and prints one JSON line.

Settings come from BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and, to time only some, BENCH_ONLY.
Every query is built and run completely each time, after one warm-up; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

import numpy as np
from pyspark.sql import functions as F

from gaugeloft.operators.silver import readings_from_messages, window_average
from gaugeloft.plans import tables
from gaugeloft.plans.quality_queries import no_lateness
from gaugeloft.plans.registry import REGISTRY
from gaugeloft.plans.staging import las_bytes
from gaugeloft.session import build_session, fresh_dir
from gaugeloft.sources.las import chunks_of, list_las, read_las, watch_las
from gaugeloft.sources.topics import RAW_TOPIC, read_topic
from gaugeloft.streaming.pipelines import run_las, run_silver

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
LONG_RUNS = 3
ONLY = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))

HEADLINE = [
    "silver_3m",
    "silver_1h",
    "silver_1d",
    "silver_by_tenant",
    "gold_all",
    "gold_range",
    "gold_from_topic",
    "silver_versions_latest",
    "json_parse",
    "raw_topic_parse",
    "csv_readings",
    "ingest_counters",
    "row_alerts",
    "alert_rate",
    "vm_lookup",
    "preview_100",
    "chunk_counts",
    "chunk_roundtrip",
    "measurements_latest",
    "file_id",
    "range_check",
    "completeness",
    "outliers_sd",
    "outliers_pct",
    "percentiles",
    "run_log_stats",
    "run_log_trend",
    "throughput_grid",
    "throughput_by_concurrency",
    "failure_templates",
    "gold_corrected_windows",
    "vm_lookup_stored",
]
# As in the published runs: files of 550,000 points, one, two and four at once.
LAS_POINTS, LAS_FILES = 550_000, (1, 2, 4)
# Small enough that one such file keeps several cores busy.
SPLIT_BYTES = 8 << 20


def seconds(run: Callable[[], None]) -> float:
    begin = time.perf_counter()
    run()
    return time.perf_counter() - begin


def median(run: Callable[[], None]) -> float:
    run()
    return round(statistics.median(seconds(run) for _ in range(RUNS)), 4)


def calibration(spark) -> float:
    """Seconds of a fixed job, so that runs on machines of different speed compare."""
    fixed = spark.range(0, 40_000_000, numPartitions=32).groupBy((F.col("id") % 1000).alias("k")).agg(F.sum(F.hash("id").cast("bigint")))
    return median(lambda: fixed.write.format("noop").mode("overwrite").save())


def las_folder(spark, files: int) -> tuple[str, float]:
    """A folder of LAS files and its size in MB."""
    folder = fresh_dir(spark, "bench-las").removeprefix("file:")
    os.makedirs(f"{folder}/tenantA")
    at = np.arange(LAS_POINTS)
    data = las_bytes(4, {"X": at, "Y": at, "Z": at % 1000, "intensity": at % 65536, "gps_time": at})
    for i in range(files):
        with open(f"{folder}/tenantA/{i}.las", "wb") as handle:
            handle.write(data)
    return f"{folder}/tenantA", files * len(data) / 1048576


def ingest_run(spark, folder: str) -> float:
    """Seconds from files in a folder to rows in the points table."""
    begin = time.perf_counter()
    points, check = fresh_dir(spark, "bench-points"), fresh_dir(spark, "bench-check")
    run_las(watch_las(spark, folder), points, check, bounded=True, split_bytes=SPLIT_BYTES).awaitTermination()
    return time.perf_counter() - begin


def stream_run(spark) -> tuple[float, int, int]:
    """Seconds, rows and state rows of one bounded silver stream over 20 stored files."""
    path = tables.staged_messages(spark, SF_DIR, files=20)
    messages = read_topic(spark, RAW_TOPIC, "parquet", path, stream=True, per_trigger=5)
    averages = window_average(readings_from_messages(messages), watermark=no_lateness(spark, SF_DIR))
    begin = time.perf_counter()
    query = run_silver(averages, fresh_dir(spark, "bench-silver"), fresh_dir(spark, "bench-check"), bounded=True)
    query.awaitTermination()
    took = time.perf_counter() - begin
    progress = query.recentProgress
    return took, sum(p["numInputRows"] for p in progress), max(s["numRowsTotal"] for p in progress for s in p["stateOperators"])


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed: dict[str, float] = {}
    details: dict[str, float] = {}

    details["calibration_sec"] = calibration(spark)

    def wanted(name: str) -> bool:
        return not ONLY or name in ONLY

    for name in filter(wanted, HEADLINE):
        timed[name] = median(lambda: REGISTRY[name][0](spark, SF_DIR).write.format("noop").mode("overwrite").save())
        print(name, timed[name], file=sys.stderr, flush=True)
    for files in LAS_FILES:
        name = f"las_scan_{files}_files"
        if wanted(name):
            folder, size = las_folder(spark, files)
            scan = read_las(spark, folder, ["tenant_id", "file_name", "point_index", "X", "Y", "Z", "intensity"], split_bytes=SPLIT_BYTES)
            timed[name] = median(lambda: scan.write.format("noop").mode("overwrite").save())
            chunks = chunks_of(list_las(spark, folder), split_bytes=SPLIT_BYTES)
            timed[f"las_chunks_{files}_files"] = median(lambda: chunks.write.format("noop").mode("overwrite").save())
            details[f"{name}_mb_per_sec"] = round(size / timed[name], 1)
            details[f"{name}_points_per_sec"] = round(files * LAS_POINTS / timed[name])
            details[f"las_chunks_{files}_files_mb_per_sec"] = round(size / timed[f"las_chunks_{files}_files"], 1)
            ingest_run(spark, folder)
            timed[f"las_ingest_{files}_files"] = round(statistics.median(ingest_run(spark, folder) for _ in range(LONG_RUNS)), 4)
            details[f"las_ingest_{files}_files_mb_per_sec"] = round(size / timed[f"las_ingest_{files}_files"], 1)
            print(name, timed[name], size, file=sys.stderr, flush=True)
    if wanted("streaming_silver"):
        stream_run(spark)
        took, rows, state = sorted(stream_run(spark) for _ in range(LONG_RUNS))[LONG_RUNS // 2]
        timed["streaming_silver"] = round(took, 4)
        details.update(streaming_rows_per_sec=round(rows / took), streaming_state_rows=state)
    spark.stop()
    scale = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    details["total_in_calibrations"] = round(sum(timed.values()) / details["calibration_sec"], 2)
    line = {"metric": "headline_total", "value": round(sum(timed.values()), 3), "unit": "sec", "queries": timed, "sf": float(scale), **details}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
