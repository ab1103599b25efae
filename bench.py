"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores, BENCH_RUNS (default 5) how often each query runs; the median counts
and the spread is told.  Archives are packed from the tables beforehand and not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = (
    "ingest_full",
    "ingest_release",
    "ingest_all",
    "weekly_rollup",
    "xml_device_scan",
    "xml_device_scan_native",
    "xlsx_device_scan",
    "widen_records",
    "sorted_records",
    "full_release_rows",
    "dead_letter",
    "archive_bytes",
    "feed_scan",
    "catalog_listing",
    "catalog_sorted",
    "latest_release",
    "xml_clean",
    "amp_escape",
    "csv_roundtrip",
    "target_projection",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("releasemill-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="releasemill-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from releasemill import bindings
    from releasemill.queries import QUERIES
    from releasemill.sources import archives

    for style in bindings.STYLES:
        bindings.part_archives(spark, sf_dir, style)
    snapshot = bindings.line_archives(spark, sf_dir)

    seconds, spread = {}, {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs):
            started = time.monotonic()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.monotonic() - started)
        seconds[name] = round(statistics.median(taken), 3)
        spread[name] = [round(min(taken), 3), round(max(taken), 3)]

    slices = archives.list_slices(archives.scan_archives(spark, snapshot))
    mib = slices.bytes / (1 << 20)
    records = bindings.table(spark, sf_dir, "lineitem").count()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of median runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "least_and_most": spread,
                "sf": Path(sf_dir).name,
                "cpus": cpus,
                "ingest_full_records_per_sec": round(records / seconds["ingest_full"]),
                "ingest_full_mib_per_sec": round(mib / seconds["ingest_full"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
