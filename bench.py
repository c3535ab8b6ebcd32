"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed completely with the ``noop`` sink (every row is
produced, nothing is collected to the driver); the best of ``BENCH_REPEAT``
runs is reported per query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from faresight.plans.registry import registered  # noqa: E402
from faresight.session import build_session  # noqa: E402

HEADLINE = [
    "silver_trips",
    "fct_trip_hourly",
    "dim_zones",
    "quality_report",
    "column_tests",
    "duplicate_keys",
    "batch_lineage",
    "taxi_normalize",
    "bronze_roundtrip",
    "hourly_series",
    "dashboard_kpis",
    "latest_per_key",
    "run_audit_latest",
    "medallion_job",
    "medallion_job_incremental",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "8g")})
    spark.sparkContext.setLogLevel("ERROR")
    qs = registered()
    # warm-up: JVM, codegen caches and parquet footers, not timed
    qs["silver_trips"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            qs[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - t0
            best = elapsed if best is None else min(best, elapsed)
        timings[name] = round(best, 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
