"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (the whole plan
runs, nothing is collected).  One warm-up pass, then the median of
$BENCH_REPEAT timed runs per query.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pricecube.plans.registry import QUERIES  # noqa: E402
from pricecube.session import get_session  # noqa: E402

HEADLINE = [
    "mart_prices",
    "mart_half",
    "stg_prices",
    "tier_mode_general",
    "annual_with_mode",
    "prices_summary",
    "prices_yoy",
    "yoy_top",
    "health",
    "dq_suite",
    "dq_report",
    "cube_decode",
    "multi_dataset_union",
    "country_lookup",
    "raw_tidy",
    "csv_roundtrip",
    "raw_load",
    "load_once",
    "export_staging",
    "export_summary",
    "mart_table",
    "gated_publish",
    "cube_stream_load",
]


def run(spark, key: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]
    spark = get_session(
        f"local[{cpus}]",
        app_name="pricecube-bench",
        shuffle_partitions=int(cpus),
        extra={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="pricecube-bench-ckpt-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="pricecube-bench-wh-"),
        },
    )
    for k in keys:  # warm-up: JIT, file listing caches, Python workers
        run(spark, k, sf_dir)
    medians = {}
    for k in keys:
        medians[k] = round(statistics.median(run(spark, k, sf_dir) for _ in range(repeat)), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(medians.values()), 4),
                "unit": "sec",
                "queries": medians,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                "repeat": repeat,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
