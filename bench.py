"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs once to warm up and three times measured, the slow ones once; the median
counts. Results go to Spark's ``noop`` sink, so every row and column is computed and none
is collected. ``build`` is the part of a query's time until it returns its frame: jobs that
write tables or look at data beforehand.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemark.registry.queries import QUERIES
from tidemark.session import build_session

HEADLINES = (
    "fct_orders",
    "scd2_fold",
    "merge_changes",
    "test_staging_dates",
    "asof_customer_version",
    "dim_customers",
    "dim_products",
    "scd2_apply",
    "dedupe_keep_last",
    "order_item_totals",
    "payment_totals",
    "compute_order_total",
    "test_relationships",
    "test_scd2_overlap",
    "range_join_versions",
    "run_tests",
    "run_cycle",
    "cdc_stream",
)
SLOW = ("run_tests", "run_cycle", "cdc_stream")
RUNS = 3


def run(spark, name: str, sf: str) -> tuple[float, float]:
    """Seconds in all, and until the frame was there."""
    start = time.perf_counter()
    frame = QUERIES[name](spark, sf)
    built = time.perf_counter() - start
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start, built


def main(names: list[str]) -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "tidemark-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, build = {}, {}
    for name in names:
        run(spark, name, sf)
        taken = [run(spark, name, sf) for _ in range(1 if name in SLOW else RUNS)]
        seconds[name] = round(statistics.median(t for t, _ in taken), 3)
        build[name] = round(statistics.median(b for _, b in taken), 3)
    total = round(sum(seconds.values()), 3)
    line = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "build": build}
    print(json.dumps({**line, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or list(HEADLINES))
