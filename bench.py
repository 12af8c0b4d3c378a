"""Headline queries over the test tables, timed; prints one line of JSON.

Reads ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores). Each query runs
once unmeasured and then ``BENCH_RUNS`` times; the median counts. Results go to
a sink that computes every row and keeps none.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starkeel.plans.queries import QUERIES  # noqa: E402
from starkeel.plans.session import build_session  # noqa: E402

HEADLINE = (
    "conform_orders",
    "dedup_orders",
    "dedup_customers",
    "scd2_initial_load",
    "scd2_merged",
    "scd2_backfill",
    "scd1_upserted",
    "as_of_lookup",
    "interval_join_half_open",
    "interval_join_by_month",
    "interval_join_sliced",
    "fact_orders",
    "unmatched_orders",
    "daily_sales_summary",
    "version_continuity",
    "repeated_keys",
    "orphan_values",
    "ordered_ids",
)


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "starkeel-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        timed(spark, name, sf_dir)
        measured = [timed(spark, name, sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(measured), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf.group(1)) if sf else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
