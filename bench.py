"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   data directory (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline products)
BENCH_RUNS     timed runs per query, the best counts (default 3)
"""

from __future__ import annotations

import json
import os
import pathlib
import re
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from granary import local_session  # noqa: E402
from workload.queries import registered  # noqa: E402

HEADLINE = [
    "run_rate",
    "run_rate_details",
    "run_rate_range",
    "zero_filled_daily_sales",
    "ewm_series",
    "demand_shape",
    "raw_material_run_rate",
    "raw_material_status",
    "retention_by_cohort",
    "daily_order_cnt_by_channel_range",
    "obfuscated_line_items",
    "history_union",
    "inventory_status",
    "product_daily_series",
    "stock_trend_bounds",
    "alert_finished_goods",
    "validate_split",
    "flatten_orders",
    "active_variants",
    "dimension_upsert",
]


def run_once(build) -> float:
    begin = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    spark = local_session(cores, shuffle_partitions=int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    names = list(queries) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    # One pass over the fact tables so that file listing and class loading are not billed
    # to the first query.
    run_once(lambda: queries["rows_per_date"](spark, sf_dir))
    seconds = {}
    for name in names:
        best = min(run_once(lambda: queries[name](spark, sf_dir)) for _ in range(runs))
        seconds[name] = round(best, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
