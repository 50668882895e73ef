"""Time the headline queries on the tables in $BENCH_SF_DIR and print one JSON line.

The raw tables are derived from the given ones and stored once, which is timed by itself as
``derive_raw``; with BENCH_DERIVE=each every query derives them anew, as in earlier rounds. A time is the
median of $BENCH_RUNS runs; ``value`` sums those of the headline queries, and reports over stored marts are
listed besides.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from collections.abc import Callable
from functools import partial
from statistics import median

from pyspark.sql import DataFrame, SparkSession

from martwright.plans import reports
from martwright.plans.build import Warehouse, build_marts, check, load_raw, missing_orders
from martwright.session import local_session
from martwright.sources.synthetic import generate
from martwright.sources.tables import scratch_path
from verification.queries import QUERIES
from verification.tables import store_raw

HEADLINE = (
    "fct_orders",
    "dim_customers",
    "revenue_by_region",
    "revenue_by_category_and_region",
    "customer_spend",
    "monthly_revenue",
    "status_distribution",
    "top_customers",
    "orphan_mart_orders",
    "hierarchy_counts",
    "uk_analyst_revenue",
    "dim_customers_as_uk_analyst",
    "policy_report_orders",
    "insert_raw_orders",
    "first_row_per_key",
    "stg_orders",
    "stg_customers",
    "net_revenue_by_category",
    "net_revenue_by_month_pivot",
    "quantity_histogram",
    "kpis",
    "repeated_keys",
    "quality_report",
)


STORED_CUSTOMERS, STORED_ORDERS, STORED_FILES, HOT_PERCENT = 20_000, 400_000, 16, 33
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def stored_queries(spark: SparkSession) -> dict[str, Callable[[], DataFrame]]:
    """Reports over stored marts of several files, of which one customer has a third of the orders."""
    warehouse = Warehouse(spark, scratch_path(spark, "bench"))
    people, sales = generate(spark, STORED_CUSTOMERS, STORED_ORDERS, hot_percent=HOT_PERCENT)
    load_raw(warehouse, people.repartition(STORED_FILES), sales.repartition(STORED_FILES))
    build_marts(warehouse, "2025-01-01")
    mart = warehouse.tables()
    dim, fct = mart["dim_customers"], mart["fct_orders"]
    return {
        "stored_revenue_by_region": lambda: reports.revenue_by_region(fct),
        "stored_customer_spend": lambda: reports.customer_spend(dim, fct),
        "stored_top_customers": lambda: reports.top_customers(dim, fct),
        "stored_status_distribution": lambda: reports.status_distribution(fct),
        "stored_orphans": lambda: reports.orphan_orders(dim, fct),
        "stored_missing_orders": lambda: missing_orders(warehouse),
        "stored_checks": lambda: check(warehouse, "2025-01-01"),
    }


def seconds(make: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    derived = None
    if os.environ.get("BENCH_DERIVE") != "each":
        start = time.perf_counter()
        store_raw(spark, folder, scratch_path(spark, "raw"))
        derived = round(time.perf_counter() - start, 3)
    asked = {name: partial(QUERIES[name], spark, folder) for name in sys.argv[1:] or HEADLINE}
    if not sys.argv[1:]:
        asked |= stored_queries(spark)
    for make in list(asked.values())[:3]:  # start the JVM's compiler before the clock runs
        seconds(make)
    runs = {name: sorted(seconds(make) for _ in range(RUNS)) for name, make in asked.items()}
    times = {name: round(median(r), 3) for name, r in runs.items()}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times[n] for n in times if not n.startswith("stored_")), 3),
                "unit": "sec",
                "queries": times,
                "derive_raw": derived,
                "runs": RUNS,
                "spread": {name: [round(r[0], 3), round(r[-1], 3)] for name, r in runs.items()},
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
