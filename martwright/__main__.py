"""Run a step on a warehouse folder: ``python -m martwright build FOLDER``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from martwright.plans import reports
from martwright.plans.build import Warehouse, build_marts, check, load_raw
from martwright.session import configured
from martwright.sources.seeds import read_seed, with_load_times, write_seed
from martwright.sources.synthetic import generate


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="martwright")
    parser.add_argument("step", choices=["generate", "seed", "export", "build", "check", "report"])
    parser.add_argument("folder", help="warehouse folder")
    parser.add_argument("--customers", type=int, default=1000)
    parser.add_argument("--orders", type=int, default=5000)
    parser.add_argument("--seeds", help="folder of the seed CSV files")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    args = parser.parse_args(arguments)

    spark = configured(SparkSession.builder.appName("martwright")).getOrCreate()
    warehouse = Warehouse(spark, args.folder)
    if args.step == "generate":
        load_raw(warehouse, *generate(spark, args.customers, args.orders))
    elif args.step == "seed":
        names = ("raw_customers", "raw_orders")
        seeds = [with_load_times(read_seed(spark, n, f"{args.seeds}/{n}")) for n in names]
        load_raw(warehouse, *seeds)
    elif args.step == "export":
        for name in ("raw_customers", "raw_orders"):
            write_seed(warehouse.read(name), name, f"{args.seeds}/{name}")
    elif args.step == "build":
        build_marts(warehouse, args.as_of)
    elif args.step == "check":
        check(warehouse, args.as_of).show(200, truncate=False)
    else:
        tables = warehouse.tables()
        reports.hierarchy_counts(
            tables["raw_customers"], tables["raw_orders"], tables["dim_customers"], tables["fct_orders"]
        ).show(truncate=False)
        reports.revenue_by_region(tables["fct_orders"]).show(truncate=False)
        reports.customers_by(tables["raw_customers"], "region").show(truncate=False)


if __name__ == "__main__":
    main()
