"""``python -m starlane --root ... --rentals ... --customers ... [--date yyyymmdd]``"""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import SparkSession

from starlane.functions.dates import NOT_GIVEN, resolve_run_date
from starlane.plans.daily import Warehouse, bootstrap, run_day
from starlane.session import use_adaptive


def main() -> None:
    parser = argparse.ArgumentParser(description="Load one day into the warehouse.")
    parser.add_argument("--root", required=True, help="folder of the warehouse tables")
    parser.add_argument("--rentals", required=True, help="path of the rental file, with {ds}")
    parser.add_argument("--customers", required=True, help="path of the customer file, with {ds}")
    parser.add_argument("--date", default=NOT_GIVEN, help="run date as yyyymmdd")
    parser.add_argument("--bootstrap", action="store_true", help="create the tables first")
    parser.add_argument("--json-array", action="store_true", help="a day's rentals are one JSON array, not one per line")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("starlane").getOrCreate()
    house = bootstrap(spark, args.root) if args.bootstrap else Warehouse(use_adaptive(spark), args.root)
    ds = resolve_run_date(args.date, datetime.date.today().isoformat())
    run_day(house, ds, args.rentals, args.customers, multi_line=args.json_array)


if __name__ == "__main__":
    main()
