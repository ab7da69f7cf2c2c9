"""``spark-submit``-able job: a folder of trip and station files to all reports."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from velomart.plans.publish import publish_folder
from velomart.plans.reports import MONTHLY_PASS
from velomart.sinks.reports import jdbc_sink, parquet_sink


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="velomart", description=__doc__)
    parser.add_argument("--folder", required=True, help="trip and station files")
    parser.add_argument(
        "--recent",
        nargs="+",
        required=True,
        help="names of the trip files that say which type a bike has",
    )
    parser.add_argument("--mart", required=True, help="where the mart is written")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--reports", help="folder for the reports as Parquet")
    target.add_argument("--jdbc-url", help="database for the reports")
    parser.add_argument("--jdbc-driver")
    parser.add_argument("--jdbc-connections", type=int, default=8)
    parser.add_argument(
        "--jdbc-property", action="append", default=[], metavar="KEY=VALUE"
    )
    parser.add_argument("--pass-type", default=MONTHLY_PASS)
    parser.add_argument("--station-header", action="store_true")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("velomart").getOrCreate()
    if args.reports:
        sink = parquet_sink(args.reports)
    else:
        properties = dict(p.split("=", 1) for p in args.jdbc_property)
        sink = jdbc_sink(
            args.jdbc_url, args.jdbc_driver, args.jdbc_connections, properties
        )
    tables = publish_folder(
        spark,
        args.folder,
        args.recent,
        args.mart,
        sink,
        args.pass_type,
        args.station_header,
    )
    print("\n".join(f"{key} {table}" for key, table in tables.items()))


if __name__ == "__main__":
    main()
