"""All reports, published."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart import workspace
from velomart.functions.checksum import checksum
from velomart.plans.mart import land_mart_from_folder
from velomart.plans.reports import MONTHLY_PASS, REPORTS
from velomart.plans.rollups import shared_reports
from velomart.sinks.reports import Sink
from velomart.sources.mart import read_mart


def run_all(
    trips: DataFrame, sink: Sink, pass_type: str = MONTHLY_PASS
) -> dict[str, str]:
    """Hand every report to ``sink``; returns report key -> table name.

    ``trips`` should be a landed mart: it is scanned six times, once for each of what
    the reports share. That is written first, and may be deleted when the sink has
    written all reports (``workspace.scope``).
    """
    shared = shared_reports(trips, pass_type)
    for key, report in REPORTS.items():
        sink(report.table, shared[key])
    return {key: report.table for key, report in REPORTS.items()}


def published(spark: SparkSession, folder: str, tables: dict[str, str]) -> DataFrame:
    """What ``parquet_sink`` has published: ``report``, ``n_rows`` and ``checksum`` of each table.

    The checksums are taken from the files, so they also say that what was written is
    what is read.
    """
    found = [
        checksum(spark.read.parquet(f"{folder}/{table}")).select(F.lit(key).alias("report"), "n_rows", "checksum")
        for key, table in tables.items()
    ]
    every = found[0]
    for one in found[1:]:
        every = every.unionByName(one)
    return every


def publish_folder(
    spark: SparkSession,
    folder: str,
    recent_files: Sequence[str],
    mart: str,
    sink: Sink,
    pass_type: str = MONTHLY_PASS,
    station_header: bool = False,
) -> dict[str, str]:
    """From a folder of trip and station files to all reports.

    The files are parsed and joined once, into the mart; the reports read that. Tables
    written on the way are deleted at the end.
    """
    with workspace.scope(spark):
        land_mart_from_folder(spark, folder, recent_files, mart, station_header)
    with workspace.scope(spark):
        return run_all(read_mart(spark, mart), sink, pass_type)
