"""The enriched trips as month-partitioned Parquet, with a summary beside them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from velomart import workspace
from velomart.functions.dates import month_bucket
from velomart.sources.mart import STALE, SUMMARY, UNFINISHED, month_extremes


def by_month(trips: DataFrame) -> DataFrame:
    """The trips gathered by start month, in parts of the advisory partition size."""
    month = month_bucket(F.col("start_station_time"))
    return trips.withColumn("dealt_by_", month).hint("rebalance", "dealt_by_").drop("dealt_by_")


def write_mart(trips: DataFrame, path: str, keep_other_months: bool = False, dealt: bool = False) -> None:
    """Overwrite ``path`` with the trips, one folder per start month.

    With ``keep_other_months`` only the folders of months that the trips have are
    replaced. Without the rebalance every task would open a file in every month. With it
    each month is gathered into files of the advisory partition size: adaptive
    execution cuts a month that is too large into several tasks and packs small
    ones together, so one hot month is no straggler. Trips from a table that was written
    ``by_month`` are ``dealt``: its parts hold few months each and are not moved again.

    Beside the months, in a folder that scans of the mart pass over, lies the least and
    greatest duration of each. It is taken from the months just written, one narrow
    column of them. A marker says so while it does not fit the mart, also if the job ends
    in between.
    """
    spark = trips.sparkSession
    if keep_other_months:
        workspace.touch(spark, f"{path}/{STALE}")
    fresh = _write(trips, path, "overwrite", "dynamic" if keep_other_months else "static", dealt)
    if "duration" not in trips.columns:
        return
    if not keep_other_months:
        workspace.touch(spark, f"{path}/{STALE}")
    _summarise(_read(trips, path).where(fresh), path)


def write_mart_in_parts(parts: Sequence[DataFrame], path: str, build: Callable[[DataFrame], DataFrame]) -> None:
    """``write_mart`` of what is built of all parts together, one after the other.

    Only one part is moved at a time. A month that several parts have is written by each of
    them. What is at ``path`` is deleted first. While parts are missing a marker says so,
    and ``read_mart`` raises.
    """
    if len(parts) == 1:
        write_mart(build(parts[0]), path)
        return
    spark = parts[0].sparkSession
    workspace.remove(spark, path)
    workspace.touch(spark, f"{path}/{UNFINISHED}")
    for trips in map(build, parts):
        _write(trips, path, "append", "static", False)
    if "duration" in trips.columns:
        _summarise(_read(trips, path), path)
    workspace.remove(spark, f"{path}/{UNFINISHED}")


def _dated(trips: DataFrame) -> DataFrame:
    return trips.withColumn("month_year", month_bucket(F.col("start_station_time")))


def _read(trips: DataFrame, path: str) -> DataFrame:
    return trips.sparkSession.read.schema(_dated(trips).schema).parquet(path)


def _write(trips: DataFrame, path: str, mode: str, overwriting: str, dealt: bool) -> Column:
    """Write the trips into their months; returns what holds for rows of these months."""
    seen, month = Observation(), F.col("month_year")
    rows = _dated(trips).observe(
        seen, F.collect_set(month).alias("months"), F.count_if(month.isNull()).alias("undated")
    )
    (
        (rows if dealt else rows.hint("rebalance", "month_year"))
        .write.mode(mode)
        .option("partitionOverwriteMode", overwriting)
        .partitionBy("month_year")
        .parquet(path)
    )
    fresh = month.isin(*seen.get["months"])
    return fresh | month.isNull() if seen.get["undated"] else fresh


def _summarise(written: DataFrame, path: str) -> None:
    (
        month_extremes(written)
        .coalesce(1)  # a row a month
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month_year")
        .parquet(f"{path}/{SUMMARY}")
    )
    workspace.remove(written.sparkSession, f"{path}/{STALE}")
