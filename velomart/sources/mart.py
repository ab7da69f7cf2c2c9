"""The landed mart, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart import workspace
from velomart.functions.dates import trip_month
from velomart.schema import MART

# Beside the months of a mart; scans of the mart pass over such names.
SUMMARY = "_summary"
STALE = "_summary_stale"
UNFINISHED = "_unfinished"

_EXTREMES = "least int, greatest int, trips long, month_year date"


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """Enriched trips with their month; filters on ``month_year`` prune folders."""
    if workspace.exists(spark, f"{path}/{UNFINISHED}"):
        raise ValueError(f"the mart at {path} was not written to its end")
    return spark.read.schema(MART).parquet(path)


def month_extremes(trips: DataFrame) -> DataFrame:
    """Least and greatest duration and number of trips of each month."""
    return trips.groupBy(trip_month(trips).alias("month_year")).agg(
        F.min("duration").alias("least"),
        F.max("duration").alias("greatest"),
        F.count(F.lit(1)).alias("trips"),
    )


def read_extremes(spark: SparkSession, path: str) -> DataFrame:
    """``month_extremes`` of the mart at ``path``: as kept beside it, or from a scan if it is not there.

    Reports that filter by an extreme take it from here, by ``durations=`` the column
    renamed, in place of a scan of the trips.
    """
    columns = ("month_year", "least", "greatest", "trips")
    if workspace.exists(spark, f"{path}/{STALE}") or not workspace.exists(spark, f"{path}/{SUMMARY}"):
        return month_extremes(read_mart(spark, path)).select(*columns)
    return spark.read.schema(_EXTREMES).parquet(f"{path}/{SUMMARY}").select(*columns)
