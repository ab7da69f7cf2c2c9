"""Date columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two time formats trip files use.
ISO_TIME = "yyyy-MM-dd HH:mm:ss"
US_TIME = "M/d/yyyy H:mm"


def mixed_date(text: Column) -> Column:
    """The DATE of a time text in either format; NULL when it is in neither.

    A text in the second format always holds a slash and one in the first never
    does, so the slash picks the format and each value is parsed once. Trying
    one format after the other gives the same dates but raises an exception
    inside the JVM for every row of the second kind.
    """
    return F.when(
        F.contains(text, F.lit("/")), F.try_to_date(text, US_TIME)
    ).otherwise(F.try_to_date(text, ISO_TIME))


def month_bucket(date: Column) -> Column:
    """First day of the month of ``date``."""
    return F.trunc(date, "month")


def trip_month(trips: DataFrame) -> Column:
    """Month of the trip's start: the partition column where the mart has it."""
    if "month_year" in trips.columns:
        return F.col("month_year")
    return month_bucket(F.col("start_station_time"))
