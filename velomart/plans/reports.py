"""The sixteen reports over enriched trips.

Every report is a function from a DataFrame to a DataFrame. A result carries no
order of its own unless it is a top-k; ``preview`` sorts for reading. What a report
takes besides the trips (``durations``, ``averages``, ``shares``) it makes itself
unless the caller has it already.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.functions.dates import trip_month
from velomart.operators.filters import at_max, at_min
from velomart.operators.lookup import Lookup, lookup_join
from velomart.operators.pairs import (
    PAIR,
    shares_around_average,
    written_averages,
)

# Fixed value: the pass the station ranking is about.
MONTHLY_PASS = "Monthly Pass"

# Columns of the ride details, in the order that also breaks ties.
DETAIL = (
    "start_station",
    "start_station_name",
    "start_station_time",
    "end_station",
    "end_station_name",
    "end_station_time",
    "duration",
    "passholder_type",
    "bike_type",
)


def _ascending(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def _descending(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def trips_per_month(trips: DataFrame) -> DataFrame:
    return trips.groupBy(trip_month(trips).alias("month_year")).agg(
        F.count("trip_id").alias("total_trip")
    )


def passes_per_month(trips: DataFrame) -> DataFrame:
    return trips.groupBy(
        trip_month(trips).alias("month_year"),
        F.col("passholder_type").alias("pass_type"),
    ).agg(F.count("trip_id").alias("trip_count"))


def pass_trips_by_station(
    trips: DataFrame, pass_type: str = MONTHLY_PASS
) -> DataFrame:
    """Trips on one pass per month and start station."""
    return (
        trips.filter(F.col("passholder_type") == pass_type)
        .groupBy(
            trip_month(trips).alias("month_year"),
            "start_station",
            "start_station_name",
        )
        .agg(F.count("trip_id").alias("monthly_pass_total"))
    )


def stations_of_longest_rides(
    trips: DataFrame, k: int = 5, durations: DataFrame | None = None
) -> DataFrame:
    """Start stations with the most rides of the overall longest duration."""
    rides = at_max(trips, "duration", durations).groupBy("start_station", "start_station_name")
    return most_long_rides(rides.agg(F.count("trip_id").alias("No_of_LongDuration_ride")), k)


def most_long_rides(counted: DataFrame, k: int = 5) -> DataFrame:
    """The first k stations by their counted rides of the longest duration."""
    return counted.orderBy(
        _descending("No_of_LongDuration_ride"),
        *_ascending("start_station", "start_station_name"),
    ).limit(k)


def bikes_by_type_month(trips: DataFrame) -> DataFrame:
    return trips.groupBy(trip_month(trips).alias("month_year"), "bike_type").agg(
        F.count_distinct("bike_id").alias("total_bike")
    )


def bikes_by_category_month(trips: DataFrame) -> DataFrame:
    return (
        trips.filter(F.col("trip_route_category").isNotNull())
        .groupBy("trip_route_category", trip_month(trips).alias("month_year"))
        .agg(F.count_distinct("bike_id").alias("total_bike"))
        .select("trip_route_category", "total_bike", "month_year")
    )


def trips_by_type_category(trips: DataFrame) -> DataFrame:
    return (
        trips.filter(F.col("trip_route_category").isNotNull())
        .groupBy("bike_type", "trip_route_category")
        .agg(F.count("trip_id").alias("total_trip"))
    )


def duration_by_type(trips: DataFrame) -> DataFrame:
    """Summed duration of each bike type."""
    return trips.groupBy("bike_type").agg(F.sum("duration").alias("total_duration"))


def first_details(trips: DataFrame, k: int = 5) -> DataFrame:
    """The first k distinct ride details."""
    return trips.select(*DETAIL).distinct().orderBy(*_ascending(*DETAIL)).limit(k)


def longest_ride_details(
    trips: DataFrame, k: int = 5, durations: DataFrame | None = None
) -> DataFrame:
    return first_details(at_max(trips, "duration", durations), k)


def shortest_ride_details(
    trips: DataFrame, k: int = 5, durations: DataFrame | None = None
) -> DataFrame:
    return first_details(at_min(trips, "duration", durations), k)


def station_bike_types(trips: DataFrame, k: int = 10) -> DataFrame:
    """Start stations and bike types with the most trips (rows, not bikes)."""
    groups = trips.groupBy("start_station_name", "start_station", "bike_type")
    return most_used(groups.agg(F.count("bike_id").alias("total_bike")), k)


def most_used(counted: DataFrame, k: int = 10) -> DataFrame:
    """The first k of counted start stations and bike types."""
    return counted.orderBy(
        _descending("total_bike"),
        *_ascending("start_station", "bike_type", "start_station_name"),
    ).limit(k)


def bike_types_between_stations(trips: DataFrame) -> DataFrame:
    return trips.select(*PAIR, "bike_type").distinct()


def trips_with_pair_average(
    trips: DataFrame, averages: Lookup | None = None
) -> DataFrame:
    """Every trip with the average duration of its pair of station names.

    The averages are few, the trips are not: the averages are measured and sent
    to the trips. Trips without a station name are left out.
    """
    if averages is None:
        averages = written_averages(trips)
    return lookup_join(
        trips.select(*PAIR, "duration", "bike_type"), averages, PAIR
    ).select(*PAIR, "avg", "duration", "bike_type")


def _percentage(
    trips: DataFrame, shares: DataFrame | None, part: str, name: str
) -> DataFrame:
    if shares is None:
        shares = shares_around_average(trips)
    return shares.filter(F.col(part).isNotNull()).select(
        "bike_type", (F.col(part) * 100 / F.col("total")).alias(name)
    )


def delay_percentage(trips: DataFrame, shares: DataFrame | None = None) -> DataFrame:
    """Per bike type, the share of trips *shorter* than their pair's average.

    The name says delay, the definition is the established one. The share is of
    all trips of the type, so the two percentages need not add up to 100.
    """
    return _percentage(trips, shares, "below", "delay_percentage")


def good_percentage(trips: DataFrame, shares: DataFrame | None = None) -> DataFrame:
    """Per bike type, the share of trips at or above their pair's average."""
    return _percentage(trips, shares, "not_below", "good_percentage")


def shortest_per_pair(trips: DataFrame) -> DataFrame:
    """Quickest trip between each two stations."""
    return trips.groupBy("start_station", "end_station").agg(
        F.min("duration").alias("min_duration")
    )


@dataclass(frozen=True)
class Report:
    """A report, the table it is published as, and its reading order."""

    table: str
    build: Callable[..., DataFrame]
    order: tuple[str, ...] = ()  # a leading "-" means descending


# The table names reports are published under.
REPORTS: dict[str, Report] = {
    "r1": Report("total_users_per_month", trips_per_month, ("month_year",)),
    "r2": Report("passes_for_trip_months", passes_per_month, ("month_year",)),
    "r3": Report(
        "station_has_most_monthly_pass", pass_trips_by_station, ("-monthly_pass_total",)
    ),
    "r4": Report(
        "station_has_booked_long_duration_ride",
        stations_of_longest_rides,
        ("-No_of_LongDuration_ride", "start_station"),
    ),
    "r5": Report(
        "bikes_mostly_used_in_months", bikes_by_type_month, ("month_year", "-total_bike")
    ),
    "r6": Report(
        "bike_trip_route_category_in_months", bikes_by_category_month, ("-total_bike",)
    ),
    "r7": Report(
        "bike_trip_category_mapping",
        trips_by_type_category,
        ("bike_type", "-total_trip"),
    ),
    "r8": Report(
        "bike_trip_covered_max_duration", duration_by_type, ("-total_duration",)
    ),
    "r9": Report("detail_max_duration", longest_ride_details, DETAIL),
    "r10": Report("detail_min_duration", shortest_ride_details, DETAIL),
    "r11": Report(
        "station_bike_type",
        station_bike_types,
        ("-total_bike", "start_station", "bike_type"),
    ),
    "r12": Report("bike_type_used_between_station", bike_types_between_stations),
    "r13": Report("avg_duration_between_station", trips_with_pair_average, PAIR),
    "r14": Report("avg_bikedelay_percentage", delay_percentage),
    "r15": Report("avg_bikebest_percentage", good_percentage),
    "r16": Report(
        "shortest_duration_between_two_station",
        shortest_per_pair,
        ("start_station", "end_station"),
    ),
}


def preview(df: DataFrame, report: str, rows: int = 20) -> DataFrame:
    """The first rows in the report's reading order, without sorting the rest.

    Columns that the reading order leaves out follow it, so that only equal rows tie.
    """
    order = REPORTS[report].order
    named = {k.removeprefix("-") for k in order}
    keys = [
        _descending(k[1:]) if k.startswith("-") else F.col(k).asc_nulls_last()
        for k in [*order, *(c for c in df.columns if c not in named)]
    ]
    return df.orderBy(*keys).limit(rows)
