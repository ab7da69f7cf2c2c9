"""Reports from shared roll-ups: one scan of the trips for many reports.

Grouping sets give two tables in one scan, one by month, pass and start station, the other
by both stations, bike type and route category. Eight reports, the averages of the
station pairs and the overall extremes are sums over one of them. The roll-ups grow with
the number of groups, not of trips; tasks combine before anything is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart import workspace
from velomart.functions.dates import trip_month
from velomart.operators.bitmaps import bitmaps, distinct_counts
from velomart.operators.filters import at_max, at_min
from velomart.operators.lookup import measured
from velomart.operators.pairs import PAIR, shares_around_average
from velomart.plans import reports
from velomart.plans.reports import DETAIL

_STATIONS = ("start_station", "start_station_name")
#: Keys of the two roll-ups.
MONTHS = ("month_year", "passholder_type", *_STATIONS)
ROUTES = (*_STATIONS, "end_station", "end_station_name", "bike_type", "trip_route_category")


@dataclass(frozen=True)
class Rollups:
    months: DataFrame
    routes: DataFrame


def rollups(trips: DataFrame) -> Rollups:
    """Both roll-ups, written by one scan of the trips."""
    keys = list(dict.fromkeys([*MONTHS, *ROUTES]))
    rows = trips.select(
        trip_month(trips).alias("month_year"), *keys[1:], "trip_id", "bike_id", "duration"
    )
    written = workspace.materialize(
        rows.groupingSets([[F.col(k) for k in MONTHS], [F.col(k) for k in ROUTES]], *map(F.col, keys)).agg(
            F.grouping("month_year").alias("by_route"),
            F.count("trip_id").alias("trips"),
            F.count("bike_id").alias("bikes"),
            F.count("duration").alias("durations"),
            F.sum("duration").alias("total"),
            F.min("duration").alias("least"),
            F.max("duration").alias("greatest"),
        ),
        "rollups",
    )
    return Rollups(
        written.where("by_route = 0").drop("by_route"), written.where("by_route = 1").drop("by_route")
    )


def pair_averages(rolled: Rollups) -> DataFrame:
    """Average duration of each pair of station names."""
    sums = rolled.routes.groupBy(*PAIR).agg(F.sum("total").alias("total"), F.sum("durations").alias("n"))
    return sums.select(*PAIR, (F.col("total").cast("double") / F.nullif(F.col("n"), F.lit(0))).alias("avg"))


def extreme_details(trips: DataFrame, rolled: Rollups) -> DataFrame:
    """Distinct ride details at either extreme of the duration, with their number of trips."""
    bounds = rolled.routes.agg(F.min("least").alias("least"), F.max("greatest").alias("greatest")).first()
    at = trips.where(F.col("duration").isin(*{b for b in bounds if b is not None}))
    return workspace.materialize(
        at.groupBy(*DETAIL).agg(F.count("trip_id").alias("trips")), "extremes"
    )


def bike_bitmaps(trips: DataFrame) -> DataFrame:
    """Bitmaps of the bikes by month, type and category, for every count of bikes."""
    rows = trips.select(
        trip_month(trips).alias("month_year"), "bike_type", "trip_route_category", "bike_id"
    )
    keys = ["month_year", "bike_type", "trip_route_category"]
    return workspace.materialize(bitmaps(rows, keys, "bike_id"), "bike-bitmaps")


def bikes_by_type_month(maps: DataFrame) -> DataFrame:
    return distinct_counts(maps, ["month_year", "bike_type"], "total_bike")


def bikes_by_category_month(maps: DataFrame) -> DataFrame:
    named = maps.where(F.col("trip_route_category").isNotNull())
    return distinct_counts(named, ["trip_route_category", "month_year"], "total_bike").select(
        "trip_route_category", "total_bike", "month_year"
    )


def shared_reports(trips: DataFrame, pass_type: str = reports.MONTHLY_PASS) -> dict[str, DataFrame]:
    """All sixteen reports, equal to each one built alone, from six scans of the trips.

    The scans: both roll-ups; rides at the extremes; the dictionary of bikes and their
    bitmaps; the shares around the pair averages; and the trips with these, which are a
    row a trip.
    """
    rolled = rollups(trips)
    months, routes = rolled.months, rolled.routes
    # Sums of counts, so the trip reports hold over a roll-up with its counts unfolded.
    by = lambda df, name, *keys, of="trips": df.groupBy(*keys).agg(F.sum(of).alias(name))
    extremes = extreme_details(trips, rolled)
    maps = bike_bitmaps(trips)
    averages = measured(pair_averages(rolled), "pair-averages")
    shares = workspace.materialize(shares_around_average(trips, averages), "shares")
    longest = at_max(extremes, "duration")
    return {
        "r1": by(months, "total_trip", "month_year"),
        "r2": by(months, "trip_count", "month_year", F.col("passholder_type").alias("pass_type")),
        "r3": by(months.where(F.col("passholder_type") == pass_type), "monthly_pass_total", "month_year", *_STATIONS),
        "r4": reports.most_long_rides(by(longest, "No_of_LongDuration_ride", *_STATIONS)),
        "r5": bikes_by_type_month(maps),
        "r6": bikes_by_category_month(maps),
        "r7": by(routes.where(F.col("trip_route_category").isNotNull()), "total_trip", "bike_type", "trip_route_category"),
        "r8": by(routes, "total_duration", "bike_type", of="total"),
        "r9": reports.first_details(longest),
        "r10": reports.first_details(at_min(extremes, "duration")),
        "r11": reports.most_used(by(routes, "total_bike", "start_station_name", "start_station", "bike_type", of="bikes")),
        "r12": reports.bike_types_between_stations(routes),
        "r13": reports.trips_with_pair_average(trips, averages),
        "r14": reports.delay_percentage(trips, shares),
        "r15": reports.good_percentage(trips, shares),
        "r16": routes.groupBy("start_station", "end_station").agg(F.min("least").alias("min_duration")),
    }
