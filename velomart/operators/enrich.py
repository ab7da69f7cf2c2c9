"""The steps that turn raw trips into enriched ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.functions.dates import mixed_date
from velomart.operators.lookup import (
    BROADCAST_BYTES,
    HOT_SHARE,
    Lookup,
    lookup_join,
    measured,
)


def parse_times(trips: DataFrame) -> DataFrame:
    """Replace the two time texts by dates; the time of day is not kept."""
    return trips.withColumns(
        {
            "start_station_time": mixed_date(F.col("start_time")),
            "end_station_time": mixed_date(F.col("end_time")),
        }
    ).drop("start_time", "end_time")


def bike_types(recent: DataFrame) -> DataFrame:
    """Distinct (bike, type) pairs of the recent trips."""
    return recent.select("bike_id", "bike_type").distinct()


def join_bike_type(
    trips: DataFrame,
    recent: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Give each trip the type its bike has in the recent trips.

    Trips of a bike not seen there are dropped, those of a bike seen with two
    types are doubled, and a type the trip file itself carries is ignored.
    """
    return with_bike_type(trips, written_types(recent), broadcast_bytes, hot_share)


def written_types(recent: DataFrame) -> Lookup:
    return measured(bike_types(recent), "bike-types")


def with_bike_type(
    trips: DataFrame,
    types: Lookup,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
    hot: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The same from a written lookup, and with its hot keys where they are known."""
    return lookup_join(
        trips.drop("bike_type"), types, ["bike_id"], broadcast_bytes, hot_share, hot=(hot or {}).get("bike_id")
    )


def join_stations(
    trips: DataFrame,
    stations: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Add both station names; trips with an unknown end are dropped.

    The station table is written and measured once, then joined in two roles.
    """
    return with_stations(trips, written_names(stations), broadcast_bytes, hot_share)


def written_names(stations: DataFrame) -> Lookup:
    return measured(stations.select("station_id", "station_name"), "stations")


def with_stations(
    trips: DataFrame,
    names: Lookup,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
    hot: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The same from a written lookup, and with the hot keys of both roles where they are known."""
    for role in ("start", "end"):
        key = f"{role}_station"
        in_role = names.df.select(
            F.col("station_id").alias(key),
            F.col("station_name").alias(f"{key}_name"),
        )
        trips = lookup_join(
            trips,
            Lookup(in_role, names.rows, names.bytes),
            [key],
            broadcast_bytes,
            hot_share,
            hot=(hot or {}).get(key),
        )
    return trips
