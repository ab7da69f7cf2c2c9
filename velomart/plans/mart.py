"""From files to enriched trips."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from velomart.operators.enrich import (
    parse_times,
    with_bike_type,
    with_stations,
    written_names,
    written_types,
)
from velomart.operators.lookup import BROADCAST_BYTES, HOT_SHARE, hot_keys
from velomart.sinks.mart import write_mart_in_parts
from velomart.sources.trips import read_stations, read_trips, trip_parts


def build_mart(
    trips: DataFrame,
    recent: DataFrame,
    stations: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Enriched trips: dates, the bike's type, both station names.

    ``recent`` are the trips that say which type a bike has. The lookups are written
    first. Keys of those that are too large to be sent to the trips are counted in one
    scan of the trips, before any join; the joins then are a second one.
    """
    return mart_builder(trips, recent, stations, broadcast_bytes, hot_share)(trips)


def mart_builder(
    trips: DataFrame,
    recent: DataFrame,
    stations: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
) -> Callable[[DataFrame], DataFrame]:
    """What enriches the trips, or a part of them: the lookups and their hot keys are known."""
    types, names = written_types(recent), written_names(stations)
    large = ["bike_id"] if types.bytes > broadcast_bytes else []
    large += ["start_station", "end_station"] if names.bytes > broadcast_bytes else []
    hot = hot_keys(trips, large, hot_share)

    def build(part: DataFrame) -> DataFrame:
        typed = with_bike_type(parse_times(part), types, broadcast_bytes, hot_share, hot)
        return with_stations(typed, names, broadcast_bytes, hot_share, hot)

    return build


def land_mart(
    trips: DataFrame, parts: Sequence[DataFrame], recent: DataFrame, stations: DataFrame, path: str
) -> None:
    """Build the mart of all ``trips`` and write it, a part of them after the other.

    What a part moves is freed before the next one, so the disk that a build needs besides
    its files and the mart is that of one part.
    """
    write_mart_in_parts(parts, path, mart_builder(trips, recent, stations))


def land_mart_from_folder(
    spark: SparkSession,
    folder: str,
    recent_files: Sequence[str],
    path: str,
    station_header: bool = False,
) -> None:
    """The same from one folder that holds trip and station files together."""
    land_mart(
        read_trips(spark, folder, by_kind=True),
        trip_parts(spark, folder, by_kind=True),
        read_trips(spark, folder, file_names=recent_files),
        read_stations(spark, folder, header=station_header, by_kind=True),
        path,
    )


def build_mart_from_folder(
    spark: SparkSession,
    folder: str,
    recent_files: Sequence[str],
    station_header: bool = False,
) -> DataFrame:
    """``build_mart`` of one folder that holds trip and station files together."""
    return build_mart(
        read_trips(spark, folder, by_kind=True),
        read_trips(spark, folder, file_names=recent_files),
        read_stations(spark, folder, header=station_header, by_kind=True),
    )
