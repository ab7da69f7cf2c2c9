"""Durations of station pairs.

Tasks combine the trips of a pair before anything is shuffled, so a pair that
holds a third of all trips costs no more than another. What comes out is small
next to the trips and is sent to them: the trips themselves are not moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.operators.lookup import Lookup, lookup_join, measured

PAIR = ("start_station_name", "end_station_name")


def pair_durations(trips: DataFrame) -> DataFrame:
    """Average, least and greatest duration of each pair of station names."""
    return trips.groupBy(*PAIR).agg(
        F.avg("duration").alias("avg"),
        F.min("duration").alias("least"),
        F.max("duration").alias("greatest"),
    )


def averages_of(durations: Lookup) -> Lookup:
    """The averages among written pair durations."""
    return Lookup(durations.df.select(*PAIR, "avg"), durations.rows, durations.bytes)


def written_averages(trips: DataFrame) -> Lookup:
    """Average duration of each pair, written and measured."""
    return measured(
        trips.groupBy(*PAIR).agg(F.avg("duration").alias("avg")), "pair-averages"
    )


def shares_around_average(
    trips: DataFrame, averages: Lookup | None = None
) -> DataFrame:
    """Per bike type: trips below, and at or above, their pair's average.

    All trips of the type are in ``total``: also those without a duration and
    those without a station name, which are neither below nor above.
    """
    if averages is None:
        averages = written_averages(trips)
    return shares_of(
        lookup_join(
            trips.select(*PAIR, "duration", "bike_type"), averages, PAIR, how="left"
        )
    )


def shares_of(trips: DataFrame) -> DataFrame:
    """``shares_around_average`` of trips that have their pair's ``avg`` beside them."""
    return (
        trips.groupBy("bike_type")
        .agg(
            F.sum(F.when(F.col("duration") < F.col("avg"), 1)).alias("below"),
            F.sum(F.when(F.col("duration") >= F.col("avg"), 1)).alias("not_below"),
            F.count(F.lit(1)).alias("total"),
        )
        .filter(F.col("bike_type").isNotNull())
    )
