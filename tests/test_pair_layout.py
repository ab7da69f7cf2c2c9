"""Trips laid out by pair of stations: same results, no shuffle, hot pairs in many buckets."""

import os

import pytest
from frames import plan, rows, trips

from velomart.operators.pairs import PAIR, shares_around_average, shares_of
from velomart.plans.reports import trips_with_pair_average
from velomart.sinks.pairs import PART, drop_pairs, with_averages, write_pairs
from velomart.workspace import fresh_path

COLUMNS = (*PAIR, "avg", "duration", "bike_type")


@pytest.fixture
def some(spark):
    """Two thirds of the trips are of one pair; equal rows, nulls in every column."""
    made = []
    for i in range(240):
        start, end = ("Main", "Oak") if i % 3 else (f"s{i % 7}", f"e{i % 5}")
        made.append(
            {
                "trip_id": i // 4,
                "start_station_name": None if i % 31 == 0 else start,
                "end_station_name": None if i % 37 == 0 else end,
                "duration": None if i % 11 == 0 else i % 17,
                "bike_type": None if i % 13 == 0 else f"t{i % 2}",
            }
        )
    return trips(spark, *made)


@pytest.fixture
def laid(spark, some):
    path = fresh_path(spark, "pairs")
    layout = write_pairs(some, "pairs_test", path, bucket_rows=20)
    yield layout
    drop_pairs(spark, layout)


def test_averages_equal_those_of_the_report(spark, some, laid):
    assert rows(with_averages(spark, laid).select(*COLUMNS)) == rows(trips_with_pair_average(some).select(*COLUMNS))


def test_shares_equal(spark, some, laid):
    assert rows(shares_of(with_averages(spark, laid, "left"))) == rows(shares_around_average(some))


def test_all_trips_are_kept_unchanged(spark, some, laid):
    assert rows(spark.table(laid.trips).select(*some.columns)) == rows(some)
    assert rows(with_averages(spark, laid, "left").select(*some.columns)) == rows(some)


def test_trips_meet_their_averages_without_a_shuffle(spark, laid):
    physical = plan(with_averages(spark, laid))
    assert "Exchange" not in physical and "ShuffledHashJoin" in physical
    shares = plan(shares_of(with_averages(spark, laid, "left")))
    assert shares.count("Exchange hashpartitioning") <= 1 and "BroadcastExchange" not in shares


def test_hot_pair_is_spread(spark, laid):
    hot = spark.table(laid.trips).filter("start_station_name = 'Main' and end_station_name = 'Oak'")
    assert hot.select(PART).distinct().count() > 10
    assert hot.selectExpr("input_file_name() as f").distinct().count() > 4
    largest = spark.table(laid.trips).groupBy(*PAIR, PART).count().agg({"count": "max"}).first()[0]
    assert largest < 20


def test_dropped_tables_are_gone(spark, some):
    path = fresh_path(spark, "pairs")
    layout = write_pairs(some, "pairs_gone", path)
    drop_pairs(spark, layout)
    assert not spark.catalog.tableExists("pairs_gone") and not os.path.exists(path)


def test_empty_table(spark, some):
    layout = write_pairs(some.limit(0), "pairs_empty", fresh_path(spark, "pairs"))
    assert rows(with_averages(spark, layout)) == []
    assert rows(shares_of(with_averages(spark, layout, "left"))) == []
    drop_pairs(spark, layout)
