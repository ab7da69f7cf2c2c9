"""Dates, the bike-type lookup, the two station lookups."""

from datetime import date

import pytest
from frames import raw_trips, rows
from pyspark.sql import functions as F

from velomart.functions.dates import mixed_date, month_bucket
from velomart.operators.enrich import join_bike_type, join_stations, parse_times
from velomart.plans.mart import build_mart
from velomart.schema import ENRICHED_TRIP, STATION_FILE


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2021-01-02 03:04:05", date(2021, 1, 2)),
        ("01/02/2021 03:04", date(2021, 1, 2)),
        ("1/2/2021 3:04", date(2021, 1, 2)),
        ("13/2/2021 3:04", None),
        ("2021-01-02 03:04", None),
        ("2021-1-2 3:04:05", None),
        ("1/2/2021", None),
        ("2021/01/02 03:04:05", None),
        ("bad", None),
        ("", None),
        (None, None),
    ],
)
def test_mixed_date(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(mixed_date(F.col("s"))).first()[0] == expected


def test_mixed_date_equals_trying_both_formats(spark):
    texts = [
        f"{m}{sep}{d}{sep}{y}{tail}"
        for m in ("1", "01", "12", "13", "2021", "-1")
        for d in ("2", "02", "31", "32")
        for y in ("2021", "21", "1", "02", "12021", "-2021")
        for sep in ("/", "-")
        for tail in ("", " 3:04", " 03:04:05", " 24:00", "T03:04:05", " 03:04 ")
    ]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    s = F.col("s")
    both = F.coalesce(
        F.try_to_date(s, "yyyy-MM-dd HH:mm:ss"), F.try_to_date(s, "M/d/yyyy H:mm")
    )
    assert df.filter(~mixed_date(s).eqNullSafe(both)).collect() == []
    assert df.filter(both.isNotNull()).count() > 0


def test_month_bucket_is_the_first_day(spark):
    df = spark.createDataFrame([(date(2021, 12, 31),), (None,)], "d date")
    months = df.select(month_bucket(F.col("d"))).collect()
    assert [m[0] for m in months] == [date(2021, 12, 1), None]


def test_parse_times_replaces_the_texts(spark):
    df = parse_times(raw_trips(spark, {"start_time": "1/2/2021 3:04", "end_time": "x"}))
    assert "start_time" not in df.columns and "end_time" not in df.columns
    row = df.first()
    assert row.start_station_time == date(2021, 1, 2)
    assert row.end_station_time is None


def test_bike_type_comes_from_the_lookup(spark):
    fact = raw_trips(
        spark,
        {"trip_id": 1, "bike_id": "b1", "bike_type": "ignored"},
        {"trip_id": 2, "bike_id": "unknown"},
        {"trip_id": 3, "bike_id": None},
    )
    recent = raw_trips(
        spark,
        {"bike_id": "b1", "bike_type": "electric"},
        {"bike_id": "b1", "bike_type": "electric"},
        {"bike_id": None, "bike_type": "standard"},
    )
    joined = join_bike_type(fact, recent).select("trip_id", "bike_id", "bike_type")
    assert rows(joined) == [(1, "b1", "electric")]


def test_a_bike_with_two_types_doubles_its_trips(spark):
    fact = raw_trips(spark, {"trip_id": 1, "bike_id": "b1"})
    recent = raw_trips(
        spark,
        {"bike_id": "b1", "bike_type": "electric"},
        {"bike_id": "b1", "bike_type": "standard"},
    )
    joined = join_bike_type(fact, recent).select("trip_id", "bike_type")
    assert rows(joined) == [(1, "electric"), (1, "standard")]


def test_stations_in_two_roles(spark):
    stations = spark.createDataFrame(
        [(1, "A", None, None, None), (2, "B", None, None, None)], STATION_FILE
    )
    fact = raw_trips(
        spark,
        {"trip_id": 1, "start_station": 1, "end_station": 2},
        {"trip_id": 2, "start_station": 2, "end_station": 2},
        {"trip_id": 3, "start_station": 9, "end_station": 2},
        {"trip_id": 4, "start_station": 1, "end_station": 9},
        {"trip_id": 5, "start_station": None, "end_station": 1},
    )
    named = join_stations(fact, stations).select(
        "trip_id", "start_station_name", "end_station_name"
    )
    assert rows(named) == [(1, "A", "B"), (2, "B", "B")]


def test_station_names_are_the_same_without_broadcast(spark):
    stations = spark.createDataFrame(
        [(i, f"S{i % 7}", None, None, None) for i in range(10)], STATION_FILE
    )
    fact = raw_trips(
        spark,
        *(
            {"trip_id": i, "start_station": 1 if i % 2 else i % 12, "end_station": i % 11}
            for i in range(300)
        ),
    )
    keep = ("trip_id", "start_station_name", "end_station_name")
    small = join_stations(fact, stations).select(*keep)
    large = join_stations(fact, stations, broadcast_bytes=0, hot_share=0.05)
    assert rows(small) == rows(large.select(*keep))


def test_build_mart_has_the_enriched_columns(spark):
    fact = raw_trips(
        spark,
        {
            "trip_id": 1,
            "duration": 9,
            "start_time": "2021-01-02 03:04:05",
            "end_time": "1/3/2021 3:04",
            "start_station": 1,
            "end_station": 1,
            "bike_id": "b1",
            "bike_type": "electric",
        },
    )
    stations = spark.createDataFrame([(1, "A", None, None, None)], STATION_FILE)
    mart = build_mart(fact, fact, stations)
    assert mart.columns == ENRICHED_TRIP.names
    assert [t for _, t in mart.dtypes] == [f.dataType.simpleString() for f in ENRICHED_TRIP]
    row = mart.first()
    assert (row.start_station_time, row.end_station_time) == (
        date(2021, 1, 2),
        date(2021, 1, 3),
    )
    assert (row.bike_type, row.start_station_name, row.end_station_name) == (
        "electric",
        "A",
        "A",
    )
