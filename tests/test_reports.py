"""Report semantics on hand-written trips, and equal forms against each other."""

import re
from datetime import date

import pytest
from frames import plan, rows, trips
from pyspark.sql import Window
from pyspark.sql import functions as F

from velomart import fixtures
from velomart.operators import lookup
from velomart.operators.filters import at_max, at_min
from velomart.operators.lookup import Lookup
from velomart.operators.pairs import PAIR, shares_around_average, written_averages
from velomart.plans import reports
from velomart.plans.publish import run_all
from velomart.plans.reports import REPORTS, preview
from velomart.sinks.mart import write_mart
from velomart.sources.mart import read_mart
from velomart.workspace import fresh_path

SF_DIR = "/root/testdata/sf0.001"


def pair(duration, kind, start="A", end="B", **more):
    return {
        "duration": duration,
        "bike_type": kind,
        "start_station_name": start,
        "end_station_name": end,
        **more,
    }


def test_extremes_are_numeric(spark):
    df = trips(spark, {"duration": 9}, {"duration": 100}, {"duration": 20}, {})
    assert at_max(df, "duration").first().duration == 100
    assert at_min(df, "duration").first().duration == 9


def test_extreme_of_nothing_is_nothing(spark):
    assert at_max(trips(spark, {}), "duration").count() == 0


def test_months_of_unparsed_dates_are_counted_under_null(spark):
    df = trips(
        spark,
        {"trip_id": 1, "start_station_time": date(2021, 1, 2)},
        {"trip_id": 2, "start_station_time": date(2021, 1, 30)},
        {"trip_id": 3},
        {"start_station_time": date(2021, 1, 3)},
    )
    assert rows(reports.trips_per_month(df)) == [(date(2021, 1, 1), 2), (None, 1)]


def test_pass_report_filters_exactly_one_pass(spark):
    df = trips(
        spark,
        {"trip_id": 1, "start_station": 1, "passholder_type": "Monthly Pass"},
        {"trip_id": 2, "start_station": 1, "passholder_type": "Flex Pass"},
    )
    assert rows(reports.pass_trips_by_station(df)) == [(None, 1, None, 1)]
    assert rows(reports.pass_trips_by_station(df, "Flex Pass")) == [(None, 1, None, 1)]


def test_duration_report_sums(spark):
    df = trips(spark, pair(9, "e"), pair(100, "e"), pair(None, "s"))
    assert rows(reports.duration_by_type(df)) == [("e", 109), ("s", None)]


def test_distinct_bikes_and_counted_rows(spark):
    df = trips(
        spark,
        *[{"bike_id": "b", "bike_type": "e", "start_station": 1}] * 3,
        {"bike_id": None, "bike_type": "e", "start_station": 1},
    )
    assert rows(reports.bikes_by_type_month(df)) == [(None, "e", 1)]
    assert rows(reports.station_bike_types(df)) == [(None, 1, "e", 3)]


def test_top_k_breaks_ties_by_key(spark):
    df = trips(
        spark,
        *({"trip_id": i, "duration": 5, "start_station": i % 9} for i in range(90)),
    )
    top = reports.stations_of_longest_rides(df).collect()
    assert [r.start_station for r in top] == [0, 1, 2, 3, 4]


def test_details_are_distinct(spark):
    df = trips(spark, *[pair(5, "e", start_station=1)] * 4, pair(4, "e"))
    assert reports.longest_ride_details(df).count() == 1


def test_pair_average_leaves_out_unnamed_trips_and_null_durations(spark):
    df = trips(
        spark,
        pair(10, "e"),
        pair(20, "e"),
        pair(None, "e"),
        pair(99, "e", start=None),
        pair(None, "s", start="C"),
    )
    assert rows(reports.trips_with_pair_average(df)) == [
        ("A", "B", 15.0, 10, "e"),
        ("A", "B", 15.0, 20, "e"),
        ("A", "B", 15.0, None, "e"),
        ("C", "B", None, None, "s"),
    ]


def test_shares_count_all_trips_of_the_type(spark):
    df = trips(
        spark,
        pair(10, "e"),
        pair(20, "e"),
        pair(None, "e"),
        pair(99, "e", start=None),
        pair(7, "s", start="C"),  # its own average: good, never below
        pair(5, None),
    )
    # The pair's average over 10, 20 and 5 is 35/3.
    assert rows(reports.delay_percentage(df)) == [("e", 25.0)]
    assert rows(reports.good_percentage(df)) == [("e", 25.0), ("s", 100.0)]


def test_join_form_equals_window_form(spark):
    df = fixtures.trips(spark, SF_DIR)
    window = df.filter(
        F.col(PAIR[0]).isNotNull() & F.col(PAIR[1]).isNotNull()
    ).select(
        *PAIR,
        F.avg("duration").over(Window.partitionBy(*PAIR)).alias("avg"),
        "duration",
        "bike_type",
    )
    assert rows(reports.trips_with_pair_average(df)) == rows(window)


def test_one_pass_shares_equal_separate_counts(spark):
    df = fixtures.trips(spark, SF_DIR)
    with_average = reports.trips_with_pair_average(df)
    total = df.groupBy("bike_type").agg(F.count(F.lit(1)).alias("total"))

    def share(condition):
        part = with_average.filter(condition).groupBy("bike_type").count()
        return part.join(total, "bike_type").select(
            "bike_type", F.col("count") * 100 / F.col("total")
        )

    assert rows(reports.delay_percentage(df)) == rows(share("duration < avg"))
    assert rows(reports.good_percentage(df)) == rows(share("duration >= avg"))


def test_shares_are_the_same_without_broadcast(spark):
    df = fixtures.trips(spark, SF_DIR).withColumn(
        "start_station_name",
        F.when(F.col("trip_id") % 5 != 0, F.col("start_station_name")),
    )
    expected = rows(shares_around_average(df))
    averages = written_averages(df)
    too_large = Lookup(averages.df, averages.rows, lookup.BROADCAST_BYTES + 1)
    assert rows(shares_around_average(df, too_large)) == expected
    with_average = rows(reports.trips_with_pair_average(df, averages))
    assert rows(reports.trips_with_pair_average(df, too_large)) == with_average


def test_shortest_trip_of_each_pair(spark):
    df = trips(
        spark,
        *(
            {"start_station": 1, "end_station": e, "duration": d}
            for e, d in ((1, 30), (1, 9), (2, 100), (2, None))
        ),
    )
    assert rows(reports.shortest_per_pair(df)) == [(1, 1, 9), (1, 2, 100)]


def test_preview_is_in_reading_order(spark):
    df = reports.duration_by_type(
        trips(spark, pair(1, "a"), pair(3, "b"), pair(2, "c"), pair(None, "d"))
    )
    assert [r.bike_type for r in preview(df, "r8").collect()] == ["b", "c", "a", "d"]
    assert "TakeOrderedAndProject" in plan(preview(df, "r8"))
    assert [r.bike_type for r in preview(df, "r8", 1).collect()] == ["b"]


@pytest.mark.parametrize("key", REPORTS)
def test_every_report_has_its_order_columns(spark, key):
    df = REPORTS[key].build(trips(spark, pair(1, "a")))
    assert {k.lstrip("-") for k in REPORTS[key].order} <= set(df.columns)


def test_reports_are_the_same_over_a_landed_mart(spark):
    df = fixtures.trips(spark, SF_DIR)
    path = fresh_path(spark, "mart")
    write_mart(df, path)
    mart = spark.read.parquet(path)
    for key in ("r1", "r2", "r5", "r6", "r9", "r11", "r14"):
        build = REPORTS[key].build
        assert rows(build(mart)) == rows(build(df)), key


def test_run_all_publishes_every_report_once(spark):
    df = fixtures.trips(spark, SF_DIR)
    published = {}
    tables = run_all(
        df, lambda name, report: published.update({name: report}), fixtures.PASS_TYPE
    )
    assert list(tables) == [f"r{i}" for i in range(1, 17)]
    assert set(tables.values()) == set(published) and len(published) == 16
    for key, table in tables.items():
        options = {"pass_type": fixtures.PASS_TYPE} if key == "r3" else {}
        alone = REPORTS[key].build(df, **options)
        assert rows(published[table]) == rows(alone), key
        assert published[table].dtypes == alone.dtypes, key


def test_a_failing_sink_is_not_swallowed(spark):
    def broken(name, df):
        raise RuntimeError(name)

    with pytest.raises(RuntimeError):
        run_all(trips(spark, pair(1, "a")), broken)


def test_plans_over_the_mart(spark):
    path = fresh_path(spark, "mart")
    write_mart(fixtures.trips(spark, SF_DIR), path)
    mart = spark.read.parquet(path)

    months = plan(reports.trips_per_month(mart))
    assert "ReadSchema: struct<trip_id:bigint>" in months

    passes = plan(reports.pass_trips_by_station(mart))
    assert "EqualTo(passholder_type,Monthly Pass)" in passes

    longest = plan(reports.stations_of_longest_rides(mart))
    assert "EqualTo(duration,ScalarSubquery" in longest
    assert "TakeOrderedAndProject" in longest

    # The averages are broadcast; the trips are neither broadcast nor shuffled.
    average = plan(reports.trips_with_pair_average(mart))
    assert "BroadcastHashJoin Inner BuildRight" in average
    assert "hashpartitioning" not in average

    # Nor are they for the shares: only sums per bike type are.
    shares = plan(reports.delay_percentage(mart))
    assert "BroadcastHashJoin LeftOuter BuildRight" in shares
    assert set(re.findall(r"hashpartitioning\((\w+)#", shares)) == {"bike_type"}

    one_month = plan(
        reports.trips_per_month(mart.filter("month_year = date '1998-01-01'"))
    )
    assert "PartitionFilters: [isnotnull(month_year" in one_month


def test_mart_of_typed_schema_reads_back(spark):
    df = trips(
        spark,
        {"trip_id": 1, "start_station_time": date(2021, 1, 2)},
        {"trip_id": 2},
    )
    path = fresh_path(spark, "mart")
    write_mart(df, path)
    back = read_mart(spark, path)
    assert rows(back.select("trip_id", "month_year")) == [
        (1, date(2021, 1, 1)),
        (2, None),
    ]
    assert rows(back.drop("month_year")) == rows(df)
    write_mart(df.filter("trip_id = 2"), path)
    assert read_mart(spark, path).count() == 1
