"""Shared roll-ups, bitmaps and checksums against the separate forms."""

import os
import random
import re
from datetime import date

import duckdb
import pytest
from frames import plan, rows, trips
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from velomart import fixtures, workspace
from velomart.functions.checksum import checksum, checksum_sql
from velomart.operators.bitmaps import bitmaps, dictionary, distinct_counts
from velomart.plans import rollups
from velomart.plans.publish import publish_folder, published, run_all
from velomart.plans.reports import REPORTS
from velomart.schema import MART
from velomart.sinks.mart import write_mart
from velomart.sinks.reports import parquet_sink
from velomart.workspace import fresh_path, materialize, scope, work_dir

SF_DIR = "/root/testdata/sf0.001"


def awkward(spark):
    """Trips with NULL in any column, ties, repeated rows and names shared by stations."""
    rng = random.Random(3)
    pick = lambda *v: rng.choice([*v, None])
    made = [
        {
            "trip_id": pick(i),
            "duration": pick(1, 5, 5, 9),
            "start_station_time": pick(date(2021, 1, 2), date(2021, 2, 28)),
            "start_station": pick(1, 2),
            "start_station_name": pick("A", "B"),
            "end_station": pick(1, 2),
            "end_station_name": pick("A", "B"),
            "bike_id": pick("x", "y", "z"),
            "bike_type": pick("e", "s"),
            "passholder_type": pick("Monthly Pass", "Flex"),
            "trip_route_category": pick("one", "two"),
        }
        for i in range(400)
    ]
    return trips(spark, *made, *made[:30])


@pytest.mark.parametrize("case", ["awkward", "nothing", "no durations", "given"])
def test_shared_reports_equal_separate_ones(spark, case):
    df = {
        "awkward": lambda: awkward(spark),
        "nothing": lambda: awkward(spark).limit(0),
        "no durations": lambda: awkward(spark).withColumn("duration", F.lit(None).cast("int")),
        "given": lambda: fixtures.trips(spark, SF_DIR),
    }[case]()
    shared = rollups.shared_reports(df)
    assert list(shared) == list(REPORTS)
    for key, report in REPORTS.items():
        alone = report.build(df)
        assert shared[key].dtypes == alone.dtypes, key
        assert rows(shared[key]) == rows(alone), key


def test_publishing_scans_the_mart_at_most_eight_times(spark, monkeypatch):
    mart = fresh_path(spark, "counted-mart")
    write_mart(fixtures.trips(spark, SF_DIR), mart)
    plans = []
    plain = DataFrameWriter.parquet

    def writing(writer, *args, **more):
        plans.append(plan(writer._df))
        return plain(writer, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", writing)
    run_all(spark.read.parquet(mart), parquet_sink(fresh_path(spark, "reports")), fixtures.PASS_TYPE)
    name = os.path.basename(mart)
    scans = sum(len(re.findall(rf"Location: .*{name}", p)) for p in plans)
    assert 0 < scans <= 8


def test_every_scan_reads_only_what_it_needs(spark):
    mart = fresh_path(spark, "mart")
    write_mart(fixtures.trips(spark, SF_DIR), mart)
    rolled = rollups.rollups(spark.read.parquet(mart))
    shown = plan(rollups.extreme_details(spark.read.parquet(mart), rolled))
    assert "plan_duration" not in shown
    maps = plan(bitmaps(spark.read.parquet(mart), ["bike_type"], "bike_id"))
    # Only groups with bitmaps are shuffled, not rows of groups and bikes.
    assert set(re.findall(r"hashpartitioning\(([\w#, ]+?), 8\)", maps)) and "bike_id" not in "".join(
        re.findall(r"hashpartitioning\(([^)]*)\)", maps)
    )


def test_a_publish_leaves_no_working_tables(spark, tmp_path):
    folder = fixtures.export_trips(spark, SF_DIR)
    stations = fixtures.export_stations(fixtures.station_table(spark, SF_DIR))
    both = tmp_path / "files"
    both.mkdir()
    for k, (source, kind) in enumerate(((folder, "trips-2021-q{}.csv"), (stations, "stations-{}.csv"))):
        found = [os.path.join(d, f) for d, _, fs in os.walk(source) for f in fs if f.endswith(".csv")]
        for i, path in enumerate(found):
            os.symlink(path, both / kind.format(f"{k}{i}"))
    names = sorted(f for f in os.listdir(both) if f.startswith("trips"))
    before = set(os.listdir(work_dir(spark)))
    out = str(tmp_path / "reports")
    tables = publish_folder(spark, str(both), names, str(tmp_path / "mart"), parquet_sink(out), fixtures.PASS_TYPE)
    assert set(os.listdir(work_dir(spark))) == before
    counts = {r["report"]: r["n_rows"] for r in published(spark, out, tables).collect()}
    assert len(counts) == 16 and counts["r13"] > 1000


def test_scopes_nest_and_close_on_failure(spark):
    before = set(os.listdir(work_dir(spark)))
    kept = None
    with pytest.raises(RuntimeError), scope(spark):
        outer = materialize(spark.range(2), "outer")
        with scope(spark):
            materialize(spark.range(3), "inner")
        assert len(set(os.listdir(work_dir(spark))) - before) == 1
        assert outer.count() == 2
        raise RuntimeError
    assert set(os.listdir(work_dir(spark))) == before
    kept = materialize(spark.range(5), "kept")
    assert workspace._scope.get() is None and kept.count() == 5


# Bitmaps


@pytest.mark.parametrize("n", [0, 1, 40_000, 100_001])
def test_bitmap_counts_equal_distinct_counts(spark, n):
    """More numbers than a bucket holds; NULL values, and groups of nothing else."""
    df = spark.range(n).selectExpr(
        "cast(if(id % 11 = 3, null, id % 70001) as string) as bike", "id % 5 as a", "if(id % 7 = 0, null, id % 3) as b"
    ).unionByName(spark.createDataFrame([(None, 99, 99)], "bike string, a long, b long"))
    maps = materialize(bitmaps(df, ["a", "b"], "bike"))
    for keys in (["a", "b"], ["a"], ["b"], []):
        want = df.groupBy(*keys).agg(F.count_distinct("bike").alias("n"))
        assert rows(distinct_counts(maps, keys, "n")) == rows(want), keys


def test_dictionary_is_dense(spark):
    df = spark.range(5000).selectExpr("cast(id % 1234 as string) as v").unionByName(
        spark.createDataFrame([(None,), ("",)], "v string")
    )
    got = rows(dictionary(df, "v"))
    assert sorted(n for _, n in got) == list(range(1, 1236))
    assert len({v for v, _ in got}) == 1235


# Checksums

COLUMNS = "i int, l long, s string, d date, x double"


def some_rows(rng, n):
    pick = lambda *v: rng.choice([*v, None])
    return [
        (
            pick(rng.randrange(-9, 9)),
            pick(rng.randrange(-(1 << 62), 1 << 62)),
            pick("", "~", "=", "a\x1fb", "é日本", "it's"),
            pick(date(2021, 1, 2), date(1999, 12, 31)),
            pick(rng.random() * 100, 1 / 3, -0.0, 12345678.25, -2.5),
        )
        for _ in range(n)
    ]


def of(df):
    return tuple(checksum(df).first())


def test_checksum_equals_the_sql_one(spark):
    import pandas as pd  # noqa: F401

    rng = random.Random(1)
    for n in (0, 1, 300):
        data = some_rows(rng, n)
        df = spark.createDataFrame(data, COLUMNS)
        con = duckdb.connect()
        con.execute("create table t (i int, l bigint, s varchar, d date, x double)")
        for r in data:
            con.execute("insert into t values (?,?,?,?,?)", r)
        sql = checksum_sql("select * from t", ["x", "d", "s", "l", "i"], ("x",))
        assert con.execute(sql).fetchall() == [of(df)]


def test_checksum_shows_changes_but_not_order(spark):
    data = some_rows(random.Random(2), 60)
    df = spark.createDataFrame(data, COLUMNS)
    whole = of(df)
    assert of(df.repartition(7).select("x", "i", "s", "l", "d")) == whole
    assert of(spark.createDataFrame(data[1:], COLUMNS)) != whole
    assert of(spark.createDataFrame([*data, data[0]], COLUMNS)) != whole
    for c in df.columns:  # a value moved between two rows
        order = [{**dict(zip(df.columns, r))} for r in data]
        a, b = next((i, j) for i in range(60) for j in range(60) if order[i][c] != order[j][c])
        order[a][c], order[b][c] = order[b][c], order[a][c]
        moved = [tuple(r[k] for k in df.columns) for r in order]
        if sorted(map(str, moved)) != sorted(map(str, data)):
            assert of(spark.createDataFrame(moved, COLUMNS)) != whole
    assert of(df.limit(0)) == (0, 0)


def test_mart_schema_has_a_checksum(spark):
    assert of(spark.createDataFrame([], MART)) == (0, 0)
