"""Marts that are built a part of the trips after the other."""

import os

import pytest
from frames import rows

from velomart import fixtures, workspace
from velomart.plans.mart import build_mart, land_mart
from velomart.sinks import mart as sinks
from velomart.sources.mart import SUMMARY, UNFINISHED, month_extremes, read_extremes, read_mart
from velomart.sources.trips import read_stations, read_trips, trip_parts
from velomart.workspace import fresh_path, scope


@pytest.fixture
def orders(spark, tmp_path):
    """The order tables, with keys that are null or come twice."""
    day = "timestamp_ntz'2001-01-31 10:00:00' + make_dt_interval(cast(id * 11 as int))"
    tables = {
        "region": "select 0 as r_regionkey, 'R' as r_name",
        "nation": "select cast(id as int) as n_nationkey, concat('N', id) as n_name, 0 as n_regionkey from range(3)",
        "customer": "select nullif(id, 4) as c_custkey, cast(id % 3 as int) as c_nationkey, 'MACHINERY' as c_mktsegment from range(9)",
        "supplier": "select id as s_suppkey, 's' as s_name, cast(id % 3 as int) as s_nationkey, 0D as s_acctbal from range(4)",
        "part": "select id % 6 as p_partkey, concat('T', id) as p_type from range(7)",
        "orders": f"select nullif(id % 37, 5) as o_orderkey, nullif(id % 10, 2) as o_custkey, 'O' as o_orderstatus, {day} as o_orderdate from range(40)",
        "lineitem": f"""select nullif(id % 37, 6) as l_orderkey, id % 6 as l_partkey, id % 4 as l_suppkey, cast(id % 5 as int) as l_linenumber,
            cast(id % 20 as double) as l_quantity, 'N' as l_returnflag, {day} as l_shipdate from range(200)""",
    }
    for name, sql in tables.items():
        spark.sql(sql).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_trips_exported_in_parts_are_those_exported_at_once(spark, orders):
    whole = fixtures.export_trips(spark, orders)
    in_parts = fixtures.export_trips(spark, orders, part_bytes=workspace.size(spark, f"{orders}/lineitem.parquet") // 3)
    expected = rows(fixtures.raw_trips(spark, orders).drop("quarter"))
    assert len(expected) > 150
    assert rows(read_trips(spark, whole)) == rows(read_trips(spark, in_parts)) == expected


def test_a_part_holds_whole_files_and_each_file_is_in_one(spark, orders):
    folder = fixtures.export_trips(spark, orders)
    files = [os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(folder) for f in fs if f.endswith(".csv")]
    parts = trip_parts(spark, folder, part_bytes=2 * max(files))
    assert 1 < len(parts) < len(files)
    read = [sorted(r[0] for r in p.select("_metadata.file_path").distinct().collect()) for p in parts]
    assert sum(map(len, read)) == len(set(sum(read, []))) == len(files)
    assert sum(read, []) == sorted(sum(read, []))
    assert len(trip_parts(spark, folder, part_bytes=1)) == len(files)
    assert len(trip_parts(spark, folder)) == 1


def test_a_mart_landed_in_parts_is_the_whole_one(spark, orders, monkeypatch):
    written = []
    monkeypatch.setattr(sinks, "_write", lambda *a, plain=sinks._write: written.append(a[0]) or plain(*a))
    with scope(spark):
        folder = fixtures.export_trips(spark, orders)
        trips, stations = read_trips(spark, folder), read_stations(spark, fixtures.export_stations(fixtures.station_table(spark, orders)))
        parts = trip_parts(spark, folder, part_bytes=2000)
        path = fresh_path(spark, "landed")
        for _ in range(2):  # the second one replaces the first
            land_mart(trips, parts, trips, stations, path)
        assert len(written) == 2 * len(parts) > 4
        built = build_mart(trips, trips, stations)
        mart = read_mart(spark, path)
        assert rows(mart.select(*built.columns)) == rows(built)
        assert workspace.exists(spark, f"{path}/{SUMMARY}")
        assert rows(read_extremes(spark, path)) == rows(month_extremes(mart).select("month_year", "least", "greatest", "trips"))
    assert not workspace.exists(spark, folder)  # the trip files were those of the scope


def test_a_mart_with_missing_parts_is_not_read(spark, orders):
    path = fresh_path(spark, "unfinished")
    folder = fixtures.export_trips(spark, orders)

    def fails(trips):
        if trips is not parts[0]:
            raise RuntimeError
        return build_mart(trips, trips, fixtures.station_table(spark, orders))

    parts = trip_parts(spark, folder, part_bytes=1)
    with pytest.raises(RuntimeError):
        sinks.write_mart_in_parts(parts, path, fails)
    assert workspace.exists(spark, f"{path}/{UNFINISHED}")
    with pytest.raises(ValueError, match="not written to its end"):
        read_mart(spark, path)
