"""Damaged rows of trip files: told apart, counted by file, kept as text."""

import pytest
from frames import plan, rows
from test_sources import csv_text, line

from velomart.schema import TRIP_FILE
from velomart.sources.rescue import faults_by_file, read_trips_with_faults, rescue_trips
from velomart.sources.trips import read_trips

WHOLE = line(1, 10, "2021-01-02 03:04:05", kind="electric")
OLDER = line(2, 20, "1/2/2018 9:05")
BAD = line("x7", 30, "2021-01-02 03:04:05", kind="electric")
BAD_OLDER = line(4, "long", "1/2/2018 9:05")
SURPLUS = line(5, 50, "2021-01-02 03:04:05", kind="electric") + ",more"
SHORT = "6,60,1/2/2018 9:05"
QUOTED = line(7, 70, "1/2/2018 9:05", bike='"b,1"')
QUOTED_SURPLUS = line(8, 80, "1/2/2018 9:05", bike='"b,1"', kind="electric") + ","
BLANKS = "9" + "," * 14
BAD_AND_SHORT = "y,90"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "trips-a.csv").write_text(csv_text(15, WHOLE, BAD, SURPLUS, SHORT, BLANKS, "", QUOTED_SURPLUS))
    (tmp_path / "trips-b.csv").write_text(csv_text(14, OLDER, BAD_OLDER, QUOTED, BAD_AND_SHORT))
    (tmp_path / "trips-c.csv").write_text(csv_text(14))
    return str(tmp_path)


def test_faults_are_told_apart_and_lines_kept(spark, folder):
    found = read_trips_with_faults(spark, folder)
    assert rows(found.filter("fault is not null").select("line", "fault")) == sorted(
        [
            (BAD, "bad_value"),
            (BAD_OLDER, "bad_value"),
            (SURPLUS, "surplus_field"),
            (QUOTED_SURPLUS, "surplus_field"),
            (SHORT, "short_row"),
            (BAD_AND_SHORT, "short_row"),
        ],
        key=lambda r: tuple((False, v) for v in r),
    )
    whole = found.filter("fault is null")
    assert sorted(r.trip_id for r in whole.collect()) == [1, 2, 7, 9]
    assert whole.filter("line is not null").count() == 0


def test_rows_are_those_of_the_plain_scan(spark, folder):
    found = read_trips_with_faults(spark, folder)
    assert rows(found.select(*TRIP_FILE.names)) == rows(read_trips(spark, folder))


def test_counts_by_file(spark, folder):
    counts = faults_by_file(read_trips_with_faults(spark, folder))
    assert counts.columns == ["file_name", "n_rows", "bad_value", "short_row", "surplus_field"]
    assert rows(counts) == [("trips-a.csv", 6, 1, 1, 2), ("trips-b.csv", 4, 1, 1, 0)]


def test_faults_do_not_depend_on_what_is_selected(spark, folder):
    found = read_trips_with_faults(spark, folder)
    assert found.select("trip_id", "fault").filter("fault = 'bad_value'").count() == 2
    assert found.filter("fault = 'bad_value'").select("bike_id").count() == 2


def test_whole_rows_go_on_and_damaged_ones_are_written(spark, folder, tmp_path):
    rejects = str(tmp_path / "out" / "rejects")
    whole = rescue_trips(spark, [f"{folder}/trips-a.csv", f"{folder}/trips-b.csv"], rejects)
    assert whole.schema == TRIP_FILE
    assert sorted(r.trip_id for r in whole.collect()) == [1, 2, 7, 9]
    written = spark.read.parquet(rejects)
    assert rows(written.groupBy("fault").count()) == [("bad_value", 2), ("short_row", 2), ("surplus_field", 2)]
    assert "Exchange" not in plan(whole) and "Python" not in plan(whole)


def test_too_many_faults_are_an_error(spark, folder, tmp_path):
    rejects = str(tmp_path / "out" / "rejects")
    paths = [f"{folder}/trips-a.csv"]
    rescue_trips(spark, paths, rejects, most_faults=0.7)
    with pytest.raises(ValueError, match="4 of 6 rows are damaged"):
        rescue_trips(spark, paths, rejects, most_faults=0.5)
    assert spark.read.parquet(rejects).count() == 4


def test_no_files_of_rows(spark, tmp_path):
    (tmp_path / "trips-a.csv").write_text(csv_text(15))
    assert rows(faults_by_file(read_trips_with_faults(spark, str(tmp_path)))) == []
    assert rescue_trips(spark, str(tmp_path), str(tmp_path / "rejects"), 0.0).count() == 0
