"""Files: CSV of both widths, classification by name, archives."""

import io
import zipfile
from datetime import date

import pytest
from frames import rows
from pyspark.sql import functions as F

from velomart.__main__ import main
from velomart.functions.names import file_kind, last_segment
from velomart.plans.mart import build_mart_from_folder
from velomart.plans.reports import REPORTS
from velomart.schema import STATION_FILE, TRIP_FILE
from velomart.sources import archives
from velomart.sources.archives import archive_lines, read_archives
from velomart.sources.trips import (
    classify_files,
    list_files,
    read_stations,
    read_trips,
)

HEADER = TRIP_FILE.names


def line(trip, duration, start, station=1, bike="b1", kind=None):
    fields = [trip, duration, start, start, station, 1.5, -2.5, station, 1.5, -2.5]
    fields += [bike, 30, "One Way", "Monthly Pass"]
    if kind is not None:
        fields.append(kind)
    return ",".join(map(str, fields))


def csv_text(width, *lines):
    return "\n".join([",".join(HEADER[:width]), *lines]) + "\n"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "trips-2018-Q4.CSV").write_text(
        csv_text(14, line(1, 100, "12/31/2018 9:05"), line(2, 9, "1/2/2018 9:05"))
    )
    (tmp_path / "trips-2021-q1.csv").write_text(
        csv_text(15, line(3, 20, "2021-01-02 03:04:05", kind="electric"))
    )
    (tmp_path / "stations.csv").write_text("1,Main,7/7/2016,Downtown,Active\n")
    (tmp_path / "stations.CSV").write_text("1,Never read,,,\n")
    (tmp_path / "readme-q.txt").write_text("not a table\n")
    return tmp_path


def test_both_widths_are_typed(spark, folder):
    df = read_trips(spark, str(folder), by_kind=True)
    assert df.schema == TRIP_FILE
    got = rows(df.select("trip_id", "duration", "bike_id", "bike_type", "start_lat"))
    assert got == [
        (1, 100, "b1", None, 1.5),
        (2, 9, "b1", None, 1.5),
        (3, 20, "b1", "electric", 1.5),
    ]
    assert df.agg(F.max("duration"), F.min("duration")).first()[:] == (100, 9)


def test_ids_beyond_32_bits_are_kept(spark, tmp_path):
    (tmp_path / "q.csv").write_text(csv_text(14, line(5_000_000_000, 1, "x")))
    assert read_trips(spark, str(tmp_path)).first().trip_id == 5_000_000_000


def test_scan_of_named_files_reads_no_others(spark, folder):
    df = read_trips(spark, str(folder), file_names=["trips-2021-q1.csv"])
    assert [r.trip_id for r in df.collect()] == [3]
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 1


def test_several_paths(spark, folder):
    paths = [str(folder / "trips-2018-Q4.CSV"), str(folder / "trips-2021-q1.csv")]
    assert read_trips(spark, paths).count() == 3


def test_stations_with_and_without_header(spark, folder, tmp_path):
    df = read_stations(spark, str(folder), by_kind=True)
    assert df.schema == STATION_FILE
    assert rows(df) == [(1, "Main", "7/7/2016", "Downtown", "Active")]
    named = tmp_path / "named"
    named.mkdir()
    (named / "stations.csv").write_text("id,name,date,type,status\n1,Main,,,Active\n")
    assert rows(read_stations(spark, str(named), header=True)) == [
        (1, "Main", None, None, "Active")
    ]


@pytest.mark.parametrize(
    "name, kind",
    [
        ("trips-2020-Q4.CSV", "trips"),
        ("trips-2020-q4.csv.gz", "trips"),
        ("stations.csv", "stations"),
        ("stations.CSV", None),
        ("readme-q.txt", None),
        ("notes.txt", None),
        (None, None),
    ],
)
def test_file_kind(spark, name, kind):
    df = spark.createDataFrame([(name,)], "name string")
    assert df.select(file_kind(F.col("name"))).first()[0] == kind


def test_files_are_listed_and_classified(spark, folder):
    got = classify_files(list_files(spark, str(folder))).select("file_name", "kind")
    assert rows(got) == [
        ("readme-q.txt", None),
        ("stations.CSV", None),
        ("stations.csv", "stations"),
        ("trips-2018-Q4.CSV", "trips"),
        ("trips-2021-q1.csv", "trips"),
    ]


@pytest.mark.parametrize(
    "url, name",
    [
        ("https://x.example/a/b.zip", "b.zip"),
        ("https://x.example/a/", ""),
        ("b.zip", "b.zip"),
        ("", ""),
        (None, None),
    ],
)
def test_last_segment(spark, url, name):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(last_segment(F.col("url"))).first()[0] == name


def test_mart_from_one_folder(spark, folder):
    mart = build_mart_from_folder(spark, str(folder), ["trips-2021-q1.csv"])
    got = rows(mart.select("trip_id", "bike_type", "start_station_name"))
    assert got == [(i, "electric", "Main") for i in (1, 2, 3)]
    assert mart.filter("start_station_time is null").count() == 0


def test_job_from_folder_to_reports(spark, folder, tmp_path, capsys):
    main(
        [
            *("--folder", str(folder), "--recent", "trips-2021-q1.csv"),
            *("--mart", str(tmp_path / "mart"), "--reports", str(tmp_path / "out")),
        ]
    )
    assert capsys.readouterr().out.splitlines()[0] == "r1 total_users_per_month"

    def report(key):
        return rows(spark.read.parquet(str(tmp_path / "out" / REPORTS[key].table)))

    assert report("r1") == [
        (date(2018, 1, 1), 1),
        (date(2018, 12, 1), 1),
        (date(2021, 1, 1), 1),
    ]
    assert report("r4") == [(1, "Main", 1)]
    assert report("r8") == [("electric", 129)]
    assert report("r14") == [("electric", 200 / 3)]


def zipped(**members):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name.replace("__", "."), text)
    return packed.getvalue()


def test_archives_on_disk(spark, tmp_path):
    first = csv_text(14, line(1, 5, "1/2/2018 9:05"), "", line(2, 6, "1/2/2018 9:05"))
    second = csv_text(15, line(3, 7, "1/2/2018 9:05", kind="electric"))
    (tmp_path / "a.zip").write_bytes(
        zipped(one__csv="﻿" + first.replace("\n", "\r\n"), readme__txt="no\n")
    )
    (tmp_path / "b.zip").write_bytes(zipped(dir__csv=second, empty__csv=""))
    (tmp_path / "c.txt").write_text("not an archive")
    df = read_archives(spark, str(tmp_path), TRIP_FILE)
    assert df.schema == TRIP_FILE
    assert rows(df.select("trip_id", "duration", "bike_type")) == [
        (1, 5, None),
        (2, 6, None),
        (3, 7, "electric"),
    ]


def test_archive_without_header(spark, tmp_path):
    (tmp_path / "s.zip").write_bytes(zipped(stations__csv='1,"Main, 1st",,,Active\n'))
    df = read_archives(spark, str(tmp_path), STATION_FILE, header=False)
    assert rows(df) == [(1, "Main, 1st", None, None, "Active")]


def test_long_members_come_in_batches(spark, monkeypatch):
    import pandas as pd

    monkeypatch.setattr(archives, "_BATCH_LINES", 10)
    text = "".join(f"{i}\n" for i in range(95))
    frame = pd.DataFrame({"path": ["a.zip"], "content": [zipped(a__csv=text)]})
    batches = list(archives._lines("utf-8")(iter([frame])))
    assert [len(b) for b in batches] == [10] * 9 + [5]
    assert [int(v) for b in batches for v in b["line"]] == list(range(95))


def test_a_broken_archive_is_an_error(spark):
    bad = spark.createDataFrame([("x.zip", bytearray(b"nonsense"))], "path string, content binary")
    with pytest.raises(Exception, match="(?i)zip"):
        archive_lines(bad).collect()


def test_named_trip_files_must_exist(spark, tmp_path):
    row = ",".join(["1"] * len(HEADER))
    for name in ("trips 2021 q1.csv", "trips-2021-q2.csv"):
        (tmp_path / name).write_text(",".join(HEADER) + "\n" + row + "\n")
    folder = str(tmp_path)
    both = ["trips 2021 q1.csv", "trips-2021-q2.csv"]
    assert read_trips(spark, folder, file_names=both).count() == 2
    assert read_trips(spark, folder, file_names=both[:1]).count() == 1
    for names in (["trips-2021-q3.csv"], [both[0], "trips-2021-Q2.csv"]):
        with pytest.raises(FileNotFoundError, match="no such trip files"):
            read_trips(spark, folder, file_names=names)


def packed(tmp_path, members):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        for name, data in members.items():
            archive.writestr(name, data)
    return str(tmp_path)


def test_archive_members_are_told_apart(spark, tmp_path):
    folder = packed(
        tmp_path,
        {
            "in/trips-q1.csv": "\n \ntrip_id,duration\n1,5\n",
            "stations.csv": "9,Main,,,Active\n",
            "__MACOSX/in/._trips-q1.csv": "junk\njunk\n",
            "in/._trips-q2.csv": "junk\njunk\n",
        },
    )
    trips = read_archives(spark, folder, TRIP_FILE, kind="trips")
    assert [(r.trip_id, r.duration) for r in trips.collect()] == [(1, 5)]
    stations = read_archives(spark, folder, STATION_FILE, header=False, kind="stations")
    assert [r.station_id for r in stations.collect()] == [9]


def test_archive_bytes_are_not_altered(spark, tmp_path):
    folder = packed(tmp_path, {"s.csv": b"9,Caf\xe9,,,Active\n"})
    latin = read_archives(spark, folder, STATION_FILE, header=False, encoding="latin-1")
    assert [r.station_name for r in latin.collect()] == ["Café"]
    with pytest.raises(Exception, match="decode"):
        read_archives(spark, folder, STATION_FILE, header=False).collect()
