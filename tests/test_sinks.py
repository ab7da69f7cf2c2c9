"""Sinks, and the folder that written tables go to."""

import os
from types import SimpleNamespace

import pytest
from frames import rows
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from velomart import workspace
from velomart.sinks.mart import by_month, write_mart
from velomart.sinks.reports import jdbc_sink, parquet_sink, spread
from velomart.sources.mart import read_extremes
from velomart.workspace import fresh_path, materialize, work_dir


def test_parquet_sink_overwrites(spark):
    folder = fresh_path(spark, "reports")
    save = parquet_sink(folder)
    save("t", spark.range(5))
    save("t", spark.range(2))
    assert rows(spark.read.parquet(f"{folder}/t")) == [(0,), (1,)]


def test_jdbc_sink_settings(spark, monkeypatch):
    """What is asked of Spark's JDBC writer; no database is started for it."""
    seen = {"options": {}}
    monkeypatch.setattr(
        DataFrameWriter, "format", lambda w, name: seen.update(format=name) or w
    )
    monkeypatch.setattr(
        DataFrameWriter,
        "option",
        lambda w, key, value: seen["options"].update({key: value}) or w,
    )
    monkeypatch.setattr(
        DataFrameWriter,
        "options",
        lambda w, **more: seen["options"].update(more) or w,
    )
    monkeypatch.setattr(DataFrameWriter, "mode", lambda w, mode: seen.update(mode=mode) or w)
    monkeypatch.setattr(DataFrameWriter, "save", lambda w: seen.update(saved=True))
    save = jdbc_sink(
        "jdbc:some:url", driver="some.Driver", connections=3, properties={"user": "u"}
    )
    save("report_table", spark.range(1))
    assert seen == {
        "format": "jdbc",
        "mode": "overwrite",
        "saved": True,
        "options": {
            "user": "u",
            "url": "jdbc:some:url",
            "dbtable": "report_table",
            "numPartitions": 3,
            "driver": "some.Driver",
        },
    }


def test_few_connections_do_not_narrow_the_scan(spark):
    df = spread(spark.range(0, 1000, 1, 12).withColumn("task", F.spark_partition_id()), 3)
    assert df.rdd.getNumPartitions() == 3
    assert df.agg(F.count_distinct("task")).first()[0] == 12


def test_months_are_gathered_and_a_hot_month_is_split(spark):
    """Few files per month, yet more than one for a month that is too large."""
    day = F.when(F.col("id") % 3 == 0, F.lit("2021-05-05")).otherwise(
        F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") % 120).cast("int"))
    )
    df = spark.range(0, 60_000, 1, 12).select(
        F.col("id").alias("trip_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("x"),
        day.cast("date").alias("start_station_time"),
    )
    path = fresh_path(spark, "mart")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "300KB")
    try:
        write_mart(df, path)
    finally:
        spark.conf.unset(key)
    files = {
        d: sum(f.endswith(".parquet") for f in os.listdir(f"{path}/{d}"))
        for d in os.listdir(path)
        if d.startswith("month_year=")
    }
    assert set(files) == {f"month_year=2021-0{m}-01" for m in range(1, 6)}
    assert 1 < files["month_year=2021-05-01"] < 20
    assert sum(files.values()) < 12 * 5
    assert spark.read.parquet(path).count() == 60_000


def test_materialized_table_is_a_scan(spark):
    df = materialize(spark.range(3).withColumn("s", F.lit("x")))
    assert rows(df) == [(0, "x"), (1, "x"), (2, "x")]
    assert len(df.inputFiles()) > 0
    assert materialize(df.filter("id > 9")).count() == 0


def test_work_dir_is_the_configured_one(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def session_of(master, configured=None, current=None):
    state = {"dir": current}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda d: state.update(dir=d),
    )
    conf = SimpleNamespace(get=lambda key, default: configured or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(session_of("spark://host:7077"))
    assert work_dir(session_of("yarn", "hdfs://shared/x/")) == "hdfs://shared/x"
    assert work_dir(session_of("yarn", None, "hdfs://set/y")) == "hdfs://set/y"


def test_local_sessions_get_one_temporary_folder():
    session = session_of("local[8]")
    assert work_dir(session) == work_dir(session)


def test_paths_are_never_reused(spark):
    assert fresh_path(spark, "a") != fresh_path(spark, "a")
    assert workspace.fresh_path(spark, "a").startswith(work_dir(spark))


def mart_rows(spark, *rows):
    from datetime import date

    from frames import trips

    made = [{"trip_id": i, "start_station_time": d and date(*d), "duration": n} for i, d, n in rows]
    return trips(spark, *made)


def test_one_new_month_leaves_the_others_untouched(spark):
    from velomart.sources.mart import read_extremes, read_mart

    path = fresh_path(spark, "mart")
    write_mart(mart_rows(spark, (1, (2021, 1, 2), 5), (2, (2021, 2, 3), 9), (3, None, 1), (4, (2021, 2, 4), None)), path)
    files = lambda: {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("month_year")}
    before = files()
    write_mart(mart_rows(spark, (5, (2021, 2, 9), 40), (6, (2021, 3, 9), 3)), path, keep_other_months=True)
    after = files()
    new = "month_year=2021-02-01", "month_year=2021-03-01"
    assert {k: v for k, v in after.items() if k not in new} == {k: v for k, v in before.items() if k != new[0]}
    assert rows(read_mart(spark, path).select("trip_id")) == [(1,), (3,), (5,), (6,)]
    found = {str(r.month_year): (r.least, r.greatest, r.trips) for r in read_extremes(spark, path).collect()}
    assert found == {"2021-01-01": (5, 5, 1), "2021-02-01": (40, 40, 1), "2021-03-01": (3, 3, 1), "None": (1, 1, 1)}


def test_extremes_come_from_the_mart_while_the_summary_does_not_fit(spark, monkeypatch):
    from velomart.sinks import mart
    from velomart.sources.mart import read_extremes

    path = fresh_path(spark, "mart")
    write_mart(mart_rows(spark, (1, (2021, 1, 2), 5)), path)

    def broken(trips):
        raise RuntimeError

    monkeypatch.setattr(mart, "month_extremes", broken)
    for keep, duration in ((True, 8), (False, 9)):
        with pytest.raises(RuntimeError):
            write_mart(mart_rows(spark, (1, (2021, 1, 2), duration)), path, keep)
        assert [r.greatest for r in read_extremes(spark, path).collect()] == [duration]


def test_longest_rides_read_the_summary_not_the_trips(spark):
    import re

    from frames import plan
    from velomart import fixtures
    from velomart.plans.reports import REPORTS
    from velomart.sources.mart import read_extremes

    path = fresh_path(spark, "mart")
    df = fixtures.trips(spark, "/root/testdata/sf0.001")
    for _ in range(2):  # and again after a rewrite
        write_mart(df, path)
        mart = spark.read.parquet(path)
        extremes = read_extremes(spark, path)
        for key, of in (("r4", "greatest"), ("r9", "greatest"), ("r10", "least")):
            durations = extremes.select(F.col(of).alias("duration"))
            report = REPORTS[key].build(mart, durations=durations)
            assert rows(report) == rows(REPORTS[key].build(mart)), key
            scans = re.findall(r"ReadSchema: struct<(.*)>", plan(report))
            # Of the trips the report's own columns, and the extremes; never their durations alone.
            assert f"{of}:int" in scans and "duration:int" not in scans, (key, scans)
        df = df.where("duration between 4 and 30")


def test_dealt_trips_are_written_without_a_shuffle(spark, tmp_path):
    """The same mart and summary as from trips that are not dealt yet; a part holds few months."""
    days = spark.range(0, 6000).selectExpr(
        "id as trip_id", "if(id % 9 = 0, null, date_add(date'2020-01-05', int(id % 60) * 31)) as start_station_time",
        "int(id % 50) as duration",
    )
    table = str(tmp_path / "built")
    by_month(days).write.parquet(table)
    built = spark.read.parquet(table)
    assert built.columns == days.columns
    plans = []
    for name, trips, dealt in (("plain", days, False), ("dealt", built, True)):
        write_mart(trips, str(tmp_path / name), dealt=dealt)
        write_mart(trips.filter("duration > 5 and start_station_time > date'2022-01-01'"), str(tmp_path / name), True, dealt)
        mart = spark.read.parquet(str(tmp_path / name))
        plans.append((
            sorted(map(str, mart.select("trip_id", "month_year").collect())),
            sorted(map(str, read_extremes(spark, str(tmp_path / name)).collect())),
        ))
    assert plans[0] == plans[1] and len(plans[0][1]) > 40


def test_trips_are_dealt_before_their_texts_are_made(spark):
    """What is shuffled for the trip files has no column that can be made of others."""
    from velomart import fixtures

    dealt = fixtures.dealt_items(spark, "/root/testdata/sf0.001")
    assert not {"start_time", "end_time", "start_lat", "end_lat", "bike_id", "quarter"} & set(dealt.columns)
    plain = sorted(map(str, fixtures.raw_trips(spark, "/root/testdata/sf0.001").collect()))
    assert sorted(map(str, fixtures._trip_columns(dealt).collect())) == plain
