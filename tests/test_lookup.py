"""The lookup join against brute force, in both of its forms."""

import pytest
from frames import plan, rows
from pyspark.sql import functions as F

from velomart.operators import lookup
from velomart.operators.lookup import lookup_join, measured


def skewed(spark):
    """A third of the rows on one key, identical copies among them."""
    hot = [("hot", 1)] * 400
    cold = [(f"k{i % 50}", i) for i in range(700)]
    none = [(None, i) for i in range(100)]
    return spark.createDataFrame(hot + cold + none, "k string, v int").repartition(5)


def keys(spark):
    table = [("hot", "x"), ("hot", "y"), ("unused", "z"), (None, "n")]
    table += [(f"k{i}", f"t{i}") for i in range(0, 50, 2)]
    return spark.createDataFrame(table, "k string, t string")


def brute(fact, table):
    pairs = [(r.k, r.t) for r in table.collect() if r.k is not None]
    out = [(r.k, r.v, t) for r in fact.collect() for k, t in pairs if k == r.k]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("hot_share", [lookup.HOT_SHARE, 0.02, 0.5])
def test_equals_brute_force(spark, limit, hot_share):
    fact, table = skewed(spark), keys(spark)
    got = lookup_join(fact, measured(table), ["k"], limit, hot_share)
    assert got.columns == ["k", "v", "t"]
    assert rows(got) == brute(fact, table)


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, 0])
def test_left_join_keeps_unmatched_and_null_keys(spark, limit):
    fact, table = skewed(spark), keys(spark)
    got = lookup_join(fact, measured(table), ["k"], limit, 0.02, how="left")
    assert rows(got) == rows(fact.join(table, "k", "left"))
    assert got.filter("k is null").count() == 100


def test_other_joins_are_refused(spark):
    with pytest.raises(ValueError):
        lookup_join(skewed(spark), measured(keys(spark)), ["k"], how="full")


def test_two_keys(spark):
    fact = spark.range(500).select(
        (F.col("id") % 3).alias("a"), (F.col("id") % 5).alias("b"), "id"
    )
    table = spark.range(15).select(
        (F.col("id") % 3).alias("a"), (F.col("id") % 5).alias("b"), F.col("id").alias("x")
    )
    expected = rows(fact.join(table, ["a", "b"]))
    for limit in (lookup.BROADCAST_BYTES, 0):
        for how in ("inner", "left"):
            got = lookup_join(fact, measured(table), ["a", "b"], limit, 0.02, how)
            assert rows(got) == expected


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, -1])
def test_empty_sides(spark, limit):
    fact, table = skewed(spark), keys(spark)
    nothing = measured(table.filter("k = 'absent'"))
    assert (nothing.rows, nothing.bytes) == (0, 0)
    assert lookup_join(fact, nothing, ["k"], limit).count() == 0
    assert lookup_join(fact.limit(0), measured(table), ["k"], limit).count() == 0


def test_measures_rows_and_text(spark):
    short = measured(spark.createDataFrame([("a",), (None,)], "k string"))
    long = measured(spark.createDataFrame([("a" * 1000,), (None,)], "k string"))
    assert short.rows == long.rows == 2
    assert long.bytes - short.bytes == 999


def test_form_follows_the_size(spark):
    fact, table = skewed(spark), measured(keys(spark))
    assert "BroadcastHashJoin" in plan(lookup_join(fact, table, ["k"]))
    spread = plan(lookup_join(fact, table, ["k"], 0, 0.02))
    assert "_part" in spread


def test_hot_key_is_spread_over_tasks(spark):
    """No task of the shuffled form sees all rows of the hot key."""
    fact = skewed(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = lookup_join(fact, measured(keys(spark)), ["k"], 0, 0.02)
        tasks = (
            got.filter("k = 'hot'")
            .groupBy(F.spark_partition_id().alias("p"))
            .count()
            .collect()
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(t["count"] for t in tasks) == 800
    assert len(tasks) > 1


def test_hot_keys_of_several_columns_are_counted_in_one_scan(spark, monkeypatch):
    """At a limit of 0 bytes the raw trips are read twice: for the counts and for the joins."""
    import os
    import re

    from pyspark.sql import DataFrameWriter
    from velomart import fixtures
    from velomart.plans.mart import build_mart
    from velomart.sources.trips import read_stations, read_trips

    sf = "/root/testdata/sf0.001"
    folder, other = fixtures.export_trips(spark, sf), fixtures.export_trips(spark, sf)
    stations = read_stations(spark, fixtures.export_stations(fixtures.station_table(spark, sf)))
    recent = read_trips(spark, fixtures.recent_files(other))
    expected = rows(build_mart(read_trips(spark, folder), recent, stations))
    plans, plain = [], DataFrameWriter.parquet

    def writing(writer, *args, **more):
        plans.append(plan(writer._df))
        return plain(writer, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", writing)
    built = build_mart(read_trips(spark, folder), recent, stations, 0, 0.01)
    plans.append(plan(built))
    scans = sum(len(re.findall(rf"Location: .*{os.path.basename(folder)}", p)) for p in plans)
    assert scans == 2
    assert "_part" in plans[-1]
    assert rows(built) == expected


def test_hot_keys_are_those_above_the_share(spark):
    from velomart.operators.lookup import hot_keys

    fact = skewed(spark)
    found = hot_keys(fact, ["k", "v", "k"], 0.2)
    assert rows(found["k"]) == [("hot", 2)]  # 400 of 1100 rows, 220 a part
    assert rows(found["v"]) == [(1, 2)]
    assert hot_keys(fact, []) == {}
    assert rows(hot_keys(fact.limit(0), ["k"], 0.2)["k"]) == []


def test_nested_columns_are_not_sent_around(spark):
    nested = measured(spark.createDataFrame([("k1", [1, 2])], "k string, t array<int>"))
    assert nested.bytes > lookup.BROADCAST_BYTES
    assert rows(lookup_join(skewed(spark).filter("v = 1"), nested, ["k"]).select("k", "t")) == [("k1", [1, 2])]
    short = measured(spark.createDataFrame([("k", b"x")], "k string, t binary"))
    long = measured(spark.createDataFrame([("k", b"x" * 5000)], "k string, t binary"))
    assert long.bytes - short.bytes == 4999
