import os
import time

import pytest
from pyspark.sql import functions as F

from velomart.workspace import Tables, materialize, scope, work_dir


def _folders(spark, *names):
    root = work_dir(spark).removeprefix("file://")
    return {n: [f for f in os.listdir(root) if f.startswith(f"{n}-")] for n in names}


def test_a_table_written_again_replaces_the_earlier_one(spark):
    with Tables(spark) as tables:
        now = tables.write(spark.range(3), "scope-a")
        for _ in range(3):
            now = tables.write(now.selectExpr("id + 1 as id"), "scope-a")
            assert len(_folders(spark, "scope-a")["scope-a"]) == 1
        assert sorted(r[0] for r in now.collect()) == [3, 4, 5]
    assert _folders(spark, "scope-a") == {"scope-a": []}


def test_tables_go_when_no_longer_read_and_on_failure(spark):
    with pytest.raises(RuntimeError), Tables(spark) as tables:
        tables.write(spark.range(1), "scope-b")
        tables.write(spark.range(1), "scope-c")
        tables.drop("scope-b", "never-written")
        assert [len(v) for v in _folders(spark, "scope-b", "scope-c").values()] == [0, 1]
        kept = materialize(spark.range(4), "scope-kept")
        raise RuntimeError
    assert _folders(spark, "scope-b", "scope-c") == {"scope-b": [], "scope-c": []}
    assert kept.count() == 4


def _shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def test_a_scope_holds_the_shuffle_files_of_one_query_at_a_time(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = _shuffle_files(spark)
    with scope(spark):
        for n in range(3):
            spread = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
            assert materialize(spread, f"scope-spread-{n}").count() == 7
        for _ in range(50):  # they are deleted beside the queries
            if not _shuffle_files(spark) - before:
                break
            time.sleep(0.1)
        assert not _shuffle_files(spark) - before
    assert spark.conf.get(setting, None) is None
    spark.conf.set(setting, "false")
    try:
        with scope(spark):
            assert spark.conf.get(setting) == "false"
        assert spark.conf.get(setting) == "false"
    finally:
        spark.conf.unset(setting)
