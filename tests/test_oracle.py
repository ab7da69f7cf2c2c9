"""Every registered query against its SQL in DuckDB, on the given tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as contract  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(
            f"create view {name} as select * from '{SF_DIR}/{name}.parquet'"
        )
    return con


def _kind(dtype: str) -> str:
    """Type names of both engines on common ground."""
    return {
        "int32": "int",
        "int64": "bigint",
        "int": "int",
        "integer": "int",
        "bigint": "bigint",
        "double": "double",
        "varchar": "string",
        "string": "string",
        "date": "date",
    }[dtype.lower()]


def _canonical(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("key", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, key):
    got = contract.queries()[key](spark, SF_DIR)
    names = sorted(got.columns)
    got = got.select(*names)

    relation = duck.sql(contract.oracle_sql()[key])
    assert sorted(relation.columns) == names
    want_types = dict(zip(relation.columns, map(str, relation.types)))
    for name, dtype in got.dtypes:
        assert _kind(dtype) == _kind(want_types[name]), name

    quoted = ",".join(f'"{n}"' for n in names)
    want = duck.sql(
        f"select {quoted} from ({contract.oracle_sql()[key]}) q"
    ).fetchall()
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want)
    assert len(rows) > 0
    assert _canonical(rows) == _canonical(want)


def test_every_query_has_an_oracle():
    assert set(contract._own_queries()) == set(contract._own_sql())


def test_line_items_are_never_the_side_that_is_built(spark):
    """At the largest size at hand, where the plan chooses by its estimates."""
    sf = "/root/testdata/sf0.1"
    for trips in (contract.fixtures.trips(spark, sf), contract.fixtures.raw_trips(spark, sf)):
        physical = trips._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in physical.splitlines() if "Join [" in line]
        assert joins and not any("BuildLeft" in line for line in joins)


def test_entry(spark):
    assert contract.entry(spark).count() == 6
