"""Trips derived from the order tables, for tests, checks and timings.

A line item is a trip from its supplier's nation to its customer's nation, a part
is a bike, and the files a mart is built from are written out by Spark.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart.functions.dates import ISO_TIME, US_TIME
from velomart.schema import TRIP_FILE
from velomart.workspace import fresh_path, size, working_path

# The pass type that stands for the monthly pass.
PASS_TYPE = "MACHINERY"

# Trips from this day on stand for the recent files.
RECENT_FROM = "2001-01-01"


# Bytes of line items whose trips are joined and written at once. What is shuffled for them
# takes several times as much disk until they are written.
EXPORT_BYTES = 512 * 1024 * 1024

# Stated, so that naming a table starts no job to look for its columns.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_type string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
        "o_orderdate timestamp_ntz"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_returnflag string, l_shipdate timestamp_ntz"
    ),
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _line_items_with_ends(
    spark: SparkSession, sf_dir: str, nation: DataFrame | None = None, part: tuple[int, int] = (0, 1)
) -> DataFrame:
    """Line items with their order and customer; those of one of so many parts, by order key.

    Line items lead every join, so that the side built or broadcast is always one of the
    tables they refer to, never the line items. Orders get their customer before, while
    they are few, so that line items are moved once for both. Adaptive execution splits a
    hot order key, and broadcasts the orders where they turn out to be few.
    """
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    number, parts = part
    if parts > 1:
        within = lambda key: F.pmod(F.xxhash64(key), F.lit(parts)) == number
        items, orders = items.filter(within("l_orderkey")), orders.filter(within("o_orderkey"))
    orders = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    items = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if nation is None:
        return items
    ends = nation.select(
        F.col("n_nationkey").alias("c_nationkey"),
        F.col("n_name").alias("end_station_name"),
    )
    return items.join(ends, "c_nationkey")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched trips."""
    nation = table(spark, sf_dir, "nation")
    return (
        _line_items_with_ends(spark, sf_dir, nation)
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(
            nation.select(
                F.col("n_nationkey").alias("s_nationkey"),
                F.col("n_name").alias("start_station_name"),
            ),
            "s_nationkey",
        )
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            _trip_id(),
            _duration(),
            F.col("o_orderdate").cast("date").alias("start_station_time"),
            F.col("l_shipdate").cast("date").alias("end_station_time"),
            F.col("s_nationkey").alias("start_station"),
            "start_station_name",
            F.col("c_nationkey").alias("end_station"),
            "end_station_name",
            F.col("l_partkey").alias("bike_id"),
            F.col("p_type").alias("bike_type"),
            F.col("c_mktsegment").alias("passholder_type"),
            _category(),
        )
    )


def recent(trips: DataFrame) -> DataFrame:
    return trips.filter(F.col("start_station_time") >= F.lit(RECENT_FROM).cast("date"))


def _trip_id() -> Column:
    return (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trip_id")


def _duration() -> Column:
    return F.nullif(F.col("l_quantity").cast("int"), F.lit(13)).alias("duration")


def _category() -> Column:
    return F.nullif(F.col("l_returnflag"), F.lit("N")).alias("trip_route_category")


def _time_text(time: Column, key: Column) -> Column:
    """A time in one of the two formats, or in neither, by key."""
    return (
        F.when(key % 3 == 0, F.date_format(time, ISO_TIME))
        .when(key % 3 == 1, F.date_format(time, US_TIME))
        .otherwise(F.lit("bad"))
    )


def mixed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys with a time text in mixed formats."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key, _time_text(F.col("o_orderdate"), key).alias("s")
    )


def _line_items_with_all(spark: SparkSession, sf_dir: str, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """Line items with all that a trip file is made of."""
    return (
        _line_items_with_ends(spark, sf_dir, part=part)
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifteen columns of a trip file, plus the ``quarter`` it belongs to."""
    return _trip_columns(_line_items_with_all(spark, sf_dir))


def _quarter(time: Column) -> Column:
    return F.concat(F.year(time).cast("string"), F.lit("-q"), F.quarter(time).cast("string"))


def _trip_columns(joined: DataFrame) -> DataFrame:
    key = F.col("l_orderkey")
    start = F.col("o_orderdate")
    return joined.select(
        _trip_id(),
        _duration(),
        _time_text(start, key).alias("start_time"),
        _time_text(F.col("l_shipdate"), key).alias("end_time"),
        F.col("s_nationkey").alias("start_station"),
        (F.col("s_nationkey") * 0.5).alias("start_lat"),
        (F.col("s_nationkey") * -0.25).alias("start_lon"),
        F.col("c_nationkey").alias("end_station"),
        (F.col("c_nationkey") * 0.5).alias("end_lat"),
        (F.col("c_nationkey") * -0.25).alias("end_lon"),
        F.col("l_partkey").cast("string").alias("bike_id"),
        F.col("l_linenumber").alias("plan_duration"),
        _category(),
        F.col("c_mktsegment").alias("passholder_type"),
        F.col("p_type").alias("bike_type"),
        _quarter(start).alias("quarter"),
    )


def station_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as the five columns of a station file."""
    return table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        F.col("n_nationkey").alias("station_id"),
        F.col("n_name").alias("station_name"),
        F.lit("2016-07-07").alias("station_date"),
        F.col("r_name").alias("station_type"),
        F.lit("Active").alias("current_status"),
    )


def supplier_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the five columns of a station file: a table that grows."""
    return (
        table(spark, sf_dir, "supplier")
        .join(
            table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
        )
        .select(
            F.col("s_suppkey").cast("int").alias("station_id"),
            F.col("s_name").alias("station_name"),
            F.lit("2016-07-07").alias("station_date"),
            F.col("n_name").alias("station_type"),
            F.when(F.col("s_acctbal") < 0, F.lit("Inactive"))
            .otherwise(F.lit("Active"))
            .alias("current_status"),
        )
    )


def classed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with classes at their navigation."""
    html = F.replace("html", F.lit("<nav>"), F.lit('<nav id="top" class="site menu">'))
    return table(spark, sf_dir, "pages").withColumn("html", html)


def dealt_items(spark: SparkSession, sf_dir: str, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """Line items with all that a trip file is made of, gathered by quarter."""
    number = F.year("o_orderdate") * 4 + F.quarter("o_orderdate")
    return _line_items_with_all(spark, sf_dir, part).withColumn("dealt_by_", number).hint("rebalance", "dealt_by_")


def export_trips(
    spark: SparkSession, sf_dir: str, compression: str = "none", part_bytes: int = EXPORT_BYTES
) -> str:
    """Write the trips as CSV files with headers, a folder per quarter.

    Rows are dealt while they are narrow; texts and places are made of them afterwards.
    Line items of more than ``part_bytes`` are exported in parts, one after the other.
    """
    path = working_path(spark, "trip-files")
    parts = max(1, -(-size(spark, f"{sf_dir}/lineitem.parquet") // part_bytes))
    for number in range(parts):
        (
            _trip_columns(dealt_items(spark, sf_dir, (number, parts)))
            .write.mode("append")
            .option("header", True)
            .option("compression", compression)
            .partitionBy("quarter")
            .csv(path)
        )
    return path


def export_damaged(spark: SparkSession, sf_dir: str) -> str:
    """Write the trips as CSV lines without header; some are damaged, by their number."""
    trip = F.col("trip_id")
    bad = F.when(trip % 97 == 0, F.lit("n/a")).otherwise(F.col("duration").cast("string"))
    fields = [bad.alias("duration") if n == "duration" else F.col(n) for n in TRIP_FILE.names]
    newer, older = F.to_csv(F.struct(*fields)), F.to_csv(F.struct(*fields[:-1]))
    line = (
        F.when(trip % 89 == 0, F.concat(newer, F.lit(",more")))
        .when(trip % 83 == 0, F.concat_ws(",", trip, bad))
        .when(trip % 7 == 0, older)
        .otherwise(newer)
    )
    path = fresh_path(spark, "damaged-files")
    raw_trips(spark, sf_dir).select(line.alias("value")).write.text(path)
    return path


def recent_files(folder: str) -> str:
    """The exported files of the recent quarters, as a glob."""
    return f"{folder}/quarter={{200[1-9],20[1-9][0-9],2[1-9][0-9][0-9]}}-q[1-4]"


def export_stations(stations: DataFrame) -> str:
    """Write a station table as CSV without header."""
    path = working_path(stations.sparkSession, "station-files")
    stations.write.csv(path)
    return path


def file_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file path per order, of every kind there is."""
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    year, quarter = F.year(date).cast("string"), F.quarter(date).cast("string")
    name = (
        F.when(key % 6 == 0, F.concat(F.lit("trips-"), year, F.lit("-q"), quarter, F.lit(".csv")))
        .when(key % 6 == 1, F.concat(F.lit("TRIPS-"), year, F.lit("-Q"), quarter, F.lit(".CSV")))
        .when(key % 6 == 2, F.concat(F.lit("stations-"), year, F.lit(".csv")))
        .when(key % 6 == 3, F.concat(F.lit("stations-"), year, F.lit(".CSV")))
        .when(key % 6 == 4, F.concat(F.lit("readme-q"), quarter, F.lit(".txt")))
        .otherwise(F.concat(F.lit("notes-"), year, F.lit(".txt")))
    )
    return table(spark, sf_dir, "orders").select(
        key, F.concat_ws("/", F.lit("data"), F.col("o_orderstatus"), name).alias("path")
    )


def _zip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    header = ",".join(TRIP_FILE.names)
    for number, batch in enumerate(batches):
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            half = (len(batch) + 1) // 2
            for part in (batch["line"][:half], batch["line"][half:]):
                member = f"trips-q{len(archive.namelist())}.csv"
                archive.writestr(member, "\n".join([header, *part]) + "\n")
            archive.writestr("readme.txt", "not a table\n")
            archive.writestr("__MACOSX/._trips-q0.csv", "not a table\n")
            archive.writestr("stations.csv", "9,Station,2016-07-07,Kind,Active\n")
        yield pd.DataFrame(
            {"path": [f"batch-{number}.zip"], "content": [packed.getvalue()]}
        )


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip files zipped, one archive per Arrow batch: ``(path, content)``."""
    fields = F.struct(*(F.col(n) for n in TRIP_FILE.names))
    lines = raw_trips(spark, sf_dir).select(F.to_csv(fields).alias("line"))
    return lines.mapInPandas(_zip, "path string, content binary")
