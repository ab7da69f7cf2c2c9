"""Trips laid out by their pair of station names, with the pairs' averages laid out alike.

Both are tables bucketed by the pair and a part of it. A trip and the average of its pair
lie in buckets of one number, so they meet where they lie: the trips are not shuffled a
second time, and no table of pairs is sent to every executor, however many pairs there are.

A pair with many trips is cut into parts, each with its own row of the average, so a pair
that holds a third of all trips is spread over many buckets. So are trips without a name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart import workspace
from velomart.operators.lookup import HOT_SHARE
from velomart.operators.pairs import PAIR

#: Trips that a bucket holds on average; one task reads a bucket.
BUCKET_ROWS = 4_000_000

#: Spark's own limit of buckets; beyond it they hold more trips.
MOST_BUCKETS = 100_000

PART = "pair_part"
_LAID = (*PAIR, PART)


@dataclass(frozen=True)
class PairLayout:
    """Names of both tables, and where they lie."""

    trips: str
    averages: str
    path: str


def _save(df: DataFrame, buckets: int, table: str, path: str) -> None:
    # Tasks are dealt as buckets are, so each writes the whole file of one bucket.
    (
        df.repartition(buckets, *_LAID)
        .write.mode("overwrite")
        .bucketBy(buckets, *_LAID)
        .option("path", path)
        .saveAsTable(table)
    )


def write_pairs(
    trips: DataFrame, table: str, path: str, bucket_rows: int = BUCKET_ROWS, hot_share: float = HOT_SHARE
) -> PairLayout:
    """Lay the trips out as ``table``, and the averages of their pairs as ``table``_averages.

    The trips are scanned twice, to count their pairs and to be dealt. A pair is cut into
    parts of a quarter of a bucket, or of the share ``hot_share`` of all trips if that is
    more: so the table of cut pairs, which is sent to the trips, has at most
    1 / ``hot_share`` rows. The part of a trip follows from its content and partition, so
    a task that runs again deals alike, and equal trips are spread too. Averages of pairs
    without any duration are NULL. An empty table gives empty tables.
    """
    spark = trips.sparkSession
    with workspace.scope(spark):
        counted = workspace.materialize(
            trips.groupBy(*PAIR).agg(
                F.count(F.lit(1)).alias("_rows"), F.count("duration").alias("_n"), F.sum("duration").alias("_total")
            ),
            "pair-counts",
        )
        total = counted.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
        buckets = min(max(1, math.ceil(total / bucket_rows)), MOST_BUCKETS)
        part_rows = max(1.0, bucket_rows / 4, total * hot_share)
        pairs = counted.withColumn("_parts", F.ceil(F.col("_rows") / part_rows))
        cut = F.broadcast(
            pairs.filter("_parts > 1").select(*(F.col(c).alias(f"_{c}") for c in PAIR), "_parts")
        )
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PAIR]
        content = F.xxhash64(F.spark_partition_id(), *trips.columns)
        part = F.coalesce(F.pmod(content, F.col("_parts")), F.lit(0)).cast("int")
        laid = trips.join(cut, same, "left").withColumn(PART, part)
        names = PairLayout(table, f"{table}_averages", path)
        _save(laid.select(*trips.columns, PART), buckets, names.trips, f"{path}/trips")
        averages = pairs.dropna(subset=list(PAIR)).select(
            *PAIR,
            F.explode(F.sequence(F.lit(0), F.col("_parts").cast("int") - 1)).alias(PART),
            (F.col("_total").cast("double") / F.nullif(F.col("_n"), F.lit(0))).alias("avg"),
        )
        _save(averages, buckets, names.averages, f"{path}/averages")
    return names


def with_averages(spark: SparkSession, layout: PairLayout, how: str = "inner") -> DataFrame:
    """Laid-out trips with the ``avg`` of their pair; nothing is shuffled.

    Inner leaves out trips without a station name, ``left`` keeps them. A task holds the
    averages of one bucket in a hash table and passes its trips by them, unsorted.
    """
    averages = spark.table(layout.averages).hint("shuffle_hash")
    return spark.table(layout.trips).join(averages, list(_LAID), how).drop(PART)


def drop_pairs(spark: SparkSession, layout: PairLayout) -> None:
    """Forget both tables and delete what they hold."""
    for table in (layout.trips, layout.averages):
        spark.sql(f"drop table if exists {table}")
    workspace.remove(spark, layout.path)
