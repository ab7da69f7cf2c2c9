"""Exact distinct counts by bitmaps over a dictionary.

Values get dense numbers once. A group then holds a bitmap of them, in buckets of fixed
size, and groups are merged by OR: counts by any part of the group's keys come from the
same table. What is shuffled is at most one bucket a task and group, never a row for each
group and value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velomart import workspace
from velomart.operators.lookup import lookup_join, measured


def dictionary(values: DataFrame, column: str) -> DataFrame:
    """Each value of ``column`` but NULL, with a dense ``number`` from 1.

    Ranges of values are numbered in parallel; one row for each range is all that meets
    in one place.
    """
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    ranged = workspace.materialize(
        distinct.repartitionByRange(column).withColumn("part_", F.spark_partition_id()),
        "dictionary",
    )
    sizes = ranged.groupBy("part_").agg(F.count(F.lit(1)).alias("n_"))
    earlier = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part_", F.coalesce(F.sum("n_").over(earlier), F.lit(0)).alias("before_"))
    nth = F.row_number().over(Window.partitionBy("part_").orderBy(column))
    return (
        ranged.withColumn("nth_", nth)
        .join(F.broadcast(before), "part_")
        .select(column, (F.col("nth_") + F.col("before_")).alias("number"))
    )


def bitmaps(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """A bitmap of the numbers of ``column`` for each group and bucket of numbers.

    A group without any value has a row too, with a NULL bucket and no bit set.
    """
    numbers = measured(dictionary(df, column), "numbers")
    number = F.col("number")
    return (
        lookup_join(df.select(*keys, column), numbers, [column], how="left")
        .groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    )


def distinct_counts(maps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct values by ``keys``, which may be fewer than those the bitmaps were made for."""
    merged = maps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
