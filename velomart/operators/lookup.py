"""Joins of a large fact to a lookup whose size is measured first.

Spark estimates an aggregate to be about as large as its input, so left alone it
would shuffle the whole fact to meet a lookup of a few thousand rows. The size is
therefore measured while the lookup is written to the shared folder. Below the
limit it is broadcast and the fact is not moved. Above it both sides are shuffled,
with the hot keys of the fact spread over several tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomart import workspace

# Measured bytes of a side that every executor may hold. The measure counts what a
# hashed relation keeps per row, so this is about the memory it takes.
BROADCAST_BYTES = 256 * 1024 * 1024

# A key with more than this share of the fact is hot. There can be no more than
# 1 / HOT_SHARE such keys, which bounds the table of them that is broadcast.
HOT_SHARE = 1e-5

# Bytes counted per row besides its text and 8 per column: the record's header
# and its place in a half-full hash table.
_ROW_BYTES = 48


@dataclass(frozen=True)
class Lookup:
    """A written lookup table and its measured size."""

    df: DataFrame
    rows: int
    bytes: float


def _has_bounded_rows(df: DataFrame) -> bool:
    """Whether a row's memory follows from its text, bytes and number of columns."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    return not any(isinstance(f.dataType, nested) for f in df.schema)


def _row_size(df: DataFrame) -> Column:
    text = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = F.lit(_ROW_BYTES + 8 * len(df.columns)).cast("long")
    for name in text:
        size = size + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    return size


def measured(df: DataFrame, name: str = "lookup") -> Lookup:
    """Write a lookup once, counting its rows and bytes in the same job.

    Nested columns are not measured: such a lookup counts as too large to be sent around.
    """
    seen = Observation()
    written = workspace.materialize(
        df.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(_row_size(df)), F.lit(0)).alias("bytes"),
        ),
        name,
    )
    return Lookup(written, seen.get["rows"], seen.get["bytes"] if _has_bounded_rows(df) else math.inf)


def hot_keys(
    fact: DataFrame, columns: Sequence[str], hot_share: float = HOT_SHARE
) -> dict[str, DataFrame]:
    """For each column its values with more than ``hot_share`` of the fact, and their parts.

    All columns are counted in one scan, before any join; a join in between changes how
    many rows a part holds, not what is joined.
    """
    if not columns:
        return {}
    names = list(dict.fromkeys(columns))
    counts = workspace.materialize(
        fact.select(*names)
        .groupingSets([[F.col(c)] for c in names], *map(F.col, names))
        .agg(*(F.grouping(c).alias(f"_without_{c}") for c in names), F.count(F.lit(1)).alias("_n")),
        "key-counts",
    )
    found = {}
    for c in names:
        of = counts.filter((F.col(f"_without_{c}") == 0) & F.col(c).isNotNull()).select(c, "_n")
        found[c] = _hot(of, [c], hot_share)
    return found


def _hot(counts: DataFrame, on: list[str], hot_share: float) -> DataFrame:
    """Keys that are split, with how many parts each gets."""
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    part_rows = max(1.0, total * hot_share)
    return counts.filter(F.col("_n") > part_rows).select(
        *on, F.ceil(F.col("_n") / part_rows).alias("_parts")
    )


def lookup_join(
    fact: DataFrame,
    lookup: Lookup,
    on: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
    how: str = "inner",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner or left equi-join; columns of the fact first, then those of the lookup.

    A key that the lookup holds twice doubles its fact rows. NULL keys match
    nothing. ``hot`` are the keys to split, with their parts (``hot_keys``), if they
    are known; else a shuffled join counts them first.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    if lookup.bytes <= broadcast_bytes:
        joined = fact.join(F.broadcast(lookup.df), list(on), how)
    else:
        joined = _spread_join(fact, lookup.df, list(on), hot_share, how, hot)
    added = [c for c in lookup.df.columns if c not in on]
    return joined.select(*fact.columns, *added)


def _spread_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: list[str],
    hot_share: float,
    how: str,
    hot: DataFrame | None,
) -> DataFrame:
    """Shuffle join in which each hot key of the fact is split into parts.

    The lookup rows of a hot key are repeated once per part, so every fact row
    still meets all of them, exactly once. The part of a row depends on its
    content and its partition: it is the same again if the task is rerun, and
    equal rows of different partitions do not all land in one part. Rows with a
    NULL key meet nothing and are simply spread.
    """
    if how == "inner":
        fact = fact.dropna(subset=on)
    if hot is None:
        counts = workspace.materialize(
            fact.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("_n")),
            "key-counts",
        )
        hot = _hot(counts, on, hot_share)
    hot = F.broadcast(hot)  # 1 / hot_share rows at most
    content = F.xxhash64(F.spark_partition_id(), *fact.columns)
    has_null = reduce(or_, (F.col(key).isNull() for key in on))
    spread = fact.join(hot, on, "left").withColumn(
        "_part",
        F.when(has_null, content)
        .when(F.col("_parts").isNotNull(), F.pmod(content, F.col("_parts")))
        .otherwise(F.lit(0)),
    )
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    repeated = (
        lookup.dropna(subset=on)
        .join(hot, on, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    )
    return (
        spread.drop("_parts")
        .join(repeated.drop("_parts"), [*on, "_part"], how)
        .drop("_part")
    )
