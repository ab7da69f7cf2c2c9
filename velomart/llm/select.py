"""The least rows of a table without gathering k rows of every partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Intervals that the keys are counted in; a pass narrows the cut by this factor.
BINS = 1024


def cut(df: DataFrame, key: Column, k: int) -> int | None:
    """A value of the 63-bit integer ``key`` with at least ``k`` rows up to it, and few more.

    Rows are counted by interval, then by interval of the one that holds the k-th row,
    until that is narrow; the driver gets ``BINS`` counts a pass. Rows of one value can't
    be parted, so ties of the k-th row lie below the cut too. Fewer rows than k: the
    greatest value; no rows: None. Null keys don't count.
    """
    keys = df.select(key.alias("k")).where("k is not null")
    low, high, n = keys.agg(F.min("k"), F.max("k"), F.count("k")).first()
    if n <= k:
        return high
    before = 0
    while True:
        width = (high - low) // BINS + 1
        counts = keys.where(F.col("k").between(low, high)).groupBy(F.expr(f"(k - {low}L) div {width}L").alias("b")).count()
        for b, found in sorted(map(tuple, counts.collect())):
            if before + found >= k:
                break
            before += found
        low, high = low + b * width, min(high, low + (b + 1) * width - 1)
        if width == 1 or before + found <= k + max(k // 4, 1000):
            return high


def least(df: DataFrame, key: Column, order: list[Column], k: int) -> DataFrame:
    """The first k rows by ``order``, of which ``key`` (63-bit integers) is the coarse first part."""
    high = cut(df, key, k)
    return df.limit(0) if high is None else df.where(key <= high).orderBy(*order).limit(k)
