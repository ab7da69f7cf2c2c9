"""Row filters that compare with an aggregate of the same table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at_extreme(
    df: DataFrame,
    column: str,
    extreme: Callable[[Column], Column],
    of: DataFrame | None = None,
) -> DataFrame:
    """Rows whose ``column`` equals its overall maximum (``F.max``) or minimum.

    An uncorrelated scalar subquery: it reads that one column, and its value is
    then pushed into the scan of the rest, where row groups that cannot hold it
    are skipped. ``of`` is a smaller table to take the value from, if there is one
    that holds the same values.
    """
    bound = (df if of is None else of).agg(extreme(F.col(column))).scalar()
    return df.filter(F.col(column) == bound)


def at_max(df: DataFrame, column: str, of: DataFrame | None = None) -> DataFrame:
    return at_extreme(df, column, F.max, of)


def at_min(df: DataFrame, column: str, of: DataFrame | None = None) -> DataFrame:
    return at_extreme(df, column, F.min, of)
