"""File names and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_segment(path: Column) -> Column:
    """What follows the last slash of a path or URL (all of it without one)."""
    return F.substring_index(path, "/", -1)


def file_kind(name: Column) -> Column:
    """'trips', 'stations' or NULL, by file name.

    A name with a ``q`` (quarter, any case) is a trip file if it also contains
    ``.csv`` in any case, and otherwise nothing. A name without a ``q`` is a
    station file if it contains ``.csv`` in lower case.
    """
    folded = F.lower(name)
    return F.when(
        F.contains(folded, F.lit("q")),
        F.when(F.contains(folded, F.lit(".csv")), F.lit("trips")),
    ).when(F.contains(name, F.lit(".csv")), F.lit("stations"))
