"""Trip files read with what is wrong in them: damaged rows are kept as text and counted.

A scan turns a value that does not parse into NULL and says nothing. Here such a row
also carries its line and what is wrong with it, so that it can be counted by file,
written away and mended. Both widths of a trip file, 14 and 15 fields, are whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomart.schema import TRIP_FILE
from velomart.sources.trips import trip_csv

#: What may be wrong with a row.
FAULTS = ("bad_value", "short_row", "surplus_field")

_LINE = "_line"
_KEEP = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE}


def _whole(line: Column, fields: Sequence[T.StructField]) -> Column:
    """Whether a line has exactly these fields and every value parses."""
    schema = T.StructType([*fields, T.StructField(_LINE, T.StringType())])
    return F.from_csv(line, schema.simpleString()[len("struct<") : -1].replace(":", " "), _KEEP)[_LINE].isNull()


def _texts(n: int) -> list[T.StructField]:
    return [T.StructField(f"_{i}", T.StringType()) for i in range(n)]


def _fault(line: Column) -> Column:
    """What is wrong with a line that the scan marked; NULL for a whole one of 14 fields.

    The width is what Spark's own CSV parser finds, so quoted commas do not count.
    """
    older, newer = len(TRIP_FILE) - 1, len(TRIP_FILE)
    right_width = _whole(line, _texts(older)) | _whole(line, _texts(newer))
    # A row of too many fields keeps a value in the last of so many; a short one cannot have it.
    at_least = F.size(F.split(F.regexp_replace(line, r'"(?:[^"\\]|\\.)*"', "q"), ",", -1))
    return F.when(
        line.isNotNull() & ~_whole(line, TRIP_FILE.fields[:older]),
        F.when(right_width, "bad_value").when(at_least > newer, "surplus_field").otherwise("short_row"),
    )


def read_trips_with_faults(
    spark: SparkSession, paths: str | Sequence[str], header: bool = True
) -> DataFrame:
    """The rows of ``read_trips``, all of them, with ``file_name``, ``fault`` and ``line``.

    ``fault`` is one of ``FAULTS`` or NULL, ``line`` the row's text where there is a
    fault. A row that has both a wrong width and a wrong value counts by its width. An
    empty field is a NULL and no fault; empty lines are no rows. All columns are parsed,
    whatever is selected later, since a fault may lie in any of them.
    """
    schema = T.StructType([*TRIP_FILE, T.StructField(_LINE, T.StringType())])
    rows = trip_csv(spark, schema, header).options(**_KEEP).csv(paths)
    # A scan parses only the fields that are asked for and marks no line for the others, so
    # all are asked for: nothing of their hash is put behind the line.
    asked = F.left(F.xxhash64(*TRIP_FILE.names).cast("string"), F.lit(0))
    marked = F.nullif(F.concat_ws("", F.col(_LINE), asked), F.lit(""))
    found = rows.select(
        *TRIP_FILE.names, F.col("_metadata.file_name").alias("file_name"), marked.alias(_LINE)
    ).withColumn("fault", _fault(F.col(_LINE)))
    return found.withColumn("line", F.when(F.col("fault").isNotNull(), F.col(_LINE))).drop(_LINE)


def faults_by_file(trips: DataFrame) -> DataFrame:
    """Rows of each file, and how many have which fault. Tasks count before the shuffle."""
    return trips.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows"), *_counts())


def _counts() -> list[Column]:
    return [F.count_if(F.col("fault") == name).alias(name) for name in FAULTS]


def rescue_trips(
    spark: SparkSession,
    paths: str | Sequence[str],
    rejects: str,
    most_faults: float = 1.0,
) -> DataFrame:
    """The whole rows, typed; damaged ones are written to ``rejects`` as text.

    ``rejects`` then holds Parquet with ``file_name``, ``fault`` and ``line``, a folder
    for each fault, and is overwritten. The counts are observed by that same scan; if
    more than the share ``most_faults`` of all rows are damaged, it is an error, and the
    rejected lines are there to be looked at.
    """
    found = read_trips_with_faults(spark, paths)
    seen = Observation()
    (
        found.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("fault").alias("faults"), *_counts())
        .filter(F.col("fault").isNotNull())
        .select("file_name", "fault", "line")
        .write.mode("overwrite")
        .partitionBy("fault")
        .parquet(rejects)
    )
    counts = seen.get
    if counts["faults"] > most_faults * counts["rows"]:
        listed = ", ".join(f"{counts[name]} {name}" for name in FAULTS)
        raise ValueError(f"{counts['faults']} of {counts['rows']} rows are damaged ({listed}): see {rejects}")
    return found.filter(F.col("fault").isNull()).select(*TRIP_FILE.names)
