"""Trip and station CSV files.

Paths are anything Spark resolves: local, HDFS, object store, folders or globs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomart.functions.names import file_kind, last_segment
from velomart.schema import STATION_FILE, TRIP_FILE


def _csv(spark: SparkSession, schema, header: bool):
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("recursiveFileLookup", True)
    )


def trip_csv(spark: SparkSession, schema: T.StructType = TRIP_FILE, header: bool = True):
    """The reader of trip files."""
    return _csv(spark, schema, header)


# Bytes of trip files that are read as one part of a mart.
PART_BYTES = 1 << 30


def read_trips(
    spark: SparkSession,
    paths: str | Sequence[str],
    file_names: Sequence[str] | None = None,
    by_kind: bool = False,
) -> DataFrame:
    """Trips of all files under ``paths``, typed, whether 14 or 15 fields wide.

    ``file_names`` keeps only files of those names, ``by_kind`` only those whose
    name says they hold trips. Both are predicates on file metadata: other files
    are left out when the scan is planned, not read and dropped. A name that no file
    has is an error.
    """
    trips = trip_csv(spark).csv(paths)
    name = F.col("_metadata.file_name")
    if by_kind:
        trips = trips.filter(file_kind(name) == "trips")
    if file_names is not None:
        escaped = {n.replace("%", "%25").replace(" ", "%20"): n for n in file_names}
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        found = files.load(paths).filter(name.isin(*escaped)).select(name.alias("name"))
        missing = set(escaped) - {r["name"] for r in found.distinct().collect()}
        if missing:
            listed = ", ".join(sorted(escaped[n] for n in missing))
            raise FileNotFoundError(f"no such trip files: {listed}")
        trips = trips.filter(name.isin(*escaped))
    return trips


def trip_parts(
    spark: SparkSession,
    paths: str | Sequence[str],
    by_kind: bool = False,
    part_bytes: int = PART_BYTES,
) -> list[DataFrame]:
    """``read_trips`` in parts of whole files, in order of their paths, of about ``part_bytes``.

    Each file is in one part; a larger file is a part of its own.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    if by_kind:
        files = files.filter(file_kind(F.col("_metadata.file_name")) == "trips")
    listed = files.select("_metadata.file_path", "_metadata.file_size").collect()
    parts: list[list[str]] = []
    room = 0
    for path, length in sorted(map(tuple, listed)):
        if not parts or length > room:
            parts.append([])
            room = part_bytes
        parts[-1].append(path)
        room -= length
    trips = read_trips(spark, paths, by_kind=by_kind)
    if len(parts) < 2:
        return [trips]
    return [trips.filter(F.col("_metadata.file_path").isin(part)) for part in parts]


def read_stations(
    spark: SparkSession,
    paths: str | Sequence[str],
    header: bool = False,
    by_kind: bool = False,
) -> DataFrame:
    """Stations; columns are named by position, with or without a header line."""
    stations = _csv(spark, STATION_FILE, header).csv(paths)
    if by_kind:
        stations = stations.filter(
            file_kind(F.col("_metadata.file_name")) == "stations"
        )
    return stations


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of every file under ``path``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )


def classify_files(files: DataFrame, path: str = "path") -> DataFrame:
    """Add ``file_name`` and ``kind`` to a table of paths."""
    return files.withColumn("file_name", last_segment(F.col(path))).withColumn(
        "kind", file_kind(F.col("file_name"))
    )
