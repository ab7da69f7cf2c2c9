"""Schemas of the input files and of the landed mart."""

from __future__ import annotations

from pyspark.sql import types as T

# Positional schema of a trip file. Older files have 14 fields; the 15th,
# bike_type, is then NULL. trip_id is wider than the 32 bits such files are
# documented with, because a value that does not fit reads as NULL and would
# silently leave the trip counts.
TRIP_FILE = T.StructType(
    [
        T.StructField("trip_id", T.LongType()),
        T.StructField("duration", T.IntegerType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("start_station", T.IntegerType()),
        T.StructField("start_lat", T.DoubleType()),
        T.StructField("start_lon", T.DoubleType()),
        T.StructField("end_station", T.IntegerType()),
        T.StructField("end_lat", T.DoubleType()),
        T.StructField("end_lon", T.DoubleType()),
        T.StructField("bike_id", T.StringType()),
        T.StructField("plan_duration", T.IntegerType()),
        T.StructField("trip_route_category", T.StringType()),
        T.StructField("passholder_type", T.StringType()),
        T.StructField("bike_type", T.StringType()),
    ]
)

STATION_FILE = T.StructType(
    [
        T.StructField("station_id", T.IntegerType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("station_date", T.StringType()),
        T.StructField("station_type", T.StringType()),
        T.StructField("current_status", T.StringType()),
    ]
)

# What the reports read: the trip without its time texts, with dates, the
# looked-up bike type and both station names.
ENRICHED_TRIP = T.StructType(
    [
        f
        for f in TRIP_FILE
        if f.name not in ("start_time", "end_time", "bike_type")
    ]
    + [
        T.StructField("start_station_time", T.DateType()),
        T.StructField("end_station_time", T.DateType()),
        T.StructField("bike_type", T.StringType()),
        T.StructField("start_station_name", T.StringType()),
        T.StructField("end_station_name", T.StringType()),
    ]
)

# On disk the month is the partition column, so it costs no bytes to read.
MART = T.StructType(
    list(ENRICHED_TRIP) + [T.StructField("month_year", T.DateType())]
)
