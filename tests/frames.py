"""Small hand-written frames."""

from velomart.schema import ENRICHED_TRIP, TRIP_FILE


def raw_trips(spark, *rows):
    """Trip-file rows; a row gives only the fields it cares about."""
    defaults = dict.fromkeys(TRIP_FILE.names)
    return spark.createDataFrame(
        [tuple({**defaults, **row}[n] for n in TRIP_FILE.names) for row in rows],
        TRIP_FILE,
    )


def trips(spark, *rows):
    """Enriched trips; a row gives only the fields it cares about."""
    defaults = dict.fromkeys(ENRICHED_TRIP.names)
    return spark.createDataFrame(
        [tuple({**defaults, **row}[n] for n in ENRICHED_TRIP.names) for row in rows],
        ENRICHED_TRIP,
    )


def rows(df):
    """Rows as sorted tuples."""
    return sorted(
        map(tuple, df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def plan(df):
    """The formatted physical plan as text."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(
            "formatted"
        )
    )
