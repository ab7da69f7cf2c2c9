"""Sinks for named report tables: ``sink(table_name, df)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Sink = Callable[[str, DataFrame], None]


def parquet_sink(folder: str) -> Sink:
    """Overwrite ``folder/<table>`` with each report."""

    def save(table: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/{table}")

    return save


def jdbc_sink(
    url: str,
    driver: str | None = None,
    connections: int = 8,
    properties: dict[str, str] | None = None,
) -> Sink:
    """Overwrite a database table with each report.

    URL, driver and credentials are the caller's. ``connections`` caps how many
    tasks write at once, so that a wide cluster does not flood one database.
    """

    def save(table: str, df: DataFrame) -> None:
        writer = (
            spread(df, connections).write.format("jdbc")
            .options(**(properties or {}))
            .option("url", url)
            .option("dbtable", table)
            .option("numPartitions", connections)
        )
        if driver is not None:
            writer = writer.option("driver", driver)
        writer.mode("overwrite").save()

    return save


def spread(df: DataFrame, connections: int) -> DataFrame:
    """``df`` in as many partitions as there are connections.

    By a shuffle: left to itself the writer merges the tasks of the scan and the joins
    before it too, and those would then run no wider than the connections.
    """
    return df.repartition(connections)
