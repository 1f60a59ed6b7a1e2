"""Relational tables over JDBC. Address, user and password are always the caller's options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, options: dict[str, str] | None = None,
              partition: tuple[str, object, object, int] | None = None) -> DataFrame:
    """A table as a DataFrame; ``partition=(column, lower, upper, count)`` reads it in parallel ranges.

    Without ``partition`` the driver of the database serves all rows to one task: fine for a lookup
    table, not for a fact table.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {}))
    if partition:
        column, lower, upper, count = partition
        reader = reader.options(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(count)
        )
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, options: dict[str, str] | None = None,
               mode: str = "append", connections: int = 16) -> None:
    """Append to a table; at most ``connections`` sessions are opened at a time."""
    (
        df.write.format("jdbc").mode(mode).options(**(options or {}))
        .option("url", url).option("dbtable", table).option("numPartitions", connections).save()
    )
