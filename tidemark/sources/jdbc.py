"""Marts in a database, through Spark's JDBC source.

Connection settings come from the caller; nothing here knows a host, a user or a password.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def write_options(table: str, connection: Mapping[str, str], mode: str, partitions: int, batch: int):
    options = {**connection, "dbtable": table, "numPartitions": str(partitions), "batchsize": str(batch)}
    if mode == "overwrite":
        # Keep the table, its grants and indexes; only the rows go.
        options["truncate"] = "true"
    return options


def jdbc_writer(
    df: DataFrame,
    table: str,
    connection: Mapping[str, str],
    mode: str = "overwrite",
    *,
    partitions: int,
    batch: int = 10_000,
) -> DataFrameWriter:
    """A writer of ``df`` to a mart; ``partitions`` is how many connections the database bears."""
    options = write_options(table, connection, mode, partitions, batch)
    return df.write.format("jdbc").options(**options).mode(mode)


def publish_mart(df: DataFrame, table: str, connection: Mapping[str, str], **how) -> None:
    jdbc_writer(df, table, connection, **how).save()


def read_mart(
    spark: SparkSession,
    table: str,
    connection: Mapping[str, str],
    split_on: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A mart read back, in parallel ranges of ``split_on`` when given."""
    reader = spark.read.format("jdbc").options(**connection, dbtable=table)
    if split_on and bounds:
        reader = reader.options(
            partitionColumn=split_on,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()
