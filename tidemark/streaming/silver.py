"""Streams that upsert each micro-batch into a keyed table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.scalar import parse_timestamp, time_parts
from tidemark.operators.upsert import upsert_batches
from tidemark.plans.stocks import SILVER_INTRADAY
from tidemark.sources import tables


def silver_bars(bronze: DataFrame) -> DataFrame:
    """typed instant, year and capture stamp."""
    typed = bronze
    if dict(bronze.dtypes)["timestamp"] == "string":
        typed = bronze.withColumn("timestamp", parse_timestamp("timestamp"))
    return typed.withColumn("ano", F.year("timestamp")).withColumn(
        "_capture_time_silver", F.current_timestamp()
    )


def upsert_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    latest_by: Sequence[Column | str],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    partitions_follow_keys: bool = False,
    report: Callable[[int, int, int], None] | None = None,
    drain: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Run ``upsert_batches`` over a stream."""
    trigger = {"availableNow": True} if drain else {"processingTime": interval}
    batches = upsert_batches(path, keys, latest_by, prepare, partitions_follow_keys, report)
    return (
        rows.writeStream.foreachBatch(batches)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def bars_to_silver(
    spark: SparkSession, bronze_path: str, silver_path: str, checkpoint: str, max_files: int | None = None, **how
) -> StreamingQuery:
    """Bronze bars into silver, one row per ticker and instant, the last captured wins."""
    tables.ensure_table(spark, silver_path, SILVER_INTRADAY, ["ticker", "ano"])
    return upsert_stream(
        tables.read_table_stream(spark, bronze_path, max_files, checkpoint=checkpoint),
        silver_path,
        checkpoint,
        ["ticker", "timestamp"],
        ["_capture_time_kafka"],
        prepare=silver_bars,
        partitions_follow_keys=True,
        **how,
    )


def with_time_parts(events: DataFrame) -> DataFrame:
    """year to minute from the creation stamp, which may be text."""
    moment = parse_timestamp("data_criacao")
    stamped = events.withColumn("_moment", moment)
    return stamped.withColumns(time_parts("_moment")).drop("_moment")


def events_to_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint: str,
    schema,
    latest_by: Sequence[Column | str] = ("data_criacao",),
    max_files: int | None = None,
    **how,
) -> StreamingQuery:
    """Audit events into silver by ``_id``, partitioned by day."""
    tables.ensure_table(spark, silver_path, schema, ["ano", "mes", "dia"])
    return upsert_stream(
        tables.read_table_stream(spark, bronze_path, max_files, checkpoint=checkpoint),
        silver_path,
        checkpoint,
        ["_id"],
        list(latest_by),
        prepare=with_time_parts,
        **how,
    )
