"""Streams that only append."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import decode
from tidemark.functions.decode import encode_replay
from tidemark.shared import materialized
from tidemark.sources import tables
from tidemark.sources.files import stream_bar_csvs
from tidemark.sources.storage import Storage
from tidemark.sources.topics import as_messages

Check = Callable[[DataFrame], DataFrame]

# How a message is checked and decoded, by the encoding of its topic.
CHECKS: dict[str, Check] = {
    "json": decode.checked_json,
    "avro": decode.checked_avro,
    "framed": lambda messages: decode.checked_frame(messages, decode.checked_avro).drop("schema_id"),
    "changes": decode.checked_changes,
    "flat": decode.checked_flat_changes,
}
STAMPED = ("json", "avro", "framed")  # whose rows are bars with the stamps of their capture


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to: the same after a restart, another for a new checkpoint."""
    return json.loads(Storage(spark, checkpoint).read_text(f"{checkpoint}/metadata"))["id"]


def run_batches(rows: DataFrame, checkpoint: str, write: Callable[[DataFrame, str], None], drain: bool, interval: str) -> StreamingQuery:
    """A stream whose batches go to ``write`` with a name that a repeated batch has again."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write(batch, f"{stream_id(batch.sparkSession, checkpoint)}-{batch_id:09d}")

    trigger = {"availableNow": True} if drain else {"processingTime": interval}
    return rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def append_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    drain: bool = True,
    partition_by: Sequence[str] = (),
    interval: str = "1 minute",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append a stream to a table, exactly once; new columns widen its schema.

    Each batch writes a folder of its own, which a repeated batch writes anew. ``drain`` takes all there is and stops;
    otherwise the query runs on. The checkpoint lies outside the table.
    """
    if fmt == "parquet":
        return run_batches(rows, checkpoint, lambda batch, name: tables.put_batch(batch, path, name, partition_by), drain, interval)
    writer = rows.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    trigger = {"availableNow": True} if drain else {"processingTime": interval}
    return writer.trigger(**trigger).start(path)


def topic_to_bronze(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    encoding: str = "json",
    rejects: str | None = None,
    check: Check | None = None,
    partition_by: Sequence[str] = (),
    drain: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """A topic decoded into the bronze table, and what cannot be decoded into a table of rejects.

    One stream writes both. A batch is decoded once and written, and the two tables are made of that copy, each in a
    folder of the batch, so that a repeated batch leaves the same rows. ``encoding`` is one of ``CHECKS``; ``check`` replaces
    it. Rejects keep the message as it came and a reason; they lie in ``_rejects`` of the table unless another path is given.
    Bars get the broker's stamp as ``_capture_time_kafka`` and, like all rejects, ``_capture_time_bronze``.
    """
    checked, aside = check or CHECKS[encoding], rejects or f"{path}/_rejects"
    stamped = check is None and encoding in STAMPED

    def write(batch: DataFrame, name: str) -> None:
        kept = batch.columns
        whole = checked(batch).withColumn("_captured", F.current_timestamp())
        # The message is only written again where it is needed.
        slim = whole.withColumns({c: F.when(F.col("reason").isNotNull(), F.col(c)) for c in kept if c != "timestamp"})
        with materialized(slim, "bronze-batch") as copy:
            stamps = (F.col("timestamp").alias("_capture_time_kafka"), F.col("_captured").alias("_capture_time_bronze")) if stamped else ()
            rows = copy.where(F.col("row").isNotNull())
            # Names of the row come first: it may have a timestamp of its own.
            rows = rows.select("row", *stamps).select("row.*", *[s for s in ("_capture_time_kafka", "_capture_time_bronze") if stamped])
            tables.put_batch(rows, path, name, partition_by)
            lost = copy.where(F.col("reason").isNotNull()).select(*kept, "reason", F.col("_captured").alias("_capture_time_bronze"))
            tables.put_batch(lost, aside, name)

    return run_batches(messages, checkpoint, write, drain, interval)


def keep_every_copy(bronze: DataFrame, path: str, checkpoint: str, **how) -> StreamingQuery:
    """T4: bronze appended to silver without dedup, to compare with the upsert."""
    rows = bronze.withColumn("_capture_time_silver", F.current_timestamp())
    return append_stream(rows, path, checkpoint, **how)


def replay(
    spark: SparkSession,
    csv_path: str,
    checkpoint: str,
    path: str | None = None,
    bootstrap: str | None = None,
    files_per_batch: int = 1,
) -> StreamingQuery:
    """Bar files pushed to topics named by file stem, a few files per batch."""
    messages = as_messages(encode_replay(stream_bar_csvs(spark, csv_path, files_per_batch)))
    writer = messages.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True)
    if bootstrap:
        return writer.format("kafka").option("kafka.bootstrap.servers", bootstrap).start()
    return writer.format("parquet").start(path)
