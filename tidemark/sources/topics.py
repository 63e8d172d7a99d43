"""Message topics, on Kafka or as a directory of Kafka-shaped Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the columns of Spark's Kafka source.
TOPIC_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
    "timestampType int"
)


def stream_topic(
    spark: SparkSession,
    topic: str,
    bootstrap: str | None = None,
    path: str | None = None,
    first_run: bool = True,
    max_files: int | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """S3: a topic as a stream, from the start when the target is missing, else only what is new.

    Offsets that the broker no longer has are an error unless ``fail_on_data_loss`` is off. Where a checkpoint exists it decides, not ``first_run``. A topic directory always starts at
    its first file.
    """
    if bootstrap:
        return (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest" if first_run else "latest")
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
            .load()
        )
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path).where(F.col("topic") == topic)


def read_topic(
    spark: SparkSession, topic: str, bootstrap: str | None = None, path: str | None = None
) -> DataFrame:
    """The whole topic as a batch."""
    if bootstrap:
        return (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", topic)
            .load()
        )
    return spark.read.schema(TOPIC_SCHEMA).parquet(path).where(F.col("topic") == topic)


def as_messages(encoded: DataFrame, topic: str | None = None, partitions: int = 4) -> DataFrame:
    """Shape encoded rows (``key``, ``value``, optionally ``topic``, ``timestamp``) like Kafka's.

    ``offset`` is left to the broker; in a topic directory it is NULL, as files have their own order.
    """
    has = set(encoded.columns)
    return encoded.select(
        "key",
        "value",
        (F.lit(topic) if topic else F.col("topic")).alias("topic"),
        F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(partitions)).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        (F.col("timestamp") if "timestamp" in has else F.current_timestamp())
        .cast("timestamp")
        .alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def write_topic(
    encoded: DataFrame, topic: str | None = None, bootstrap: str | None = None, path: str | None = None
) -> None:
    """Publish encoded rows to a topic."""
    messages = as_messages(encoded, topic)
    if bootstrap:
        (
            messages.select("key", "value", "topic")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .save()
        )
    else:
        messages.write.mode("append").parquet(path)
