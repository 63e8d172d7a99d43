"""Queries that encode bars as messages or files and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import adapters
from tidemark.functions import decode
from tidemark.functions.scalar import parse_timestamp
from tidemark.queries.registry import BARS, query
from tidemark.shared import scratch_path
from tidemark.sources import files, topics
from tidemark.streaming import bronze

BAR_COLUMNS = "ticker, \"timestamp\", open, high, low, close, volume"
IDENTITY = f"with {BARS} select {BAR_COLUMNS} from bars"


def _plain(bars: DataFrame) -> DataFrame:
    """Bar columns with a wall-clock timestamp, as the source table has it."""
    typed = bars
    if dict(bars.dtypes)["timestamp"] == "string":
        typed = bars.withColumn("timestamp", parse_timestamp("timestamp"))
    return typed.select(
        "ticker",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "open", "high", "low", "close", "volume",
    )


@query("message_roundtrip", IDENTITY)
def message_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "topic")
    topics.write_topic(decode.encode_bars(adapters.bars(spark, sf_dir)), "stocks", path=path)
    return _plain(decode.decode_json(topics.read_topic(spark, "stocks", path=path), decode.BAR_JSON))


@query("replay_roundtrip", f"with {BARS} select description, {BAR_COLUMNS} from bars")
def replay_roundtrip(spark, sf_dir):
    bars = adapters.bars(spark, sf_dir).withColumn("topic", F.col("ticker"))
    read = decode.decode_replay(decode.encode_replay(bars))
    return read.withColumn("timestamp", parse_timestamp("timestamp").cast("timestamp_ntz"))


@query("avro_roundtrip", IDENTITY)
def avro_roundtrip(spark, sf_dir):
    encoded = decode.encode_avro_bars(adapters.bars(spark, sf_dir))
    return _plain(decode.decode_avro_bars(encoded))


@query("framed_payload", f"with {BARS} select 7 as schema_id, {BAR_COLUMNS} from bars")
def framed_payload(spark, sf_dir):
    encoded = decode.encode_bars(adapters.bars(spark, sf_dir))
    framed = encoded.withColumn("value", decode.frame(F.col("value"), 7))
    read = decode.decode_json(decode.unframe(framed), decode.BAR_JSON, ("schema_id",))
    return read.select(
        "schema_id",
        "ticker",
        parse_timestamp("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "open", "high", "low", "close", "volume",
    )


@query(
    "framed_change_record",
    f"""with {BARS} select 9 as schema_id, _id, ticker, description, date_trunc('millisecond', "timestamp") as "timestamp",
      open, high, low, close, volume, case when ticker = 'error' then null else 'c' end as __op,
      'stocks' as __collection, epoch_us("timestamp") // 1000 as __ts_ms from bars""",
)
def framed_change_record(spark, sf_dir):
    """Flat change records behind a schema id; fields may be missing."""
    stamp = F.unix_millis(F.col("timestamp").cast("timestamp"))
    record = F.struct(
        "_id", "ticker", "description", stamp.alias("timestamp"), "open", "high", "low", "close", "volume",
        F.when(F.col("ticker") != "error", "c").alias("__op"), F.lit("stocks").alias("__collection"), stamp.alias("__ts_ms"),
    )
    framed = adapters.bars(spark, sf_dir).select(decode.frame(decode.utf8(F.to_json(record)), 9).alias("value"))
    rows = decode.decode_flat_changes(framed)
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(
    "cdc_unwrap",
    f"""with {BARS} select _id, ticker, description, date_trunc('millisecond', "timestamp") as "timestamp",
      open, high, low, close, volume, case when ticker = 'purchase' then 'u' else 'c' end as __op,
      'stocks' as __collection, epoch_us("timestamp") // 1000 as __ts_ms
    from bars where ticker <> 'error'""",
)
def cdc_unwrap(spark, sf_dir):
    changes = decode.unwrap_cdc(adapters.cdc_messages(spark, sf_dir))
    return changes.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(
    "api_pages",
    f"""with {BARS} select ticker, date_trunc('second', "timestamp") as "timestamp",
      cast(cast(open as float) as double) as open, cast(cast(high as float) as double) as high,
      cast(cast(low as float) as double) as low, cast(cast(close as float) as double) as close, volume
    from bars""",
)
def api_pages(spark, sf_dir):
    return _plain(decode.bars_from_pages(adapters.api_pages(spark, sf_dir)))


@query(
    "csv_export_text",
    f"""with {BARS} select ticker, strftime("timestamp", '%Y-%m-%d %H:%M:%S') as "timestamp",
      printf('%f', open) as open, printf('%f', high) as high, printf('%f', low) as low,
      printf('%f', close) as close, cast(volume as varchar) as volume from bars""",
)
def csv_export_text(spark, sf_dir):
    return files.bar_text(adapters.bars(spark, sf_dir))


@query(
    "csv_roundtrip",
    f"""with {BARS} select ticker, date_trunc('second', "timestamp") as "timestamp",
      cast(printf('%f', open) as double) as open, cast(printf('%f', high) as double) as high,
      cast(printf('%f', low) as double) as low, cast(printf('%f', close) as double) as close, volume
    from bars""",
)
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_bar_csvs(adapters.bars(spark, sf_dir), path)
    return _plain(files.read_bar_csvs(spark, path))


@query(
    "replay_stream",
    f"""with {BARS} select ticker, date_trunc('second', "timestamp") as "timestamp",
      cast(printf('%f', open) as double) as open, cast(printf('%f', high) as double) as high,
      cast(printf('%f', low) as double) as low, cast(printf('%f', close) as double) as close, volume
    from bars""",
)
def replay_stream(spark, sf_dir):
    """Bars as CSV files, the files replayed into a topic per file, the topics read."""
    path = scratch_path(spark, "replay")
    files.write_bar_csvs(adapters.bars(spark, sf_dir), f"{path}/files")
    bronze.replay(
        spark, f"{path}/files", f"{path}/_checkpoint", path=f"{path}/topics", files_per_batch=1000
    ).awaitTermination()
    sent = spark.read.schema(topics.TOPIC_SCHEMA).parquet(f"{path}/topics")
    return _plain(decode.decode_replay(sent))


@query(
    "ticker_list",
    """select cast(c_custkey as varchar) as _id, c_name as ticker, concat(c_name, ', "Inc."') as security,
      c_mktsegment as asset_type from customer""",
)
def ticker_list(spark, sf_dir):
    """Customers as a list of tickers with commas and quotes in a field, written and read."""
    path = scratch_path(spark, "tickers")
    unknown = F.lit(None).cast("string")
    files.write_tickers(
        adapters.table(spark, sf_dir, "customer").select(
            F.col("c_custkey").cast("string").alias("_id"),
            F.col("c_name").alias("ticker"),
            F.concat("c_name", F.lit(', "Inc."')).alias("security"),
            F.col("c_mktsegment").alias("asset_type"),
            *[unknown.alias(c) for c in ("currency", "mic", "cik", "composite_figi", "share_figi", "lei")],
        ),
        path,
    )
    return files.read_tickers(spark, path).select("_id", "ticker", "security", "asset_type")
