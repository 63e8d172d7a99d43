"""The scheduled jobs: each wires sources, refinement and sinks of one data set together."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.upsert import merge_upsert
from tidemark.plans import events, maintenance, retail, stocks
from tidemark.sources import tables
from tidemark.sources.jdbc import publish_mart
from tidemark.sources.layout import Lake
from tidemark.streaming.bronze import topic_to_bronze
from tidemark.streaming.silver import bars_to_silver

# Table names of the lakehouse and of the marts.
STOCK_DB = "StockData"
MART_CONNECTIONS = 32  # what the mart database bears at once
MARTS = {
    "invoices": "invoicesbycountry",
    "daily": "stocks_daily",
    "intraday": "stocks_intraday",
    "events": "eventos",
}


def retail_job(
    spark: SparkSession, lake: Lake, landing: DataFrame, connection: Mapping[str, str] | None = None
) -> None:
    """Landing sheet to bronze, to silver lines and lists, to gold quantities and their mart."""
    bronze_path = lake.path("bronze", "vendas")
    tables.publish(landing, bronze_path)
    bronze = tables.read_table(spark, bronze_path)
    tables.publish(retail.silver(bronze), lake.path("silver", "vendas"))
    tables.publish(retail.stock_list(bronze), lake.path("silver", "stock"), sort_cols=["Description"])
    tables.publish(retail.country_list(bronze), lake.path("silver", "country"), sort_cols=["country"])
    silver = tables.read_table(spark, lake.path("silver", "vendas"))
    gold_path = lake.path("gold", "invoicesbycountry")
    tables.publish(retail.by_country(silver), gold_path, sort_cols=["country", "InvoiceDate", "type"])
    if connection:
        publish_mart(tables.read_table(spark, gold_path), MARTS["invoices"], connection, partitions=MART_CONNECTIONS)


def stocks_job(
    spark: SparkSession,
    lake: Lake,
    messages: DataFrame,
    connection: Mapping[str, str] | None = None,
    keep_copies: bool = False,
    unit: str | None = None,
) -> None:
    """Change messages drained to bronze, then silver and daily gold brought up to date, then both marts.

    Messages that cannot be unwrapped go to a table of rejects. Bronze is read as a stream: only the days that its new
    bars fall on are recomputed, see ``stocks.refresh_days``. ``unit`` is the width of the time slices of the lag.

    A re-sent bar would show a change of 0 and count its volume twice, so copies are dropped
    unless ``keep_copies`` asks for the plain recompute of everything from all of bronze.
    """
    bronze_path = lake.path("bronze", "stocks", STOCK_DB)
    topic_to_bronze(
        messages,
        bronze_path,
        lake.checkpoint("bronze", "stocks", STOCK_DB, reader="topic"),
        "changes",
        rejects=lake.path("rejects", "stocks", STOCK_DB),
        partition_by=["ticker"],
    ).awaitTermination()
    silver_path, gold_path = (lake.path(tier, "stocks", STOCK_DB) for tier in ("silver", "gold"))
    if keep_copies:
        bars = tables.read_table(spark, bronze_path)
        tables.publish(stocks.silver(bars, fill="all", unit=unit), silver_path, ["ticker", "day"], sort_cols=["timestamp"])
        tables.publish(stocks.gold_daily(tables.read_table(spark, silver_path)), gold_path, ["ticker", "day"])
    elif tables.exists(spark, bronze_path):
        latest_path = lake.path("silver", "stocks_latest", STOCK_DB)
        refresh = lambda batch, _: stocks.refresh_days(batch, latest_path, silver_path, gold_path, unit=unit or "hour")
        reader = lake.checkpoint("silver", "stocks", STOCK_DB, reader="bronze")
        bars = tables.read_table_stream(spark, bronze_path, checkpoint=reader)
        bars.writeStream.foreachBatch(refresh).option("checkpointLocation", reader).trigger(availableNow=True).start().awaitTermination()
    if connection:
        silver = tables.read_table(spark, silver_path)
        publish_mart(tables.read_table(spark, gold_path), MARTS["daily"], connection, partitions=MART_CONNECTIONS)
        publish_mart(stocks.intraday_mart(silver), MARTS["intraday"], connection, partitions=MART_CONNECTIONS)


def intraday_job(spark: SparkSession, lake: Lake, messages: DataFrame, encoding: str = "json") -> None:
    """Topic to bronze, bronze upserted into silver, and gold brought up to date from what changed.

    Gold keeps each bar's silver stamp, so that its newest stamp tells what it has seen, also after
    a run that stopped half way.
    """
    bronze, silver, gold = (lake.path(t, "stocks_intraday") for t in ("bronze", "silver", "gold"))
    topic_to_bronze(
        messages, bronze, lake.checkpoint("bronze", "stocks_intraday", reader="topic"), encoding, rejects=lake.path("rejects", "stocks_intraday")
    ).awaitTermination()
    bars_to_silver(
        spark, bronze, silver, lake.checkpoint("silver", "stocks_intraday", reader="bronze")
    ).awaitTermination()
    created = tables.ensure_table(spark, gold, stocks.GOLD_INTRADAY, ["ticker", "ano"])
    bars = tables.read_table(spark, silver)
    if created:
        fresh = stocks.gold_intraday(bars)
    else:
        seen = tables.read_table(spark, gold).agg(F.max("_capture_time_silver")).first()[0]
        unseen = F.lit(True) if seen is None else F.col("_capture_time_silver") > F.lit(seen)
        changed = bars.where(unseen).select("ticker", "timestamp")
        rows = stocks.refreshed_changes(bars, changed)
        fresh = stocks.latency(rows.withColumn("_capture_time_gold", F.current_timestamp()))
    merge_upsert(fresh, gold, ["ticker", "timestamp"], partitions_follow_keys=True, unique=True)


def events_job(
    spark: SparkSession,
    lake: Lake,
    connection: Mapping[str, str] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> None:
    """Silver audit events to the gold mart, days replaced whole, and the days' rows exported.

    The export appends, so it needs its range of days: without one, each run would add all rows again.
    """
    if connection and not (start and end):
        raise ValueError("the export needs start and end")
    silver = tables.read_table(spark, lake.path("silver", "audit"))
    gold_path = lake.path("gold", "audit")
    tables.publish(events.mart(silver), gold_path, events.DAY, replace="partitions")
    if connection:
        rows = events.export_rows(tables.read_table(spark, gold_path), start, end)
        publish_mart(rows, MARTS["events"], connection, mode="append", partitions=MART_CONNECTIONS)


def maintenance_job(spark: SparkSession, lake: Lake, retention_hours: float = 4) -> list[dict]:
    """Compact and vacuum every table of the lake; report per table.

    Tables by batches, as bronze and its rejects, have their batches merged once they are older than the retention.
    A table that a file sink of Spark's own appends to belongs to that sink's file log: it is reported as skipped, with
    its number of files.
    """
    report = []
    for row in maintenance.discover(spark, lake).collect():
        path = row["path"]
        if tables.stream_written(spark, path):
            files = maintenance.files(spark, path).count()
            report.append({"tier": row["tier"], "table": row["table"], "skipped": "written by a stream", "files_before": files})
            continue
        if tables.partition_cols_of(spark, path)[:1] == [tables.BATCH]:
            result = maintenance.merge_batches(spark, path, retention_hours)
        else:
            result = maintenance.compact(spark, path)
        result["removed"] = maintenance.vacuum(spark, path, retention_hours)
        report.append({"tier": row["tier"], "table": row["table"], **result})
    return report
