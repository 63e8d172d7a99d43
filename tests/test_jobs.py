import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import adapters
from tidemark.functions.decode import encode_bars
from tidemark.plans import backfill, events, jobs, retail, stocks
from tidemark.sources import tables, topics
from tidemark.sources.layout import Lake
from tidemark.streaming import silver as silver_streams


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_retail_job(spark, sf, path):
    lake, landing = Lake(path), adapters.retail(spark, sf)
    for _ in range(2):
        jobs.retail_job(spark, lake, landing)
    gold = tables.read_table(spark, lake.path("gold", "invoicesbycountry"))
    assert _rows(gold) == _rows(retail.by_country(retail.silver(landing)))
    assert tables.read_table(spark, lake.path("silver", "vendas")).count() == landing.count()


def test_stocks_job(spark, sf, path):
    lake, topic = Lake(path), f"{path}/_topic"
    messages = adapters.cdc_messages(spark, sf).withColumn("key", F.lit(None).cast("binary"))
    topics.write_topic(messages, "stocks", path=topic)
    topics.write_topic(messages, "stocks", path=topic)
    jobs.stocks_job(spark, lake, topics.stream_topic(spark, "stocks", path=topic))
    bars = adapters.bars(spark, sf).where("ticker <> 'error'")
    silver = tables.read_table(spark, lake.path("silver", "stocks", "StockData"))
    assert silver.count() == bars.count()
    assert set(silver.columns) >= {"day", "osc", "osc_per", "__op", "__collection", "__ts_ms"}
    gold = tables.read_table(spark, lake.path("gold", "stocks", "StockData"))
    want = stocks.gold_daily(bars)
    assert _rows(gold) == _rows(want)
    # The change is captured when the bar is made, five hours are taken off the stamp.
    assert silver.where(F.col("__ts_ms") != F.col("timestamp") - F.expr("interval 5 hours")).count() == 0
    assert jobs.maintenance_job(spark, lake)


def test_stocks_job_takes_later_messages_and_keeps_broken_ones(spark, sf, path):
    """The second run recomputes the days of its messages only, and equals one run over everything."""
    lake, topic = Lake(path), f"{path}/_topic"
    changes = adapters.cdc_messages(spark, sf).withColumn("key", F.lit(None).cast("binary"))
    for value in (None, bytearray(b'{"op": {"string": "c"'), bytearray(b'{"op": {"string": "c"}, "after": null}')):
        if value is None:
            topics.write_topic(changes, "stocks", path=topic)
        else:
            topics.write_topic(spark.createDataFrame([(None, value)], "key binary, value binary"), "stocks", path=topic)
        jobs.stocks_job(spark, lake, topics.stream_topic(spark, "stocks", path=topic))
    bars = adapters.bars(spark, sf).where("ticker <> 'error'")
    assert _rows(tables.read_table(spark, lake.path("gold", "stocks", "StockData"))) == _rows(stocks.gold_daily(bars))
    lost = tables.read_table(spark, lake.path("rejects", "stocks", "StockData"))
    assert sorted(r["reason"] for r in lost.collect()) == ["no document", "unreadable envelope"]
    report = {(r["tier"], r["table"]): r for r in jobs.maintenance_job(spark, lake, 4)}
    assert all("skipped" not in r for r in report.values()) and "batches_before" in report["bronze", "stocks"]


def test_intraday_job_twice(spark, sf, path):
    lake, topic = Lake(path), f"{path}/_topic"
    bars = adapters.bars(spark, sf)
    late = F.col("timestamp") >= F.lit("2024-01-20").cast("timestamp_ntz")
    revised = bars.where((F.col("ticker") == "view") & (F.col("timestamp") > F.lit("2024-01-18").cast("timestamp_ntz")))
    revised = revised.withColumn("close", F.col("close") + 2)
    first = bars.where(~late)
    second = bars.where(late & (F.col("ticker") != "view")).unionByName(revised)
    for part in (first, second):
        topics.write_topic(encode_bars(part), "stocks", path=topic)
        jobs.intraday_job(spark, lake, topics.stream_topic(spark, "stocks", path=topic))
    gold = tables.read_table(spark, lake.path("gold", "stocks_intraday"))
    assert gold.schema.names == stocks.GOLD_INTRADAY.names
    final = bars.join(revised.select("_id", F.col("close").alias("new")), "_id", "left").withColumn(
        "close", F.coalesce("new", "close")
    )
    key = ["ticker", F.col("timestamp").cast("string").alias("t"), "close", "osc", "osc_per"]
    assert _rows(gold.select(*key)) == _rows(stocks.with_changes(final).select(*key))
    assert gold.where("_delta_kafka_bronze is null or _delta_silver_gold is null").count() == 0


def test_events_job_is_repeatable(spark, sf, path):
    lake = Lake(path)
    evento = adapters.evento(spark, sf)
    tables.publish(evento, lake.path("silver", "audit"), events.DAY)
    for _ in range(2):
        jobs.events_job(spark, lake)
    gold = tables.read_table(spark, lake.path("gold", "audit"))
    assert gold.agg(F.sum("quantidade")).first()[0] == evento.count()
    # One name per id keeps the statistics' row count.
    assert gold.count() == events.statistics(evento).count()
    days = events.export_rows(gold, dt.date(2024, 1, 3), dt.date(2024, 1, 4))
    assert {r["d"] for r in days.select(F.to_date("horario").alias("d")).distinct().collect()} == {
        dt.date(2024, 1, 3), dt.date(2024, 1, 4),
    }


def test_null_ids_drop_out_of_the_mart(spark, sf):
    evento = adapters.evento(spark, sf).withColumn(
        "idcliente", F.when(F.col("idcliente") != "3", F.col("idcliente"))
    )
    got = events.mart(evento).agg(F.sum("quantidade")).first()[0]
    assert got == evento.where("idcliente is not null").count()


def test_no_events_give_an_empty_mart(spark, sf):
    assert events.mart(adapters.evento(spark, sf).limit(0)).count() == 0


def test_audit_schema_and_text_stamps(spark, sf, path):
    lake = Lake(path)
    bronze, silver = lake.path("bronze", "audit"), lake.path("silver", "audit")
    rows = [("1", "2024-12-31T23:00:00-03:00"), ("2", "bad"), ("1", "2024-01-05T10:07:00Z")]
    text = spark.createDataFrame(rows, "_id string, data_criacao string")
    for name in events.AUDIT_TEXT:
        if name != "data_criacao":
            text = text.withColumn(name, F.lit(None).cast("string"))
    tables.append(text, bronze)
    silver_streams.events_to_silver(
        spark, bronze, silver, lake.checkpoint("silver", "audit"), events.AUDIT
    ).awaitTermination()
    got = tables.read_table(spark, silver).select("_id", "ano", "mes", "dia", "hora", "minuto").collect()
    assert sorted(map(tuple, got)) == [("1", 2025, 1, 1, 2, 0), ("2", None, None, None, None, None)]


def test_backfill(spark):
    bars = lambda rows: spark.createDataFrame(
        [(t, dt.datetime.fromisoformat(ts)) for t, ts in rows], "ticker string, timestamp timestamp"
    )
    history = bars([("A", "2024-01-04 10:00"), ("A", "2024-01-04 11:00")])
    later = bars(
        [("A", "2024-01-04 12:00"), ("A", "2024-01-05 09:00"), ("A", "2024-01-06 09:00"), ("B", "2024-01-01 09:00")]
    )
    got = backfill.concat(history, later).select("ticker", F.date_format("timestamp", "dd HH")).collect()
    assert sorted(map(tuple, got)) == [("A", "04 10"), ("A", "04 11"), ("A", "05 09"), ("B", "01 09")]
    days = backfill.business_days_between(spark, dt.date(2024, 1, 5), dt.date(2024, 1, 9)).collect()
    assert [r["day"] for r in days] == [dt.date(2024, 1, 5), dt.date(2024, 1, 8)]
    same = backfill.business_days_between(spark, dt.date(2024, 1, 5), dt.date(2024, 1, 5))
    assert same.count() == 0


def test_checkpoint_folder_comes_from_the_session(spark):
    from tidemark.shared import shared_dir

    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        pytest.skip("no folder named in this session")
    assert shared_dir(spark) == named.rstrip("/")
