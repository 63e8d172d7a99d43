"""Views that shape the test tables into bars, invoices, audit events, features and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import decode
from tidemark.operators.lag import choose_slice


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market bars from ``events``: ticker = event type, volume = the number in ``props``."""
    k = F.regexp_extract("props", "([0-9]+)", 1)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("_id"),
        F.col("event_type").alias("ticker"),
        F.col("event_type").alias("description"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("open"),
        (F.col("value") + k.cast("double") / F.lit(100.0)).alias("high"),
        (F.col("value") - k.cast("double") / F.lit(1000.0)).alias("low"),
        F.col("value").alias("close"),
        k.cast("bigint").alias("volume"),
    )


def captured_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with the four layer capture stamps, each a few seconds after the one before."""
    seconds = lambda n: F.make_dt_interval(secs=(F.col("_id").cast("bigint") % n).cast("decimal(18,6)"))
    return (
        bars(spark, sf_dir)
        .withColumn("_capture_time_kafka", F.col("timestamp"))
        .withColumn("_capture_time_bronze", F.col("_capture_time_kafka") + seconds(7))
        .withColumn("_capture_time_silver", F.col("_capture_time_bronze") + seconds(11))
        .withColumn("_capture_time_gold", F.col("_capture_time_silver") + seconds(13))
    )


def retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines; an order with status F becomes a cancellation."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(
                F.when(F.col("o_orderstatus") == "F", "C").otherwise(""),
                F.col("o_orderkey").cast("string"),
            ).alias("InvoiceNo"),
            F.col("l_partkey").cast("string").alias("StockCode"),
            F.col("p_name").alias("Description"),
            F.col("l_quantity").cast("bigint").alias("Quantity"),
            F.col("o_orderdate").alias("InvoiceDate"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("UnitPrice"),
            F.col("o_custkey").alias("CustomerID"),
            F.col("n_name").alias("Country"),
        )
    )


def evento(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit events; some users carry two names."""
    user, event = F.col("user_id"), F.col("event_id")
    text = lambda c: c.cast("string")
    return table(spark, sf_dir, "events").select(
        text(event).alias("_id"),
        F.year("ts").alias("ano"),
        F.month("ts").alias("mes"),
        F.dayofmonth("ts").alias("dia"),
        F.hour("ts").alias("hora"),
        F.minute("ts").alias("minuto"),
        F.col("ts").alias("data_criacao"),
        text(user % 3).alias("idplataforma"),
        F.concat(F.lit("plataforma "), text(user % 3)).alias("plataforma"),
        text(user % 7).alias("idcliente"),
        F.concat(F.lit("cliente "), text(user % 7)).alias("cliente"),
        text(event % 5).alias("idservico"),
        F.concat(F.lit("servico "), text(event % 5)).alias("servico"),
        text(event % 4).alias("idproduto"),
        F.concat(F.lit("produto "), text(event % 4)).alias("produto"),
        text(event % 6).alias("idatividade"),
        F.concat(F.lit("atividade "), text(event % 6)).alias("atividade"),
        F.col("event_type").alias("idacao"),
        F.concat(F.lit("acao "), F.col("event_type")).alias("acao"),
        text(user).alias("idusuario"),
        F.concat(
            F.lit("usuario "), text(user), F.when(event % 97 == 0, " b").otherwise("")
        ).alias("nomeusuario"),
    )


ENTRIES = 64  # of an embedding
FEATURES = [f"f{i}" for i in range(1, ENTRIES + 1)]


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entries of each embedding as measurements, and its class; a longer one is an error, a shorter one lacks some."""
    longer = F.raise_error(F.concat(F.lit("an embedding has more entries than the "), F.lit(ENTRIES)))
    whole = F.when(F.size("embedding") > ENTRIES, longer.cast("array<float>")).otherwise(F.col("embedding"))
    return table(spark, sf_dir, "embeddings").withColumn("embedding", whole).select(
        F.col("vec_id").alias("id"),
        "label",
        *[
            F.get("embedding", F.lit(i)).cast("double").alias(name)
            for i, name in enumerate(FEATURES)
        ],
    )


def cdc_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change messages over bars: deletes for ``error``, updates for ``purchase``, a tombstone
    after each delete."""
    rows = bars(spark, sf_dir).withColumn(
        "op",
        F.when(F.col("ticker") == "error", "d")
        .when(F.col("ticker") == "purchase", "u")
        .otherwise("c"),
    )
    messages = rows.select(
        decode.cdc_envelope(
            F.struct("_id", "ticker", "description", "timestamp", "open", "high", "low", "close", "volume"),
            F.col("op"),
            collection="stocks",
        ).alias("value"),
        "op",
    )
    tombstone = F.when(F.col("op") == "d", F.array(F.col("value"), F.lit(None).cast("binary")))
    return messages.select(
        F.explode(F.coalesce(tombstone, F.array("value"))).alias("value")
    )


def broken_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change messages over bars, deletes for ``error``, of which a quarter are broken, each in one of five ways."""
    rows = bars(spark, sf_dir).withColumn("op", F.when(F.col("ticker") == "error", "d").otherwise("c"))
    row = F.struct("_id", "ticker", "description", "timestamp", "open", "high", "low", "close", "volume")
    value = decode.cdc_envelope(row, F.col("op"), collection="stocks").cast("string")
    kind = F.col("_id").cast("long") % 20
    broken = (
        F.when(kind == 0, F.expr("substring(value, 1, length(value) - 9)"))
        .when(kind == 1, F.regexp_replace("value", r'\\"close\\":', r'\\"close\\" '))
        .when(kind == 2, F.regexp_replace("value", '"after":[{].*[}],"source"', '"after":null,"source"'))
        .when(kind == 3, F.regexp_replace("value", '"op":[{][^}]*[}]', '"op":null'))
        .when(kind == 4, F.regexp_replace("value", r'oid', "other"))
        .otherwise(F.col("value"))
    )
    return rows.withColumn("value", value).select(F.lit(None).cast("binary").alias("key"), decode.utf8(broken).alias("value"))


def broken_flat_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat change records of bars behind a frame, of which some have no frame and some are cut."""
    stamp = F.unix_millis(F.col("timestamp").cast("timestamp"))
    record = F.struct("_id", "ticker", "description", stamp.alias("timestamp"), "open", "high", "low", "close", "volume")
    text = decode.utf8(F.to_json(record))
    kind = F.col("_id").cast("long") % 20
    framed = decode.frame(text, 9)
    value = F.when(kind == 0, text).when(kind == 1, F.substring(framed, 1, 40)).otherwise(framed)
    return bars(spark, sf_dir).select(F.lit(None).cast("binary").alias("key"), value.alias("value"))


def api_pages(spark: SparkSession, sf_dir: str, page_rows: int = 500) -> DataFrame:
    """Bars grouped into response pages, each page one time slice of one ticker.

    The slice width is measured so that no page collects more than ``page_rows`` bars.
    """
    rows = bars(spark, sf_dir)
    unit = choose_slice(rows, ["ticker"], "timestamp", page_rows)
    item = F.struct(
        F.unix_timestamp(F.col("timestamp").cast("timestamp")).alias("t"),
        *[F.col(c).cast("float").alias(c[0]) for c in ("open", "high", "low", "close")],
        F.col("volume").cast("int").alias("v"),
    )
    return (
        rows.groupBy("ticker", F.date_trunc(unit, "timestamp").alias("slice"))
        .agg(F.collect_list(item).alias("data"))
        .select("ticker", F.to_json(F.struct("data")).alias("body"))
    )
