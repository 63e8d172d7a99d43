"""Queries over published tables: dedup, upsert, streams, maintenance, catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import adapters
from tidemark.functions.decode import encode_bars
from tidemark.functions.scalar import parse_date, rejected
from tidemark.operators import dedup
from tidemark.operators.upsert import merge_upsert
from tidemark.plans import maintenance, stocks
from tidemark.queries.registry import BARS, EVENTO, query
from tidemark.shared import materialize, scratch_path
from tidemark.sources import tables, topics
from tidemark.sources.layout import Lake, TableName
from tidemark.sources.storage import Storage
from tidemark.streaming import bronze as bronze_streams
from tidemark.streaming import silver as silver_streams

# Fixed values of the queries: when the second delivery starts, and the re-sent day.
CUTOFF = "2024-01-24 00:00:00"
RESENT_FROM = "2024-01-29 00:00:00"
TOPIC = "stocks"
BAR_COLUMNS = ["ticker", "timestamp", "open", "high", "low", "close", "volume"]

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_REST = (
    "l_shipdate l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus"
).split()

RESENT = f"""with {BARS}, resent as (
  select * from bars union all select * from bars where "timestamp" >= timestamp '{RESENT_FROM}')"""


def _stamp(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _resent(spark, sf_dir) -> DataFrame:
    bars = adapters.bars(spark, sf_dir)
    return bars.unionByName(bars.where(F.col("timestamp") >= _stamp(RESENT_FROM)))


def _plain(rows: DataFrame, *more: str) -> DataFrame:
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp").cast("timestamp_ntz")).select(
        *BAR_COLUMNS, *more
    )


# ---- dedup and audits ---------------------------------------------------------------------------


@query("dedup_full", f"{RESENT} select distinct * from resent")
def dedup_full(spark, sf_dir):
    return dedup.distinct_rows(_resent(spark, sf_dir))


@query(
    "dedup_by_key",
    f"""select * exclude (place) from (
      select *, row_number() over (partition by {', '.join(LINE_KEYS)}
        order by {', '.join(c + ' desc' for c in LINE_REST)}) as place from lineitem) where place = 1""",
)
def dedup_by_key(spark, sf_dir):
    return dedup.one_per_key(adapters.table(spark, sf_dir, "lineitem"), LINE_KEYS, *LINE_REST)


@query(
    "dup_audit",
    """select cast(sum(c) as bigint) as rows, count(*) as distinct_keys, cast(sum(c) as bigint) - count(*) as surplus
    from (select count(*) as c from lineitem group by l_orderkey, l_linenumber)""",
)
def dup_audit(spark, sf_dir):
    return dedup.duplicate_audit(adapters.table(spark, sf_dir, "lineitem"), LINE_KEYS)


@query(
    "reconcile_layers",
    f"""{RESENT}, silver as (select * from bars where "timestamp" < timestamp '{CUTOFF}')
    select (select count(*) from resent) as upstream_rows, (select count(*) from silver) as downstream_rows,
      (select count(*) from (select ticker, "timestamp" from resent except select ticker, "timestamp" from silver))
        as missing_keys, cast(0 as bigint) as extra_keys""",
)
def reconcile_layers(spark, sf_dir):
    late = adapters.bars(spark, sf_dir).where(F.col("timestamp") < _stamp(CUTOFF))
    return dedup.reconcile(_resent(spark, sf_dir), late, ["ticker", "timestamp"])


@query(
    "reconcile_content",
    f"""with {BARS} select ticker, strftime("timestamp", '%Y-%m-%d') as day,
      cast(count_if(cast(_id as bigint) % 10 = 3) as bigint) as missing, cast(count_if(cast(_id as bigint) % 10 = 4) as bigint) as extra,
      cast(count_if(cast(_id as bigint) % 10 = 5) as bigint) as changed
    from bars where (ticker = 'purchase' and day("timestamp") in (3, 17)) or (ticker = 'view' and day("timestamp") = 9)
    group by all having missing + extra + changed > 0""",
)
def reconcile_content(spark, sf_dir):
    """A10: layers that agree but for a few partitions, in which rows are missing, doubled under a new id, or have another price."""
    bars = adapters.bars(spark, sf_dir).withColumn("day", F.date_format("timestamp", "yyyy-MM-dd"))
    spoiled = ((F.col("ticker") == "purchase") & F.dayofmonth("timestamp").isin(3, 17)) | ((F.col("ticker") == "view") & (F.dayofmonth("timestamp") == 9))
    kind = F.when(spoiled, F.col("_id").cast("long") % 10).otherwise(-1)
    copies = F.when(kind == 3, F.array()).when(kind == 4, F.array(F.lit(""), F.lit("+"))).otherwise(F.array(F.lit("")))
    below = bars.withColumn("close", F.when(kind == 5, F.col("close") + 1).otherwise(F.col("close"))).withColumn("_more", F.explode(copies.cast("array<string>")))
    below = below.withColumn("_id", F.concat("_id", "_more")).drop("_more")
    return dedup.differences(bars, below, ["ticker", "day"], ["_id"])


@query(
    "not_null_counts",
    f"""select count(*) as rows, count(vec_id) as id, count(label) as label,
      {', '.join(f'count(embedding[{i}]) as f{i}' for i in range(1, adapters.ENTRIES + 1))} from embeddings""",
)
def not_null_counts(spark, sf_dir):
    return dedup.not_null_counts(adapters.features(spark, sf_dir))


# ---- upsert -------------------------------------------------------------------------------------


@query(
    "upsert_batch",
    f"""with {BARS} select ticker, cast(year("timestamp") as int) as ano, "timestamp", open, high, low,
      case when ticker = 'purchase' then close + 1 else close end as close, volume from bars""",
)
def upsert_batch(spark, sf_dir):
    """A first delivery, then a second with later bars and corrected ``purchase`` closes.

    A ticker may have several bars of one instant. A delivery has all of those or none, so they are replaced together.
    """
    bars = adapters.bars(spark, sf_dir).withColumn("ano", F.year("timestamp"))
    bars = bars.select("ticker", "ano", "timestamp", "open", "high", "low", "close", "volume")
    path = scratch_path(spark, "upsert")
    tables.ensure_table(spark, path, bars.schema, ["ticker", "ano"])
    merge_upsert(bars.where(F.col("timestamp") < _stamp(CUTOFF)), path, ["ticker", "timestamp"], True, repeats=True)
    revised = F.when(F.col("ticker") == "purchase", F.col("close") + 1).otherwise(F.col("close"))
    second = bars.where((F.col("timestamp") >= _stamp(CUTOFF)) | (F.col("ticker") == "purchase"))
    merge_upsert(second.withColumn("close", revised), path, ["ticker", "timestamp"], True, repeats=True)
    return tables.read_table(spark, path)


_EVENT_COLUMNS = ["_id", "ano", "mes", "dia", "data_criacao", "acao", "idusuario"]


@query(
    "upsert_by_id",
    f"""with {EVENTO}, revised as (
      select _id, case when idacao = 'signup' then data_criacao + interval 1 day else data_criacao end as data_criacao,
             concat(acao, ' v2') as acao, idusuario from evento where dia > 15)
    select _id, ano, mes, dia, data_criacao, acao, idusuario from evento where dia <= 15 union all
    select _id, cast(year(data_criacao) as int) as ano, cast(month(data_criacao) as int) as mes,
           cast(day(data_criacao) as int) as dia, data_criacao, acao, idusuario from revised""",
)
def upsert_by_id(spark, sf_dir):
    """Events by ``_id``; some revised events move to another day's partition."""
    events = adapters.evento(spark, sf_dir).select(*_EVENT_COLUMNS, "idacao")
    path = scratch_path(spark, "upsert-id")
    tables.ensure_table(
        spark, path, events.select(*_EVENT_COLUMNS).schema, ["ano", "mes", "dia"]
    )
    merge_upsert(events.where("dia <= 20"), path, ["_id"])
    moved = F.col("data_criacao") + F.when(
        F.col("idacao") == "signup", F.make_dt_interval(days=F.lit(1))
    ).otherwise(F.make_dt_interval())
    revised = (
        events.where("dia > 15")
        .withColumn("data_criacao", moved)
        .withColumn("acao", F.concat("acao", F.lit(" v2")))
        .withColumn("ano", F.year("data_criacao"))
        .withColumn("mes", F.month("data_criacao"))
        .withColumn("dia", F.dayofmonth("data_criacao"))
    )
    merge_upsert(revised, path, ["_id"])
    return tables.read_table(spark, path)


@query(
    "refresh_after_correction",
    f"""with {BARS}, corrected as (
      select * replace (case when ticker = 'purchase' and "timestamp" >= timestamp '{CUTOFF}' then close + 1
                        else close end as close) from bars), lagged as (
      select *, lag(close) over (partition by ticker order by "timestamp") as prev from corrected)
    select ticker, cast(year("timestamp") as int) as ano, "timestamp", close, coalesce(close - prev, 0) as osc,
      coalesce(coalesce(close - prev, 0) * 100.0 / nullif(prev, 0), 0) as osc_per from lagged""",
)
def refresh_after_correction(spark, sf_dir):
    """Gold built once, then only what a correction of late ``purchase`` bars alters."""
    keys, columns = ["ticker", "timestamp"], ["ticker", "ano", "timestamp", "close"]
    bars = adapters.bars(spark, sf_dir).withColumn("ano", F.year("timestamp")).select(*columns)
    first = stocks.with_changes(bars)
    path = scratch_path(spark, "refresh")
    tables.publish(first, path, ["ticker", "ano"])
    late = (F.col("ticker") == "purchase") & (F.col("timestamp") >= _stamp(CUTOFF))
    corrected = bars.withColumn("close", F.when(late, F.col("close") + 1).otherwise(F.col("close")))
    changes = stocks.refreshed_changes(corrected, bars.where(late).select(*keys))
    merge_upsert(changes, path, keys, partitions_follow_keys=True)
    return tables.read_table(spark, path)


DAYS_TABLES = ("latest", "silver", "gold")
CORRECTED = f"""{BARS}, corrected as (
      select * replace (case when ticker = 'purchase' and day("timestamp") in (5, 20) then close + 1 else close end as close) from bars)"""


def _refreshed_days(spark, sf_dir) -> dict[str, str]:
    """Bars up to a day, then all later ones with corrections of two earlier days, then the corrections once more."""
    bars = adapters.bars(spark, sf_dir)
    root = scratch_path(spark, "refresh-days")
    paths = {name: f"{root}/{name}" for name in DAYS_TABLES}
    late = F.col("timestamp") >= _stamp(CUTOFF)
    wrong = (F.col("ticker") == "purchase") & F.dayofmonth("timestamp").isin(5, 20)
    corrected = bars.withColumn("close", F.when(wrong, F.col("close") + 1).otherwise(F.col("close")))
    for rows, stamp in ((bars.where(~late), 1), (corrected.where(late | wrong), 2), (corrected.where(wrong), 2)):
        stocks.refresh_days(rows.withColumn("__ts_ms", F.lit(stamp).cast("long")), *paths.values())
    return paths


@query(
    "refresh_days_silver",
    f"""with {CORRECTED}, lagged as (
      select *, lag(close) over (partition by ticker order by "timestamp") as prev from corrected)
    select _id, ticker, strftime("timestamp", '%Y-%m-%d') as day, "timestamp", close, coalesce(close - prev, 0) as osc,
      coalesce((close - prev) * 100.0 / nullif(prev, 0), 0) as osc_per from lagged""",
)
def refresh_days_silver(spark, sf_dir):
    """Silver kept up to date by the days that new and corrected bars fall on, and those after them."""
    paths = _refreshed_days(spark, sf_dir)
    return tables.read_table(spark, paths["silver"]).select("_id", "ticker", "day", "timestamp", "close", "osc", "osc_per")


@query(
    "refresh_days_gold",
    f"""with {CORRECTED}, days as (
      select ticker, strftime("timestamp", '%Y-%m-%d') as day, arg_min(open, "timestamp") as open, min(low) as low,
        max(high) as high, arg_max(close, "timestamp") as close, cast(sum(volume) as bigint) as volume from corrected group by all)
    select *, close - open as osc, (close - open) / nullif(open, 0) as osc_per from days""",
)
def refresh_days_gold(spark, sf_dir):
    """Daily gold of the same, of which only the days touched are written anew."""
    return tables.read_table(spark, _refreshed_days(spark, sf_dir)["gold"])


# ---- streams ------------------------------------------------------------------------------------


def _deliver(spark, sf_dir, path: str, again: bool = False) -> None:
    """Send all bars to the topic directory, or the last days once more."""
    bars = adapters.bars(spark, sf_dir)
    if again:
        bars = bars.where(F.col("timestamp") >= _stamp(RESENT_FROM))
    topics.write_topic(encode_bars(bars), TOPIC, path=path)


def _bronze(spark, topic_path: str, lake: Lake, **how) -> str:
    path = lake.path("bronze", "stocks_intraday")
    bronze_streams.topic_to_bronze(
        topics.stream_topic(spark, TOPIC, path=topic_path),
        path,
        lake.checkpoint("bronze", "stocks_intraday", reader="topic"),
        **how,
    ).awaitTermination()
    return path


def _lake(spark) -> Lake:
    return Lake(scratch_path(spark, "lake"))


STREAMED = f"""{RESENT} select ticker, "timestamp", open, high, low, close, volume from resent"""


@query("stream_bronze_append", STREAMED)
def stream_bronze_append(spark, sf_dir):
    """Two deliveries, two drains of the same checkpoint."""
    lake = _lake(spark)
    topic = f"{lake.root}/_topic"
    for again in (False, True):
        _deliver(spark, sf_dir, topic, again)
        path = _bronze(spark, topic, lake)
    return _plain(tables.read_table(spark, path))


@query(
    "stream_bronze_rejects",
    f"""with {BARS} select ticker, count(*) as rows from bars group by 1
    union all select 'broken' as ticker, count(*) as rows from bars where cast(_id as bigint) % 10 = 0""",
)
def stream_bronze_rejects(spark, sf_dir):
    """Broken messages between the bars; both kinds counted."""
    lake = _lake(spark)
    topic = f"{lake.root}/_topic"
    _deliver(spark, sf_dir, topic)
    bars = adapters.bars(spark, sf_dir)
    broken = bars.where(F.col("_id").cast("long") % 10 == 0).select("_id", F.encode(F.to_json(F.struct("ticker", "open", "close")), "UTF-8").alias("value"))
    cut = F.when(F.col("_id").cast("long") % 20 == 0, F.encode(F.lit("no json"), "UTF-8")).otherwise(
        F.expr("substring(value, 1, octet_length(value) - 5)")
    )
    topics.write_topic(broken.select(F.lit(None).cast("binary").alias("key"), cut.alias("value")), TOPIC, path=topic)
    rejects = lake.path("rejects", "stocks_intraday")
    path = _bronze(spark, topic, lake, rejects=rejects)
    good = tables.read_table(spark, path).groupBy("ticker").agg(F.count(F.lit(1)).alias("rows"))
    return good.unionByName(tables.read_table(spark, rejects).agg(F.lit("broken").alias("ticker"), F.count(F.lit(1)).alias("rows")))


@query(
    "stream_change_rejects",
    f"""with {BARS}, kinds as (select *, cast(_id as bigint) % 20 as kind from bars)
    select ticker as what, count(*) as rows from kinds where kind >= 5 and ticker <> 'error' group by 1
    union all select 'unreadable envelope', count(*) from kinds where kind = 0
    union all select 'unreadable document', count(*) from kinds where kind = 1 and ticker <> 'error'
    union all select 'no document', count(*) from kinds where kind = 2 and ticker <> 'error'
    union all select 'no operation', count(*) from kinds where kind = 3
    union all select 'no _id', count(*) from kinds where kind = 4 and ticker <> 'error'""",
)
def stream_change_rejects(spark, sf_dir):
    """Change messages of which some have a broken envelope or document, drained to bronze and rejects."""
    lake = _lake(spark)
    topic, rejects = f"{lake.root}/_topic", lake.path("rejects", "changes")
    topics.write_topic(adapters.broken_changes(spark, sf_dir), TOPIC, path=topic)
    path = _bronze(spark, topic, lake, encoding="changes", rejects=rejects, partition_by=["ticker"])
    good = tables.read_table(spark, path).groupBy(F.col("ticker").alias("what")).agg(F.count(F.lit(1)).alias("rows"))
    return good.unionByName(tables.read_table(spark, rejects).groupBy(F.col("reason").alias("what")).agg(F.count(F.lit(1)).alias("rows")))


@query(
    "stream_framed_rejects",
    f"""with {BARS}, kinds as (select *, cast(_id as bigint) % 20 as kind from bars)
    select ticker as what, count(*) as rows from kinds where kind >= 2 group by 1
    union all select 'no frame', count(*) from kinds where kind = 0
    union all select 'unreadable JSON', count(*) from kinds where kind = 1""",
)
def stream_framed_rejects(spark, sf_dir):
    """Flat change records behind registry framing, some without a frame, some cut."""
    lake = _lake(spark)
    topic, rejects = f"{lake.root}/_topic", lake.path("rejects", "flat")
    topics.write_topic(adapters.broken_flat_changes(spark, sf_dir), TOPIC, path=topic)
    path = _bronze(spark, topic, lake, encoding="flat", rejects=rejects)
    good = tables.read_table(spark, path).groupBy(F.col("ticker").alias("what")).agg(F.count(F.lit(1)).alias("rows"))
    return good.unionByName(tables.read_table(spark, rejects).groupBy(F.col("reason").alias("what")).agg(F.count(F.lit(1)).alias("rows")))


@query(
    "capture_stamps",
    f"with {BARS} select ticker, count(*) as rows, true as stamped from bars group by 1",
)
def capture_stamps(spark, sf_dir):
    """every bronze row has the broker's stamp and, not before it, its own."""
    lake = _lake(spark)
    topic = f"{lake.root}/_topic"
    _deliver(spark, sf_dir, topic)
    rows = tables.read_table(spark, _bronze(spark, topic, lake))
    in_order = F.coalesce(F.col("_capture_time_bronze") >= F.col("_capture_time_kafka"), F.lit(False))
    return rows.groupBy("ticker").agg(F.count(F.lit(1)).alias("rows"), F.min(in_order).alias("stamped"))


@query("stream_bronze_partitioned", STREAMED)
def stream_bronze_partitioned(spark, sf_dir):
    """The same, written by ticker."""
    lake = _lake(spark)
    topic = f"{lake.root}/_topic"
    for again in (False, True):
        _deliver(spark, sf_dir, topic, again)
        path = _bronze(spark, topic, lake, partition_by=["ticker"])
    return _plain(tables.read_table(spark, path))


@query("stream_dup_append", STREAMED)
def stream_dup_append(spark, sf_dir):
    """T4: silver that keeps every copy."""
    lake = _lake(spark)
    topic = f"{lake.root}/_topic"
    _deliver(spark, sf_dir, topic)
    _deliver(spark, sf_dir, topic, again=True)
    bronze = _bronze(spark, topic, lake)
    path = lake.path("silver", "stocks_intraday_dup")
    bronze_streams.keep_every_copy(
        tables.read_table_stream(spark, bronze),
        path,
        lake.checkpoint("silver", "stocks_intraday_dup", reader="bronze"),
    ).awaitTermination()
    return _plain(tables.read_table(spark, path))


@query(
    "stream_silver_upsert",
    f"""with {BARS} select ticker, "timestamp", open, high, low, close, volume,
    cast(year("timestamp") as int) as ano from bars""",
)
def stream_silver_upsert(spark, sf_dir):
    """Bronze with re-sent bars into silver, one row per ticker and instant."""
    lake = _lake(spark)
    topic, silver = f"{lake.root}/_topic", lake.path("silver", "stocks_intraday")
    for again in (False, True):
        _deliver(spark, sf_dir, topic, again)
        bronze = _bronze(spark, topic, lake)
        silver_streams.bars_to_silver(
            spark, bronze, silver, lake.checkpoint("silver", "stocks_intraday", reader="bronze")
        ).awaitTermination()
    return _plain(tables.read_table(spark, silver), "ano")


@query(
    "stream_event_upsert",
    f"""with {EVENTO} select _id, ano, mes, dia, hora, minuto, acao, idusuario from evento""",
)
def stream_event_upsert(spark, sf_dir):
    """T5: audit events, creation stamp as text, by ``_id`` with time parts."""
    lake = _lake(spark)
    bronze, silver = lake.path("bronze", "audit"), lake.path("silver", "audit")
    events = adapters.evento(spark, sf_dir)
    text = events.select("_id", F.col("data_criacao").cast("string").alias("data_criacao"), "acao", "idusuario")
    schema = events.select(
        "_id", "ano", "mes", "dia", "hora", "minuto", F.col("data_criacao").cast("string"), "acao", "idusuario"
    ).schema
    for rows in (text, text.where(events["dia"] > 20)):
        tables.append(rows, bronze)
        silver_streams.events_to_silver(
            spark, bronze, silver, lake.checkpoint("silver", "audit"), schema
        ).awaitTermination()
    return tables.read_table(spark, silver).drop("data_criacao")


# ---- publishing and maintenance -----------------------------------------------------------------


@query(
    "schema_evolution_append",
    f"""with {BARS} select _id, ticker, "timestamp", close,
      case when "timestamp" >= timestamp '{CUTOFF}' then volume end as volume from bars""",
)
def schema_evolution_append(spark, sf_dir):
    """The later half brings a column the earlier half lacks."""
    bars = adapters.bars(spark, sf_dir).select("_id", "ticker", "timestamp", "close", "volume")
    path = scratch_path(spark, "evolve")
    tables.append(bars.where(F.col("timestamp") < _stamp(CUTOFF)).drop("volume"), path, ["ticker"])
    tables.append(bars.where(F.col("timestamp") >= _stamp(CUTOFF)), path, ["ticker"])
    return tables.read_table(spark, path).select(*bars.columns)


@query("append_by_run", f"with {BARS} select * from bars")
def append_by_run(spark, sf_dir):
    """Two runs appended, one of them twice, then merged into one folder."""
    bars = adapters.bars(spark, sf_dir)
    path = scratch_path(spark, "runs")
    early = F.col("timestamp") < _stamp(CUTOFF)
    for run, rows in (("early", early), ("late", ~early), ("early", early)):
        tables.append(bars.where(rows), path, ["ticker"], run=run)
    maintenance.merge_batches(spark, path, 0)
    return tables.read_table(spark, path).select(*bars.columns)


@query("overwrite_table", f"with {BARS} select * from bars")
def overwrite_table(spark, sf_dir):
    """Published twice, the second in place of the first."""
    bars = adapters.bars(spark, sf_dir)
    path = scratch_path(spark, "overwrite")
    tables.publish(bars.where(F.col("timestamp") < _stamp(CUTOFF)), path, ["ticker"])
    tables.publish(bars, path, ["ticker"], sort_cols=["timestamp"])
    return tables.read_table(spark, path)


def _in_pieces(spark, sf_dir) -> str:
    bars = adapters.bars(spark, sf_dir)
    path = scratch_path(spark, "pieces")
    early = F.col("timestamp") < _stamp(CUTOFF)
    for piece in (early, ~early):
        tables.append(bars.where(piece), path, ["ticker"])
    return path


@query(
    "compact_content",
    f"""with {BARS} select *, true as shrunk from bars""",
)
def compact_content(spark, sf_dir):
    """M2: the rows, and whether each partition now has the one file that its size calls for."""
    path = _in_pieces(spark, sf_dir)
    maintenance.compact(spark, path)
    rows = tables.read_table(spark, path).select(*adapters.bars(spark, sf_dir).columns)
    report = maintenance.storage_report(spark.read.parquet(path), ["ticker"]).select("ticker", (F.col("files") == 1).alias("shrunk"))
    return rows.join(report, "ticker")


@query("vacuum_content", f"with {BARS} select *, true as had_old, true as clean from bars")
def vacuum_content(spark, sf_dir):
    """M3: the rows, whether compaction left replaced files behind, and whether none is left now."""
    path = _in_pieces(spark, sf_dir)
    maintenance.compact(spark, path)
    storage = Storage(spark, path)
    replaced = lambda: bool(storage.folders(f"{path}/{tables.RETIRED}"))
    had_old = replaced()
    maintenance.vacuum(spark, path, 0, force=True)
    rows = tables.read_table(spark, path).select(*adapters.bars(spark, sf_dir).columns)
    return rows.withColumns({"had_old": F.lit(had_old), "clean": F.lit(not replaced())})


@query(
    "storage_rows",
    f"with {BARS} select ticker, count(*) as rows, true as has_files, true as has_bytes from bars group by 1",
)
def storage_rows(spark, sf_dir):
    """M8: what each partition's files hold. How many they are and their bytes depend on the writer,
    so they are held against the listing of the folder."""
    path = _in_pieces(spark, sf_dir)
    schema = tables.schema_of(spark, path)
    report = maintenance.storage_report(spark.read.schema(schema).parquet(path), ["ticker"])
    listed = maintenance.files(spark, path).groupBy(F.regexp_extract("folder", "ticker=(.*)$", 1).alias("ticker"))
    listed = listed.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("length"))
    return report.join(listed, "ticker").select(
        "ticker", "rows", (F.col("files") == F.col("n")).alias("has_files"), (F.col("bytes") == F.col("length")).alias("has_bytes")
    )


@query(
    "discover_tables",
    """select * from (values ('bronze', 'StockData', 'stocks_intraday'), ('gold', 'StockData', 'stocks'))
    as t(tier, db, "table")""",
)
def discover_tables(spark, sf_dir):
    lake = _lake(spark)
    bars = adapters.bars(spark, sf_dir)
    tables.publish(bars, lake.path("bronze", "stocks_intraday", "StockData"), ["ticker"])
    tables.publish(bars, lake.path("gold", "stocks", "StockData"), ["ticker"])
    return maintenance.discover(spark, lake).select("tier", "db", "table")


@query(
    "catalog_counts",
    f"""with {BARS} select 'bars' as "table", count(*) as rows from bars union all
    select 'events' as "table", count(*) as rows from events""",
)
def catalog_counts(spark, sf_dir):
    """M7: a database of its own, an external partitioned and an external plain table."""
    database = f"tidemark_{uuid.uuid4().hex}"
    path = scratch_path(spark, "catalog")
    tables.publish(adapters.bars(spark, sf_dir), f"{path}/bars", ["ticker"])
    maintenance.register(spark, database, "bars", f"{path}/bars", location=f"{path}/db")
    maintenance.register(spark, database, "events", f"{sf_dir}/events.parquet")
    counted = materialize(maintenance.count_rows(spark, database, ["bars", "events"]), "counts")
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return counted


@query("load_view", f"with {BARS} select ticker, count(*) as rows from bars group by 1")
def load_view(spark, sf_dir):
    """A table that exists, registered under its name; one that does not is left out."""
    lake = _lake(spark)
    name = TableName("bronze", "StockData", "loaded")
    tables.publish(adapters.bars(spark, sf_dir), lake.path("bronze", "loaded", "StockData"), ["ticker"])
    tables.load_table(lake, spark, name)
    if tables.load_table(lake, spark, TableName("bronze", None, "missing")) is not None:
        raise AssertionError("a table that is not there was loaded")
    return spark.table(name.view).groupBy("ticker").agg(F.count(F.lit(1)).alias("rows"))


@query("preview_rows", f"with {BARS} select least(count(*), 5) as rows, true as known from bars")
def preview_rows(spark, sf_dir):
    """Some five rows, all of them rows of the table."""
    bars = adapters.bars(spark, sf_dir)
    shown = tables.preview(bars)
    known = bars.select(F.col("_id").alias("_known")).join(shown, F.col("_known") == F.col("_id"), "right")
    return known.agg(F.count(F.lit(1)).alias("rows"), F.min(F.col("_known").isNotNull()).alias("known"))


@query(
    "text_dates",
    f"""with {BARS} select case when cast(_id as bigint) % 50 = 0 then null else cast("timestamp" as date) end as day,
      count(*) as rows, cast(count_if(cast(_id as bigint) % 50 = 0) as bigint) as rejected from bars group by 1""",
)
def text_dates(spark, sf_dir):
    """F8: stamps as text to dates; texts that are none are counted."""
    bars = adapters.bars(spark, sf_dir)
    text = F.when(F.col("_id").cast("long") % 50 == 0, "soon").otherwise(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    rows = bars.select(text.alias("text")).withColumn("day", parse_date("text"))
    return rows.groupBy("day").agg(F.count(F.lit(1)).alias("rows"), F.count_if(rejected(F.col("day"), "text")).alias("rejected"))
