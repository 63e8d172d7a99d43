"""Queries over market bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import adapters
from tidemark.operators.rollup import edge_bars
from tidemark.operators.star import count_by
from tidemark.functions import decode
from tidemark.functions.scalar import day_key
from tidemark.plans import backfill, stocks
from tidemark.queries.registry import BARS, CAPTURED, query

# Fixed values of the queries: where history ends, and the tickers of the selected series.
HISTORY_END = "2024-01-15 00:00:00"
SINCE = "2024-01-20T07:00:00-03:00"
SELECTED = ("click", "purchase")

LAGGED = f"""with {BARS}, lagged as (
  select *, lag(close) over (partition by ticker order by "timestamp") as prev from bars)"""

SILVER = f"""{LAGGED}, silver as (
  select _id, ticker, strftime("timestamp", '%Y-%m-%d') as day, description, "timestamp", open, high, low,
         close, volume, coalesce(close - prev, 0) as osc,
         coalesce(coalesce(close - prev, 0) * 100.0 / nullif(prev, 0), 0) as osc_per
  from lagged)"""

DAILY = f"""with {BARS}, daily as (
  select ticker, strftime("timestamp", '%Y-%m-%d') as day, arg_min(open, "timestamp") as open, min(low) as low,
         max(high) as high, arg_max(close, "timestamp") as close, cast(sum(volume) as bigint) as volume
  from bars group by all)
select *, close - open as osc, (close - open) / nullif(open, 0) as osc_per from daily"""


@query("gold_daily", DAILY)
def gold_daily(spark, sf_dir):
    return stocks.gold_daily(adapters.bars(spark, sf_dir))


@query("silver_osc", f"{SILVER} select * from silver")
def silver_osc(spark, sf_dir):
    return stocks.silver(adapters.bars(spark, sf_dir))


@query(
    "silver_osc_fillna",
    f"""{LAGGED} select _id, ticker, strftime("timestamp", '%Y-%m-%d') as day, description, "timestamp",
      coalesce(open, 0) as open, coalesce(high, 0) as high, coalesce(low, 0) as low, coalesce(close, 0) as close,
      coalesce(volume, 0) as volume, coalesce(close - prev, 0) as osc,
      coalesce((close - prev) * 100.0 / nullif(prev, 0), 0) as osc_per from lagged""",
)
def silver_osc_fillna(spark, sf_dir):
    return stocks.silver(adapters.bars(spark, sf_dir), fill="all")


@query(
    "gold_intraday_mart",
    f"""{SILVER} select * replace ("timestamp" - interval 3 hours as "timestamp") from silver
    order by ticker, "timestamp" desc""",
)
def gold_intraday_mart(spark, sf_dir):
    return stocks.newest_first(stocks.intraday_mart(stocks.silver(adapters.bars(spark, sf_dir))))


@query(
    "silver_cdc",
    f"""with {BARS}, changes as (
      select * replace (date_trunc('millisecond', "timestamp") as "timestamp") from bars where ticker <> 'error'), lagged as (
      select *, lag(close) over (partition by ticker order by "timestamp") as prev from changes)
    select _id, ticker, strftime("timestamp", '%Y-%m-%d') as day, description, "timestamp", open, high, low, close, volume,
      coalesce(close - prev, 0) as osc, coalesce(coalesce(close - prev, 0) * 100.0 / nullif(prev, 0), 0) as osc_per,
      case when ticker = 'purchase' then 'u' else 'c' end as __op, 'stocks' as __collection,
      "timestamp" - interval 5 hours as __ts_ms
    from lagged""",
)
def silver_cdc(spark, sf_dir):
    """silver straight from the change messages, their capture stamp shifted."""
    rows = stocks.silver(decode.unwrap_cdc(adapters.cdc_messages(spark, sf_dir)))
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("timestamp", "__ts_ms")})


@query(
    "gold_intraday",
    f"""with {CAPTURED}, lagged as (
      select *, lag(close) over (partition by ticker order by "timestamp") as prev from captured)
    select _id, ticker, "timestamp", close, coalesce(close - prev, 0) as osc,
           coalesce(coalesce(close - prev, 0) * 100.0 / nullif(prev, 0), 0) as osc_per,
           _delta_kafka_bronze, _delta_bronze_silver, _delta_silver_gold from lagged""",
)
def gold_intraday(spark, sf_dir):
    rows = stocks.gold_intraday(adapters.captured_bars(spark, sf_dir))
    deltas = [c for c in rows.columns if c.startswith("_delta_")]
    return rows.select("_id", "ticker", "timestamp", "close", "osc", "osc_per", *deltas)


@query(
    "first_last_bar",
    f"""with {BARS}, ranked as (
      select *, strftime("timestamp", '%Y-%m-%d') as day,
             row_number() over (partition by ticker, cast("timestamp" as date) order by "timestamp") as a,
             row_number() over (partition by ticker, cast("timestamp" as date) order by "timestamp" desc) as z
      from bars)
    select ticker, day, 'first' as edge, "timestamp", open, high, low, close, volume from ranked where a = 1
    union all
    select ticker, day, 'last' as edge, "timestamp", open, high, low, close, volume from ranked where z = 1""",
)
def first_last_bar(spark, sf_dir):
    return edge_bars(adapters.bars(spark, sf_dir))


@query("count_by_ticker", f"with {BARS} select ticker, count(*) as qtd from bars group by ticker")
def count_by_ticker(spark, sf_dir):
    return count_by(adapters.bars(spark, sf_dir), ["ticker"], "qtd")


@query(
    "count_by_ticker_day",
    f"""with {BARS} select ticker, cast("timestamp" as date) as dia, count(*) as qtd from bars group by all""",
)
def count_by_ticker_day(spark, sf_dir):
    rows = adapters.bars(spark, sf_dir).withColumn("dia", F.to_date("timestamp"))
    return count_by(rows, ["ticker", "dia"], "qtd")


@query(
    "count_by_ticker_op",
    f"""with {BARS} select ticker, case when ticker = 'purchase' then 'u' else 'c' end as __op,
    count(*) as qtd from bars where ticker <> 'error' group by all""",
)
def count_by_ticker_op(spark, sf_dir):
    changes = decode.unwrap_cdc(adapters.cdc_messages(spark, sf_dir))
    return count_by(changes, ["ticker", "__op"], "qtd")


@query(
    "trailing_24h",
    f"""with {BARS} select ticker, "timestamp" - interval 3 hours as "timestamp", close, volume from bars
    where "timestamp" >= (select max("timestamp") from bars) - interval 24 hours""",
)
def trailing_24h(spark, sf_dir):
    rows = adapters.bars(spark, sf_dir)
    return stocks.trailing_series(rows, 24, stocks.newest(rows))


@query(
    "trailing_8h_selected",
    f"""with {BARS} select ticker, "timestamp", open, high, low, close, volume from bars
    where ticker in ('click', 'purchase')
      and "timestamp" >= (select max("timestamp") from bars) - interval 8 hours""",
)
def trailing_8h_selected(spark, sf_dir):
    rows = adapters.bars(spark, sf_dir)
    recent = stocks.trailing(rows, 8, stocks.newest(rows), SELECTED)
    return recent.select("ticker", "timestamp", "open", "high", "low", "close", "volume")


@query(
    "bars_since",
    f"""with {BARS} select * from bars where "timestamp" > timestamp '2024-01-20 10:00:00'""",
)
def bars_since(spark, sf_dir):
    return stocks.since(adapters.bars(spark, sf_dir), SINCE)


@query(
    "layer_latency",
    f"""with {CAPTURED} select _id, ticker, _delta_kafka_bronze, _delta_bronze_silver, _delta_silver_gold
    from captured""",
)
def layer_latency(spark, sf_dir):
    rows = stocks.latency(adapters.captured_bars(spark, sf_dir))
    return rows.select("_id", "ticker", *[c for c in rows.columns if c.startswith("_delta_")])


_HOP = """select ticker, '{hop}' as hop, count(*) as n, round(quantile_cont({hop}, 0.5), 6) as p50,
  round(quantile_cont({hop}, 0.9), 6) as p90, round(quantile_cont({hop}, 0.99), 6) as p99
  from captured group by ticker"""
_HOPS = [f"_delta_{a}_{b}" for a, b in zip(stocks.LAYERS, stocks.LAYERS[1:])]


@query(
    "layer_latency_summary",
    f"with {CAPTURED} " + " union all ".join(_HOP.format(hop=h) for h in _HOPS),
)
def layer_latency_summary(spark, sf_dir):
    found = stocks.latency_summary(adapters.captured_bars(spark, sf_dir))
    return found.select(
        "ticker", "hop", "n", *[F.round(p, 6).alias(p) for p in ("p50", "p90", "p99")]
    )


@query(
    "weekday_spine",
    """select cast(d as date) as day from (
      select unnest(generate_series(cast(min(ts) as date), cast(max(ts) as date) - 1, interval 1 day)) as d
      from events) where isodow(d) <= 5""",
)
def weekday_spine(spark, sf_dir):
    rows = adapters.bars(spark, sf_dir)
    bounds = rows.agg(
        F.to_date(F.min("timestamp")).alias("start"), F.to_date(F.max("timestamp")).alias("end")
    )
    return backfill.business_days(bounds)


@query(
    "download_days",
    f"""with {BARS}, last as (
      select ticker, max(cast("timestamp" as date)) as last from bars
      where "timestamp" < timestamp '{HISTORY_END}' group by ticker), spine as (
      select ticker, cast(unnest(generate_series(last + 1, (select cast(max(ts) as date) from events) - 1,
             interval 1 day)) as date) as day from last)
    select ticker, day from spine where isodow(day) <= 5""",
)
def download_days(spark, sf_dir):
    rows = adapters.bars(spark, sf_dir)
    history = rows.where(F.col("timestamp") < F.lit(HISTORY_END).cast("timestamp_ntz"))
    return backfill.download_days(history, stocks.newest(rows))


@query(
    "backfill_concat",
    f"""with {BARS}, history as (select * from bars where "timestamp" < timestamp '{HISTORY_END}'), last as (
      select ticker, max(cast("timestamp" as date)) as last from history group by ticker)
    select * from history union all
    select bars.* from bars left join last using (ticker)
    where (last is null or cast("timestamp" as date) > last) and isodow("timestamp") <= 5""",
)
def backfill_concat(spark, sf_dir):
    rows = adapters.bars(spark, sf_dir)
    history = rows.where(F.col("timestamp") < F.lit(HISTORY_END).cast("timestamp_ntz"))
    return backfill.concat(history, rows)


@query(
    "day_key_counts",
    f"""with {BARS} select strftime("timestamp", '%Y-%m-%d') as day, count(*) as qtd from bars group by 1""",
)
def day_key_counts(spark, sf_dir):
    rows = adapters.bars(spark, sf_dir).select(day_key("timestamp").alias("day"))
    return count_by(rows, ["day"], "qtd")
