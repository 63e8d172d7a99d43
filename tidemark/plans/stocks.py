"""Market bars: silver with changes, daily gold, marts, latency and chart series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.functions.scalar import day_key, from_epoch_millis, seconds_between, shift_hours
from tidemark.operators.dedup import in_partitions, one_per_key
from tidemark.operators.lag import change, percent_change, with_previous
from tidemark.operators.order_statistics import quantiles_of_few
from tidemark.operators.rollup import daily
from tidemark.operators.upsert import pruned
from tidemark.shared import materialize, materialized
from tidemark.sources import tables

# Hour shifts of the capture stamp and of the marts.
CAPTURE_SHIFT_HOURS = -5
MART_SHIFT_HOURS = -3

_prices = [(c, T.DoubleType()) for c in ("open", "high", "low", "close")]
_stamps = [
    (f"_capture_time_{layer}", T.TimestampType()) for layer in ("kafka", "bronze", "silver", "gold")
]
_bar = [
    ("ticker", T.StringType()),
    ("ano", T.IntegerType()),
    ("timestamp", T.TimestampType()),
    *_prices,
    ("volume", T.LongType()),
]
SILVER_INTRADAY = T.StructType([T.StructField(*f) for f in [*_bar, *_stamps[:3]]])
GOLD_INTRADAY = T.StructType(
    [
        T.StructField(*f)
        for f in [
            *_bar,
            ("osc", T.DoubleType()),
            ("osc_per", T.DoubleType()),
            *_stamps,
            ("_delta_kafka_bronze", T.IntegerType()),
            ("_delta_bronze_silver", T.IntegerType()),
            ("_delta_silver_gold", T.IntegerType()),
        ]
    ]
)


def with_changes(bars: DataFrame, fill: str = "coalesce", unit: str | None = None) -> DataFrame:
    """``osc`` and ``osc_per`` against the ticker's bar before.

    ``fill="coalesce"`` turns only these two from NULL to 0, and ``osc_per`` builds on the filled
    ``osc``; ``fill="all"`` zeroes every numeric NULL afterwards, prices included.
    """
    return _changes(with_previous(bars, "close", ["ticker"], "timestamp", "_previous", unit), fill)


def _changes(rows: DataFrame, fill: str) -> DataFrame:
    """``osc`` and ``osc_per`` of rows that have the close before as ``_previous``."""
    osc = change("close", "_previous")
    if fill == "coalesce":
        rows = rows.withColumn("osc", F.coalesce(osc, F.lit(0.0)))
        rows = rows.withColumn(
            "osc_per", F.coalesce(percent_change("osc", "_previous"), F.lit(0.0))
        )
        return rows.drop("_previous")
    rows = rows.withColumn("osc", osc).withColumn("osc_per", percent_change("osc", "_previous"))
    return rows.drop("_previous").fillna(0)


def silver(bars: DataFrame, fill: str = "coalesce", unit: str | None = None) -> DataFrame:
    """The silver bars: day key and changes beside the bar, change-capture fields if present."""
    return _silver_columns(with_changes(bars, fill, unit))


def _silver_columns(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("day", day_key("timestamp"))
    if "__ts_ms" in rows.columns:
        stamp = shift_hours(from_epoch_millis("__ts_ms"), CAPTURE_SHIFT_HOURS)
        rows = rows.withColumn("__ts_ms", stamp)
    tail = [c for c in ("__op", "__collection", "__ts_ms") if c in rows.columns]
    return rows.select(
        "_id", "ticker", "day", "description", "timestamp", "open", "high", "low", "close",
        "volume", "osc", "osc_per", *tail,
    )


def _of_years(bars: DataFrame, first: int | None, end: int | None) -> DataFrame:
    """The bars of the years from ``first`` up to but without ``end``, by partitions where there are any."""
    year = F.col("ano") if "ano" in bars.columns else F.year("timestamp")
    rows = bars if first is None else bars.where(year >= first)
    return rows if end is None else rows.where(year < end)


def _last_before(bars: DataFrame, start: DataFrame) -> DataFrame:
    """The last bar of each ticker before its ``_from``."""
    return (
        bars.join(start, "ticker")
        .where(F.col("timestamp") < F.col("_from"))
        .groupBy("ticker")
        .agg(F.max_by("close", "timestamp").alias("close"), F.max("timestamp").alias("timestamp"))
    )


def refreshed_changes(bars: DataFrame, changed: DataFrame, fill: str = "coalesce") -> DataFrame:
    """N1, N2 after late or corrected bars: only the rows whose change may differ.

    ``changed`` has the ticker and timestamp of every bar that was inserted or updated in ``bars``.
    Each of those tickers is recomputed from its first changed bar on, with the bar before it
    carried in, since a corrected bar also alters the one after it. The bar before is looked for in the
    year of the first change and the one before; only tickers without any bar there are looked up in what
    is older. Filters are on ``timestamp`` and, where it is there, on the partition column ``ano``.
    """
    start = materialize(
        changed.groupBy("ticker").agg(F.min("timestamp").alias("_from")), "changed-from"
    )
    first = start.agg(F.min("_from")).first()[0]
    if first is None:
        return with_changes(bars.where(F.lit(False)), fill)
    tail = _of_years(bars, first.year, None).where(F.col("timestamp") >= F.lit(first)).join(start, "ticker")
    tail = tail.where(F.col("timestamp") >= F.col("_from")).withColumn("_before", F.lit(False))
    recent = materialize(_last_before(_of_years(bars, first.year - 1, None), start), "before")
    older = start.join(recent, "ticker", "left_anti")
    before = recent
    if not older.isEmpty():
        before = recent.unionByName(_last_before(_of_years(bars, None, first.year - 1), older))
    before = before.withColumn("_before", F.lit(True))
    seeded = materialize(tail.unionByName(before, allowMissingColumns=True), "changed-bars")
    return with_changes(seeded, fill).where(~F.col("_before")).drop("_before", "_from")


DAYS = ["ticker", "day"]


def refresh_days(
    bars: DataFrame, latest_path: str, silver_path: str, gold_path: str, latest_by: str = "__ts_ms", fill: str = "all", unit: str = "hour"
) -> None:
    """Keep the latest bars, silver and daily gold up to date with bars that were added or corrected.

    All three tables are partitioned by ticker and day. Of the latest bars only the days that new bars fall on are read and
    written anew, of gold the same. Of silver also the day after each, since its first bar changes against a close that may be
    new; the close before a day comes from the day that gold has before it. All other partitions are neither read nor
    written. A run that was cut short is repeated whole; bars that come again change nothing.
    """
    spark = bars.sparkSession
    new = bars.withColumn("day", day_key("timestamp"))
    empty = spark.createDataFrame([], new.schema)
    schema = _silver_columns(_changes(empty.withColumn("_previous", F.lit(None).cast("double")), fill)).schema
    tables.ensure_table(spark, latest_path, new.schema, DAYS)
    tables.ensure_table(spark, silver_path, schema, DAYS)
    tables.ensure_table(spark, gold_path, gold_daily(empty).schema, DAYS)
    with materialized(latest_bars(new, latest_by), "new-bars") as new, materialized(new.select(*DAYS).distinct(), "new-days") as days:
        known = tables.read_table(spark, latest_path)
        merged = latest_bars(pruned(known, DAYS, days).unionByName(new.select(*known.columns)), latest_by)
        with materialized(merged, "merged-bars") as merged:
            tables.replace_partitions(merged, latest_path, DAYS, ["timestamp"])
            filled = merged.fillna(0) if fill == "all" else merged
            tables.replace_partitions(gold_daily(filled.drop("day")), gold_path, DAYS)
        with materialized(_with_neighbors(tables.read_table(spark, gold_path), days), "days") as around:
            tables.replace_partitions(_silver_of_days(tables.read_table(spark, latest_path), around, fill, unit), silver_path, DAYS, ["timestamp"])


def _with_neighbors(gold: DataFrame, days: DataFrame) -> DataFrame:
    """The days, the one after each, and for all of them the one before as ``before``: by the partitions of gold alone."""
    by_ticker = Window.partitionBy("ticker").orderBy("day")
    spine = gold.select(*DAYS).distinct().withColumn("before", F.lag("day").over(by_ticker))
    ours = in_partitions(spine, DAYS, days)
    after = spine.alias("spine").join(
        days.alias("days"), F.col("spine.ticker").eqNullSafe(F.col("days.ticker")) & F.col("spine.before").eqNullSafe(F.col("days.day"))
        & F.col("spine.before").isNotNull(), "left_semi",
    )
    return ours.unionByName(after).distinct()


def _silver_of_days(latest: DataFrame, around: DataFrame, fill: str, unit: str) -> DataFrame:
    """Silver of some days, each with the last close of the day before as a row in front."""
    rows = pruned(latest, DAYS, around.select(*DAYS))
    previous = around.where("before is not null").select("ticker", F.col("before").alias("day")).distinct()
    closes = pruned(latest, DAYS, previous).groupBy(*DAYS).agg(F.max_by("close", "timestamp").alias("close")).withColumnRenamed("day", "before")
    in_front = F.to_timestamp("day").cast(latest.schema["timestamp"].dataType) - F.expr("interval 1 microsecond")
    same = F.col("around.ticker").eqNullSafe(F.col("closes.ticker")) & (F.col("around.before") == F.col("closes.before"))
    carried = around.alias("around").join(closes.alias("closes"), same).select("around.ticker", "around.day", "closes.close")
    carried = carried.withColumn("timestamp", in_front).withColumn("_front", F.lit(True))
    seeded = rows.withColumn("_front", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    lagged = with_previous(materialize(seeded, "days-and-closes"), "close", DAYS, "timestamp", "_previous", unit)
    return _silver_columns(_changes(lagged.where(~F.col("_front")).drop("_front", "day"), fill))


def latest_bars(bronze: DataFrame, *latest_by: Column | str) -> DataFrame:
    """One bar per ticker and instant, the one captured last; run before any lag or sum."""
    return one_per_key(bronze, ["ticker", "timestamp"], *latest_by)


def gold_daily(silver_bars: DataFrame) -> DataFrame:
    """A3, A4: the daily mart. Its ``osc_per`` is a ratio, not a percentage."""
    return daily(silver_bars)


def intraday_mart(silver_bars: DataFrame) -> DataFrame:
    """Silver shifted to local time; ``day`` stays as it was before the shift.

    In no order, as a database table keeps none: see ``newest_first`` for reading it.
    """
    return silver_bars.withColumn("timestamp", shift_hours(F.col("timestamp"), MART_SHIFT_HOURS))


def newest_first(mart: DataFrame) -> DataFrame:
    """O2: by ticker, its newest bar first."""
    return mart.orderBy("ticker", F.col("timestamp").desc())


def gold_intraday(silver_bars: DataFrame, now: Column | None = None) -> DataFrame:
    """Changes and the seconds each layer took."""
    rows = with_changes(silver_bars)
    if "_capture_time_gold" not in rows.columns:
        rows = rows.withColumn("_capture_time_gold", F.current_timestamp() if now is None else now)
    return latency(rows)


LAYERS = ("kafka", "bronze", "silver", "gold")


def latency(rows: DataFrame) -> DataFrame:
    """Whole seconds between the capture stamps of neighboring layers."""
    for earlier, later in zip(LAYERS, LAYERS[1:]):
        rows = rows.withColumn(
            f"_delta_{earlier}_{later}",
            seconds_between(f"_capture_time_{earlier}", f"_capture_time_{later}"),
        )
    return rows


def latency_summary(rows: DataFrame) -> DataFrame:
    """M9: per ticker and hop, the median and the tail of the seconds taken."""
    hops = [f"_delta_{a}_{b}" for a, b in zip(LAYERS, LAYERS[1:])]
    long = latency(rows).unpivot(["ticker"], hops, "hop", "seconds")
    return quantiles_of_few(long, ["ticker", "hop"], "seconds", {"p50": 0.5, "p90": 0.9, "p99": 0.99})


def trailing(
    bars: DataFrame, hours: int, as_of: Column, tickers: Sequence[str] | None = None
) -> DataFrame:
    """Bars of the last ``hours`` before ``as_of``, of the chosen tickers."""
    rows = bars.where(F.col("timestamp") >= shift_hours(as_of, -hours))
    return rows.where(F.col("ticker").isin(*tickers)) if tickers else rows


def since(bars: DataFrame, instant: str) -> DataFrame:
    """Bars after an instant written with its zone offset."""
    moment = F.to_timestamp(F.lit(instant))
    if dict(bars.dtypes)["timestamp"] == "timestamp_ntz":
        moment = moment.cast("timestamp_ntz")
    return bars.where(F.col("timestamp") > moment)


def newest(bars: DataFrame) -> Column:
    """The newest stamp, as a scalar subquery to pass as ``as_of``."""
    return bars.agg(F.max("timestamp")).scalar()


def trailing_series(bars: DataFrame, hours: int, as_of: Column) -> DataFrame:
    """V1: close and volume per ticker over the last hours, in local time."""
    return trailing(bars, hours, as_of).select(
        "ticker",
        shift_hours(F.col("timestamp"), MART_SHIFT_HOURS).alias("timestamp"),
        "close",
        "volume",
    )
