import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.lag import UNITS, choose_slice, with_previous
from tidemark.plans import stocks

START = dt.datetime(2024, 1, 1)


def _bars(spark, rows):
    return spark.createDataFrame(
        rows,
        "_id string, ticker string, description string, timestamp timestamp, open double, high double, "
        "low double, close double, volume bigint",
    )


def _bar(i, ticker, when, close):
    price = close if close is not None else 1.0
    return (str(i), ticker, "", when, price, price, price, close, 1)


def _random_bars(spark, n=600, seed=1):
    rng = random.Random(seed)
    # One ticker holds most rows; stamps cluster in bursts below a second and leave long gaps.
    stamps = set()
    while len(stamps) < n:
        base = rng.choice([0, 5, 86400 * 3, 86400 * 40, 3600 * 7])
        stamps.add(base * 10**6 + rng.randrange(3 * 10**6 if rng.random() < 0.5 else 10**11))
    rows = [
        _bar(i, rng.choice(["A", "A", "A", "B", None]), START + dt.timedelta(microseconds=us), None if rng.random() < 0.1 else rng.random())
        for i, us in enumerate(stamps)
    ]
    return _bars(spark, rows)


@pytest.mark.parametrize("unit", list(UNITS))
def test_sliced_lag_equals_plain_lag(spark, unit):
    bars = _random_bars(spark)
    plain = bars.select(
        "_id", F.lag("close").over(Window.partitionBy("ticker").orderBy("timestamp")).alias("p")
    )
    sliced = with_previous(bars, "close", ["ticker"], "timestamp", "p", unit).select("_id", "p")
    assert sorted(sliced.collect(), key=lambda r: int(r["_id"])) == sorted(
        plain.collect(), key=lambda r: int(r["_id"])
    )


def test_slice_is_fine_enough(spark):
    bars = _random_bars(spark)
    for limit in (1000, 50, 5, 2):
        unit = choose_slice(bars, ["ticker"], "timestamp", limit)
        busiest = (
            bars.groupBy("ticker", F.date_trunc(unit, "timestamp")).count().agg(F.max("count")).first()[0]
        )
        assert busiest <= limit or unit == "millisecond"
    assert choose_slice(bars, ["ticker"], "timestamp", 10_000) == "day"
    assert choose_slice(bars.limit(0), ["ticker"], "timestamp", 10) == "day"


def test_first_bar_zero_close_and_missing_price(spark):
    minute = lambda m: START + dt.timedelta(minutes=m)
    bars = _bars(
        spark,
        [
            _bar(1, "one", minute(0), 5.0),
            _bar(2, "z", minute(0), 0.0),
            _bar(3, "z", minute(1), 4.0),
            _bar(4, "z", minute(2), None),
            _bar(5, "z", minute(3), 6.0),
        ],
    )
    kept = {r["_id"]: r for r in stocks.silver(bars).collect()}
    assert (kept["1"]["osc"], kept["1"]["osc_per"]) == (0.0, 0.0)
    assert (kept["3"]["osc"], kept["3"]["osc_per"]) == (4.0, 0.0)
    assert kept["4"]["close"] is None and kept["4"]["osc"] == 0.0
    zeroed = {r["_id"]: r for r in stocks.silver(bars, fill="all").collect()}
    assert zeroed["4"]["close"] == 0.0 and zeroed["5"]["osc"] == 0.0


def test_changes_add_up(spark, sf):
    from tidemark import adapters

    bars = adapters.bars(spark, sf)
    got = (
        stocks.silver(bars)
        .groupBy("ticker")
        .agg(
            F.sum("osc").alias("total"),
            (F.max_by("close", "timestamp") - F.min_by("close", "timestamp")).alias("span"),
        )
        .collect()
    )
    assert got and all(abs(r["total"] - r["span"]) < 1e-6 for r in got)


def test_day_is_taken_before_the_shift(spark):
    bars = _bars(spark, [_bar(1, "A", dt.datetime(2024, 1, 2, 1), 1.0)])
    row = stocks.intraday_mart(stocks.silver(bars)).first()
    assert row["day"] == "2024-01-02" and row["timestamp"] == dt.datetime(2024, 1, 1, 22)


def test_open_zero_has_no_ratio(spark):
    bars = _bars(spark, [_bar(1, "A", START, 0.0), _bar(2, "A", START + dt.timedelta(hours=1), 3.0)])
    row = stocks.gold_daily(bars).first()
    assert (row["open"], row["close"], row["osc"], row["osc_per"]) == (0.0, 3.0, 3.0, None)


def test_refresh_matches_full_recompute(spark):
    bars = _random_bars(spark, seed=3).where("ticker is not null").withColumn("ano", F.year("timestamp"))
    late = bars.where("ticker = 'B'").orderBy("timestamp").offset(7).limit(2).select("ticker", "timestamp")
    full = {r["_id"]: (r["osc"], r["osc_per"]) for r in stocks.with_changes(bars).collect()}
    part = {r["_id"]: (r["osc"], r["osc_per"]) for r in stocks.refreshed_changes(bars, late).collect()}
    assert part and part.items() <= full.items()
    assert len(part) == bars.where("ticker = 'B'").count() - 7


def test_refresh_reads_the_years_it_needs(spark, path):
    """The scan behind a refresh is limited to partitions from the year before the first change on."""
    from tidemark.sources import tables

    rows = [(str(y), "a", dt.datetime(y, 6, 1), float(y), y) for y in range(2000, 2020)] + [("x", "b", dt.datetime(2001, 1, 1), 3.0, 2001), ("z", "b", dt.datetime(2018, 9, 1), 6.0, 2018)]
    schema = "_id string, ticker string, timestamp timestamp_ntz, close double, ano int"
    tables.publish(spark.createDataFrame(rows, schema), path, ["ticker", "ano"])
    bars = tables.read_table(spark, path)
    changed = bars.where("ano >= 2018").select("ticker", "timestamp")
    got = {r["_id"]: r["osc"] for r in stocks.refreshed_changes(bars, changed).collect()}
    assert got == {"2018": 1.0, "2019": 1.0, "z": 3.0}  # b's bar before is found in 2001
    plan = stocks._of_years(bars, 2017, None)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan and "(ano" in plan
    assert stocks.refreshed_changes(bars, changed.limit(0)).count() == 0
