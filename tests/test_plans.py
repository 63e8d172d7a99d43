"""What the physical plans must show: pruning, few shuffles, no Python, joins chosen by size."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import adapters
from tidemark.operators import dedup
from tidemark.operators.lag import with_previous
from tidemark.plans import events, retail, stocks
from tidemark.sources import tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_change_has_one_shuffle_of_the_bars(spark, sf):
    bars = adapters.bars(spark, sf)
    plan = _plan(stocks.silver(bars, unit="day"))
    # The bars move once, by ticker and slice; the other two exchanges carry one row per slice.
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.count("Window [lag(close") == 2
    assert "SortAggregate" not in plan


def test_native_operators_run_no_python(spark, sf):
    bars, invoices, event = adapters.bars(spark, sf), adapters.retail(spark, sf), adapters.evento(spark, sf)
    for df in (
        stocks.silver(bars),
        stocks.gold_daily(bars),
        stocks.intraday_mart(bars),
        retail.by_country(retail.silver(invoices)),
        events.statistics(event),
        dedup.one_per_key(bars, ["ticker", "timestamp"], "_id"),
    ):
        assert "Python" not in _plan(df) and "Pandas" not in _plan(df) and "CartesianProduct" not in _plan(df)


def test_daily_rollup_reduces_before_its_only_shuffle(spark, sf):
    plan = _plan(stocks.gold_daily(adapters.bars(spark, sf)))
    assert plan.count("Exchange") == 1 and "partial_min_by" in plan and "Sort" not in plan


def test_hot_keys_shrink_before_the_shuffle(spark, sf):
    plan = _plan(dedup.one_per_key(adapters.bars(spark, sf), ["ticker", "timestamp"], "_id"))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_only_needed_columns_are_read(spark, sf):
    plan = _plan(stocks.gold_daily(adapters.bars(spark, sf)))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in plan
    audit = _plan(dedup.duplicate_audit(adapters.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in audit


def test_filters_reach_the_scan(spark, sf):
    bars = adapters.bars(spark, sf)
    assert "GreaterThan(ts," in _plan(stocks.since(bars, "2024-01-20T07:00:00-03:00"))
    one = stocks.trailing(bars, 8, F.lit(dt.datetime(2024, 1, 20)).cast("timestamp_ntz"), ["click"])
    assert "EqualTo(event_ty" in _plan(one) and "GreaterThanOrEqual(ts" in _plan(one)


def test_day_range_prunes_partitions(spark, sf, path):
    tables.publish(events.statistics(adapters.evento(spark, sf)), path, events.DAY)
    plan = _plan(events.export_rows(tables.read_table(spark, path), dt.date(2024, 1, 5), dt.date(2024, 1, 6)))
    filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "make_date" in filters and "ano" in filters
    scanned = events.export_rows(tables.read_table(spark, path), dt.date(2024, 1, 5), dt.date(2024, 1, 6))
    assert {r["dia"] for r in scanned.select("dia").distinct().collect()} == {5, 6}


def test_dimensions_are_broadcast_only_below_the_threshold(spark, sf):
    event = adapters.evento(spark, sf)
    assert _plan(events.mart(event)).count("BroadcastHashJoin") == 7
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = events.mart(event)
        assert "Broadcast" not in _plan(df) and _plan(df).count("SortMergeJoin") == 7
        large = sorted(map(tuple, df.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert large == sorted(map(tuple, events.mart(event).collect()))


@pytest.mark.parametrize("unit", ["second"])
def test_narrow_slices_carry_in_steps(spark, sf, unit):
    bars = adapters.bars(spark, sf)
    plan = _plan(with_previous(bars, "close", ["ticker"], "timestamp", "p", unit))
    assert plan.count("Window [lag(") == 3
