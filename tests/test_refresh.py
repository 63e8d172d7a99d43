"""Daily tables kept up to date: equal to a full recompute, and only the days touched are read and written."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup
from tidemark.plans import stocks
from tidemark.sources import tables
from tidemark.sources.storage import Storage

BAR = (
    "_id string, ticker string, description string, timestamp timestamp, open double, high double, low double, "
    "close double, volume bigint, __op string, __collection string, __ts_ms bigint"
)


def _bars(spark, rows):
    full = [(f"{t}{s}", t, "d", s, c, c, c, c, 1, "c", "stocks", v) for t, s, c, v in rows]
    text = BAR.replace("timestamp timestamp", "timestamp string")
    return spark.createDataFrame(full, text).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def _paths(path):
    return [f"{path}/{name}" for name in ("latest", "silver", "gold")]


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def _files(spark, path):
    storage = Storage(spark, path)
    return {f: set(storage.children(f"{path}/{f}")) for f in tables.leaf_folders(storage, path, 2)}


def _check(spark, path, bars):
    latest, silver, gold = _paths(path)
    want = stocks.silver(stocks.latest_bars(bars, "__ts_ms"), fill="all", unit="day")
    assert _rows(tables.read_table(spark, silver)) == _rows(want)
    assert _rows(tables.read_table(spark, gold)) == _rows(stocks.gold_daily(want))


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_equal_a_full_recompute(spark, path, seed):
    rng = random.Random(seed)
    stamps = [f"2024-01-{d:02d} {h:02d}:{m:02d}:00" for d in (2, 3, 8, 9) for h in (9, 15) for m in (0, 30)]
    rows = [(rng.choice("AAB"), rng.choice(stamps), None if rng.random() < 0.1 else rng.randrange(1, 50) / 4, v) for v in range(90)]
    for start in range(0, 90, 30):
        stocks.refresh_days(_bars(spark, rows[start : start + 30]), *_paths(path))
    _check(spark, path, _bars(spark, rows))
    stocks.refresh_days(_bars(spark, rows[10:20]), *_paths(path))  # delivered again, and by now partly outdated
    _check(spark, path, _bars(spark, rows))


def test_a_correction_touches_its_day_and_the_next(spark, path):
    rows = [(t, f"2024-01-{d:02d} {h}:00:00", 1.0 * d + h, 1) for t in "AB" for d in range(2, 12) for h in (10, 11)]
    stocks.refresh_days(_bars(spark, rows), *_paths(path))
    before = [_files(spark, p) for p in _paths(path)]
    late = ("A", "2024-01-05 11:00:00", 99.0, 2)
    stocks.refresh_days(_bars(spark, [late]), *_paths(path))
    after = [_files(spark, p) for p in _paths(path)]
    changed = [{f for f in b if a[f] != b[f]} for b, a in zip(before, after)]
    day = "ticker=A/day=2024-01-05"
    assert changed == [{day}, {day, "ticker=A/day=2024-01-06"}, {day}]
    _check(spark, path, _bars(spark, [*rows, late]))


def test_only_the_days_are_read(spark, path, monkeypatch):
    """Every read of the latest bars is pruned by the days of the batch while it runs."""
    rows = [("A", f"2024-01-{d:02d} 10:00:00", 1.0 * d, 1) for d in range(2, 12)]
    stocks.refresh_days(_bars(spark, rows), *_paths(path))
    plans, real = [], stocks.pruned
    monkeypatch.setattr(stocks, "pruned", lambda *a: (plans.append(found := real(*a)), found)[1])
    stocks.refresh_days(_bars(spark, [("A", "2024-01-05 10:00:00", 9.0, 2)]), *_paths(path))
    assert len(plans) == 3
    assert all("dynamicpruning#" in p._jdf.queryExecution().optimizedPlan().toString() for p in plans)


def test_a_refresh_that_was_cut_is_repeated(spark, path, monkeypatch):
    rows = [("A", f"2024-01-{d:02d} 10:00:00", 1.0 * d, 1) for d in range(2, 8)]
    stocks.refresh_days(_bars(spark, rows), *_paths(path))
    late, real = [("A", "2024-01-04 10:00:00", 50.0, 2), ("A", "2024-01-09 10:00:00", 7.0, 2)], tables.replace_partitions
    for stop in range(3):
        done = []

        def failing(*a, **how):
            if len(done) == stop:
                raise OSError("stopped")
            done.append(a)
            real(*a, **how)

        monkeypatch.setattr(tables, "replace_partitions", failing)
        with pytest.raises(OSError):
            stocks.refresh_days(_bars(spark, late), *_paths(path))
        monkeypatch.undo()
    stocks.refresh_days(_bars(spark, late), *_paths(path))
    _check(spark, path, _bars(spark, rows + late))


# ---- reconciliation by content ------------------------------------------------------------------

PART = "p string, k int, v double, w string"


def test_fingerprints_do_not_depend_on_order_and_tell_values_apart(spark):
    rows = [("a", 1, 1.0, "x"), ("a", 2, None, "y"), ("b", 3, 2.0, None), (None, 4, 4.0, "z"), (None, 4, 4.0, "z")]
    up = spark.createDataFrame(rows, PART).repartition(4)
    differ = lambda other: {r["p"] for r in dedup.differing_partitions(up, spark.createDataFrame(other, PART), ["p"], ["k", "v", "w"]).collect()}
    assert differ(rows[::-1]) == set()
    assert differ(rows[:-1]) == {None}
    assert differ([*rows[:1], ("a", 2, 1e-9, "y"), *rows[2:]]) == {"a"}
    assert differ([*rows[:2], ("b", 3, None, "2.0"), *rows[3:], ("c", 1, 1.0, "x")]) == {"b", "c"}
    # Values that swap places between two rows leave all sums of columns as they are.
    assert differ([("a", 1, None, "x"), ("a", 2, 1.0, "y"), *rows[2:]]) == {"a"}


def test_differences_are_counted_in_the_partitions_that_differ(spark):
    up = [(p, k, float(k), "x") for p in "abc" for k in range(5)] + [("a", None, 1.0, "n"), (None, 7, 1.0, None)]
    down = [r for r in up if r[:2] != ("a", 3)] + [("b", 9, 9.0, "x"), ("d", 1, 1.0, "x")]
    down = [(p, k, v + 1 if (p, k) in (("a", 1), (None, 7)) else v, w) for p, k, v, w in down]
    found = dedup.differences(spark.createDataFrame(up, PART), spark.createDataFrame(down, PART), ["p"], ["k"])
    assert {tuple(r) for r in found.collect()} == {("a", 1, 0, 1), ("b", 0, 1, 0), ("d", 0, 1, 0), (None, 0, 0, 1)}
    assert dedup.differences(spark.createDataFrame(up, PART), spark.createDataFrame(up, PART), ["p"], ["k"]).count() == 0


def test_copies_of_a_row_count_as_changed(spark):
    up = [("a", 1, 1.0, "x"), ("a", 1, 1.0, "x"), ("a", 2, 1.0, "x")]
    found = dedup.differences(spark.createDataFrame(up, PART), spark.createDataFrame(up[1:], PART), ["p"], ["k"])
    assert [tuple(r) for r in found.collect()] == [("a", 0, 0, 1)]
