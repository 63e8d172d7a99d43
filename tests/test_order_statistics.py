import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.order_statistics import quantiles, quantiles_of_few

PROBS = {"low": 0.0, "q1": 0.25, "q2": 0.5, "p99": 0.99, "high": 1.0}


@pytest.mark.parametrize("accuracy", [50, 400, 20_000])
def test_quantiles_are_exact(spark, accuracy):
    rng = random.Random(accuracy)
    # A third of group "a" is one value; "b" is spread; "c" has one row; "d" only NULL.
    rows = [("a", 7.0 if rng.random() < 0.34 else rng.gauss(0, 100)) for _ in range(4000)]
    rows += [("b", rng.random()) for _ in range(1500)] + [("c", 3.0), ("d", None), ("b", None)]
    rows += [(None, float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in quantiles(df, ["g"], "v", PROBS, accuracy).collect()}
    assert set(got) == {"a", "b", "c", None}
    for group, row in got.items():
        values = [v for g, v in rows if g == group and v is not None]
        assert row["n"] == len(values)
        for name, p in PROBS.items():
            assert row[name] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_without_groups(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    row = quantiles(df, [], "v", {"q": 0.5}, 100).first()
    assert (row["n"], row["q"]) == (1001, 500.0)


def test_few_levels(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice([None, 1, 2, 3, 50])) for _ in range(500)] + [("c", 4)]
    df = spark.createDataFrame(rows, "g string, v int")
    for row in quantiles_of_few(df, ["g"], "v", PROBS).collect():
        values = [v for g, v in rows if g == row["g"] and v is not None]
        assert row["n"] == len(values)
        assert [row[name] for name in PROBS] == pytest.approx([np.quantile(values, p) for p in PROBS.values()])


@pytest.mark.parametrize("by", [["g"], []])
def test_large_brackets_are_cut_until_they_fit(spark, by, monkeypatch):
    """With a coarse sketch and a limit of 8 rows, the one-task window never sees more than a few values."""
    from tidemark.operators import order_statistics

    rng = random.Random(4)
    rows = [(i % 2, rng.choice([rng.gauss(0, 1), 7.0, rng.random() * 1e9])) for i in range(4000)]
    df = spark.createDataFrame(rows, "g int, v double")
    seen = []
    pick = order_statistics._pick

    def watched(rows_, by_, wanted):
        for w in wanted.collect():
            group = [v for g, v in rows if not by_ or g == w["g"]]
            seen.extend(len({v for v in group if m["low"] <= v <= m["high"]}) for m in w["marks"])
        return pick(rows_, by_, wanted)

    monkeypatch.setattr(order_statistics, "_pick", watched)
    monkeypatch.setattr(order_statistics, "WINDOW_ROWS", 8)
    found = order_statistics.quantiles(df, by, "v", {"q1": 0.25, "median": 0.5, "q9": 0.9}, accuracy=50, window_rows=8).collect()
    for row in found:
        values = sorted(v for g, v in rows if not by or g == row["g"])
        for name, p in (("q1", 0.25), ("median", 0.5), ("q9", 0.9)):
            at = p * (len(values) - 1)
            low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
            assert row[name] == pytest.approx(low + (high - low) * (at - int(at)), rel=1e-12)
    assert len(found) == (2 if by else 1) and max(seen) <= 16


def test_no_join_without_a_key(spark):
    from tidemark.operators.order_statistics import _marked

    rows = spark.range(10).select(F.col("id").alias("value"))
    wanted = spark.createDataFrame([(10, [("m", 1, 1, 0, 9)])], "n long, marks array<struct<name:string,first:long,last:long,low:long,high:long>>")
    marked = _marked(rows, [], wanted)
    assert marked.count() == 10 and "Join" not in marked._jdf.queryExecution().executedPlan().toString()
