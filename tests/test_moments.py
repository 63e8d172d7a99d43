import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import moments
from tidemark.plans import classify

NAMES = ["a", "b", "c", "d"]


def _table(spark, rows):
    return spark.createDataFrame(rows, "label int, a double, b double, c double, d double").repartition(5)


def _rows(n=300, shift=0.0):
    pick = np.random.default_rng(1)
    x = pick.normal(size=(n, 4)) + shift
    x[:, 1] += x[:, 0]
    out = []
    for i, r in enumerate(x.tolist()):
        r = [None if (i + j) % 7 == 0 else float("nan") if (i * j) % 11 == 5 else v for j, v in enumerate(r)]
        out.append((i % 3 if i % 50 else None, *r))
    return out


def _pair(rows, i, j):
    good = lambda v: v is not None and not math.isnan(v)
    return np.array([(r[i + 1], r[j + 1]) for r in rows if good(r[i + 1]) and good(r[j + 1])])


@pytest.mark.parametrize("shift", [0.0, 1e7])
def test_correlations_of_what_is_there(spark, shift):
    """NULL and NaN pair by pair; a mean far off the spread does not cost digits."""
    rows = _rows(shift=shift)
    found = {(r["x"], r["y"]): r["corr"] for r in classify.correlations(_table(spark, rows), NAMES).collect()}
    assert len(found) == 16
    for i, x in enumerate(NAMES):
        for j, y in enumerate(NAMES):
            want = 1.0 if i == j else np.corrcoef(_pair(rows, i, j).T - shift)[0, 1]
            assert found[x, y] == pytest.approx(want, abs=1e-6 if shift else 1e-12)


def test_pairs_without_a_correlation(spark):
    rows = [(0, 1.0, 5.0, None, 2.0), (0, 2.0, 5.0, None, float("nan")), (1, 3.0, 5.0, 1.0, None)]
    found = {(r["x"], r["y"]): r["corr"] for r in classify.correlations(_table(spark, rows), NAMES).collect()}
    assert {k for k, v in found.items() if v is not None} == {(n, n) for n in NAMES}
    assert classify.correlations(_table(spark, rows).limit(0), NAMES).count() == 0


def test_blocks_merge_as_one(spark):
    pick = np.random.default_rng(2)
    rows = pick.normal(size=(90, 5)) + 1e6
    rows[pick.random(rows.shape) < 0.3] = np.nan
    whole = moments.moments_of(rows)
    parts = moments.merged(moments.merged(moments.moments_of(rows[:1]), moments.moments_of(rows[1:40])), moments.moments_of(rows[40:]))
    for a, b in zip(whole, parts):
        assert np.allclose(a, b, rtol=1e-9, atol=1e-3)


def test_pair_bins_count_every_pair(spark, monkeypatch):
    monkeypatch.setattr(moments, "OPEN_LABELS", 2)
    rows = _rows(200)
    df = _table(spark, rows)
    found = {tuple(r)[:5]: r["n"] for r in classify.pair_bins(df, NAMES, 3).collect()}
    binned = df.select("label", classify._binned(df, NAMES, 3).alias("b")).collect()
    want = {}
    for r in binned:
        for i in range(4):
            for j in range(i + 1, 4):
                if r["b"][i] is not None and r["b"][j] is not None:
                    key = (r["label"], NAMES[i], NAMES[j], r["b"][i], r["b"][j])
                    want[key] = want.get(key, 0) + 1
    assert found == want


def test_few_rows_are_shuffled(spark):
    """At most tasks x non-empty cells, and tasks x measurements, however many rows there are; no pair is exploded."""
    df = spark.range(0, 20_000, 1, 4).select((F.col("id") % 2).cast("int").alias("label"), *[F.rand(i).alias(n) for i, n in enumerate(NAMES)])
    bins = classify.pair_bins(df, NAMES, 3)
    corr = classify.correlations(df, NAMES)
    for found, most in ((bins, 4 * 2 * 6 * 9), (corr, 4 * 4)):
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan.split("Initial Plan")[0]
        written = _shuffled(found)
        assert 0 < written <= most


def _shuffled(df):
    """Records written by the exchanges of a plan that has run."""
    plan = df._jdf.queryExecution().executedPlan().executedPlan()
    total, open_nodes = 0, [plan]
    while open_nodes:
        node = open_nodes.pop()
        while "QueryStage" in node.nodeName():
            node = node.plan()
        metrics = node.metrics()
        if node.nodeName() == "Exchange" and metrics.contains("shuffleRecordsWritten"):
            total += metrics.apply("shuffleRecordsWritten").value()
        children = node.children()
        open_nodes += [children.apply(i) for i in range(children.size())]
    return total
