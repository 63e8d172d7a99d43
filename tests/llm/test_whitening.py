import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening


def plain(rows, most=4):
    """(id, component) -> values, by the definition: covariance of distinct vectors, eigenvectors by numpy."""
    distinct = sorted({tuple(x) for _, x in rows})
    n, width = len(distinct), len(distinct[0])
    sums = [sum(x[j] for x in distinct) for j in range(width)]
    middle = np.array([[float(n * x[j] - sums[j]) / n for j in range(width)] for x in distinct])
    values, vectors = np.linalg.eigh(middle.T @ middle / n)
    order = np.argsort(-values)
    out = {}
    for at, (i, x) in enumerate(rows):
        c = np.array([float(n * x[j] - sums[j]) / n for j in range(width)])
        deviation = sum((n * x[j] - sums[j]) ** 2 for j in range(width))
        for k in range(min(most, width)):
            e = values[order[k]]
            out[at, k + 1] = (i, n, deviation, abs(c @ vectors[:, order[k]]) / np.sqrt(e), e / values.sum())
    return out


def check(spark, rows):
    df = spark.createDataFrame([(at, x) for at, (_, x) in enumerate(rows)], "vec_id long, x array<long>").repartition(3)
    found = {(r["vec_id"], r["component"]): r for r in whitening.whiten(df, "vec_id").collect()}
    expected = plain(rows)
    assert set(found) == set(expected)
    for key, (_, n, deviation, size, share) in expected.items():
        r = found[key]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["whitened"]) == pytest.approx(size, rel=1e-8, abs=1e-8)
        assert r["explained"] == pytest.approx(share, rel=1e-9)
        assert r["identity_error"] < 1e-9
    return found


def test_matches_eigenvectors(spark):
    pick = np.random.default_rng(1)
    mixed = pick.normal(size=(400, 8)) @ pick.normal(size=(8, 8)) * 100
    rows = [(i, [int(v) for v in x]) for i, x in enumerate(mixed)]
    check(spark, rows + rows[:50] + rows[:1] * 200)


def test_ill_conditioned_rows(spark):
    """One direction is a hundred million times as wide as the others, and far off the origin."""
    pick = np.random.default_rng(2)
    wide = pick.integers(-(10**11), 10**11, 300)
    rows = [(i, [int(w) + 10**12, 2 * int(w) + int(a), int(b)]) for i, (w, a, b) in enumerate(zip(wide, *pick.integers(-900, 900, (2, 300))))]
    df = spark.createDataFrame(rows, "vec_id long, x array<long>")
    found = whitening.whiten(df, "vec_id", 3).collect()
    assert len(found) == 900
    assert max(r["identity_error"] for r in found) < 1e-4
    assert all(r["deviation"] is None or r["deviation"] >= 0 for r in found)


def test_signs_are_the_same_for_all_rows(spark):
    pick = np.random.default_rng(3)
    rows = [(i, [int(v) for v in x]) for i, x in enumerate(pick.integers(-99, 99, (100, 5)))]
    found = check(spark, rows)
    for k in range(1, 5):
        white = np.array([found[i, k]["whitened"] for i, _ in rows])
        assert abs(white.mean()) < 1e-9 and white.std() == pytest.approx(1)


def test_directions_that_are_not_there(spark):
    """A constant component, a repeated one: eigenvalues of 0 have no whitened value."""
    rows = [(i, [i % 7, 5, i % 7, 0]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, x array<long>")
    found = whitening.whiten(df, "vec_id").collect()
    assert len(found) == 160
    for r in found:
        assert (r["whitened"] is None) == (r["component"] > 1)
        assert r["explained"] == pytest.approx(1 if r["component"] == 1 else 0)
        assert r["identity_error"] < 1e-9 and r["n"] == 7


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [3.0, -1.0], 0), (2, None, 0), (3, [], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0),
        (6, [inf, 1.0], 0), (7, [0.25, 8.0], 0), (8, [1.0, 2.0, 3.0], 0), (9, [-0.0, 0.001], 0),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int")
    good = df.where(whitening.usable(F.col("embedding"))).select("vec_id", F.transform("embedding", lambda c: F.floor(256 * c)).alias("x"))
    found = whitening.whiten(good, "vec_id").collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in found) == sorted(
        [(False, i, c) for i in (1, 1, 7, 9) for c in (1, 2)] + [(True, 0, 1), (True, 0, 2)] + [(False, 8, c) for c in (1, 2, 3)]
    )
    assert {r["n"] for r in found if r["vec_id"] != 8} == {4}
    alone = [r for r in found if r["vec_id"] == 8]
    assert all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 and r["identity_error"] is None for r in alone)
    assert whitening.whiten(good.limit(0), "vec_id").count() == 0


def test_large_components_stay_exact(spark):
    rows = [(0, [2**62, 1]), (1, [-(2**62), 0]), (2, [0, -5])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, x array<long>"), "vec_id").collect()
    assert all(r["deviation"] is None for r in found if r["vec_id"] < 2)
    assert all(r["n"] == 3 for r in found)


def test_query(spark, sf):
    found = whitening.op12_whitening(spark, sf).toPandas()
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    rows = [(r["vec_id"], [int(np.floor(256 * float(c))) for c in r["embedding"]]) for r in vectors]
    expected = {(i, k): v for (_, k), (i, *v) in plain(rows).items()}
    assert len(found) == len(expected)
    for r in found.itertuples():
        n, deviation, size, share = expected[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(size, rel=1e-7, abs=1e-7) and r.explained == pytest.approx(share, rel=1e-6)
