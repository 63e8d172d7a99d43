import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk


def plain(queries, rows, k):
    out = []
    for q, a in queries:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q and len(a) == len(b))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("clusters", [0, 5])
def test_matches_scoring_everything(spark, monkeypatch, clusters):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(topk.vectors, "QUERY_BYTES", 8 * 8 * 12)
    pick = np.random.default_rng(clusters)
    vectors = pick.integers(-9, 9, (700, 12))
    if clusters:
        vectors = pick.integers(-60, 60, (clusters, 12))[pick.integers(0, clusters, 700)] + pick.integers(-2, 3, (700, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(3)
    found = topk.top_k(spark, df.filter("vec_id % 25 = 0"), df, 5).collect()
    assert sorted(map(tuple, found)) == plain(rows[::25], rows, 5)


def test_reading_stops_early_where_bounds_allow():
    """A block with some near vectors and many far ones is decided before its lists end."""
    pick = np.random.default_rng(0)
    block = np.vstack([np.full((5, 4), 100), -pick.integers(1, 50, (95, 4))])
    queries = np.ones((1, 4), np.int64)
    best = topk.Best(1, 5)
    depths = topk.search_block(block, np.arange(100), queries, np.array([-1]), best)
    assert depths[0] < 0.5 and [i for _, i in best.heaps[0]] == [0, 1, 2, 3, 4]


def test_bounds_hold_at_every_depth():
    pick = np.random.default_rng(1)
    block, queries = pick.integers(-50, 50, (200, 9)).astype(float), pick.integers(-50, 50, (7, 9)).astype(float)
    signed = np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)])
    lists, exact = topk.Lists(block), block @ queries.T
    part = np.zeros(exact.shape)
    for low in range(0, 200, 20):
        part += lists.part(low, low + 20, signed)
        upper = part + (lists.rest(low + 20, signed) if low + 20 < 200 else 0)
        assert (upper >= exact - 1e-9).all()
    assert np.allclose(part, exact)


def test_share_decided_before_the_lists_end(spark, sf):
    """On the test vectors, which point everywhere, most queries stop reading after five eighths of the lists."""
    df = spark.read.parquet(sf.replace("0.001", "0.1") + "/embeddings.parquet").select("vec_id", topk.vectors.whole(F.col("embedding")).alias("v")).collect()
    block = np.array([r["v"] for r in df])
    ids = np.array([r["vec_id"] for r in df])
    own = np.flatnonzero(ids % 50 == 0)
    best = topk.Best(len(own), 5)
    depths = topk.search_block(block, ids, block[own], ids[own], best)
    assert (depths < 1).mean() == 1 and np.median(depths) <= 0.7
    scores = block @ block[own].T
    scores[own, np.arange(len(own))] = -np.inf
    assert [sorted(-s for s, _ in heap) for heap in best.heaps] == np.sort(scores, axis=0)[-5:].T.astype(int).tolist()


@pytest.mark.parametrize("low, high", [(2**24, 2**25), (-(2**27), 2**27), (-(2**45), 2**45)])
def test_large_components_are_exact(spark, low, high):
    """Beyond 2^53 scores are added up in integers; beyond 64 bits they rank by their true value."""
    pick = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(pick.integers(low, high, (200, 64)))]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(2)
    found = sorted(map(tuple, topk.top_k(spark, df.filter("vec_id % 50 = 0"), df, 5).collect()))
    near = lambda s: min(max(s, -(2**63 - 1)), 2**63 - 1)
    assert found == [(q, r, i, near(s)) for q, r, i, s in plain(rows[::50], rows, 5)]


def test_an_id_with_two_vectors_is_one_query(spark):
    df = spark.createDataFrame([(0, [2, 0]), (0, [1, 5]), (1, [3, 1]), (2, [0, 9])], "vec_id long, vector array<long>")
    found = sorted(map(tuple, topk.top_k(spark, df.filter("vec_id = 0"), df, 2).collect()))
    assert found == [(0, 1, 2, 45), (0, 2, 1, 8)]


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0], 1), (50, [1.0, None], 1), (100, None, 1), (150, [], 1), (200, [float("nan"), 1.0], 1), (250, [float("inf"), 1.0], 1),
        (300, [1.0, 2.0, 3.0], 1), (None, [5.0, 5.0], 1), (7, [1.0, 1.0], 1), (7, [1.0, 1.0], 1), (8, [1.0, 1.0], 1), (9, [-0.001, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    whole = F.transform("embedding", lambda x: F.floor(256 * x))
    good = df.filter(topk.usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select("vec_id", whole.alias("vector"), "rank")
    found = sorted(map(tuple, topk.top_k(spark, good.filter("vec_id % 50 = 0"), good, 3).collect()))
    assert found == [(0, 1, 7, 196608), (0, 2, 7, 196608), (0, 3, 8, 196608)]
    assert topk.top_k(spark, good.limit(0), good, 3).count() == 0
    assert topk.top_k(spark, good, good.limit(0), 3).count() == 0
