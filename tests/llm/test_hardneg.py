import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hardneg, vectors


def plain(anchors, rows, n_positives=5, n_negatives=3):
    out = []
    for own, label, a in anchors:
        scored = [(sum(int(x) * int(y) for x, y in zip(a, v)), i, other) for i, other, v in rows if i != own and len(v) == len(a)]
        best = sorted((-s, i) for s, i, other in scored if other == label)[:n_positives]
        for p, positive in best:
            inside = sorted((-s, i) for s, i, other in scored if other != label and 50 * -p <= 100 * s <= 95 * -p)
            out += [(own, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(inside[:n_negatives], 1)]
    return sorted(out)


def mined(spark, rows, every=7, **how):
    df = spark.createDataFrame(rows, "vec_id long, label long, vector array<long>").repartition(3)
    return sorted(map(tuple, hardneg.mine(spark, df.where(F.col("vec_id") % every == 0), df, **how).collect()))


@pytest.mark.parametrize("kind", ["dense", "clustered", "sparse", "few labels", "all labels"])
def test_matches_scoring_everything(spark, monkeypatch, kind):
    monkeypatch.setattr(hardneg, "BLOCK_ROWS", 64)
    monkeypatch.setattr(hardneg, "ANCHOR_BLOCK", 16)
    monkeypatch.setattr(vectors, "QUERY_BYTES", 8 * 20 * 40)
    pick = np.random.default_rng(len(kind))
    n, width = 400, 20
    values = pick.integers(-60, 60, (n, width))
    if kind == "clustered":
        values = values[:8][pick.integers(0, 8, n)] + pick.integers(-4, 5, (n, width))
    if kind == "sparse":
        values = values * (pick.random((n, width)) < 0.15)
    labels = {"few labels": np.arange(n) % 2, "all labels": np.arange(n)}.get(kind, pick.integers(0, 6, n))
    rows = [(i, int(label), v.tolist()) for i, (label, v) in enumerate(zip(labels, values))]
    assert mined(spark, rows) == plain(rows[::7], rows)


def test_ties_copies_and_hot_labels(spark):
    """One vector in hundreds of copies and a label that holds nearly all rows."""
    pick = np.random.default_rng(4)
    rows = [(i, 1, [30, 30, 1]) for i in range(300)] + [(300 + i, int(i % 3), pick.integers(-40, 40, 3).tolist()) for i in range(100)]
    rows += [(400 + i, 2, [26, 26, 0]) for i in range(50)]
    assert mined(spark, rows, 50) == plain(rows[::50], rows)


def test_no_pair_above_its_threshold_is_lost():
    pick = np.random.default_rng(8)
    for width in (1, 7, 8, 30):
        rows, anchors = pick.normal(size=(200, width)) * 50, pick.normal(size=(40, width)) * 50
        rows[:20, width // 2 :] = 0
        exact = anchors @ rows.T
        for level in (0.5, 0.9, 0.99):
            thresholds = np.quantile(exact, level, axis=1)
            a, x = hardneg.join_block(rows, hardneg.suffix_norms(rows), anchors, hardneg.suffix_norms(anchors), thresholds, None, 1e-6)
            found = np.zeros(exact.shape, bool)
            found[a, x] = True
            assert not ((exact >= thresholds[:, None]) & ~found).any()


def test_the_index_leaves_dimensions_out():
    """The higher the threshold, the less of a row is indexed, and the fewer pairs are left to be scored."""
    pick = np.random.default_rng(9)
    rows, anchors = pick.normal(size=(500, 64)), pick.normal(size=(30, 64))
    norms, own = hardneg.suffix_norms(rows), hardneg.suffix_norms(anchors)
    indexed = [hardneg.Index(rows, norms, own.max(axis=0), t).ends.mean() for t in (0, 20, 40, 60)]
    assert indexed[0] == 64 and all(a > b for a, b in zip(indexed, indexed[1:])) and indexed[-1] < 48
    left = [len(hardneg.join_block(rows, norms, anchors, own, np.full(30, t), None, 0)[0]) for t in (20.0, 28.0, 60.0)]
    assert left[0] > left[1] > left[2]


def test_copies_leave_few_pairs():
    """Of thousands of copies only the least ids go on to Python's lists."""
    q, r = np.repeat(np.arange(3), 1000), np.tile(np.arange(1000), 3)
    scores = np.where(r % 2, 50, 40 + q)
    ids = np.arange(1000)[::-1]
    limits = np.array([45, float("inf"), 50], object)
    a, x, s = hardneg._useful(q, r, scores, ids, np.array([0.0, 45.0, 41.0]), limits, 3)
    assert sorted(zip(a.tolist(), s.tolist(), ids[x].tolist())) == [(0, 40, i) for i in (1, 3, 5)] + [(1, 50, i) for i in (0, 2, 4)] + [(2, 42, i) for i in (1, 3, 5)] + [
        (2, 50, i) for i in (0, 2, 4)
    ]


def test_large_components(spark):
    """Scores beyond 2^53, and beyond 64 bits, rank by their true values."""
    pick = np.random.default_rng(6)
    rows = [(i, int(i % 3), v.tolist()) for i, v in enumerate(pick.integers(2**24, 2**26, (90, 16)))]
    assert mined(spark, rows, 30) == plain(rows[::30], rows)
    huge = [(i, i % 2, [int(v) << 40 for v in x]) for i, x in enumerate(pick.integers(1, 1 << 10, (40, 4)))]
    near = lambda s: min(max(s, -vectors.LONGEST), vectors.LONGEST)
    assert mined(spark, huge, 10) == [(*r[:4], near(r[4]), near(r[5])) for r in plain(huge[::10], huge)]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, 3, [0.5, 1.0]), (1, 3, [0.5, 1.0]), (1, 3, [0.5, 1.0]), (2, 4, [0.25, 0.75]), (2, 4, [0.25, 0.75]), (50, 4, [0.25, -1.0]), (7, 3, [0.2, 0.3]), (11, 3, [0.25, 0.5]), (3, 4, [1.0])]
    bad = [(100, 3, None), (4, None, [0.5, 1.0]), (None, 3, [0.5, 1.0]), (5, 4, [nan, 1.0]), (6, 4, [inf, 1.0]), (8, 4, [None, 1.0]), (9, 4, [])]
    df = spark.createDataFrame([(*r, "x") for r in good + bad], "vec_id long, label int, embedding array<double>, score string")
    path = spark.conf.get("spark.checkpoint.dir") + "/odd-embeddings"
    df.write.mode("overwrite").parquet(f"{path}/embeddings.parquet")
    found = sorted(map(tuple, hardneg.op11_hard_negatives(spark, path).collect()))
    rows = [(i, (k + 1) % 10 if i % 7 == 0 else k, [int(np.floor(256 * x)) for x in v]) for i, k, v in good]
    assert found == plain([r for r in rows if r[0] % 50 == 0], rows)
    assert found
    df.limit(0).write.mode("overwrite").parquet(f"{path}/embeddings.parquet")
    assert hardneg.op11_hard_negatives(spark, path).count() == 0
