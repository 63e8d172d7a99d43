import random

import pytest

from tidemark.operators import metrics
from tidemark.operators.knn import neighbors, vote
from tidemark.plans import classify

NAMES = ["x", "y"]


def _brute(test, train, k):
    out = {}
    for i, *point in test:
        near = sorted((sum((a - b) ** 2 for a, b in zip(point, p)), j, label) for j, label, *p in train)[:k]
        out[i] = [(j, label) for _, j, label in near]
    return out


def _check(spark, test, train, k, **sizes):
    test_df = spark.createDataFrame(test, "id bigint, x double, y double")
    train_df = spark.createDataFrame(train, "id bigint, label int, x double, y double")
    found = neighbors(test_df, train_df, NAMES, k, **sizes)
    got = {}
    for row in sorted(found.collect(), key=lambda r: (r["id"], r["rank"])):
        got.setdefault(row["id"], []).append((row["train_id"], row["train_label"]))
    want = _brute(test, train, k)
    assert got == want
    votes = {r["id"]: r["pred"] for r in vote(found).collect()}
    for i, near in want.items():
        labels = [label for _, label in near]
        best = max(labels.count(label) for label in labels)
        assert votes[i] == min(label for label in labels if labels.count(label) == best)


def test_many_blocks_with_a_third_of_copies(spark):
    rng = random.Random(5)
    spot = lambda: (0.5, 0.5) if rng.random() < 0.34 else (round(rng.random(), 2), round(rng.gauss(0, 3), 2))
    train = [(i, rng.randrange(3), *spot()) for i in range(400)]
    test = [(1000 + i, *spot()) for i in range(120)]
    _check(spark, test, train, 3, block_rows=20, chunk_rows=15, max_pivots=9)


def test_one_block(spark):
    rng = random.Random(6)
    train = [(i, i % 2, rng.random(), rng.random()) for i in range(30)]
    _check(spark, [(100 + i, rng.random(), rng.random()) for i in range(10)], train, 3)


def test_k_beyond_the_training_set(spark):
    train = [(1, 5, 0.0, 0.0), (2, 4, 1.0, 0.0)]
    _check(spark, [(10, 0.1, 0.0)], train, 3)


def test_ties(spark):
    # Equal distances go to the smaller id; a vote of one each goes to the smallest label.
    train = [(4, 9, 1.0, 0.0), (3, 8, -1.0, 0.0), (2, 7, 0.0, 1.0), (9, 1, 0.0, -1.0)]
    _check(spark, [(10, 0.0, 0.0)], train, 3)


def test_split_takes_exactly_a_quarter(spark):
    for n in (1, 2, 3, 4, 5, 101):
        marked = classify.split(spark.range(n))
        assert marked.where("test").count() == -(-n // 4)
    ids = lambda seed: {r["id"] for r in classify.split(spark.range(101), seed).where("test").collect()}
    assert ids(0) == ids(0) != ids(1)


def test_report_of_a_matrix_with_one_error(spark):
    matrix = [[13, 0, 0], [0, 15, 1], [0, 0, 9]]
    rows = [(a, b) for a in range(3) for b in range(3) for _ in range(matrix[a][b])]
    predicted = spark.createDataFrame(rows, "label int, pred int")
    confusion = metrics.confusion(predicted)
    assert {(r["label"], r["pred"]): r["n"] for r in confusion.collect()} == {
        (a, b): matrix[a][b] for a in range(3) for b in range(3)
    }
    got = {r["class"]: r for r in metrics.report(confusion).collect()}
    assert [got[c]["precision"] for c in "012"] == [1.0, 1.0, 0.9]
    assert [got[c]["recall"] for c in "012"] == [1.0, 0.9375, 1.0]
    assert got["macro avg"]["support"] == 38
    assert metrics.accuracy(predicted).first()["accuracy"] == pytest.approx(37 / 38)
    assert got["weighted avg"]["recall"] == pytest.approx(37 / 38)


def test_class_that_is_never_predicted(spark):
    predicted = spark.createDataFrame([(0, 1), (1, 1)], "label int, pred int")
    confusion = {(r["label"], r["pred"]): r["n"] for r in metrics.confusion(predicted).collect()}
    assert confusion == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 1}
    got = {r["class"]: r for r in metrics.report(metrics.confusion(predicted)).collect()}
    assert (got["0"]["precision"], got["0"]["recall"], got["0"]["f1"]) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("hole", [None, float("nan")])
def test_rows_without_a_measurement_cost_no_others_theirs(spark, hole):
    """Holes in a pivot (block_rows=8 makes many rows pivots), in plain training rows and in test rows."""
    rng = random.Random(7)
    whole = [(i, i % 3, rng.random(), rng.random()) for i in range(60)]
    torn = [(100 + i, 1, hole, rng.random()) for i in range(20)]
    test = [(1000 + i, rng.random(), rng.random()) for i in range(15)]
    test_df = spark.createDataFrame([*test, (2000, hole, 0.5)], "id bigint, x double, y double")
    train_df = spark.createDataFrame([*whole, *torn], "id bigint, label int, x double, y double")
    got = {}
    for r in sorted(neighbors(test_df, train_df, NAMES, 3, block_rows=8).collect(), key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append((r["train_id"], r["train_label"]))
    assert got == _brute(test, whole, 3)
    none = neighbors(test_df, train_df.where("id >= 100"), NAMES, 3)
    assert none.count() == 0 and vote(none).count() == 0


def test_predictions_keep_every_test_row(spark):
    rng = random.Random(8)
    rows = [(i, i % 2, None if i % 10 == 0 else rng.random(), rng.random()) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, label int, x double, y double")
    found = classify.predict(df, NAMES)
    assert found.count() == 25
    assert {r["id"] for r in found.where("pred is null").collect()} == {r["id"] for r in found.where("x is null").collect()}
    assert tuple(classify.unusable(df, NAMES).first()) == (100, 10)
    assert sum(r["n"] for r in metrics.confusion(found).collect()) == found.where("x is not null").count()


def test_bins_leave_out_what_is_not_there(spark):
    rows = [(0, 1.0, 5.0), (0, 2.0, None), (0, None, 5.0), (0, 11.0, 5.0), (0, float("nan"), 5.0)]
    df = spark.createDataFrame(rows, "label int, x double, y double")
    bins = {(r["feature"], r["bin"]): r["n"] for r in classify.histogram(df, NAMES).collect()}
    assert bins == {("x", 0): 1, ("x", 1): 1, ("x", 9): 1, ("y", 0): 4}
    pairs = {(r["x_bin"], r["y_bin"]): r["n"] for r in classify.pair_bins(df, NAMES).collect()}
    assert pairs == {(0, 0): 1, (4, 0): 1}


def _watched(monkeypatch):
    """Counts of (test row, group) visits and of (test row, training row) pairs that are refined."""
    from tidemark.operators import knn

    visits, look = [], knn._look

    def watched(seen, *rest):
        visits.append(seen.count())
        return look(seen, *rest)

    monkeypatch.setattr(knn, "_look", watched)
    return visits


def test_later_groups_drop_out(spark, monkeypatch):
    """Clustered rows: after its own group a test row visits few others."""
    visits = _watched(monkeypatch)
    rng = random.Random(9)
    spot = lambda c: (10.0 * c + rng.random(), 10.0 * (c % 7) + rng.random())
    train = [(i, i % 3, *spot(i % 40)) for i in range(2000)]
    test = [(5000 + i, *spot(i % 40)) for i in range(80)]
    test_df = spark.createDataFrame(test, "id bigint, x double, y double")
    train_df = spark.createDataFrame(train, "id bigint, label int, x double, y double")
    found = neighbors(test_df, train_df, NAMES, 3, block_rows=20, max_pivots=400, group_rows=40)
    assert {(r["id"], r["train_id"]) for r in found.collect()} == {(i, j) for i, near in _brute(test, train, 3).items() for j, _ in near}
    assert 80 <= visits[0] <= 80 * 2 and visits[1] <= 80 * 4


def test_visits_in_64_dimensions(spark, sf, monkeypatch):
    """On the embeddings a test row is sent once to each group of cells, at most, and not to each cell."""
    from tidemark import adapters

    visits = _watched(monkeypatch)
    rows = adapters.features(spark, sf)
    marked = classify.split(rows)
    test, train = marked.where("test").drop("test"), marked.where("not test").drop("test")
    found = neighbors(test, train, adapters.FEATURES, 3, block_rows=10, group_rows=100)
    tests, trained = test.count(), train.count()
    assert sum(visits) <= tests * -(-trained // 80)  # cells would be tests * trained / 10
    points = lambda df, *more: [tuple(r) for r in df.select("id", *more, *adapters.FEATURES).collect()]
    want = _brute(points(test), points(train, "label"), 3)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append((r["train_id"], r["train_label"]))
    assert got == want


def test_few_pairs_are_refined():
    """The product leaves little more than the neighbors themselves to exact distances, and loses none."""
    import numpy as np

    from tidemark.operators import knn

    pick = np.random.default_rng(3)
    tests, rows = pick.normal(size=(200, 64)) + 1e4, pick.normal(size=(3000, 64)) + 1e4
    seen, plain = [], knn.pair_distances
    knn.pair_distances = lambda a, b: (seen.append(len(a)), plain(a, b))[1]
    try:
        nearest = knn.Nearest(3, np.full(200, np.inf))
        norms = ((tests**2).sum(axis=1), (rows**2).sum(axis=1))
        for low in range(0, 3000, 1000):
            knn.visit(tests, np.arange(200), rows, norms, np.arange(low, low + 1000), nearest, np.arange(3000))
    finally:
        knn.pair_distances = plain
    exact = knn.squared_distances(tests, rows)
    order = np.argsort(exact, axis=1, kind="stable")[:, :3]
    assert nearest.at.reshape(200, 3).tolist() == order.tolist()
    assert nearest.d2.reshape(200, 3).tolist() == np.take_along_axis(exact, order, axis=1).tolist()
    assert sum(seen) < 200 * 3 * 6
