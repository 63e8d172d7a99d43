from tidemark.operators import dedup


def test_survivor_is_the_latest_then_the_greatest(spark):
    rows = spark.createDataFrame(
        [(1, 10, "a"), (1, 12, "b"), (1, 12, "c"), (2, 5, None), (None, 1, "x"), (None, 2, "y")],
        "k int, t int, v string",
    )
    got = {tuple(r) for r in dedup.one_per_key(rows, ["k"], "t").collect()}
    assert got == {(1, 12, "c"), (2, 5, None), (None, 2, "y")}


def test_audit_and_reconcile(spark):
    up = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    down = spark.createDataFrame([(1,), (4,)], "k int")
    assert tuple(dedup.duplicate_audit(up, ["k"]).first()) == (4, 3, 1)
    assert tuple(dedup.duplicate_audit(up.limit(0), ["k"]).first()) == (0, 0, 0)
    assert tuple(dedup.reconcile(up, down, ["k"]).first()) == (4, 2, 2, 1)


def test_not_null_counts(spark):
    rows = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert tuple(dedup.not_null_counts(rows).first()) == (3, 2, 1)
