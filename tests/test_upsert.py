import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.upsert import merge_upsert, upsert_batches
from tidemark.sources import tables
from tidemark.sources.storage import Storage

SCHEMA = "k int, p string, v int"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _table(spark, path, parts=("p",)):
    tables.ensure_table(spark, path, spark.createDataFrame([], SCHEMA).schema, list(parts))


def _put(spark, path, rows, keys=("k",), schema=SCHEMA, **how):
    merge_upsert(spark.createDataFrame(rows, schema), path, list(keys), **how)


def test_update_insert_and_repeat(spark, path):
    _table(spark, path)
    _put(spark, path, [(1, "a", 1), (2, "a", 2), (3, "b", 3)])
    for _ in range(2):
        _put(spark, path, [(2, "a", 20), (4, "c", 4)])
        assert _rows(tables.read_table(spark, path)) == [(1, "a", 1), (2, "a", 20), (3, "b", 3), (4, "c", 4)]


def test_no_intermediate_table_is_left(spark, path):
    from tidemark.shared import shared_dir

    root = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    _table(spark, path)
    before = Storage(spark, root).children(root)
    _put(spark, path, [(1, "a", 1)])
    _put(spark, path, [(1, "a", 2)])
    assert Storage(spark, root).children(root) == before


def test_row_that_changes_partition(spark, path):
    _table(spark, path)
    _put(spark, path, [(1, "a", 1), (2, "b", 2), (3, None, 3)])
    _put(spark, path, [(1, "b", 10), (3, "a/b", 30)])
    assert _rows(tables.read_table(spark, path)) == [(1, "b", 10), (2, "b", 2), (3, "a/b", 30)]


def test_null_keys_are_inserted(spark, path):
    _table(spark, path)
    _put(spark, path, [(None, "a", 1), (1, "a", 1)])
    _put(spark, path, [(None, "a", 2), (None, "a", 3)])
    assert tables.read_table(spark, path).where("k is null").count() == 3


def test_extra_missing_and_repeated(spark, path):
    _table(spark, path)
    _put(spark, path, [(1, "a", 1, "x")], schema=SCHEMA + ", extra string")
    assert tables.read_table(spark, path).columns == ["k", "p", "v"]
    with pytest.raises(ValueError, match="lacks"):
        _put(spark, path, [(1, "a")], schema="k int, p string")
    with pytest.raises(ValueError, match="share one key"):
        _put(spark, path, [(5, "a", 1), (5, "b", 2)])
    assert _rows(tables.read_table(spark, path)) == [(1, "a", 1)]


@pytest.mark.parametrize("follow", [True, False])
def test_all_rows_of_a_key_are_replaced_together(spark, path, follow):
    """Where keys may repeat, no row of the source is lost, and none of the target's stays beside it."""
    _table(spark, path)
    put = lambda rows: _put(spark, path, rows, partitions_follow_keys=follow, repeats=True)
    put([(1, "a", 1), (1, "a", 1), (1, "a", 2), (2, "a", 3), (2, "a", 4), (3, "b", 5), (None, "b", 6)])
    for _ in range(2):
        put([(1, "a", 10), (1, "a", 10), (3, "b", 50), (3, "b", 51), (4, "c", 60), (4, "c", 60)])
        assert _rows(tables.read_table(spark, path)) == _rows(
            spark.createDataFrame(
                [(1, "a", 10), (1, "a", 10), (2, "a", 3), (2, "a", 4), (3, "b", 50), (3, "b", 51), (4, "c", 60), (4, "c", 60), (None, "b", 6)],
                SCHEMA,
            )
        )
    put([(None, "b", 6)])
    assert tables.read_table(spark, path).where("k is null").count() == 2


def test_bars_of_one_instant_are_all_upserted(spark, tmp_path):
    """upsert_batch on bars that share ticker and time, some of them whole copies, on both sides of the cut."""
    from oracle import compare, connect
    from tidemark.queries import ORACLES, RUNS

    connect(str(tmp_path)).execute(
        f"""copy (select i % 40 as event_id, timestamp '2024-01-22 00:00:00' + interval (i % 5) day as ts, i % 3 as user_id,
          case i % 2 when 0 then 'purchase' else 'view' end as event_type, cast(i % 4 as double) as value,
          '{{"k": ' || (i % 7) || '}}' as props from range(80) r(i)) to '{tmp_path}/events.parquet' (format parquet)"""
    )
    found = RUNS["upsert_batch"](spark, str(tmp_path))
    assert found.count() == 80 and found.select("ticker", "timestamp").distinct().count() == 10
    assert compare(found, connect(str(tmp_path)), ORACLES["upsert_batch"]) is None


def test_unpartitioned(spark, path):
    _table(spark, path, ())
    _put(spark, path, [(1, "a", 1), (2, "a", 2)])
    _put(spark, path, [(2, "z", 9)])
    assert _rows(tables.read_table(spark, path)) == [(1, "a", 1), (2, "z", 9)]


def _files(spark, path):
    return {
        f"{folder}/{name}"
        for folder in tables.leaf_folders(Storage(spark, path), path, 1)
        for name in Storage(spark, path).children(f"{path}/{folder}")
        if name.endswith(".parquet")
    }


@pytest.mark.parametrize("follow", [True, False])
def test_only_places_with_matched_rows_are_rewritten(spark, path, follow):
    _table(spark, path)
    _put(spark, path, [(1, "a", 1), (2, "b", 2)], partitions_follow_keys=follow)
    first = _files(spark, path)
    # Inserts alone leave all files as they are, also within a touched partition.
    _put(spark, path, [(3, "a", 3)], partitions_follow_keys=follow)
    assert first < _files(spark, path)
    second = _files(spark, path)
    _put(spark, path, [(2, "b", 20), (9, "c", 9)], partitions_follow_keys=follow)
    gone = second - _files(spark, path)
    assert len(gone) == 1 and gone < first
    assert _rows(tables.read_table(spark, path)) == [(1, "a", 1), (2, "b", 20), (3, "a", 3), (9, "c", 9)]


def test_keys_lie_by_their_hash_where_partitions_do_not_follow_them(spark, path):
    _table(spark, path)
    _put(spark, path, [(i, "ab"[i % 2], i) for i in range(100)], buckets=8)
    layout = tables.layout_of(spark, path)
    assert layout["partitions"] == ["_bucket"] and layout["keys"] == ["k"] and layout["order"] == ["p"]
    assert {f.split("/")[0] for f in _files(spark, path)} == {f"_bucket={i}" for i in range(8)}
    _put(spark, path, [(7, None, 70)])
    assert tables.layout_of(spark, path)["buckets"] == 8
    found = tables.read_table(spark, path)
    assert found.columns == ["k", "p", "v"] and found.count() == 100 and found.where("k = 7").first()["v"] == 70


def test_a_table_of_another_layout_is_laid_out_once(spark, path):
    tables.publish(spark.createDataFrame([(i, "ab"[i % 2], i) for i in range(20)], SCHEMA), path, ["p"])
    for v in (100, 200):
        _put(spark, path, [(3, "c", v)])
        assert _rows(tables.read_table(spark, path).where("k = 3")) == [(3, "c", v)]
    assert tables.read_table(spark, path).count() == 20


def test_the_scan_prunes_places(spark, path):
    """Reads of an upsert go to the buckets of the source's keys, or to its partitions, and to no others."""
    from tidemark.operators import upsert

    for parts, keys in ((["_bucket"], ["k"]), (["p"], ["k", "p"])):
        target = f"{path}/{parts[0]}"
        _table(spark, target)
        _put(spark, target, [(i, "abcd"[i % 4], i) for i in range(40)], keys, partitions_follow_keys=parts == ["p"])
        places = spark.read.schema(tables.stored_schema(spark, target)).parquet(target).where("k = 3").select(*parts)
        places.write.parquet(f"{target}-places")
        rows = spark.read.schema(tables.stored_schema(spark, target)).parquet(target)
        found = upsert.pruned(rows, parts, spark.read.schema(places.schema).parquet(f"{target}-places"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SubqueryAdaptiveBroadcast dynamicpruning" in plan
        assert found.where("k = 3").count() == 1
        place = places.first()[0]
        assert {r[0] for r in found.select(*parts).distinct().collect()} == {place}


def test_no_list_of_partitions_or_files_reaches_the_driver():
    import inspect

    from tidemark.operators import upsert

    assert "collect(" not in inspect.getsource(upsert) and "toLocalIterator" not in inspect.getsource(upsert)


def test_odd_partition_names(spark, path):
    odd = ["a b", "x=y/z", "50%", "%20", "ação", "#?[]{}^'\":*\\+", "\x01", None]
    _table(spark, path)
    _put(spark, path, [(i, p, i) for i, p in enumerate(odd)])
    _put(spark, path, [(i, p, i + 100) for i, p in enumerate(odd)], partitions_follow_keys=True)
    assert _rows(tables.read_table(spark, path)) == _rows(
        spark.createDataFrame([(i, p, i + 100) for i, p in enumerate(odd)], SCHEMA)
    )


@pytest.mark.parametrize("cut", ["overwrite", "append"])
def test_interrupted_upsert_is_repeated(spark, path, monkeypatch, cut):
    """Cut before or after the rewrite: the table is whole, and a repeat gives what one run would have."""
    from tidemark.operators import upsert

    _table(spark, path)
    _put(spark, path, [(1, "a", 1), (2, "b", 2), (3, "c", 3)])
    real = upsert._write

    def failing(rows, at, parts, layout, mode):
        if mode == cut:
            raise OSError("stopped")
        real(rows, at, parts, layout, mode)

    monkeypatch.setattr(upsert, "_write", failing)
    with pytest.raises(OSError):
        _put(spark, path, [(1, "a", 10), (4, "d", 20)])
    monkeypatch.undo()
    seen = _rows(tables.read_table(spark, path).where("k <> 4"))
    assert seen == [(1, "a", 1 if cut == "overwrite" else 10), (2, "b", 2), (3, "c", 3)]
    _put(spark, path, [(1, "a", 10), (4, "d", 20)])
    assert _rows(tables.read_table(spark, path)) == [(1, "a", 10), (2, "b", 2), (3, "c", 3), (4, "d", 20)]


def test_a_failing_task_changes_nothing(spark, path):
    _table(spark, path)
    _put(spark, path, [(1, "a", 1), (2, "b", 2)])
    bad = spark.createDataFrame([(1, "a", 1)], SCHEMA).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        merge_upsert(bad, path, ["k"])
    assert _rows(tables.read_table(spark, path)) == [(1, "a", 1), (2, "b", 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_batch_split_does_not_matter(spark, path, seed):
    rng = random.Random(seed)
    # A total order per key, so that the last writer is the same however the rows are cut.
    rows = [(rng.randrange(8), rng.choice("abc"), i) for i in range(60)]
    final = {}
    for k, p, v in rows:
        final[k] = (k, p, v)
    for cuts in (1, 3):
        target = f"{path}/{cuts}"
        _table(spark, target)
        run = upsert_batches(target, ["k"], ["v"])
        size = len(rows) // cuts
        for batch_id in range(cuts):
            part = rows[batch_id * size : (batch_id + 1) * size]
            run(spark.createDataFrame(part, SCHEMA), batch_id)
        run(spark.createDataFrame(part, SCHEMA), batch_id)
        assert _rows(tables.read_table(spark, target)) == _rows(
            spark.createDataFrame(list(final.values()), SCHEMA)
        )


def test_two_spellings_of_one_instant(spark, path):
    schema = "ticker string, timestamp timestamp, close double"
    tables.ensure_table(spark, path, spark.createDataFrame([], schema).schema, ["ticker"])
    counts = []
    run = upsert_batches(
        path, ["ticker", "timestamp"], ["close"], report=lambda *c: counts.append(c)
    )
    rows = [("A", "2024-01-01T10:00:00-03:00", 1.0), ("A", "2024-01-01T13:00:00Z", 2.0)]
    run(spark.createDataFrame(rows, "ticker string, timestamp string, close double"), 7)
    got = tables.read_table(spark, path).select("ticker", F.col("timestamp").cast("string"), "close")
    assert [tuple(r) for r in got.collect()] == [("A", "2024-01-01 13:00:00", 2.0)]
    assert counts == [(7, 2, 1)]


def test_rows_without_a_key_are_kept_aside_once_per_batch(spark, path):
    """A micro-batch that Spark repeats leaves the same table and the same rejects."""
    _table(spark, path)
    run = upsert_batches(path, ["k"], ["v"])
    batch = spark.createDataFrame([(1, "a", 1), (None, "a", 2), (None, "b", 3)], SCHEMA)
    for _ in range(2):
        run(batch, 7)
    run(spark.createDataFrame([(1, "a", 5), (None, "c", 6)], SCHEMA), 8)
    assert _rows(tables.read_table(spark, path)) == [(1, "a", 5)]
    aside = spark.read.parquet(f"{path}/_rejects/batch_id=7").collect()
    assert sorted(r["_arrived"] for r in aside) == ['{"p":"a","v":2}', '{"p":"b","v":3}']
    assert spark.read.parquet(f"{path}/_rejects/batch_id=8").count() == 1


def test_a_batch_is_computed_once(spark, path):
    """Rows and rejects come from one copy: the source runs once for each of its rows, whatever reads it."""
    _table(spark, path)
    computed = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(v):
        computed.add(1)
        return v

    batch = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "c", 3), (1, "a", 4)], SCHEMA).withColumn("v", counted("v"))
    counts = []
    upsert_batches(path, ["k"], ["v"], report=lambda *c: counts.append(c))(batch, 3)
    assert computed.value == 4 and counts == [(3, 4, 2)]
    assert _rows(tables.read_table(spark, path)) == [(1, "a", 4), (2, "b", 2)]
    assert spark.read.parquet(f"{path}/_rejects/batch_id=3").count() == 1
