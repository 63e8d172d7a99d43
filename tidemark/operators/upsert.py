"""Keyed upsert that rewrites only the partitions that hold matched rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import nullcontext
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedup import in_partitions, one_per_key
from tidemark.shared import materialized
from tidemark.sources import tables

BUCKETS = 32


def align(source: DataFrame, target_schema) -> DataFrame:
    """The target's columns and types; extra source columns are ignored, missing ones an error."""
    missing = [f.name for f in target_schema if f.name not in source.columns]
    if missing:
        raise ValueError(f"source lacks columns of the target: {missing}")
    return source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target_schema])


def key_range(keyed: DataFrame, keys: Sequence[str], unique: bool) -> Column:
    """The range of the source's keys, as a filter that lets the scan skip row groups.

    The same job looks for keys that occur twice, unless the caller vouches for them.
    """
    copies = keyed.withColumn("copies", F.lit(1))
    if not unique:
        copies = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    ends = [f(k).alias(f"{n}_{k}") for k in keys for n, f in (("lo", F.min), ("hi", F.max))]
    row = copies.agg(F.max("copies").alias("copies"), *ends).first()
    if (row["copies"] or 0) > 1:
        raise ValueError(f"two source rows share one key {list(keys)}; dedup first")
    test = F.lit(True)
    for key in keys:
        low, high = row[f"lo_{key}"], row[f"hi_{key}"]
        kind = keyed.schema[key].dataType
        if low is not None and isinstance(kind, (T.NumericType, T.StringType, T.DatetimeType)):
            test = test & F.col(key).between(F.lit(low).cast(kind), F.lit(high).cast(kind))
    return test


def any_null(cols: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in cols], F.lit(False))


def pruned(target: DataFrame, parts: Sequence[str], among: DataFrame) -> DataFrame:
    """The target's rows in some partitions; the scan lists and reads only those.

    An equality join on partition columns is what Spark prunes by while it runs, if the other side has a filter that may
    leave something out and is small. NULL partitions, which equality passes by, are looked up apart.
    """
    some = among.where(~any_null(parts)).where(F.length(F.concat_ws("", *parts)) >= 0)
    found = target.join(some, list(parts), "left_semi").select(*target.columns)
    if list(parts) == [tables.BUCKET]:
        return found
    return found.unionByName(in_partitions(target.where(any_null(parts)), parts, among.where(any_null(parts))))


def laid_out(spark, path: str, keys: Sequence[str], partitions_follow_keys: bool, buckets: int) -> tuple[list[str], dict]:
    """The partition columns in which a key has one place, and the layout of the table.

    Where equal keys do not mean equal partition, that place is a hash of the key: a table without rows is declared
    to lie so from now on, any other is laid out anew, once. What it was partitioned by orders the rows of a folder.
    """
    layout = tables.layout_of(spark, path)
    if layout is None:
        raise ValueError(f"no table at {path}; create it first")
    if tables.stream_written(spark, path):
        raise ValueError(f"{path} is written by a stream; its file list may not be changed")
    tables.complete(spark, path)
    own = [c for c in layout["partitions"] if c not in tables.FOLDER_COLUMNS]
    if partitions_follow_keys and own == layout["partitions"] and own:
        return own, layout
    if layout["partitions"] != [tables.BUCKET] or layout["keys"] != list(keys):
        rows = tables.read_table(spark, path)
        if not rows.isEmpty():
            order = layout.get("order", own)
            placed = rows.withColumn(tables.BUCKET, tables.bucket_of(keys, buckets))
            tables.publish(placed, path, [tables.BUCKET], sort_cols=order)
        tables.set_buckets(spark, path, keys, buckets)
        layout = tables.layout_of(spark, path)
    return [tables.BUCKET], layout


def merge_upsert(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partitions_follow_keys: bool = False,
    unique: bool = False,
    buckets: int = BUCKETS,
    repeats: bool = False,
) -> None:
    """Update the target rows whose keys match, insert the rest.

    NULL keys match nothing and are inserted. Two source rows for one key are an error; ``unique``
    says that the caller has made sure of it. With ``repeats`` a key may have several rows: all that the source has of it
    take the place of all that the target has. A key has one place: its partition, when equal keys always mean equal
    partition (``partitions_follow_keys``), else one of ``buckets`` folders by its hash. A scan of the key
    columns in the source's places, within the range of its keys, finds the places that hold matched rows. These are
    written anew by dynamic partition overwrite; rows of other places are appended, and compaction gathers them. A run
    that was cut short is repeated as a whole: what it had appended then matches.
    """
    spark = source.sparkSession
    parts, layout = laid_out(spark, path, keys, partitions_follow_keys, buckets)
    rows = align(source, T.StructType.fromJson(layout["schema"]))
    if parts == [tables.BUCKET]:
        rows = rows.withColumn(tables.BUCKET, tables.bucket_of(keys, layout["buckets"]))
    with materialized(rows, "upsert") as rows, materialized(rows.select(*parts).distinct(), "places") as places:
        keyed = rows.where(~any_null(keys)).select(*keys)
        # Each key once, so that one with many rows is one row of the side that a join cannot split.
        with materialized(keyed.distinct(), "keys") if repeats else nullcontext(keyed) as keyed:
            _merge(rows, keyed, places, path, keys, parts, layout, unique or repeats)


def _merge(rows: DataFrame, keyed: DataFrame, places: DataFrame, path: str, keys, parts, layout: dict, unique: bool) -> None:
    spark = rows.sparkSession
    in_range = key_range(keyed, keys, unique)
    target = spark.read.schema(tables.stored_schema(spark, path)).parquet(path)
    there = pruned(target.where(in_range).select(*dict.fromkeys([*keys, *parts])), parts, places)
    matched = there.join(keyed, list(keys), "left_semi").select(*parts).distinct()
    with materialized(matched, "matched") as matched:
        if not matched.isEmpty():
            kept = pruned(target, parts, matched).join(keyed, list(keys), "left_anti")
            changed = kept.select(*rows.columns).unionByName(in_partitions(rows, parts, matched))
            _write(changed, path, parts, layout, "overwrite")
        _write(in_partitions(rows, parts, matched, "left_anti"), path, parts, layout, "append")


def _write(rows: DataFrame, path: str, parts: Sequence[str], layout: dict, mode: str) -> None:
    tables.replace_partitions(rows, path, parts, [c for c in layout.get("order", []) if c not in parts], mode)


def upsert_batches(
    path: str,
    keys: Sequence[str],
    latest_by: Sequence[Column | str],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    partitions_follow_keys: bool = False,
    report: Callable[[int, int, int], None] | None = None,
    rejects: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: align types, keep the latest row per key, upsert.

    The batch is computed once and written: prepared, its types aligned, and with the text of the row as it arrived where a
    key is missing. All else reads that copy. Types are aligned before rows are compared, so two spellings of one instant
    are one key. Rows without a key, as where a stamp did not parse, match nothing and would come in again with a repeated
    batch: they go to a folder of their batch below ``rejects`` (``_rejects`` in the table by default),
    as they arrived, which a repeat writes anew. So a batch that runs twice leaves the same tables.
    ``report`` gets (batch id, rows in, rows out), counted while the copies are written.
    """
    aside = rejects or f"{path}/_rejects"

    def run(batch: DataFrame, batch_id: int) -> None:
        schema = tables.schema_of(batch.sparkSession, path)
        names = schema.names
        seen, sent = Observation(f"in-{batch_id}"), Observation(f"out-{batch_id}")
        arrived = batch.withColumn("_arrived", F.to_json(F.struct(*batch.columns)))
        typed = _aligned_with(prepare(arrived) if prepare else arrived, schema, "_arrived")
        lost = any_null(keys)
        copy = typed.withColumn("_arrived", F.when(lost, F.col("_arrived"))).observe(seen, F.count(F.lit(1)).alias("rows"))
        with materialized(copy, "batch") as rows:
            latest = one_per_key(rows.where(~lost).select(*names), keys, *latest_by)
            out = latest.observe(sent, F.count(F.lit(1)).alias("rows"))
            merge_upsert(out, path, keys, partitions_follow_keys, unique=True)
            rows.where(lost).select(*keys, "_arrived").write.mode("overwrite").parquet(f"{aside}/batch_id={batch_id}")
        if report:
            report(batch_id, seen.get["rows"], sent.get["rows"])

    return run


def _aligned_with(rows: DataFrame, schema: T.StructType, *more: str) -> DataFrame:
    """``align`` with some columns beside the target's."""
    wide = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in more]])
    return align(rows, wide)
