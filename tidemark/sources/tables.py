"""Lakehouse tables as partitioned Parquet.

A table is an ordinary partitioned directory plus a schema file. Besides the partition columns that its rows have, a table
may be laid out by one of two that only its folders have: ``_bucket``, a hash of the key of a table that is upserted into,
and ``_batch``, the run or micro-batch that brought the rows of a table that is appended to. A publish writes beside the live
data, then moves finished directories into place; the ones they replace are kept under
``_retired`` until vacuumed. A publish cut short is completed by the next one, since everything
needed lies in its staging directory. One writer per table; readers that must never see a partition
change under them should use a Delta table (``fmt="delta"``), where that package is installed.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.layout import Lake, TableName
from tidemark.sources.storage import Storage

SCHEMA_FILE = "_schema.json"
STAGING, RETIRED, READY, CLEARED, READ = "_staging", "_retired", "_ready.json", "_cleared", "_read"
BUCKET, BATCH = "_bucket", "_batch"
FOLDER_COLUMNS = {BUCKET: T.IntegerType(), BATCH: T.StringType()}
MERGED = "merged-"  # how the names of batches begin that compaction has made of others


def exists(spark: SparkSession, path: str) -> bool:
    """M4: is there a table at ``path``? A folder with no schema, log or data is not one."""
    names = Storage(spark, path).children(path)
    return any(
        n in (SCHEMA_FILE, "_delta_log", "_spark_metadata") or "=" in n or n.endswith(".parquet")
        for n in names
    )


def stream_written(spark: SparkSession, path: str) -> bool:
    """Does a stream's own log list the files of this table? Then nobody else may move them."""
    return Storage(spark, path).exists(f"{path}/_spark_metadata")


def layout_of(spark: SparkSession, path: str) -> dict | None:
    """What the schema file says: ``schema``, ``partitions`` and, of a table by ``_bucket``, ``keys`` and ``buckets``."""
    storage = Storage(spark, path)
    file = f"{path}/{SCHEMA_FILE}"
    return json.loads(storage.read_text(file)) if storage.exists(file) else None


def schema_of(spark: SparkSession, path: str) -> T.StructType | None:
    layout = layout_of(spark, path)
    return T.StructType.fromJson(layout["schema"]) if layout else None


def partition_cols_of(spark: SparkSession, path: str) -> list[str]:
    layout = layout_of(spark, path)
    return layout["partitions"] if layout else []


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema with the columns that only folders have."""
    layout = layout_of(spark, path)
    if not layout:
        return None
    more = [T.StructField(c, FOLDER_COLUMNS[c]) for c in layout["partitions"] if c in FOLDER_COLUMNS]
    return T.StructType(T.StructType.fromJson(layout["schema"]).fields + more)


def _write_schema(spark, path: str, schema: T.StructType, partition_cols: Sequence[str], **more) -> None:
    own = T.StructType([f for f in schema if f.name not in FOLDER_COLUMNS])
    content = {"schema": own.jsonValue(), "partitions": list(partition_cols), **more}
    Storage(spark, path).write_text(f"{path}/{SCHEMA_FILE}", json.dumps(content))


def set_buckets(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> None:
    """Declare a table without rows, or one whose rows lie in such folders, to be laid out by a hash of ``keys``."""
    layout = layout_of(spark, path)
    order = layout.get("order", [c for c in layout["partitions"] if c not in FOLDER_COLUMNS])
    schema = T.StructType.fromJson(layout["schema"])
    _write_schema(spark, path, schema, [BUCKET], keys=list(keys), buckets=buckets, order=order)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The folder of a key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def ensure_table(
    spark: SparkSession, path: str, schema: T.StructType, partition_cols: Sequence[str] = ()
) -> bool:
    """Create an empty typed table if there is none; True when it was created."""
    if exists(spark, path):
        return False
    _write_schema(spark, path, schema, partition_cols)
    return True


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The table at ``path``; its schema file saves the inference over all footers."""
    if fmt != "parquet":
        return spark.read.format(fmt).load(path)
    schema = schema_of(spark, path)
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    return spark.read.schema(stored_schema(spark, path)).parquet(path).select(*schema.names)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Some ``n`` rows, in no order."""
    return df.limit(n)


def load_table(lake: Lake, spark: SparkSession, name: TableName) -> DataFrame | None:
    """Register ``{tier}_{table}`` if the table exists, else None."""
    path = lake.path(name.tier, name.table, name.db)
    if not exists(spark, path):
        return None
    df = read_table(spark, path)
    df.createOrReplaceTempView(name.view)
    return df


def read_table_stream(
    spark: SparkSession, path: str, max_files: int | None = None, fmt: str = "parquet", checkpoint: str | None = None
) -> DataFrame:
    """A table as a stream; the first run reads it all, later runs what was added.

    Compaction merges old batches of a table by batches. A reader whose ``checkpoint`` has a committed batch passes merged
    ones by, as it has had their rows. One that has none begins with a batch of everything that is there, merged or not,
    whatever ``max_files`` says. Without a checkpoint named, merged batches are passed by.
    """
    reader = spark.readStream
    begun = checkpoint is None or any(n.isdigit() for n in Storage(spark, checkpoint).children(f"{checkpoint}/commits"))
    merged = lambda: any(n.startswith(f"{BATCH}={MERGED}") for n in Storage(spark, path).folders(path))
    if max_files and (begun or not merged()):
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if fmt != "parquet":
        return reader.format(fmt).load(path)
    schema = schema_of(spark, path) or read_table(spark, path).schema
    rows = reader.schema(stored_schema(spark, path) or schema).parquet(path)
    if BATCH in rows.columns and begun:
        rows = rows.where(~F.col(BATCH).startswith(MERGED))
    return rows.select(*schema.names)


def files(spark: SparkSession, path: str) -> DataFrame:
    """Live data files of a table: ``folder, path, length``, as URIs. Lists names, reads no content."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.regexp_replace("_metadata.file_path", "/[^/]+$", "").alias("folder"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("length"),
        )
    )


def file_below(uri: str | Column, depth: int) -> Column:
    """The part of a data file's URI below its table, which has ``depth`` partition columns."""
    return F.substring_index(uri, "/", -(depth + 1))


def leaf_folders(storage: Storage, path: str, depth: int) -> list[str]:
    """Partition directories ``depth`` levels below ``path``, as relative paths."""
    found = [""]
    for _ in range(depth):
        found = [
            f"{folder}/{name}" if folder else name
            for folder in found
            for name in storage.folders(f"{path}/{folder}" if folder else path)
            if "=" in name
        ]
    return found


def spelled(value) -> str | None:
    """A partition value as text."""
    if value is None or value == "":
        return None
    return str(value).lower() if isinstance(value, bool) else str(value)


def publish(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = (),
    replace: str = "table",
    sort_cols: Sequence[str] = (),
    fmt: str = "parquet",
    retire: Iterable[str] = (),
) -> None:
    """Write ``df`` and put it in place of the table, of the partitions it has, or of
    given files.

    ``replace="table"`` swaps everything; ``replace="partitions"`` swaps only the partitions that
    occur in ``df``, which makes a repeated run harmless; ``replace="files"`` adds the rows and
    takes out the files in ``retire``. Rows are balanced by partition with large partitions split
    over tasks, so a hot one is not a single file.
    """
    spark = df.sparkSession
    parts = list(partition_cols)
    if parts:
        df = df.hint("rebalance", *parts)
    if sort_cols:
        df = df.sortWithinPartitions(*parts, *sort_cols)
    if fmt != "parquet":
        mode = "dynamic" if replace == "partitions" else "static"
        writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", mode)
        (writer.partitionBy(*parts) if parts else writer).save(path)
        return
    swap_in(df, path, parts, replace, retire)


def swap_in(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    replace: str,
    retire: Iterable[str] = (),
    read: DataFrame | None = None,
) -> None:
    """Write ``df`` as it is partitioned into staging, then swap it in.

    ``replace="rewritten"`` says that ``df`` has all rows of some folders, read from the files that ``read`` names
    (``_file``, see ``file_below``). Folders are swapped whole. What others have added to one meanwhile goes back into it;
    one that has lost a file that was read is left as its other writer made it.
    """
    spark = df.sparkSession
    storage = Storage(spark, path)
    if stream_written(spark, path):
        raise ValueError(f"{path} is written by a stream; its file list may not be changed")
    complete(spark, path)
    staged = f"{path}/{STAGING}/{int(time.time() * 1000)}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_cols) if partition_cols else df.write
    writer.parquet(staged)
    if read is not None:
        read.select("_file").write.parquet(f"{staged}/{READ}")
    content = {
        "replace": replace,
        "depth": len(partition_cols),
        "retire": sorted(retire),
        "schema": df.schema.jsonValue(),
        "partitions": list(partition_cols),
    }
    storage.write_text(f"{staged}/{READY}", json.dumps(content))
    complete(spark, path)


def complete(spark: SparkSession, path: str) -> int:
    """Put every finished staging directory in place; returns how many there were."""
    storage = Storage(spark, path)
    done = 0
    for name in storage.folders(f"{path}/{STAGING}"):
        staged = f"{path}/{STAGING}/{name}"
        if storage.exists(f"{staged}/{READY}"):
            _swap(spark, storage, path, name)
            storage.delete(staged)
            done += 1
    return done


def _visible(storage: Storage, folder: str) -> list[str]:
    return [n for n in storage.children(folder) if n[0] not in "_." or "=" in n]


def _swap(spark, storage: Storage, path: str, name: str) -> None:
    # Retired data is as old as this moment, however long the write took.
    staged, retired = f"{path}/{STAGING}/{name}", f"{path}/{RETIRED}/{int(time.time() * 1000)}-{name}"
    order = json.loads(storage.read_text(f"{staged}/{READY}"))
    if order["replace"] == "rewritten":
        _swap_rewritten(spark, storage, path, name, retired, order["depth"])
        return
    if order["replace"] == "files":
        folders = leaf_folders(storage, staged, order["depth"])
        below = [(f"{f}/" if f else "", f"{staged}/{f}" if f else staged) for f in folders]
        entries = [prefix + n for prefix, folder in below for n in _visible(storage, folder)]
        retire = order["retire"]
    elif order["replace"] == "table" or not order["depth"]:
        entries = _visible(storage, staged)
        retire = _visible(storage, path)
    else:
        entries = retire = leaf_folders(storage, staged, order["depth"])
    if not storage.exists(f"{staged}/{CLEARED}"):
        present = [entry for entry in retire if storage.exists(f"{path}/{entry}")]
        storage.move_all((f"{path}/{entry}", f"{retired}/{entry}") for entry in present)
        storage.write_text(f"{staged}/{CLEARED}", "")
    storage.move_all((f"{staged}/{entry}", f"{path}/{entry}") for entry in entries)
    known = layout_of(spark, path) or {}
    more = {} if order["replace"] == "table" else {k: known[k] for k in ("keys", "buckets", "order") if k in known}
    _write_schema(spark, path, T.StructType.fromJson(order["schema"]), order["partitions"], **more)


def _swap_rewritten(spark, storage: Storage, path: str, name: str, retired: str, depth: int) -> None:
    """Each staged folder takes the place of the one it was read from.

    Which files others took or added is found by comparing listings, in Spark; the driver moves folders. What an
    interrupted swap has done is seen from where its folders are: those under ``_retired`` had passed the check.
    """
    staged = f"{path}/{STAGING}/{name}"
    begun = [n for n in storage.folders(f"{path}/{RETIRED}") if n.endswith(f"-{name}")]
    retired = f"{path}/{RETIRED}/{begun[0]}" if begun else retired
    below = lambda root, folder: f"{root}/{folder}" if folder else root
    listing = lambda root: files(spark, root).select(file_below("path", depth).alias("_file"))
    read = spark.read.schema("_file string").parquet(f"{staged}/{READ}")
    if not storage.exists(f"{staged}/{CLEARED}"):
        passed = set(leaf_folders(storage, retired, depth)) if begun else set()
        folder = F.regexp_replace("_file", "/?[^/]+$", "").alias("folder")
        lost = {unquote(r["folder"]) for r in read.join(listing(path), "_file", "left_anti").select(folder).distinct().collect()}
        for one in lost - passed:
            for entry in [one] if one else _visible(storage, staged):
                storage.delete(f"{staged}/{entry}")
        rest = [f for f in leaf_folders(storage, staged, depth) if f not in lost - passed]
        old = [f for f in rest if f not in passed] if depth else [n for _ in rest for n in _visible(storage, path)]
        storage.move_all((f"{path}/{f}", f"{retired}/{f}") for f in old)
        storage.write_text(f"{staged}/{CLEARED}", "")
    for one in leaf_folders(storage, staged, depth):
        if one and not storage.exists(f"{path}/{one}"):
            storage.move(f"{staged}/{one}", f"{path}/{one}")
        else:
            source, target = below(staged, one), below(path, one)
            storage.move_all((f"{source}/{n}", f"{target}/{n}") for n in _visible(storage, source))
    if storage.exists(retired):
        late = [unquote(r["_file"]) for r in listing(retired).join(read, "_file", "left_anti").collect()]
        storage.move_all((f"{retired}/{f}", f"{path}/{f}") for f in late)


def widen_schema(spark, path: str, added: T.StructType, partition_cols: Sequence[str] = ()) -> list[str]:
    """Add the columns a table lacks to its schema file; returns its partition columns."""
    known = schema_of(spark, path)
    if known is None and exists(spark, path):
        known = read_table(spark, path).schema
    parts = list(partition_cols) or partition_cols_of(spark, path)
    layout = layout_of(spark, path) or {}
    fields = {f.name: f for f in (known or T.StructType())}
    for field in added:
        fields.setdefault(field.name, T.StructField(field.name, field.dataType, True))
    _write_schema(spark, path, T.StructType(list(fields.values())), parts, **{k: layout[k] for k in ("keys", "buckets", "order") if k in layout})
    return parts


def append(df: DataFrame, path: str, partition_cols: Sequence[str] = (), run: str | None = None) -> None:
    """Add rows, widening the table's schema by new columns.

    With a ``run``, such as the day that is loaded, the rows go to a folder of that run, which a repeat writes anew: it may
    happen twice. Without one it may not.
    """
    if run is not None:
        put_batch(df, path, run, partition_cols)
        return
    parts = widen_schema(df.sparkSession, path, df.schema, partition_cols)
    writer = df.write.mode("append")
    (writer.partitionBy(*parts) if parts else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_cols: Sequence[str], sort_cols: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write the partitions that occur in ``df`` anew, and no others, by Spark's dynamic partition overwrite.

    ``mode="append"`` adds to them instead. The table must be there. Which partitions these are is known to the tasks alone.
    """
    rows = df.hint("rebalance", *partition_cols).sortWithinPartitions(*partition_cols, *sort_cols)
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(path)


def put_batch(df: DataFrame, path: str, batch: str, partition_cols: Sequence[str] = ()) -> None:
    """Write the rows of one run or micro-batch in place of what it has written before, if anything.

    The folder of the batch is the first level of partitions, and only that folder is touched.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"a batch is named by letters, digits, '_', '.' and '-', not {batch!r}")
    spark = df.sparkSession
    known = partition_cols_of(spark, path)
    if stream_written(spark, path) or (exists(spark, path) and known[:1] != [BATCH]):
        raise ValueError(f"{path} is not laid out by batches")
    parts = [c for c in known if c != BATCH] or list(partition_cols)
    widen_schema(spark, path, df.schema, [BATCH, *parts])
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*parts) if parts else writer).parquet(f"{path}/{BATCH}={batch}")
