"""M1–M3, M7, M8: finding, compacting, vacuuming and sizing tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.upsert import pruned
from tidemark.shared import materialized
from tidemark.sources import tables
from tidemark.sources.layout import Lake, TableName
from tidemark.sources.storage import Storage
from tidemark.sources.tables import files

# Fixed value: hours below which vacuum asks for force.
MIN_RETENTION_HOURS = 1
TARGET_FILE_BYTES = 128 * 1024 * 1024
FILES_PER_RUN = 10_000


def discover(spark: SparkSession, lake: Lake) -> DataFrame:
    """M1: ``tier, db, table, path`` of every table; checkpoint folders are skipped."""
    storage = Storage(spark, lake.root)
    found = []
    for tier in storage.folders(lake.root):
        if tier[0] in "_." or "checkpoint" in tier:
            continue
        for folder in storage.folders(f"{lake.root}/{tier}"):
            if folder[0] in "_." or "checkpoint" in folder:
                continue
            name = TableName.parse(tier, folder)
            found.append((tier, name.db, name.table, f"{lake.root}/{tier}/{folder}"))
    return spark.createDataFrame(found, "tier string, db string, table string, path string")


def compact(
    spark: SparkSession,
    path: str,
    target_bytes: int = TARGET_FILE_BYTES,
    files_per_run: int = FILES_PER_RUN,
) -> dict[str, int]:
    """M2: rewrite each partition that has more files than its size calls for.

    Rows go to ``ceil(bytes / target)`` files by a hash of their place in the old files, so that
    the split repeats when a task is retried and does not depend on the data's own skew; small partitions share tasks. Of
    partitions that are already compact only footers are read. Files are counted and read by one listing, and
    neither the files nor the partitions to rewrite pass the driver as a list. What others add meanwhile stays, and a
    partition where a file that was read was replaced meanwhile is left as it is. Runs follow each other, each of about
    ``files_per_run`` new files, and each is swapped in before the next is read.
    """
    tables.complete(spark, path)
    layout = tables.layout_of(spark, path)
    parts = tables.partition_cols_of(spark, path)
    if files(spark, path).isEmpty():
        return {"partitions": 0, "files_before": 0, "files_after": 0}
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    rows = (reader.schema(tables.stored_schema(spark, path)) if layout else reader).parquet(path)
    size = F.sum("_length")
    wanted = F.greatest(F.ceil(size / F.lit(float(target_bytes))).cast("int"), F.lit(1))
    per_folder = [F.count(F.lit(1)).alias("_files"), size.alias("_bytes"), wanted.alias("_wanted")]
    with materialized(_listed(rows, parts), "file-list") as listed:
        folders = listed.groupBy(*parts, "_folder").agg(*per_folder).where("_files > _wanted")
        with materialized(folders, "crowded") as crowded:
            total = crowded.agg(F.count(F.lit(1)).alias("folders"), F.sum("_wanted").alias("wanted")).first()
            runs = ceil((total["wanted"] or 0) / files_per_run)
            for run in range(runs):
                chosen = crowded.where(F.pmod(F.xxhash64("_folder"), F.lit(runs)) == run)
                _rewrite(rows, path, parts, (layout or {}).get("order", []), chosen, listed, target_bytes)
        result = {"partitions": total["folders"], "files_before": listed.count()}
    result["files_after"] = files(spark, path).count()
    return result


def _listed(rows: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The files that ``rows`` are read from, by their first rows."""
    uri = F.col("_metadata.file_path")
    return rows.where(F.col("_metadata.row_index") == 0).select(
        *parts,
        F.regexp_replace(uri, "/[^/]+$", "").alias("_folder"),
        tables.file_below(uri, len(parts)).alias("_file"),
        F.col("_metadata.file_size").alias("_length"),
    )


def _rewrite(rows: DataFrame, path: str, parts, order, chosen: DataFrame, listed: DataFrame, target_bytes: int) -> None:
    size = chosen.agg(F.max("_wanted").alias("most"), F.sum("_bytes").alias("bytes")).first()
    if size["most"] is None:
        return
    # Consecutive numbers for the files of a folder, so no two of them share a task.
    tasks = max(size["most"], ceil(size["bytes"] / target_bytes))
    names = rows.columns
    placed = rows.select(
        *names,
        F.regexp_replace("_metadata.file_path", "/[^/]+$", "").alias("_folder"),
        F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_row"),
    )
    if parts:
        placed = pruned(placed, parts, chosen.select(*parts))
    task = F.pmod(F.pmod(F.xxhash64("_folder"), F.lit(tasks)) + F.pmod("_row", F.col("_wanted")), F.lit(tasks))
    spread = (
        placed.join(chosen.select("_folder", "_wanted"), "_folder")
        .repartitionById(tasks, task.cast("int"))
        .select(*names)
    )
    if parts:
        spread = spread.sortWithinPartitions(*parts, *[c for c in order if c not in parts])
    read = listed.join(chosen.select("_folder"), "_folder", "left_semi")
    tables.swap_in(spread, path, parts, "rewritten", read=read)


def merge_batches(spark: SparkSession, path: str, older_than_hours: float, now: float | None = None) -> dict[str, int]:
    """M2: the batches of a table that were written longer ago than that, gathered into one of few files.

    The rows go to a batch of a new name, which streams that have begun pass by, so all readers should be less than
    ``older_than_hours`` behind. Replaced folders are retired as in any publish, and a merge that was cut short is completed by
    the next.
    """
    tables.complete(spark, path)
    storage = Storage(spark, path)
    limit = ((now or time.time()) - older_than_hours * 3600) * 1000
    names = [n for n in storage.folders(path) if n.startswith(f"{tables.BATCH}=")]
    old = [n for n in names if storage.newest(f"{path}/{n}") <= limit]
    if len(old) > 1:
        parts = tables.partition_cols_of(spark, path)
        values = [n.split("=", 1)[1] for n in old]
        rows = spark.read.schema(tables.stored_schema(spark, path)).parquet(path).where(F.col(tables.BATCH).isin(values))
        merged = rows.withColumn(tables.BATCH, F.lit(f"{tables.MERGED}{uuid.uuid4().hex}")).hint("rebalance", *parts)
        tables.swap_in(merged.sortWithinPartitions(*parts), path, parts, "files", old)
    return {"batches_before": len(names), "batches_after": len(names) - (len(old) - 1 if len(old) > 1 else 0)}


def vacuum(
    spark: SparkSession,
    path: str,
    retention_hours: float,
    force: bool = False,
    now: float | None = None,
) -> int:
    """M3: delete data replaced longer ago than the retention, and writes that were cut short and whose
    newest file is older than that; returns how many.

    Live data is never looked at. Retentions under an hour need ``force``, since a running reader
    may still hold the old files.
    """
    if retention_hours < MIN_RETENTION_HOURS and not force:
        raise ValueError(f"retention under {MIN_RETENTION_HOURS} h needs force=True")
    tables.complete(spark, path)
    storage = Storage(spark, path)
    limit = ((now or time.time()) - retention_hours * 3600) * 1000
    removed = 0
    for area in (tables.RETIRED, tables.STAGING):
        for name in storage.folders(f"{path}/{area}"):
            since = int(name.split("-")[0])
            if area == tables.STAGING:
                since = max(since, storage.newest(f"{path}/{area}/{name}"))
            if since <= limit:
                storage.delete(f"{path}/{area}/{name}")
                removed += 1
    return removed


def storage_report(df: DataFrame, partition_cols: Sequence[str] = ()) -> DataFrame:
    """M8: files, bytes and rows of a table read, per partition.

    Counts come from file footers and the hidden metadata column; no data column is read.
    """
    per_file = df.groupBy(
        *partition_cols, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count(F.lit(1)).alias("rows"))
    return per_file.groupBy(*partition_cols).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
    )


def compare_sizes(landing: DataFrame, table: DataFrame) -> DataFrame:
    """M8: landing files against the table made of them, one row each."""
    tagged = lambda df, tag: storage_report(df).withColumn("layer", F.lit(tag))
    return tagged(landing, "landing").unionByName(tagged(table, "table"))


# ---- M7: catalog --------------------------------------------------------------------------------


def register(spark: SparkSession, database: str, table: str, path: str, location: str | None = None) -> None:
    """Create the database if needed and an external table over a table's directory."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
    spark.sql(f"CREATE TABLE `{database}`.`{table}` USING parquet LOCATION '{path}'")
    if tables.partition_cols_of(spark, path):
        spark.catalog.recoverPartitions(f"{database}.{table}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """The tables of a database, as ``SHOW TABLES`` gives them, views left out."""
    return spark.sql(f"SHOW TABLES IN `{database}`").where("not isTemporary").select("namespace", "tableName")


def describe(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED `{database}`.`{table}`")


def count_rows(spark: SparkSession, database: str, names: Sequence[str]) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        spark.table(f"`{database}`.`{t}`").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(t).alias("table"), "rows"
        )
        for t in names
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result
