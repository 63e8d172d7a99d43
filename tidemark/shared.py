"""Where intermediate tables go, and how a small result becomes one.

An intermediate written as Parquet cuts lineage, survives the loss of any executor, and tells the
planner its true size, so that a later join broadcasts it only when that size is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.storage import Storage


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can see, as the cluster names it in ``spark.checkpoint.dir``.

    A local session without one uses its warehouse folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return it as a table read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def materialized(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The same for the length of a block whose work is done when it ends; the table goes then."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        Storage(spark, path).delete(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; for the end of a job, when nothing lazy is left."""
    root = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    Storage(spark, root).delete(root)


def materialize_by(df: DataFrame, name: str, column: str) -> dict[str, DataFrame]:
    """Write ``df`` once, split by a column of few values, and return one read per value.

    Each part is a folder of its own, so that the planner knows the size of each.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(column).parquet(path)
    rest = df.drop(column).schema
    folders = [f for f in Storage(spark, path).folders(path) if "=" in f]
    return {f.split("=")[1]: spark.read.schema(rest).parquet(f"{path}/{f}") for f in folders}
