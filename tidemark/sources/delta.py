"""J2, M2, M3 on Delta tables, where that package is installed: its own commands, as SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def merge_statement(path: str, source_view: str, keys: Sequence[str]) -> str:
    """Update the rows whose keys match, insert the rest."""
    on = " AND ".join(f"s.`{k}` = t.`{k}`" for k in keys)
    return (
        f"MERGE INTO delta.`{path}` AS t USING {source_view} AS s ON {on} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def merge(source: DataFrame, path: str, keys: Sequence[str]) -> None:
    source.createOrReplaceTempView("_merge_source")
    source.sparkSession.sql(merge_statement(path, "_merge_source", keys))


def compact(spark: SparkSession, path: str) -> DataFrame:
    return spark.sql(f"OPTIMIZE delta.`{path}`")


def vacuum(spark: SparkSession, path: str, retention_hours: float) -> DataFrame:
    return spark.sql(f"VACUUM delta.`{path}` RETAIN {retention_hours:g} HOURS")
