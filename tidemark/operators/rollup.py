"""Bars rolled up to days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily(bars: DataFrame) -> DataFrame:
    """Open, low, high, close and volume per ticker and day, with the day's change and ratio.

    ``min_by``/``max_by`` keep only fixed-width state, so each task reduces its rows before the
    shuffle and no sort is needed. The day is grouped as a date and spelled once per group.
    """
    return (
        bars.groupBy("ticker", F.to_date("timestamp").alias("day"))
        .agg(
            F.min_by("open", "timestamp").alias("open"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.max_by("close", "timestamp").alias("close"),
            F.sum("volume").alias("volume"),
        )
        .withColumn("day", F.date_format("day", "yyyy-MM-dd"))
        .withColumn("osc", F.col("close") - F.col("open"))
        .withColumn("osc_per", F.try_divide("osc", "open"))
    )


def edge_bars(bars: DataFrame) -> DataFrame:
    """The first and the last bar of each ticker and day, one row each, tagged by ``edge``.

    Column by column, since fixed-width state aggregates by hash where a struct would be sorted.
    """
    columns = ["timestamp", "open", "high", "low", "close", "volume"]
    edges = bars.groupBy("ticker", F.to_date("timestamp").alias("day")).agg(
        *[F.min_by(c, "timestamp").alias(f"first_{c}") for c in columns],
        *[F.max_by(c, "timestamp").alias(f"last_{c}") for c in columns],
    )
    bar = lambda edge: F.struct(
        F.lit(edge).alias("edge"), *[F.col(f"{edge}_{c}").alias(c) for c in columns]
    )
    return edges.select(
        "ticker",
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        F.explode(F.array(bar("first"), bar("last"))).alias("bar"),
    ).select("ticker", "day", "bar.*")
