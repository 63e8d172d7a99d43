"""Change from one row to the next, without one task per key.

``PARTITION BY ticker`` gives a hot ticker's whole history to one task. Here the history is cut
into time slices: the lag runs inside ``(key, slice)``, and each slice receives, as an extra row in
front, the last row before it. Those carried rows come from one partial aggregate, so that the
only full shuffle is the one by ``(key, slice)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Slice widths from coarse to fine, in seconds, and the wider slice in which the
# carried rows of a narrow one are lagged in turn.
UNITS = {"day": 86_400.0, "hour": 3_600.0, "minute": 60.0, "second": 1.0, "millisecond": 0.001}
CARRY_UNIT = {"minute": "day", "second": "hour", "millisecond": "minute"}
FINEST = "millisecond"


def choose_slice(df: DataFrame, by: Sequence[str], order: str, max_rows: int = 1_000_000) -> str:
    """The coarsest time unit whose slices hold at most ``max_rows`` rows of one key.

    Each look reads the key and the stamp and counts with map-side combine; a busiest slice far
    over the limit skips the units that could not be enough. Stamps unique per key leave at most
    1,000 rows in a millisecond, so the finest unit needs no look.
    """
    unit = "day"
    while unit != FINEST:
        busiest = (
            df.groupBy(*by, F.date_trunc(unit, order).alias("slice"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .agg(F.max("rows").alias("rows"))
            .first()["rows"]
        ) or 0
        if busiest <= max_rows:
            return unit
        even = UNITS[unit] * max_rows / busiest
        finer = [u for u, seconds in UNITS.items() if seconds < UNITS[unit]]
        unit = next((u for u in finer if UNITS[u] <= even), FINEST)
    return unit


def with_previous(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    order: str,
    out: str,
    unit: str | None = None,
) -> DataFrame:
    """Add ``out`` = ``value`` of the row before, by ``order`` within ``by``; NULL on the first.

    Stamps must be unique within a key (dedup first), as for any reproducible lag. ``df`` is read
    twice, so a costly one should be a written table.
    """
    unit = unit or choose_slice(df, by, order)
    sliced = df.withColumn("_slice", F.date_trunc(unit, order))
    ends = sliced.groupBy(*by, "_slice").agg(F.max_by(value, order).alias(value))
    if unit in CARRY_UNIT:
        before = with_previous(
            ends.withColumnRenamed("_slice", "_start"), value, by, "_start", "_before", CARRY_UNIT[unit]
        ).withColumnRenamed("_start", "_slice")
    else:
        by_key = Window.partitionBy(*by).orderBy("_slice")
        before = ends.withColumn("_before", F.lag(value).over(by_key))
    carried = before.select(
        *by, "_slice", F.col("_before").alias(value), F.lit(True).alias("_carried")
    )
    in_slice = Window.partitionBy(*by, "_slice").orderBy(F.col("_carried").desc(), order)
    return (
        sliced.withColumn("_carried", F.lit(False))
        .unionByName(carried, allowMissingColumns=True)
        .withColumn(out, F.lag(value).over(in_slice))
        .where(~F.col("_carried"))
        .drop("_slice", "_carried")
    )


def change(value: str, previous: str) -> Column:
    """The difference to the row before."""
    return F.col(value) - F.col(previous)


def percent_change(change_col: str, previous: str) -> Column:
    """The change as a percentage of the row before; NULL where that was 0."""
    return F.try_divide(F.col(change_col) * F.lit(100.0), F.col(previous))
