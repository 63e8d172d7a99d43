"""The business-day spine and the join of a history with later downloads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import materialize


def is_business_day(day: Column) -> Column:
    return F.weekday(day) < 5


def business_days(bounds: DataFrame) -> DataFrame:
    """Every weekday in ``[start, end)`` of each row's bounds."""
    days = F.sequence(F.col("start"), F.date_sub("end", 1), F.expr("interval 1 day"))
    return (
        bounds.where(F.col("start") < F.col("end"))
        .withColumn("day", F.explode(days))
        .where(is_business_day(F.col("day")))
        .drop("start", "end")
    )


def business_days_between(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return business_days(spark.createDataFrame([(start, end)], "start date, end date"))


def download_days(history: DataFrame, end: Column) -> DataFrame:
    """Per ticker, the weekdays after its history ends that are still to be fetched."""
    last = history.groupBy("ticker").agg(F.to_date(F.max("timestamp")).alias("last"))
    return business_days(
        last.select("ticker", F.date_add("last", 1).alias("start"), end.cast("date").alias("end"))
    )


def concat(history: DataFrame, later: DataFrame) -> DataFrame:
    """The history, then each ticker's later bars from weekdays after its last history day.

    A ticker without history takes all its later weekday bars. The dates, one row per ticker, are
    written first, so that the planner knows their size and need not shuffle the bars.
    """
    last = materialize(
        history.groupBy("ticker").agg(F.to_date(F.max("timestamp")).alias("_last")), "history-end"
    )
    day = F.to_date("timestamp")
    added = (
        later.join(last, "ticker", "left")
        .where((F.col("_last").isNull() | (day > F.col("_last"))) & is_business_day(day))
        .select(*history.columns)
    )
    return history.unionByName(added)
