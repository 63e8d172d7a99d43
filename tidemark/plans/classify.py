"""Exploration and k-nearest-neighbor classification of a table of measurements."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import code_name
from tidemark.operators import moments
from tidemark.operators.knn import neighbors, vote
from tidemark.operators.moments import pair_counts
from tidemark.operators.order_statistics import Mark, at_ranks, quantiles

# Class codes and names; every other code gets the last name.
CLASS_NAMES = {0: "sentosa", 1: "versicolor"}
LAST_CLASS = "virginica"
TEST_SHARE = 0.25
K = 3


def named(df: DataFrame, label: str = "label") -> DataFrame:
    """L1: the class name beside its code."""
    return df.withColumn("class_name", code_name(label, CLASS_NAMES, LAST_CLASS))


def present(value: Column | str) -> Column:
    """Whether a measurement is there: neither NULL nor NaN."""
    value = F.col(value) if isinstance(value, str) else value
    return value.isNotNull() & ~F.isnan(value)


def unusable(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """How many rows lack a measurement, and so have no place among neighbors: one row, ``rows, unusable``."""
    whole = F.forall(F.array(*features), present)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~whole).alias("unusable"))


def long_form(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.unpivot(["label"], list(features), "feature", "value")


def summary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """L2: count, extremes and quartiles per class and measurement, of those that are there."""
    long = long_form(df, features).where(present("value"))
    quartiles = quantiles(long, ["label", "feature"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    extremes = long.groupBy("label", "feature").agg(
        F.min("value").alias("least"), F.max("value").alias("most")
    )
    return quartiles.join(extremes, ["label", "feature"])


def bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """The 0-based fixed-width bin of a value, the top edge in the last bin, all in bin 0 if the edges are equal.

    A missing value, NULL or NaN, has none.
    """
    place = F.floor((value - low) * F.lit(float(bins)) / (high - low))
    inside = F.when(high > low, F.least(place, F.lit(bins - 1))).otherwise(F.lit(0))
    return F.when(present(value), inside).cast("int")


def extent(df: DataFrame, features: Sequence[str]) -> tuple[list, list]:
    """Least and greatest value of each measurement: one aggregate, one row read back for each."""
    long = long_form(df, features).where(present("value"))
    found = long.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high")).collect()
    edges = {r["feature"]: (r["low"], r["high"]) for r in found}
    return tuple([edges.get(c, (0.0, 0.0))[side] for c in features] for side in (0, 1))


def _binned(df: DataFrame, features: Sequence[str], bins: int) -> Column:
    """The bins of all measurements of a row as an array."""
    low, high = (F.array(*map(F.lit, side)) for side in extent(df, features))
    values = F.array(*features)
    return F.transform(values, lambda v, i: bin_of(v, F.get(low, i), F.get(high, i), bins))


def _named(features: Sequence[str], place: str) -> Column:
    return F.get(F.array(*map(F.lit, features)), F.col(place))


def histogram(df: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """L2: the density behind a violin plot, as fixed-width counts per class and measurement."""
    return (
        df.select("label", F.posexplode(_binned(df, features, bins)).alias("i", "bin"))
        .where("bin is not null")
        .groupBy("label", "i", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("label", _named(features, "i").alias("feature"), "bin", "n")
    )


def pair_bins(df: DataFrame, features: Sequence[str], bins: int = 5) -> DataFrame:
    """L4: pair-plot counts per class and pair of measurements, binned so that output is bounded.

    Each task counts all pairs at once, as a product of its rows, and shuffles its non-empty cells.
    """
    binned = df.select("label", _binned(df, features, bins).alias("b"))
    counted = pair_counts(binned, "label", "b", len(features), bins)
    return counted.select("label", _named(features, "i").alias("x"), _named(features, "j").alias("y"), "x_bin", "y_bin", "n")


def correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """L3: the Pearson matrix in long form; a pair counts the rows where both values are there.

    Each task adds up the cross moments of its rows as one block, and one small group for each measurement merges them.
    """
    values = df.select(F.transform(F.array(*features), lambda v: F.when(present(v), v.cast("double"))).alias("v"))
    found = moments.correlations(values, "v", len(features))
    return found.select(
        _named(features, "i").alias("x"), _named(features, "j").alias("y"), F.when(F.col("i") == F.col("j"), 1.0).otherwise(F.col("corr")).alias("corr")
    )


def split(df: DataFrame, seed: int = 0, share: float = TEST_SHARE) -> DataFrame:
    """Mark exactly ``ceil(share * n)`` rows as ``test``: those whose seeded hash ranks lowest.

    The cut is found as an order statistic, so no task sorts the table.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col("id").cast("string")))
    prefix = F.conv(F.substring("_digest", 1, 13), 16, 10).cast("bigint")
    hashed = df.withColumn("_digest", digest).withColumn("_prefix", prefix)
    last = F.ceil(F.lit(share) * F.col("n")) - 1
    mark = Mark("cut", share, last, last)
    cut = at_ranks(hashed.select("_prefix"), [], "_prefix", [mark], accuracy=100_000).first()
    if cut is None:
        return df.withColumn("test", F.lit(False))
    position = math.ceil(share * cut["n"]) - 1 - cut["below"]
    tied = (
        hashed.where(F.col("_prefix") == cut["at_first"])
        .select("_digest", "id")
        .orderBy("_digest", "id")
        .offset(position)
        .first()
    )
    at_cut = (F.col("_prefix") == cut["at_first"]) & (
        (F.col("_digest") < tied["_digest"])
        | ((F.col("_digest") == tied["_digest"]) & (F.col("id") <= tied["id"]))
    )
    is_test = (F.col("_prefix") < cut["at_first"]) | at_cut
    return hashed.withColumn("test", is_test).drop("_digest", "_prefix")


def predict(df: DataFrame, features: Sequence[str], seed: int = 0, k: int = K) -> DataFrame:
    """Split, classify the test rows, and set prediction and truth side by side.

    Every test row comes out; one that lacks a measurement has no prediction, see ``unusable``.
    """
    marked = split(df, seed)
    test = marked.where("test").drop("test")
    train = marked.where("not test").drop("test")
    voted = vote(neighbors(test, train, features, k))
    return test.join(voted, "id", "left").withColumn("correct", F.col("pred") == F.col("label"))
