"""Exact order statistics and quantiles per group, for groups of any size.

``percentile`` keeps every distinct value of a group in one map. Here a sketch first brackets each
wanted rank; the second pass counts the rows below the bracket and keeps, already summed per value,
only the few inside it. The counts are exact, so the answer is; a bracket that misses its rank is
noticed and widened. A bracket is a fixed share of its group, so that of a very large group is cut into
bins of equal width, again and again, until it holds a bounded number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.shared import materialize, materialized


WINDOW_ROWS = 200_000  # of a bracket that one task sorts
BINS = 1024
MARGIN = 4.0  # half the width of a bracket, in errors of the sketch


class Mark(NamedTuple):
    """Two neighboring 0-based ranks near probability ``p``, as expressions over the count ``n``."""

    name: str
    p: float
    first: Column
    last: Column


def at_ranks(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    marks: Sequence[Mark],
    accuracy: int = 20_000,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """The values at each mark's ranks: ``by…, name, n, first, last, at_first, at_last, below``.

    ``below`` counts the values smaller than ``at_first``.
    """
    rows = df.select(*by, F.col(value).alias("value")).where("value is not null")
    margin = MARGIN / accuracy
    while True:
        with materialized(_brackets(rows, by, marks, accuracy, margin), "brackets") as wanted:
            narrow = _narrowed(rows, by, wanted, accuracy, window_rows)
            found = materialize(_pick(rows, by, narrow), "ranks")
            complete = found.where("at_first is not null and at_last is not null").count()
            if margin >= 1.0 or complete == wanted.count() * len(marks):
                return found
        margin *= 16


def _brackets(rows, by, marks, accuracy, margin) -> DataFrame:
    """One row per group: its count and, per mark, the values a sketch puts around the ranks.

    A group of up to ``accuracy`` rows is its own bracket.
    """
    edges = [edge for m in marks for edge in (max(m.p - margin, 0.0), min(m.p + margin, 1.0))]
    counted = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.percentile_approx("value", edges, accuracy).alias("edges"),
    )
    small = F.col("n") <= accuracy
    entries = []
    for i, m in enumerate(marks):
        low, high = F.col("edges")[2 * i], F.col("edges")[2 * i + 1]
        if edges[2 * i] == 0.0:
            low = F.col("least")
        if edges[2 * i + 1] == 1.0:
            high = F.col("most")
        entries.append(
            F.struct(
                F.lit(m.name).alias("name"),
                m.first.cast("bigint").alias("first"),
                m.last.cast("bigint").alias("last"),
                F.when(small, F.col("least")).otherwise(low).alias("low"),
                F.when(small, F.col("most")).otherwise(high).alias("high"),
            )
        )
    return counted.select(*by, "n", F.array(*entries).alias("marks"))


def _marked(rows: DataFrame, by: Sequence[str], wanted: DataFrame) -> DataFrame:
    """Each row beside every mark of its group: ``by…, value, n, m``, up to the high end of the bracket."""
    if by:
        same_group = F.lit(True)
        for c in by:
            same_group = same_group & F.col(f"r.{c}").eqNullSafe(F.col(f"w.{c}"))
        beside = rows.alias("r").join(wanted.alias("w"), same_group).select(*[f"r.{c}" for c in by], "value", "n", F.explode("marks").alias("m"))
    else:
        one = wanted.first()  # a single row of totals
        if one is None:
            return rows.where(F.lit(False)).join(wanted.select("n", F.explode("marks").alias("m")), how="cross")
        kinds = wanted.schema["marks"].dataType.elementType
        marks = [F.struct(*[F.lit(m[f.name]).cast(f.dataType).alias(f.name) for f in kinds]) for m in one["marks"]]
        beside = rows.select("value", F.lit(one["n"]).alias("n"), F.explode(F.array(*marks)).alias("m"))
    return beside.where(F.col("value") <= F.col("m.high"))


def _narrowed(rows: DataFrame, by: Sequence[str], wanted: DataFrame, accuracy: int, window_rows: int) -> DataFrame:
    """Brackets of at most ``window_rows`` rows, or of one value: each pass counts the bins of every bracket
    and keeps those from its first rank's to its last."""
    share = 2 * MARGIN / accuracy
    if not wanted.where(F.col("n") * share > window_rows).count():
        return wanted
    widest = None
    while True:
        width = F.col("m.high").cast("double") - F.col("m.low").cast("double")
        place = F.least(F.floor((F.col("value").cast("double") - F.col("m.low")) * F.lit(float(BINS)) / width), F.lit(BINS - 1))
        bin_ = F.when(F.col("value") < F.col("m.low"), F.lit(-1)).when(width > 0, place).otherwise(F.lit(0))
        cells = (
            _marked(rows, by, wanted)
            .groupBy(*by, "n", "m", bin_.cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("copies"), F.min("value").alias("least"), F.max("value").alias("most"))
        )
        upto = F.sum("copies").over(Window.partitionBy(*by, "m.name").orderBy("bin"))
        running = cells.withColumn("upto", upto).withColumn("below", F.col("upto") - F.col("copies"))
        holds = lambda rank: (F.col("bin") >= 0) & (F.col(rank) >= F.col("below")) & (F.col(rank) < F.col("upto"))
        between = (F.col("bin") >= 0) & (F.col("upto") > F.col("m.first")) & (F.col("below") <= F.col("m.last"))
        found = running.groupBy(*by, "n", "m").agg(
            F.max(F.when(holds("m.first"), F.col("least"))).alias("low"),
            F.max(F.when(holds("m.last"), F.col("most"))).alias("high"),
            F.sum(F.when(between, F.col("copies"))).alias("rows"),
        )
        found = materialize(found, "narrowed")
        # A bracket that misses a rank is left for the caller to widen.
        good = F.col("low").isNotNull() & F.col("high").isNotNull()
        most = found.where(good & (F.col("low") < F.col("high"))).agg(F.max("rows")).first()[0] or 0
        mark = F.struct(
            "m.name", "m.first", "m.last",
            F.when(good, F.col("low")).otherwise(F.col("m.low")).alias("low"), F.when(good, F.col("high")).otherwise(F.col("m.high")).alias("high"),
        )
        wanted = materialize(found.groupBy(*by, "n").agg(F.collect_list(mark).alias("marks")), "brackets")
        if most <= window_rows or most == widest:
            return wanted
        widest = most


def _pick(rows, by, wanted) -> DataFrame:
    """Count below and inside each bracket, then read the ranks off the running count."""
    inside = F.when(F.col("value") >= F.col("m.low"), F.col("value"))
    counts = (
        _marked(rows, by, wanted)
        .groupBy(*by, "m.name", "n", "m.first", "m.last", inside.alias("value"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    upto = Window.partitionBy(*by, "name").orderBy(F.col("value").asc_nulls_first())
    running = counts.withColumn("upto", F.sum("copies").over(upto)).withColumn(
        "below", F.col("upto") - F.col("copies")
    )
    holds = lambda rank: (
        F.col("value").isNotNull() & (F.col(rank) >= F.col("below")) & (F.col(rank) < F.col("upto"))
    )
    return running.groupBy(*by, "name", "n", "first", "last").agg(
        F.max(F.when(holds("first"), F.col("value"))).alias("at_first"),
        F.max(F.when(holds("last"), F.col("value"))).alias("at_last"),
        F.max(F.when(holds("first"), F.col("below"))).alias("below"),
    )


def quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: dict[str, float],
    accuracy: int = 20_000,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Linearly interpolated quantiles, one column per name in ``probs``, one row per group."""
    marks = [
        Mark(
            name,
            p,
            F.floor(F.lit(p) * (F.col("n") - 1)),
            F.ceil(F.lit(p) * (F.col("n") - 1)),
        )
        for name, p in probs.items()
    ]
    found = at_ranks(df, by, value, marks, accuracy, window_rows)
    share = lambda p: F.lit(p) * (F.col("n") - 1) - F.col("first")
    read = lambda name, p: F.max(
        F.when(
            F.col("name") == name,
            F.col("at_first") + (F.col("at_last") - F.col("at_first")) * share(p),
        )
    ).alias(name)
    return found.groupBy(*by).agg(
        F.max("n").alias("n"), *[read(name, p) for name, p in probs.items()]
    )


def quantiles_of_few(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """The same for a value of few distinct levels, such as whole seconds: one pass, no sketch.

    Rows become counts per level before the shuffle; what is ranked is as long as the levels are many.
    """
    levels = (
        df.select(*by, F.col(value).alias("value"))
        .where("value is not null")
        .groupBy(*by, "value")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    upto = F.sum("copies").over(Window.partitionBy(*by).orderBy("value"))
    running = (
        levels.withColumn("upto", upto)
        .withColumn("below", F.col("upto") - F.col("copies"))
        .withColumn("n", F.sum("copies").over(Window.partitionBy(*by)))
    )

    def read(p: float) -> Column:
        place = F.lit(p) * (F.col("n") - 1)
        at = lambda rank: F.max(
            F.when((rank >= F.col("below")) & (rank < F.col("upto")), F.col("value"))
        )
        share = F.max(place - F.floor(place))
        return at(F.floor(place)) + (at(F.ceil(place)) - at(F.floor(place))) * share

    return running.groupBy(*by).agg(
        F.max("n").alias("n"), *[read(p).alias(name) for name, p in probs.items()]
    )
