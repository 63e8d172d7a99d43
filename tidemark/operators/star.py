"""Event counts joined to their dimension names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.shared import materialize_by


def dimension_rows(df: DataFrame, dims: dict[str, str]) -> DataFrame:
    """``(dim, id, name)`` of every row and dimension; ``dims`` maps an id column to its name column."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(id_col).alias("dim"),
                F.col(id_col).cast("string").alias("id"),
                F.col(name_col).cast("string").alias("name"),
            )
            for id_col, name_col in dims.items()
        ]
    )
    return df.select(F.explode(pairs).alias("p")).select("p.*")


def dimension_pairs(df: DataFrame, dims: dict[str, str]) -> DataFrame:
    """A7 for all dimensions in one scan: distinct ``(dim, id, name)``, reduced before the shuffle."""
    return dimension_rows(df, dims).distinct()


def one_name_per_id(pairs: DataFrame) -> DataFrame:
    """The smallest name of each id (the survivor is declared, not arbitrary)."""
    return pairs.groupBy("dim", "id").agg(F.min("name").alias("name"))


def star_join(
    fact: DataFrame, rows: DataFrame, dims: dict[str, str], dedupe: bool = True
) -> DataFrame:
    """Inner-join a pre-aggregated fact to each dimension by id; NULL ids drop out.

    ``rows`` are ``dimension_rows``; one shuffle makes them names by id.

    The dimensions are written once, a folder each, so that the planner sees their sizes and
    broadcasts only those under its threshold; a larger one is shuffled, and adaptive execution
    splits its hot ids. With ``dedupe`` off, an id with two names doubles its fact rows.
    """
    named = materialize_by(one_name_per_id(rows) if dedupe else rows.distinct(), "dims", "dim")
    joined = fact
    for id_col, name_col in dims.items():
        if id_col not in named:  # no event at all
            joined = joined.withColumn(name_col, F.lit(None).cast("string")).where(F.lit(False))
            continue
        lookup = named[id_col].select(F.col("id").alias(id_col), F.col("name").alias(name_col))
        joined = joined.join(lookup, id_col)
    return joined


def count_by(df: DataFrame, keys: Sequence[str], name: str = "quantidade") -> DataFrame:
    """Rows per combination of keys."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
