"""One row per key, duplicate audits, layer reconciliation by keys and by content."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def one_per_key(df: DataFrame, keys: Sequence[str], *latest_by: Column | str) -> DataFrame:
    """The row with the greatest ``latest_by`` of each key; ties go to the greatest row.

    Ranking for the first place alone lets Spark keep one row per key in each task before the
    shuffle, so that a key with a third of all rows arrives as a handful.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest_by]
    order = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in [*latest_by, *rest]]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Every distinct row once."""
    return df.dropDuplicates()


def duplicate_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A10: rows, distinct keys and surplus rows, in one pass."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    ).withColumn("surplus", F.col("rows") - F.col("distinct_keys"))


def reconcile(upstream: DataFrame, downstream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A10: row counts of two layers and the keys that one has and the other lacks.

    One grouping over both sides, so that no join is needed and copies are reduced map-side.
    """
    tag = lambda df, up: df.select(*keys, F.lit(up).alias("up"), F.lit(1 - up).alias("down"))
    per_key = (
        tag(upstream, 1)
        .unionByName(tag(downstream, 0))
        .groupBy(*keys)
        .agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_key.agg(
        total("up").alias("upstream_rows"),
        total("down").alias("downstream_rows"),
        F.count_if((F.col("up") > 0) & (F.col("down") == 0)).alias("missing_keys"),
        F.count_if((F.col("up") == 0) & (F.col("down") > 0)).alias("extra_keys"),
    )


def fingerprints(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """A10: per partition the number of rows and two sums of row hashes, whatever the order of the rows.

    Sums add up over tasks, so a partition of any size arrives as one row from each. They tell multisets apart: a changed
    value, a lost row and one too many each change them. NULL has a hash of its own.
    """
    seen = _row_hash(cols)
    other = F.xxhash64(seen, F.lit(1))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), _wide_sum(seen).alias("sum"), _wide_sum(other).alias("other_sum"))


def _row_hash(cols: Sequence[str]) -> Column:
    return F.xxhash64(*cols, *[F.col(c).isNull() for c in cols])


def _wide_sum(hashed: Column) -> Column:
    return F.sum(hashed.cast("decimal(20,0)"))


def differing_partitions(upstream: DataFrame, downstream: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """A10: the partitions whose contents differ, with the rows each layer has there; NULL names a partition too."""
    marks = lambda df, up: fingerprints(df, by, cols).withColumn("up", F.lit(up))
    sides = marks(upstream, True).unionByName(marks(downstream, False))
    side = lambda c, up: F.max(F.when(F.col("up") == up, F.col(c)))
    both = sides.groupBy(*by).agg(*[side(c, up).alias(f"{c}_{up}") for c in ("rows", "sum", "other_sum") for up in (True, False)])
    same = [F.col(f"{c}_{True}").eqNullSafe(F.col(f"{c}_{False}")) for c in ("rows", "sum", "other_sum")]
    rows = lambda up: F.coalesce(F.col(f"rows_{up}"), F.lit(0))
    return both.where(~(same[0] & same[1] & same[2])).select(*by, rows(True).alias("upstream_rows"), rows(False).alias("downstream_rows"))


def differences(upstream: DataFrame, downstream: DataFrame, by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """A10: for each partition that differs, how many keys are missing downstream, extra there, or have other contents.

    Partitions are compared by their fingerprints first; rows are only looked at in those that differ, again in one
    grouping without a join of the layers. All columns of ``upstream`` are compared; ``by`` may be derived from them.
    """
    cols = [c for c in upstream.columns if c not in by]
    differing = differing_partitions(upstream, downstream, by, cols)
    with_hash = lambda df, up: in_partitions(df, by, differing).select(
        *by, *[k for k in keys if k not in by], _row_hash(cols).alias("hash"), F.lit(up).alias("up")
    )
    rows = with_hash(upstream, 1).unionByName(with_hash(downstream, -1))
    per_key = rows.groupBy(*dict.fromkeys([*by, *keys])).agg(
        F.max("up").alias("most"), F.min("up").alias("least"),
        F.sum(F.col("hash").cast("decimal(20,0)") * F.col("up")).alias("apart"), F.sum("up").alias("copies"),
    )
    changed = (F.col("most") == 1) & (F.col("least") == -1) & ((F.col("apart") != 0) | (F.col("copies") != 0))
    found = per_key.groupBy(*by).agg(
        F.count_if(F.col("least") == 1).alias("missing"), F.count_if(F.col("most") == -1).alias("extra"), F.count_if(changed).alias("changed")
    )
    return found


def in_partitions(rows: DataFrame, parts: Sequence[str], among: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose partition is (``left_anti``: is not) one of a small table of partitions, NULL among them."""
    same = [F.col(f"rows.{c}").eqNullSafe(F.col(f"among.{c}")) for c in parts]
    return rows.alias("rows").join(among.alias("among"), reduce(Column.__and__, same), how)


def not_null_counts(df: DataFrame) -> DataFrame:
    """Rows in all and non-null values per column, one row."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in df.columns]
    )
