"""Blocks over rows: each task makes one small matrix of its rows, and one small aggregate merges the tasks'.

A block depends on all columns at once, as cross products do. Tasks hand over its rows, so that what is shuffled is
tasks x rows of the block, however many rows the table has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def points(column: pa.Array, width: int) -> np.ndarray:
    """A list column of equally long rows as a matrix; NULL entries become NaN."""
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, width)


def _rows_of(block: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(0, block.size + 1, block.shape[1], dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(block.ravel()))


def summed_blocks(
    df: DataFrame, column: str, width: int, shape: tuple[int, int], block: Callable[[np.ndarray], np.ndarray]
) -> DataFrame:
    """``i int, total array<double>``: the sum of ``block(rows)`` over all batches of an array column, row by row.

    ``block`` maps a matrix of ``width`` columns to one of ``shape``. No rows, no result rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = block(points(batch.column(0), width))
                total = found if total is None else total + found
        if total is not None:
            places = pa.array(np.arange(shape[0], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([places, _rows_of(total)], ["i", "part"])

    parts = df.select(column).mapInArrow(run, "i int, part array<double>")
    sums = [F.sum(F.get("part", F.lit(j))) for j in range(shape[1])]
    return parts.groupBy("i").agg(F.array(*sums).alias("total"))


def as_matrix(sums: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """A block that ``summed_blocks`` made, whose size does not grow with the rows, on the driver; zeros without rows."""
    out = np.zeros(shape)
    for row in sums.collect():
        out[row["i"]] = row["total"]
    return out


# ---- cross moments --------------------------------------------------------------------------------

# Of the rows in which both i and j are there: how many, the means of i and of j, the sums of squares of both about
# these means, and of their products.
MOMENTS = ("n", "mean", "other_mean", "square", "other_square", "product")


def moments_of(rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """``MOMENTS`` for all pairs of columns of a matrix in which NaN is missing; each is columns x columns."""
    there = ~np.isnan(rows)
    mask = there.astype(float)
    counts = np.maximum(mask.sum(axis=0), 1)
    centre = np.where(there, rows, 0).sum(axis=0) / counts
    values = np.where(there, rows - centre, 0)
    n = mask.T @ mask
    sums = values.T @ mask
    share = np.divide(sums, n, out=np.zeros_like(sums), where=n > 0)
    mean = np.where(n > 0, centre[:, None] + share, 0)
    square = (values**2).T @ mask - sums * share
    product = values.T @ values - sums * share.T
    return n, mean, mean.T, square, square.T, product


def merged(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The moments of two sets of rows together, without the cancellation that plain sums would have."""
    n = a[0] + b[0]
    weight = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    apart, other_apart, scale = b[1] - a[1], b[2] - a[2], a[0] * weight
    return (
        n, a[1] + apart * weight, a[2] + other_apart * weight,
        a[3] + b[3] + apart**2 * scale, a[4] + b[4] + other_apart**2 * scale, a[5] + b[5] + apart * other_apart * scale,
    )


def correlation(moments: Sequence[np.ndarray]) -> np.ndarray:
    """The correlation of each pair, NaN with fewer than two rows or where one side does not vary."""
    both = np.sqrt(np.maximum(moments[3], 0) * np.maximum(moments[4], 0))
    return np.divide(moments[5], both, out=np.full_like(both, np.nan), where=(both > 0) & (moments[0] > 1))


def correlations(df: DataFrame, column: str, width: int) -> DataFrame:
    """``i int, j int, corr double`` for all pairs of an array column; NULL where there is none.

    One block for each task, one small group for each i.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = moments_of(points(batch.column(0), width).astype(float))
                total = found if total is None else merged(total, found)
        if total is not None:
            places = pa.array(np.arange(width, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([places, *map(_rows_of, total)], ["i", *MOMENTS])

    def merge(table: pa.Table) -> pa.Table:
        parts = [np.stack([np.asarray(v) for v in table.column(m).to_pylist()]) for m in MOMENTS]
        total = tuple(p[0] for p in parts)
        for k in range(1, len(parts[0])):
            total = merged(total, tuple(p[k] for p in parts))
        found = correlation(total)
        i = pa.array(np.full(width, table.column("i")[0].as_py(), np.int32))
        return pa.table([i, pa.array(np.arange(width, dtype=np.int32)), pa.array(found, mask=np.isnan(found))], names=["i", "j", "corr"])

    each = ", ".join(f"{m} array<double>" for m in MOMENTS)
    parts = df.select(column).mapInArrow(blocks, f"i int, {each}")
    return parts.groupBy("i").applyInArrow(merge, "i int, j int, corr double")


# ---- counts of pairs of bins ------------------------------------------------------------------------

OPEN_LABELS = 64  # whose counts a task holds at once


def pair_counts(df: DataFrame, label: str, column: str, width: int, bins: int) -> DataFrame:
    """``label, i, j, x_bin, y_bin, n`` for places i < j of an array of bins (NULL: none), counted by task, then summed.

    A task holds one dense block of (places x bins) squared for each label, and hands over its non-empty cells; beyond
    ``OPEN_LABELS`` labels it does so before it takes up others.
    """
    side = width * bins
    kind = df.schema[label].dataType.simpleString()
    upper = np.arange(side)[:, None] // bins < np.arange(side)[None, :] // bins

    def cells(open_blocks: dict) -> Iterator[pa.RecordBatch]:
        for name, block in open_blocks.items():
            x, y = np.nonzero(block * upper)
            columns = [c.astype(np.int32) for c in (x // bins, y // bins, x % bins, y % bins)]
            labels = pa.array([name], arrow_type).take(pa.array(np.zeros(len(x), np.int32)))
            yield pa.RecordBatch.from_arrays([labels, *map(pa.array, columns), pa.array(block[x, y])], ["label", "i", "j", "x_bin", "y_bin", "n"])

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_type = to_arrow_type(df.schema[label].dataType)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict = {}
        for batch in batches:
            values = points(batch.column(1), width).astype(float)
            row, place = np.nonzero(~np.isnan(values))
            hot = np.zeros((len(values), side), np.float32)  # exact: a batch has far fewer than 2^24 rows
            hot[row, place * bins + values[row, place].astype(int)] = 1
            names = batch.column(0).to_pylist()
            rows_of: dict = {}
            for at, name in enumerate(names):
                rows_of.setdefault(name, []).append(at)
            for name, some in rows_of.items():
                if name not in open_blocks and len(open_blocks) >= OPEN_LABELS:
                    yield from cells(open_blocks)
                    open_blocks = {}
                mine = hot[some]
                block = (mine.T @ mine).astype(np.int64)
                open_blocks[name] = open_blocks[name] + block if name in open_blocks else block
        yield from cells(open_blocks)

    counted = df.select(label, column).mapInArrow(count, f"label {kind}, i int, j int, x_bin int, y_bin int, n bigint")
    return counted.groupBy("label", "i", "j", "x_bin", "y_bin").agg(F.sum("n").alias("n"))
