"""Whitening of vectors by shifted Cholesky QR.

The fit list, each distinct vector once, is written to the shared folder. A pass over it orthogonalises the centred rows
by triangular solves against all factors found so far and adds up the Gram matrix of what results, one matrix for each
task. The driver gets that one matrix and factors it: the first time with a shift, so that rounding cannot make it
indefinite, the other times as it is. The product of the factors is the R of a QR decomposition of the centred rows, and
its singular values and right singular vectors give eigenvalues and components of the covariance without ever squaring
their condition.

Rows are centred exactly: n * x - S is an integer, and only then is it divided by n.

Defined cases: vectors that are null, empty, or hold a null or non-finite component are dropped; null ids, repeated ids
and repeated vectors are rows like any other, with the fit list holding each vector once. Vectors of different lengths
are fitted apart, each length with its own n. A component whose eigenvalue is 0, as with a single distinct vector, has
null as ``whitened``, and with a trace of 0 null as ``explained``. A ``deviation`` beyond 64 bits is null; an integer
component beyond 64 bits becomes the nearest one within. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as texts
from tidemark.llm.vectors import usable
from tidemark.operators import moments

PASSES = 3
NOUGHT = 1e-12  # of the greatest singular value: what rounding leaves of a direction that is not there
SLICE_CELLS = 1 << 20
FIELDS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def deviations(rows: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S as exact integers, in Python's own where 64 bits might not do."""
    if n * max(1, int(np.abs(rows.astype(float)).max(initial=0))) + max(map(abs, sums), default=0) < 1 << 62:
        return n * rows - np.array(sums, np.int64)
    return n * rows.astype(object) - np.array(sums, object)


def centred(rows: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (deviations(rows, n, sums) / n).astype(float)


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverse of each upper triangular factor, by forward substitution."""
    for upper in factors:
        out = np.empty_like(rows)
        for j in range(rows.shape[1]):
            out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
        rows = out
    return rows


def gram(fit: DataFrame, width: int, n: int, sums: list[int], factors: list[np.ndarray]) -> np.ndarray:
    """One pass: the Gram matrix of the orthogonalised rows."""

    def block(rows: np.ndarray) -> np.ndarray:
        q = solved(centred(rows, n, sums), factors)
        return q.T @ q

    return moments.as_matrix(moments.summed_blocks(fit, "x", width, (width, width), block), (width, width))


def upper_factor(matrix: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The Cholesky factor; with a shift from the start, or where the matrix is not positive definite."""
    width = len(matrix)
    shift = 11 * (n * width + width * (width + 1)) * np.finfo(float).eps / 2 * np.linalg.norm(matrix, 2)
    while True:
        try:
            return np.linalg.cholesky(matrix + (shift * np.eye(width) if shifted else 0)).T
        except np.linalg.LinAlgError:
            shift, shifted = shift * (4 if shifted else 1), True


def triangle(fit: DataFrame, width: int, n: int, sums: list[int]) -> np.ndarray:
    """A matrix R with R^T R = A^T A for the centred rows A; zeros if they are all 0.

    The factor of the last pass is a symmetric root, which unlike Cholesky's may be singular: directions in which no row
    differs come out as 0 and not as what the shift has left there.
    """
    factors: list[np.ndarray] = []
    product = np.eye(width)
    for turn in range(PASSES):
        found = gram(fit, width, n, sums, factors)
        if not found.any():
            return np.zeros((width, width))
        if turn == PASSES - 1:
            values, vectors = np.linalg.eigh(found)
            return (np.sqrt(np.maximum(values, 0))[:, None] * vectors.T) @ product
        factors.append(upper_factor(found, n, shifted=turn == 0))
        product = factors[-1] @ product


class Model:
    """What a fit gives: ``n``, ``sums``, the first components with their eigenvalues, and shares of the trace."""

    def __init__(self, n: int, sums: list[int], root: np.ndarray, most: int):
        _, values, vectors = np.linalg.svd(root)
        self.n, self.sums = n, sums
        trace = float((values**2).sum()) / n
        kept = vectors[:most]
        self.components = kept * np.where(kept[np.arange(len(kept)), np.abs(kept).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]
        self.eigenvalues = np.where(values > NOUGHT * values[0], values, 0)[:most] ** 2 / n
        self.explained = [e / trace if trace else None for e in self.eigenvalues.tolist()]
        self.error: float | None = None

    def whiten(self, rows: np.ndarray) -> np.ndarray:
        """Rows x components, NaN where the eigenvalue is 0."""
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (centred(rows, self.n, self.sums) @ self.components.T) / np.sqrt(self.eigenvalues)
        out[:, self.eigenvalues == 0] = np.nan
        return out


def identity_error(fit: DataFrame, width: int, model: Model) -> float | None:
    """The largest entry of the covariance of the whitened fit list minus the identity, by a pass of its own."""
    real = np.flatnonzero(model.eigenvalues)
    if not len(real):
        return None
    shape = (len(real) + 1, len(real))

    def block(rows: np.ndarray) -> np.ndarray:
        white = model.whiten(rows)[:, real]
        return np.vstack([white.T @ white, white.sum(axis=0)])

    sums = moments.as_matrix(moments.summed_blocks(fit, "x", width, shape, block), shape) / model.n
    return float(np.abs(sums[:-1] - np.outer(sums[-1], sums[-1]) - np.eye(len(real))).max())


def fit_model(rows: DataFrame, width: int, most: int) -> Model:
    """The model of the distinct vectors of ``rows`` (x array<long>), all of one length, not empty."""
    fit = texts.stored(rows.select("x").distinct(), "whitening-fit")
    # Sums as decimals: longs could overflow, and the sum must be exact.
    totals = fit.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("x", F.lit(j)).cast("decimal(20,0)")).alias(f"s{j}") for j in range(width)])
    n, *sums = totals.first()
    sums = [int(s) for s in sums]
    model = Model(n, sums, triangle(fit, width, n, sums), most)
    model.error = identity_error(fit, width, model)
    return model


def _squares(exact: np.ndarray) -> list[int | None]:
    if exact.dtype != object and float(np.abs(exact).max(initial=0)) ** 2 * exact.shape[1] < 1 << 62:
        return (exact * exact).sum(axis=1).tolist()
    totals = [sum(v * v for v in row) for row in exact.astype(object).tolist()]
    return [t if t < 1 << 63 else None for t in totals]


def whiten(rows: DataFrame, key: str, most: int = 4) -> DataFrame:
    """``key`` and ``FIELDS`` for each row of (key, x array<long>) and each of its first ``most`` components."""
    spark = rows.sparkSession
    out_schema = texts.with_key(rows, key, FIELDS)
    widths = [r["width"] for r in rows.select(F.size("x").alias("width")).distinct().collect()]
    parts = []
    for width in sorted(widths):
        same = rows.where(F.size("x") == width).select(F.col(key).alias("key"), "x")
        parts.append(texts.mapped(same, _whitener(fit_model(same, width, most), width), out_schema))
    if not parts:
        return spark.createDataFrame([], out_schema).withColumnRenamed("key", key)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.withColumnRenamed("key", key)


def _whitener(model: Model, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = len(model.eigenvalues)
        step = max(1, SLICE_CELLS // width)
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                some = batch.slice(i, step)
                x = moments.points(some.column(1), width)
                white = model.whiten(x).ravel()
                rows = len(x)
                each = np.repeat(np.arange(rows), count)
                squares = pa.array(_squares(deviations(x, model.n, model.sums)), pa.int64())
                columns = [
                    some.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(len(each), model.n)),
                    squares.take(pa.array(each)),
                    pa.array(white, mask=np.isnan(white)),
                    pa.array(model.explained * rows, pa.float64()),
                    pa.array([model.error] * len(each), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", *(f.split()[0] for f in FIELDS.split(", "))])

    return run


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every vector."""
    vectors = texts.table(spark, sf_dir, "embeddings").where(usable(F.col("embedding")))
    whole = F.transform("embedding", lambda c: F.floor(256 * c.cast("double")))
    return whiten(vectors.select("vec_id", whole.alias("x")), "vec_id")
