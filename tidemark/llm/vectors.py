"""Vectors of whole numbers: which take part, blocks of queries, exact inner products of any size.

Sums of products are exact in doubles while they stay below 2^53. Where they might not, bounds are widened by what
rounding can do, and the scores of what is left are added up in Python's integers. A score beyond 64 bits travels as
the nearest long beside its digits (``wide``), which order it among others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = 1 << 53
LONGEST = (1 << 63) - 1
OFFSET = 10**120
QUERY_BYTES = 16 << 20
PAIR_CELLS = 1 << 21  # components of pairs that are scored at once


def usable(vector: Column) -> Column:
    """Neither null nor empty, and no component null or non-finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)


def whole(vector: Column) -> Column:
    """floor(256 * x) for each component x as a double, which above 2^53 is whole as it is."""
    scaled = lambda x: 256 * x.cast("double")
    return F.transform(vector, lambda x: F.when(F.abs(scaled(x)) < EXACT, F.floor(scaled(x)).cast("double")).otherwise(scaled(x)))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of one length as the rows of a matrix, doubles or longs."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def by_width(lists: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Each length with the rows that have it."""
    sizes = np.asarray(lists.value_lengths())
    for width in np.unique(sizes):
        yield int(width), np.flatnonzero(sizes == width)


def is_plain(queries: np.ndarray, rows: np.ndarray) -> bool:
    """Whether all inner products are exact in doubles."""
    most = lambda m: float(np.abs(m.astype(float)).max(initial=0))
    return most(queries) * most(rows) * max(1, rows.shape[1]) < EXACT


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """The values as Python's integers."""
    return np.array([int(v) for v in values.ravel().tolist()], object).reshape(values.shape)


def pair_scores(queries: np.ndarray, q: np.ndarray, rows: np.ndarray, x: np.ndarray, plain: bool) -> np.ndarray:
    """The exact inner products of some pairs, however many: longs, or Python's integers."""
    out = np.zeros(len(q), np.int64 if plain else object)
    step = max(1, PAIR_CELLS // max(1, rows.shape[1]))
    for i in range(0, len(q), step):
        a, b = queries[q[i : i + step]], rows[x[i : i + step]]
        if plain:
            out[i : i + step] = np.einsum("ij,ij->i", a.astype(float), b.astype(float))
        else:
            out[i : i + step] = (whole_numbers(a) * whole_numbers(b)).sum(axis=1)
    return out


def slack(queries: np.ndarray, rows: np.ndarray, plain: bool) -> float:
    """What rounding may add to a bound of a score."""
    if plain:
        return 0.0
    norm = lambda m: float(np.sqrt((m.astype(float) ** 2).sum(axis=1)).max(initial=0))
    return 8 * rows.shape[1] * np.finfo(float).eps * norm(queries) * norm(rows)


def score_columns(scores: list[int]) -> tuple[pa.Array, pa.Array]:
    """The scores as longs, the nearest one where none fits, and the digits of those."""
    near = [min(max(s, -LONGEST), LONGEST) for s in scores]
    return pa.array(near, pa.int64()), pa.array([None if s == n else str(OFFSET + s) for s, n in zip(scores, near)], pa.string())


def exact_score(score: int, wide: str | None) -> int:
    return score if wide is None else int(wide) - OFFSET


def best_first(score: str, wide: str, *ties: str) -> list[Column]:
    """Greatest score first, also beyond 64 bits, then by ``ties``."""
    side = F.when(F.col(wide).isNull(), 0).when(F.col(score) > 0, 1).otherwise(-1)
    return [F.desc(side), F.desc(score), F.desc(wide), *map(F.col, ties)]


@dataclass
class Block:
    """Queries of one length: ids, vectors, and other columns by name."""

    ids: np.ndarray
    vectors: np.ndarray
    more: dict[str, np.ndarray]


def sent(work: list[Block]) -> list[tuple]:
    """Blocks as plain arrays: a broadcast must not name classes of this package, which workers need not have."""
    return [(b.ids, b.vectors, b.more) for b in work]


def received(work: list[tuple]) -> list[Block]:
    return [Block(*b) for b in work]


def blocks(queries: DataFrame, others: tuple[str, ...] = ()) -> Iterator[list[Block]]:
    """(vec_id, vector, others) in blocks of at most ``QUERY_BYTES``, or of one vector that is longer; no empty block.

    Rows come to the driver a block at a time, in the order of ids.
    """
    some: list = []
    size = 0
    for r in queries.orderBy("vec_id").toLocalIterator():
        more = 8 * len(r["vector"])
        if some and size + more > QUERY_BYTES:
            yield _blocked(some, others)
            some, size = [], 0
        some.append(r)
        size += more
    if some:
        yield _blocked(some, others)


def _blocked(rows: list, others: tuple[str, ...]) -> list[Block]:
    groups: dict[int, list] = {}
    for r in rows:
        groups.setdefault(len(r["vector"]), []).append(r)
    return [
        Block(
            np.array([r["vec_id"] for r in same], np.int64),
            np.array([r["vector"] for r in same]),
            {name: np.array([r[name] for r in same]) for name in others},
        )
        for same in groups.values()
    ]
