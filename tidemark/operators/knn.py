"""Exact k nearest neighbors between two tables, by filter and refine.

Some training rows, as many as the square root of all beyond ``MAX_PIVOTS``, serve as pivots. Each training row belongs
to the cell of its nearest pivot, and each cell knows its radius. Cells are gathered into groups of bounded bytes, next to each
other along the longest axis of the pivots; a cell too large for a group is cut over several. Test rows are sent to a group
in chunks, once however many of its cells they visit, and each (group, chunk) pair is one task.

A test row first looks into the group of its own cell. The k-th distance found there, or the k-th smallest distance to a
pivot, bounds its neighborhood, so by the triangle inequality only cells that reach into that ball are looked into
afterwards. Within a task cells are visited nearest first, and what is found lowers the bound for those that follow. A
visit filters by a matrix product, which gives squared distances up to rounding, and refines what may be near enough by
distances whose terms are added feature by feature. A task returns at most k rows per test row.

Ties: equal distances go to the smaller training id, equal votes to the smaller label.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.moments import points as matrix_of
from tidemark.shared import materialize

BLOCK_ROWS = 4096
MAX_PIVOTS = 2048
GROUP_BYTES, CHUNK_BYTES = 32 << 20, 8 << 20  # of training rows in a task, of test rows
SLICE_CELLS = 1 << 21


def squared_distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All squared Euclidean distances, the terms added feature by feature."""
    total = np.zeros((len(left), len(right)))
    for j in range(left.shape[1]):
        total += (left[:, j, None] - right[None, :, j]) ** 2
    return total


def pair_distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The same for the rows of two matrices pair by pair."""
    total = np.zeros(len(left))
    for j in range(left.shape[1]):
        total += (left[:, j] - right[:, j]) ** 2
    return total


class Cells:
    """Pivots with the radius of their cells, and the groups their rows lie in."""

    def __init__(self, pivots: np.ndarray, sizes: dict[int, tuple[int, float]], group_rows: int):
        """``sizes``: rows and radius of each cell that has rows."""
        self.pivots = pivots
        self.radius = np.full(len(pivots), -np.inf)
        self.first, self.parts = np.zeros(len(pivots), np.int32), np.ones(len(pivots), np.int32)
        for cell, (_, radius) in sizes.items():
            self.radius[cell] = radius
        centred = pivots - pivots.mean(axis=0)
        axis = np.linalg.svd(centred, full_matrices=False)[2][0]
        group = held = 0
        for cell in np.argsort(centred @ axis, kind="stable").tolist():
            rows = sizes.get(cell, (0, 0.0))[0]
            if held and held + rows > group_rows:
                group, held = group + 1, 0
            self.first[cell], self.parts[cell] = group, max(1, math.ceil(rows / group_rows))
            if self.parts[cell] > 1:
                group, held = group + int(self.parts[cell]), 0
            else:
                held += rows

    def in_groups(self, cells: np.ndarray) -> list[dict]:
        """The groups that hold rows of some cells, with these cells."""
        found: dict[int, list[int]] = {}
        for cell in cells.tolist():
            for group in range(self.first[cell], self.first[cell] + self.parts[cell]):
                found.setdefault(group, []).append(cell)
        return [{"group": g, "cells": c} for g, c in found.items()]


def neighbors(
    test: DataFrame,
    train: DataFrame,
    features: Sequence[str],
    k: int = 3,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int | None = None,
    max_pivots: int = MAX_PIVOTS,
    group_rows: int | None = None,
) -> DataFrame:
    """The k nearest training rows of each test row: ``id, train_id, train_label, d2, rank``.

    Both tables have ``id`` and the feature columns; ``train`` also has ``label``. A row with a NULL or NaN
    feature is at no distance: it is no neighbor and has none. ``block_rows`` are wanted in a cell; what a task holds
    of either table is bounded by ``GROUP_BYTES`` and ``CHUNK_BYTES`` unless rows are given.
    """
    width = len(features)
    group_rows = group_rows or max(1, GROUP_BYTES // (8 * width))
    chunk_rows = chunk_rows or max(1, CHUNK_BYTES // (8 * width))
    # One array column from here on; the rows are written first, so that no plan drags all columns along.
    point = F.array(*[F.col(c).cast("double") for c in features]).alias("point")
    whole = F.forall("point", lambda v: v.isNotNull() & ~F.isnan(v))
    test = materialize(test.select("id", point), "knn-test").where(whole)
    train = materialize(train.select("id", "label", point), "knn-points").where(whole)
    # Of identical training rows only the k smallest ids can ever be neighbors.
    copies = Window.partitionBy("point").orderBy("id")
    train = train.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k).drop("copy")
    train = materialize(train, "knn-train")
    rows = train.count()
    most = max(max_pivots, math.isqrt(rows))
    wanted = min(most, max(1, math.ceil(rows / block_rows)))
    # From a part of about four times as many, so that no task sorts more than that.
    part = train.where(F.pmod(F.xxhash64("id"), F.lit(max(1, rows // (4 * wanted)))) == 0) if wanted else train
    part = train if part.isEmpty() else part
    chosen = part.orderBy(F.xxhash64("id"), "id").select("point").limit(wanted).collect()
    if not chosen:  # no training rows, no neighbors
        none = train.select(F.lit(None).cast(test.schema["id"].dataType).alias("id"), F.col("id").alias("train_id"), F.col("label").alias("train_label"))
        return none.withColumn("d2", F.lit(0.0)).withColumn("rank", F.lit(1))
    pivots = np.array([row["point"] for row in chosen], dtype=float).reshape(-1, width)

    home = _home_cell(pivots)("point")
    placed = materialize(train.select("id", "label", "point", home.alias("home")).select("id", "label", "point", "home.*"), "knn-cells")
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max("distance").alias("radius"))
    cells = Cells(pivots, {r["cell"]: (r["rows"], r["radius"]) for r in sizes.collect()}, group_rows)  # one row per pivot
    first, parts = (F.get(F.array(*map(F.lit, side.tolist())), F.col("cell")) for side in (cells.first, cells.parts))
    placed = placed.drop("distance").withColumn("group", (first + F.pmod(F.xxhash64("id"), parts)).cast("int"))

    at_home = materialize(test.withColumn("home", home["cell"]), "knn-home")
    own = at_home.withColumn("bound", F.lit(None).cast("double")).withColumn("visit", F.explode(_own_groups(cells)("home")))
    near = materialize(_look(own.select("id", "point", "bound", "visit.*"), placed, cells, k, chunk_rows), "knn-near")
    if int((cells.first + cells.parts).max()) == 1:
        return _ranked(near, k)
    bound = near.groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.max("d2")).alias("bound"))
    others = at_home.join(bound, "id", "left").withColumn("visit", F.explode(_groups_in_reach(cells, k)("point", "bound", "home")))
    visits = materialize(others.select("id", "point", "bound", "visit.*"), "knn-visits")
    return _ranked(near.unionByName(materialize(_look(visits, placed, cells, k, chunk_rows), "knn-near")), k)


def _ranked(near: DataFrame, k: int) -> DataFrame:
    by_distance = Window.partitionBy("id").orderBy("d2", "train_id")
    return near.withColumn("rank", F.row_number().over(by_distance)).where(F.col("rank") <= k)


def _look(visits: DataFrame, placed: DataFrame, cells: Cells, k: int, chunk_rows: int) -> DataFrame:
    """The k nearest rows of each (group, chunk) pair, in the cells that each row of the chunk visits."""
    visitors = visits.groupBy("group").agg(F.count(F.lit(1)).alias("visitors"))
    parts = materialize(visitors.select("group", F.ceil(F.col("visitors") / chunk_rows).cast("int").alias("chunks")), "knn-parts")
    test_side = visits.join(parts, "group").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    train_side = placed.join(parts, "group").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema}
    schema = f"id {visits.schema['id'].dataType.simpleString()}, train_id {kinds['id']}, train_label {kinds['label']}, d2 double"
    left, right = (df.drop("chunks").groupBy("group", "chunk") for df in (test_side, train_side))
    return left.cogroup(right).applyInArrow(_nearest_in_group(cells, k), schema)


def vote(found: DataFrame) -> DataFrame:
    """The most frequent label among each test row's neighbors; the smallest label on a tie."""
    return found.groupBy("id").agg(F.mode("train_label", True).alias("pred"))


def _in_slices(points: pd.Series, pivots: int):
    """Where a batch's rows begin and end in slices small enough to hold their distances to every pivot."""
    step = max(1, SLICE_CELLS // max(1, pivots))
    for start in range(0, len(points), step):
        yield start, np.stack(points.iloc[start : start + step])


def _home_cell(pivots: np.ndarray):
    @F.pandas_udf("cell int, distance double")
    def home(column: pd.Series) -> pd.DataFrame:
        found = [pd.DataFrame({"cell": [], "distance": []})]
        for _, points in _in_slices(column, len(pivots)):
            d2 = squared_distances(points, pivots)
            found.append(pd.DataFrame({"cell": d2.argmin(axis=1), "distance": np.sqrt(d2.min(axis=1))}))
        return pd.concat(found, ignore_index=True)

    return home


VISITS = "array<struct<group:int,cells:array<int>>>"


def _own_groups(cells: Cells):
    """The group of a row's own cell, with all the cells of that group: they lie next to it."""

    @F.pandas_udf(VISITS)
    def own(homes: pd.Series) -> pd.Series:
        return pd.Series([cells.in_groups(np.flatnonzero((cells.first == cells.first[h]) & (cells.radius >= 0))) for h in homes])

    return own


def _groups_in_reach(cells: Cells, k: int):
    @F.pandas_udf(VISITS)
    def in_reach(column: pd.Series, known: pd.Series, homes: pd.Series) -> pd.Series:
        found = []
        for start, points in _in_slices(column, len(cells.pivots)):
            distance = np.sqrt(squared_distances(points, cells.pivots))
            bound = known.iloc[start : start + len(points)].to_numpy(dtype=float)
            bound = np.where(np.isnan(bound), np.inf, np.sqrt(bound))
            if len(cells.pivots) >= k:
                bound = np.minimum(bound, np.partition(distance, k - 1, axis=1)[:, k - 1])
            slack = 1e-9 * (1.0 + distance)
            home = homes.iloc[start : start + len(points)].to_numpy()
            touched = (distance - cells.radius <= bound[:, None] + slack) & (cells.radius >= 0)
            touched &= cells.first[None, :] != cells.first[home][:, None]  # these have been visited
            found.extend(cells.in_groups(np.flatnonzero(row)) for row in touched)
        return pd.Series(found)

    return in_reach


class Nearest:
    """The k nearest rows of each test row so far."""

    def __init__(self, k: int, bound: np.ndarray):
        self.k = k
        self.bound = bound  # of squared distances
        self.row, self.d2, self.at = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def add(self, row: np.ndarray, d2: np.ndarray, at: np.ndarray, ids: np.ndarray) -> None:
        row, d2, at = (np.concatenate(pair) for pair in ((self.row, row), (self.d2, d2), (self.at, at)))
        order = np.lexsort((ids[at], d2, row))
        row, d2, at = row[order], d2[order], at[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        last = place == self.k - 1
        self.bound[row[last]] = np.minimum(self.bound[row[last]], d2[last])
        kept = place < self.k
        self.row, self.d2, self.at = row[kept], d2[kept], at[kept]


def visit(tests: np.ndarray, some: np.ndarray, rows: np.ndarray, norms: tuple[np.ndarray, np.ndarray], places: np.ndarray, nearest: Nearest, ids: np.ndarray) -> None:
    """Some test rows look at the training rows of one cell: a product filters, exact distances decide."""
    width = tests.shape[1]
    step = max(1, SLICE_CELLS // max(1, len(some)))
    for low in range(0, len(places), step):
        block = places[low : low + step]
        scale = norms[0][some][:, None] + norms[1][block][None, :]
        near = scale - 2 * (tests[some] @ rows[block].T)
        spare = 4 * (width + 4) * np.finfo(float).eps * scale
        bound = nearest.bound[some]
        if len(block) > nearest.k:  # the k-th of this block bounds as well, rounding added
            bound = np.minimum(bound, np.partition(near + spare, nearest.k - 1, axis=1)[:, nearest.k - 1])
        r, c = np.nonzero(near - spare <= bound[:, None])
        r, c = some[r], block[c]
        nearest.add(r, pair_distances(tests[r], rows[c]), c, ids)


def _nearest_in_group(cells: Cells, k: int):
    names = ["id", "train_id", "train_label", "d2"]

    def nearest(test: pa.Table, train: pa.Table) -> pa.Table:
        kinds = [test.schema.field("id").type, train.schema.field("id").type, train.schema.field("label").type, pa.float64()]
        if not test.num_rows or not train.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        lists = [t.column("point").combine_chunks() for t in (test, train)]
        width = len(lists[0][0])
        tests, rows = (matrix_of(column, width) for column in lists)
        norms = ((tests**2).sum(axis=1), (rows**2).sum(axis=1))
        ids, cell_of = train.column("id").to_numpy(), train.column("cell").to_numpy()
        bound = test.column("bound").to_numpy()
        found = Nearest(k, np.where(np.isnan(bound), np.inf, bound.astype(float)))
        wanted = test.column("cells").combine_chunks()
        who, which = np.asarray(pc.list_parent_indices(wanted)), np.asarray(wanted.flatten())
        by_cell = {c: who[which == c] for c in np.unique(which)}
        distance = {c: np.sqrt(((tests[some] - cells.pivots[c]) ** 2).sum(axis=1)) for c, some in by_cell.items()}
        for c in sorted(by_cell, key=lambda c: distance[c].mean()):
            some = by_cell[c]
            some = some[distance[c] - cells.radius[c] <= np.sqrt(found.bound[some]) + 1e-9 * (1 + distance[c])]
            places = np.flatnonzero(cell_of == c)
            if len(some) and len(places):
                visit(tests, some, rows, norms, places, found, ids)
        columns = [test.column("id").take(pa.array(found.row)), train.column("id").take(pa.array(found.at)), train.column("label").take(pa.array(found.at))]
        return pa.table([*columns, pa.array(found.d2)], names=names)

    return nearest
