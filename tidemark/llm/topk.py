"""Exact top-k inner products by no-random-access aggregation.

Each block of candidates has one sorted list for each component. A query reads those of its positive components from the
top and those of its negative ones from the bottom, all to the same depth, a step at a time. What was read of a candidate
is its part score; what was not is at most the last value read of that list, which gives an upper bound. The candidates
of greatest upper bound so far are resolved, and the k-th greatest of all resolved scores, those of earlier blocks of the
task among them, is the lower bound of the k-th score. Reading stops once the candidates whose upper bound reaches it are
few (a ``FEW``-th of the block); all others cannot qualify, and the scores of these few are resolved. Lists are read for
a block of queries at once: a step is a product of what it reads with the queries.

The queries are a stated set: they go to the executors in blocks of at most ``vectors.QUERY_BYTES``, one after the other,
each against all rows; the results of a block are written before the next one starts. Every task returns at most k rows
for a query.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part, nor do null ids; two
vectors of different lengths are not compared; an id that comes more than once is one query, with the least of its
vectors, is no candidate of its own, and all its rows are candidates of others; ties go to the smaller id. Scores are
exact for components of every size; one beyond 64 bits ranks by its true value and is returned as the nearest long.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import text as texts
from tidemark.llm import vectors
from tidemark.llm.vectors import usable

BLOCK_ROWS = 4096
QUERY_BLOCK = 256
STEPS = 8  # of a list; each reads an eighth of it
FEW = 16
SCHEMA = "query_id long, vec_id long, score long, wide string"


class Lists:
    """The sorted lists of one block, downwards and upwards beside each other."""

    def __init__(self, block: np.ndarray):
        n, width = block.shape
        down = np.argsort(-block, axis=0, kind="stable")
        rank = np.empty_like(down)
        rank[down, np.arange(width)] = np.arange(n)[:, None]
        self.values = np.hstack([block, block])
        self.rank = np.hstack([rank, n - 1 - rank])
        ordered = np.take_along_axis(block, down, axis=0)
        self.read = np.hstack([ordered, ordered[::-1]])  # in reading order

    def part(self, low: int, high: int, signed: np.ndarray) -> np.ndarray:
        """What the entries from ``low`` to ``high`` of all lists add to the scores, candidates x queries."""
        return np.where((self.rank >= low) & (self.rank < high), self.values, 0) @ signed.T

    def rest(self, depth: int, signed: np.ndarray) -> np.ndarray:
        """The most that the entries from ``depth`` on can add."""
        return (self.rank >= depth).astype(float) @ (signed * self.read[depth - 1]).T


class Best:
    """The k best resolved scores of each query, and the lower bounds they give."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(queries)]
        self.floor = np.full(queries, -np.inf)

    def add(self, q: int, scores: list[int], ids: list[int]) -> None:
        heap = self.heaps[q]
        heap.extend(zip((-s for s in scores), ids))
        heap.sort()
        del heap[self.k :]
        if len(heap) == self.k:
            self.floor[q] = -heap[-1][0]


def search_block(block: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, best: Best, base: int = 0) -> np.ndarray:
    """Add the best candidates of a block to ``best``, whose entries from ``base`` on are those of ``queries``.

    Returns the depth, as a share of the lists, at which each query stopped reading.
    """
    plain = vectors.is_plain(queries, block)
    spare = vectors.slack(queries, block, plain)
    lists = Lists(block.astype(float))
    real = queries.astype(float)
    signed = np.hstack([np.maximum(real, 0), np.minimum(real, 0)])
    active = np.arange(len(queries))
    resolved = np.zeros((len(block), len(queries)), bool)
    resolved |= ids[:, None] == own[None, :]  # never resolved, never a candidate
    part = np.zeros((len(block), len(queries)))
    depths = np.ones(len(queries))

    def resolve(q: np.ndarray, x: np.ndarray) -> None:
        scores = vectors.pair_scores(queries, q, block, x, plain).tolist()
        names = ids[x].tolist()
        ends = np.searchsorted(q, np.unique(q), "right").tolist()
        low = 0
        for high in ends:
            best.add(base + int(q[low]), scores[low:high], names[low:high])
            low = high
        resolved[x, q] = True

    n = len(block)
    edges = sorted({max(1, n * s // STEPS) for s in range(1, STEPS + 1)})
    for low, depth in zip([0, *edges], edges):
        part[:, active] += lists.part(low, depth, signed[active])
        upper = part[:, active] + (lists.rest(depth, signed[active]) if depth < n else 0) + spare
        upper[resolved[:, active]] = -np.inf
        few = min(best.k, n)
        top = np.argpartition(-upper, few - 1, axis=0)[:few]
        q, x = np.repeat(active, few), top.T.ravel()
        real_one = ~resolved[x, q]
        resolve(q[real_one], x[real_one])
        upper[resolved[:, active]] = -np.inf
        may = upper >= best.floor[base + active]
        may &= ~resolved[:, active]
        done = (may.sum(axis=0) <= max(2 * best.k, n // FEW)) | (depth == n)
        c, x = np.nonzero(may[:, done].T)
        resolve(active[done][c], x)
        depths[active[done]] = depth / n
        active = active[~done]
        if not len(active):
            break
    return depths


def _searcher(shared, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = {b.vectors.shape[1]: (b, Best(len(b.ids), k)) for b in vectors.received(shared.value)}
        for batch in batches:
            ids_of = np.asarray(batch.column(0))
            for width, rows in vectors.by_width(batch.column(1)):
                if width not in groups:
                    continue
                queries, best = groups[width]
                for i in range(0, len(rows), BLOCK_ROWS):
                    some = rows[i : i + BLOCK_ROWS]
                    block = vectors.matrix(batch.column(1).take(pa.array(some)), width)
                    for q in range(0, len(queries.ids), QUERY_BLOCK):
                        part = slice(q, q + QUERY_BLOCK)
                        search_block(block, ids_of[some], queries.vectors[part], queries.ids[part], best, q)
        for queries, best in groups.values():
            rows = [(o, i, -s) for o, heap in zip(queries.ids.tolist(), best.heaps) for s, i in heap]
            if rows:
                own, ids, scores = zip(*rows)
                columns = [pa.array(own, pa.int64()), pa.array(ids, pa.int64()), *vectors.score_columns(list(scores))]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score", "wide"])

    return search


def top_k(spark: SparkSession, queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) from (vec_id long, vector of whole numbers) of queries and candidates."""
    rows = rows.select("vec_id", "vector")
    parts = []
    for block in vectors.blocks(queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))):
        shared = spark.sparkContext.broadcast(vectors.sent(block))
        found = texts.mapped(rows, _searcher(shared, k), SCHEMA)
        order = Window.partitionBy("query_id").orderBy(*vectors.best_first("score", "wide", "vec_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        parts.append(texts.stored(ranked.select("query_id", "rank", "vec_id", "score"), "top-k"))
        shared.destroy()
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.unionByName, parts)


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best partners of every fiftieth vector."""
    known = texts.table(spark, sf_dir, "embeddings").filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = known.select("vec_id", vectors.whole(F.col("embedding")).alias("vector"))
    return top_k(spark, rows.filter(F.col("vec_id") % 50 == 0), rows, 5)


OP8_SQL = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where len(embedding) > 0 and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
  from vectors q join vectors c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
         vec_id, score
  from scored)
select * from ranked where rank <= 5"""
