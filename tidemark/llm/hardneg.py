"""Hard negatives by threshold joins over an inverted index with suffix-norm bounds.

Two joins follow each other for a block of anchors: the best rows of the same label (positives), then rows of other
labels whose score lies in the window that each positive sets. Both find all rows whose inner product with an anchor
reaches its threshold.

In a block of rows, each row enters the inverted index with its first dimensions only: from the first dimension on at
which the norm of what is left of it, times the greatest norm an anchor has left there, is under the least threshold, its
dimensions are not indexed. Posting lists are read some dimensions at a time and add to the partial scores of anchors and
rows; whenever a partial score plus the product of both remaining norms is under the threshold of the anchor, the pair is
dropped. Pairs that are left are scored exactly.

A threshold starts high and is lowered, pass by pass, until the windows of the anchor are filled or the threshold has
reached the end of its windows. The first threshold of a positive search is the best score among the rows of its label in
a part of the anchor block, the next the last one wanted of those, the final one none at all. Within a task, what it has found
already raises thresholds: a row under the last place of all windows cannot enter.

Defined cases: rows whose id, label or vector is null, or whose vector is empty or holds a null or non-finite component,
take no part; vectors of different lengths are not compared; an id that comes more than once is one anchor, with the
least (label, vector), is no partner of its own, and all its rows are partners of others; ties go to the smaller id. Scores
are exact for components of every size; one beyond 64 bits counts by its true value and is returned as the nearest long.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as SqlWindow

from tidemark.llm import text as texts
from tidemark.llm import vectors

BLOCK_ROWS = 4096
ANCHOR_BLOCK = 256
SEGMENT = 8  # dimensions of posting lists that are read together
SPARSE = 1 / 8  # share of pairs under which they are scored one by one
STARTS = (0.8, 0.5, 0.0)  # thresholds of a window, from its lower end to its upper one
LOW, HIGH = 50, 95  # per cent of the positive's score that a negative must have
START_ROWS = 2048  # of an anchor block, from which its first thresholds come
SCHEMA = "anchor long, place int, final boolean, vec_id long, score long, wide string"
RESULT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def suffix_norms(m: np.ndarray) -> np.ndarray:
    """Rows x (dimensions + 1): the norm of what is left of a row from each dimension on."""
    squares = np.cumsum((m**2)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.hstack([squares, np.zeros((len(m), 1))]))


class Index:
    """The indexed part of a block of rows, for anchors whose least threshold is known."""

    def __init__(self, rows: np.ndarray, norms: np.ndarray, anchor_norms: np.ndarray, least: float):
        """``norms``: suffix norms of the rows; ``anchor_norms``: the greatest suffix norm of an anchor by dimension."""
        width = rows.shape[1]
        self.norms = norms
        covered = norms * anchor_norms < least  # from here on nothing needs to be indexed
        self.ends = np.where(covered.any(axis=1), covered.argmax(axis=1), width)
        self.rows = np.where(np.arange(width) < self.ends[:, None], rows, 0)
        self.postings = [(low, min(low + SEGMENT, width), np.flatnonzero(self.ends > low)) for low in range(0, width, SEGMENT)]


def join_block(
    rows: np.ndarray, norms: np.ndarray, anchors: np.ndarray, anchor_norms: np.ndarray, thresholds: np.ndarray, allowed: np.ndarray | None, spare: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (anchor, row) that may reach their thresholds, none that does left out; ``allowed``: anchors x rows."""
    width = rows.shape[1]
    alive = np.ones((len(anchors), len(rows)), bool) if allowed is None else allowed.copy()
    least = float(thresholds.min()) - spare
    index = Index(rows, norms, anchor_norms.max(axis=0), least)
    scores = np.zeros(alive.shape)
    need = (thresholds - spare)[:, None]
    for low, high, some in index.postings:
        if not len(some):
            break
        whole = len(some) == len(rows)
        at = slice(None) if whole else some
        scores[:, at] += anchors[:, low:high] @ index.rows[at, low:high].T
        # What is left of a row that has left the index begins at its end, that of the others here.
        left = norms[np.arange(len(rows)), np.minimum(index.ends, high)]
        rest = anchor_norms[:, high][:, None] * left
        if (index.ends < high).any():
            early = np.flatnonzero(index.ends < high)
            rest[:, early] = anchor_norms[:, index.ends[early]] * left[early]
        alive &= scores + rest >= need
        if alive.sum() <= SPARSE * alive.size:
            break
        if high == width:
            break
    return np.nonzero(alive)


@dataclass
class Window:
    """What one search of an anchor looks for: scores from ``end``, the threshold of this pass, to ``high``; None: no bound.

    ``final`` says that no lower threshold would find more.
    """

    place: int
    end: int | None
    high: int | None
    final: bool
    best: list[tuple[int, int]] = field(default_factory=list)  # (-score, id) so far, the best first

    def threshold(self, most: int) -> float:
        end = float("-inf") if self.end is None else self.end
        return max(end, -self.best[-1][0]) if len(self.best) == most else end

    def add(self, found: list[tuple[int, int]], most: int) -> None:
        new = [f for f in found if (self.end is None or -f[0] >= self.end) and (self.high is None or -f[0] <= self.high)]
        if new:
            self.best = sorted(self.best + new)[:most]


Searches = dict[int, list[Window]]  # by anchor


def _joiner(shared, same_label: bool, most: int) -> Callable:
    """A function over batches of (vec_id, label, vector): the best partners of each anchor in each of its windows."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = {}
        work, searches = shared.value
        for block in vectors.received(work):
            windows = [[Window(*w) for w in searches.get(own, [])] for own in block.ids.tolist()]
            groups[block.vectors.shape[1]] = (block, windows, suffix_norms(block.vectors.astype(float)))
        for batch in batches:
            ids, labels = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for width, places in vectors.by_width(batch.column(2)):
                if width not in groups:
                    continue
                block, windows, norms = groups[width]
                for i in range(0, len(places), BLOCK_ROWS):
                    some = places[i : i + BLOCK_ROWS]
                    rows = vectors.matrix(batch.column(2).take(pa.array(some)), width)
                    _visit(rows, ids[some], labels[some], block, norms, windows, same_label, most)
        for block, windows, _ in groups.values():
            every = ((own, w) for own, some in zip(block.ids.tolist(), windows) for w in some)
            found = [(own, w.place, w.final, i, -s) for own, w in every for s, i in w.best]
            if found:
                own, place, final, ids, scores = zip(*found)
                columns = [pa.array(own, pa.int64()), pa.array(place, pa.int32()), pa.array(final), pa.array(ids, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *vectors.score_columns(list(scores))], ["anchor", "place", "final", "vec_id", "score", "wide"])

    return join


def _visit(rows, ids, labels, block: vectors.Block, norms: np.ndarray, windows: list[list[Window]], same_label: bool, most: int) -> None:
    real, row_norms = rows.astype(float), suffix_norms(rows.astype(float))
    # The least score of use to an anchor; infinite if it looks for nothing.
    thresholds = np.array([min((w.threshold(most) for w in some), default=float("inf")) for some in windows], float)
    limits = [max((float("inf") if w.high is None else w.high for w in some), default=0) for some in windows]
    limits = np.array(limits, object)
    own_labels = block.more["label"]
    for low in range(0, len(block.ids), ANCHOR_BLOCK):
        chunk = low + np.flatnonzero(thresholds[low : low + ANCHOR_BLOCK] < np.inf)
        if same_label:  # only rows of the label of an anchor are looked at
            cells = [(chunk[own_labels[chunk] == label], np.flatnonzero(labels == label)) for label in np.intersect1d(own_labels[chunk], labels)]
        else:
            cells = [(chunk, np.arange(len(rows)))]
        for a, x in cells:
            if not len(a) or not len(x):
                continue
            plain = vectors.is_plain(block.vectors[a], rows[x])
            spare = vectors.slack(block.vectors[a], rows[x], plain)
            allowed = ids[x][None, :] != block.ids[a][:, None]
            if not same_label:
                allowed &= labels[x][None, :] != own_labels[a][:, None]
            q, r = join_block(real[x], row_norms[x], block.vectors[a].astype(float), norms[a], thresholds[a], allowed, spare)
            scores = vectors.pair_scores(block.vectors, a[q], rows, x[r], plain)
            q, r, scores = _useful(q, r, scores, ids[x], thresholds[a], limits[a], most)
            ends = np.searchsorted(q, np.arange(len(a) + 1))
            negated, names = (-scores).tolist(), ids[x[r]].tolist()
            for at in np.flatnonzero(np.diff(ends)):
                span = slice(ends[at], ends[at + 1])
                for w in windows[int(a[at])]:
                    w.add(list(zip(negated[span], names[span])), most)


def _useful(q: np.ndarray, r: np.ndarray, scores: np.ndarray, ids: np.ndarray, thresholds: np.ndarray, limits: np.ndarray, most: int) -> tuple:
    """The pairs between threshold and limit of their anchor; of equal scores, as copies have, the ``most`` least ids."""
    good = (scores >= thresholds[q]) & (scores <= limits[q]).astype(bool)
    q, r, scores = q[good], r[good], scores[good]
    rank = np.unique(scores, return_inverse=True)[1]
    order = np.lexsort((ids[r], rank, q))
    q, r, scores, rank = q[order], r[order], scores[order], rank[order]
    at = np.arange(len(q))
    first = np.append(True, (q[1:] != q[:-1]) | (rank[1:] != rank[:-1])) if len(q) else np.zeros(0, bool)
    kept = at - np.maximum.accumulate(np.where(first, at, 0)) < most if len(q) else first
    return q[kept], r[kept], scores[kept]


def _pass(spark: SparkSession, rows: DataFrame, work: list[vectors.Block], searches: Searches, same_label: bool, most: int) -> tuple[DataFrame, Searches]:
    """One pass over all rows: (anchor, place, rank, vec_id, score, wide) of the windows it settles, and the searches that are left."""
    plain = {own: [(w.place, w.end, w.high, w.final) for w in some] for own, some in searches.items()}
    shared = spark.sparkContext.broadcast((vectors.sent(work), plain))
    found = texts.mapped(rows, _joiner(shared, same_label, most), SCHEMA)
    window = SqlWindow.partitionBy("anchor", "place")
    ranked = found.withColumn("rank", F.row_number().over(window.orderBy(*vectors.best_first("score", "wide", "vec_id"))))
    ranked = ranked.filter(F.col("rank") <= most).withColumn("full", F.count(F.lit(1)).over(window) == most)
    settled = texts.stored(ranked.filter("full or final").drop("final", "full"), "hard-negatives-pass")
    shared.destroy()
    full = {(r["anchor"], r["place"]) for r in settled.filter(F.col("rank") == most).select("anchor", "place").toLocalIterator()}
    left = {own: [w for w in some if not w.final and (own, w.place) not in full] for own, some in searches.items()}
    return settled, {own: some for own, some in left.items() if some}


def _starts(block: vectors.Block, most: int) -> dict[int, list[int | None]]:
    """Thresholds of the positive search of each anchor: the best score of its label in a part of the block, the last wanted, none."""
    out = {}
    real, labels = block.vectors.astype(float), block.more["label"]
    part = slice(0, START_ROWS)
    plain = vectors.is_plain(block.vectors, block.vectors)
    for low in range(0, len(block.ids), ANCHOR_BLOCK):
        ids = block.ids[low : low + ANCHOR_BLOCK]
        scores = real[low : low + ANCHOR_BLOCK] @ real[part].T
        other = (labels[low : low + ANCHOR_BLOCK][:, None] == labels[part][None, :]) & (ids[:, None] != block.ids[part][None, :])
        for own, s, good in zip(ids.tolist(), scores, other):
            mine = np.sort(s[good])[::-1]
            out[own] = [int(mine[0]), int(mine[most - 1]), None] if plain and len(mine) >= most else [None]
    return out


def positives(spark: SparkSession, rows: DataFrame, work: list[vectors.Block], most: int) -> DataFrame:
    """The best ``most`` other rows of the same label for each anchor of a block, as ``_pass`` gives them."""
    starts = {own: steps for block in work for own, steps in _starts(block, most).items()}
    left: Searches = {own: [] for own in starts}
    parts = []
    while left:
        ends = {own: starts[own].pop(0) for own in left}
        part, left = _pass(spark, rows, work, {own: [Window(0, end, None, end is None)] for own, end in ends.items()}, True, most)
        parts.append(part)
    return reduce(DataFrame.unionByName, parts)


def window_of(positive: int) -> tuple[int, int]:
    """The least and the greatest score a negative may have: 50 p <= 100 s <= 95 p."""
    return -(-LOW * positive // 100), HIGH * positive // 100


def negatives(spark: SparkSession, rows: DataFrame, work: list[vectors.Block], wanted: dict[int, list[int]], most: int) -> DataFrame | None:
    """The best ``most`` rows of other labels in the window of each positive, whose scores are ``wanted``; ``place``: which of them."""
    spans = {(own, place): window_of(score) for own, some in wanted.items() for place, score in enumerate(some)}
    left: Searches = {}
    for (own, place), (low, high) in spans.items():
        if low <= high:
            left.setdefault(own, []).append(Window(place, low, high, False))
    parts = []
    for share in STARTS:
        if not left:
            break
        searches: Searches = {}
        for own, some in left.items():
            for w in some:
                low, high = spans[own, w.place]
                end = low + int((high - low) * share)
                searches.setdefault(own, []).append(Window(w.place, end, high, end == low))
        part, left = _pass(spark, rows, work, searches, False, most)
        parts.append(part)
    return reduce(DataFrame.unionByName, parts) if parts else None


def mine(spark: SparkSession, anchors: DataFrame, rows: DataFrame, n_positives: int = 5, n_negatives: int = 3) -> DataFrame:
    """``RESULT`` from (vec_id long, label long, vector of whole numbers) of anchors and of all rows.

    Blocks of anchors follow one another, each against all rows; a block's result is written before the next starts.
    The driver holds the anchors of a block with the scores of their positives, which set the windows.
    """
    rows = rows.select("vec_id", "label", "vector")
    one = anchors.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("least")).select("vec_id", "least.*")
    parts = []
    for work in vectors.blocks(one, ("label",)):
        near = positives(spark, rows, work, n_positives)
        wanted: dict[int, dict[int, int]] = {}
        for r in near.select("anchor", "rank", "score", "wide").toLocalIterator():
            wanted.setdefault(r["anchor"], {})[r["rank"]] = vectors.exact_score(r["score"], r["wide"])
        scores = {own: [some[rank] for rank in sorted(some)] for own, some in wanted.items()}
        found = negatives(spark, rows, work, scores, n_negatives)
        if found is not None:
            positive = near.select("anchor", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
            both = found.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(positive, ["anchor", "place"])
            parts.append(texts.stored(both.withColumnRenamed("anchor", "anchor_id").select(*RESULT), "hard-negatives"))
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.unionByName, parts) if parts else empty


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every fiftieth vector."""
    table = texts.table(spark, sf_dir, "embeddings")
    known = table.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vectors.usable(F.col("embedding")))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = known.select("vec_id", label.alias("label"), vectors.whole(F.col("embedding")).alias("vector"))
    return mine(spark, rows.where(F.col("vec_id") % 50 == 0), rows)


OP11_SQL = """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else cast(label as bigint) end as label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where len(embedding) > 0 and vec_id is not null and label is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
         cast(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) as bigint) as score
  from vectors a join vectors b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)),
positive as (
  select anchor_id, vec_id as positive_id, score as positive_score,
         row_number() over (partition by anchor_id order by score desc, vec_id) as place
  from scored where same qualify place <= 5),
negative as (
  select p.anchor_id, positive_id, positive_score, vec_id as negative_id, score as negative_score,
         cast(row_number() over (partition by p.anchor_id, place order by score desc, vec_id) as integer) as rank
  from positive p join scored s on p.anchor_id = s.anchor_id and not same
    and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negative where rank <= 3"""
