"""Near duplicates by Order MinHash, verified by banded alignment.

Texts are words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` in lower case. Two are near duplicates if the Jaccard similarity of
their sets of five-word shingles is 0.8 or more, and so is their edit similarity in words, 1 - distance / words of the
longer one: the same passages in another order are none. Candidates share a sketch of one of two kinds, ``SKETCHES`` of
each. An Order MinHash sketch hashes the ``PICKED`` least occurrence-labelled shingles of five words under its own order, in
the order of the text; texts that repeat much can miss all of these, as they compare multisets. A set sketch hashes the least
of the different shingles under each of ``PICKED`` orders of its own, whatever their number and place, so a pair whose sets
are at 0.8, the measure that decides, shares one with a probability of 1 - (1 - 0.8^3)^16, about 0.99999 (orders taken as
random). One pair in 100,000 that stands exactly at the limit may so be missed, fewer the more alike they are.

Copies (equal words) are one node with the class of all its rows. Nodes have an order by a hash. In each bucket of nodes
with one sketch the first node, the hub, meets all others that are not of its component yet, then the next hubs, about eight
times as many each round, those that are left, until every pair of the bucket is either in one component or was compared.
Hubs are those up to a hash that follows from the least one and the size of the bucket, which are sums and minima: no bucket
is ranked or gathered in one task. So a bucket of near copies of one text costs about one alignment for each, no candidate is
dropped, and the rounds are as many as the logarithm of the largest bucket. Where nodes meet, a bitmap of their shingles (each shingle flips one
bit, so bitmaps differ in no more bits than the sets do in shingles) leaves out pairs that are too different, before
their words are read.

Defined cases: null and empty texts, and all others without a word, are copies of each other; texts of fewer than five
words have no shingle and match copies only. Repeated rows get one class. The class id is the least key of the class,
null if all its keys are null. Nodes are told apart by a 64-bit hash of their words. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as texts
from tidemark.llm.components import components

SHINGLE = 5
PICKED = 3
SKETCHES = 16
SIMILARITY = 0.8
BITMAP_LONGS = 16
HUBS, MORE_HUBS = 1, 8  # of each bucket in the first round, and how many times as many in each later one
ALIGNED_CELLS = 1 << 20


def sketch(words: texts.Words, shingle: int = SHINGLE, picked: int = PICKED, sketches: int = SKETCHES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each document its sketches, the number of its different shingles, and their bitmap.

    A sketch hashes the ``picked`` least occurrence-labelled shingles in their text order. A document of fewer shingles
    takes those it has; one without any gets 0. After these come as many set sketches, each of the least of the different
    shingles under ``picked`` orders.
    """
    n = len(words.docs) - 1
    out, bitmap = np.zeros((n, 2 * sketches), np.uint64), np.zeros((n, BITMAP_LONGS), np.uint64)
    grams, whole = words.grams(shingle)
    place = np.flatnonzero(whole)
    if not len(place):
        return out, np.zeros(n, np.int64), bitmap
    grams, doc = grams[place], words.doc_of()[place]
    # The how-manieth such shingle of its document each one is.
    order = np.lexsort([grams, doc])
    same = np.zeros(len(order), bool)
    same[1:] = (grams[order][1:] == grams[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    at = np.arange(len(order))
    nth = np.empty(len(order), np.uint64)
    nth[order] = at - np.maximum.accumulate(np.where(same, 0, at))
    once = order[~same]
    bit = grams[once] & np.uint64(64 * BITMAP_LONGS - 1)
    np.bitwise_xor.at(bitmap, (doc[once], (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
    labelled = grams + nth * np.uint64(texts.WORD_BASE)
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    rows, size = doc[first], np.diff(np.append(first, len(doc)))
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    for k in range(sketches):
        order_of = (labelled ^ texts.mix(np.array([k + 1], np.uint64))) * np.uint64(texts.MIX_1)
        order_of ^= order_of >> np.uint64(32)
        order_of *= np.uint64(texts.MIX_2)
        places = np.full((picked, len(rows)), len(doc), np.int64)
        for p in range(picked):
            least = np.repeat(np.minimum.reduceat(order_of, first), size)
            hit = np.flatnonzero((order_of == least) & (least < top))
            hit = hit[np.append(True, doc[hit][1:] != doc[hit][:-1])] if len(hit) else hit
            places[p, np.searchsorted(rows, doc[hit])] = hit
            order_of[hit] = top
        places.sort(axis=0)
        value = np.zeros(len(rows), np.uint64)
        padded = np.append(grams, np.uint64(0))
        for p in range(picked):
            value = texts.mix(value * np.uint64(texts.WORD_BASE) + padded[places[p]])
        out[rows, k] = value
    sets = grams[once]
    start = np.flatnonzero(np.append(True, doc[once][1:] != doc[once][:-1]))
    for k in range(sketches):
        value = np.zeros(len(rows), np.uint64)
        for p in range(picked):
            # The hashes of shingles are spread already: times an odd number, another order.
            times = texts.mix(np.array([(k + 1) * 1000 + p], np.uint64)) | np.uint64(1)
            value = texts.mix(value * np.uint64(texts.WORD_BASE) + np.minimum.reduceat(sets * times, start))
        out[rows, sketches + k] = value
    return out, np.bincount(doc[once], minlength=n), bitmap


def allowed(longer: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """The greatest distance of texts that are similar enough."""
    return np.floor(longer * (1 - similarity) + 1e-9).astype(np.int64)


def banded_distances(a: list[np.ndarray], b: list[np.ndarray], band: int) -> np.ndarray:
    """Word edit distances of pairs over alignments that stray at most ``band`` from the diagonal, all at once."""
    width = 2 * band + 1
    size_a, size_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    left = np.zeros((len(a), size_a.max()), np.int64)
    right = np.full((len(a), max(size_b.max(), size_a.max()) + 2 * band + 1), -1, np.int64)  # -1 stands outside
    for r, (x, y) in enumerate(zip(a, b)):
        left[r, : len(x)] = x
        right[r, band : band + len(y)] = y
    steps = np.arange(width, dtype=np.int32)
    far = np.int32(1 << 29)
    row = np.tile(np.where(steps >= band, steps - band, far).astype(np.int32), (len(a), 1))
    out = np.where(size_a == 0, size_b, far)
    for i in range(1, size_a.max() + 1):
        # Column k of row i is word i + k - band of the other text.
        new = row + (left[:, i - 1 : i] != right[:, i - 1 : i - 1 + width])
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        if i <= band:
            new[:, : band - i] = far
            new[:, band - i] = i
        row = np.minimum.accumulate(new - steps, axis=1) + steps
        done = np.flatnonzero(size_a == i)
        if len(done):
            at = size_b[done] - i + band
            inside = (at >= 0) & (at < width)
            out[done[inside]] = row[done[inside], at[inside]]
    return out


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both without what they begin and end with alike."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = differ[0] if len(differ) else n
    a, b, n = a[head:], b[head:], n - head
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = differ[0] if len(differ) else n
    return a[: len(a) - tail], b[: len(b) - tail]


def _shared_words(a: np.ndarray, b: np.ndarray) -> int:
    """How many words the texts have in common, whatever their order."""
    both = np.sort(np.concatenate([a.astype(np.int64) * 2, b.astype(np.int64) * 2 + 1]))
    words, side = both >> 1, both & 1
    first = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
    from_b = np.add.reduceat(side, first)
    return int(np.minimum(from_b, np.diff(np.append(first, len(both))) - from_b).sum())


def aligned(pairs: list[tuple[np.ndarray, np.ndarray]], similarity: float = SIMILARITY) -> np.ndarray:
    """Whether the edit similarity of each pair is enough: by words in common, then by alignment in a band that widens."""
    out = np.zeros(len(pairs), bool)
    todo = []
    for r, (a, b) in enumerate(pairs):
        longer = max(len(a), len(b))
        limit = int(allowed(np.array(longer), similarity))
        if abs(len(a) - len(b)) > limit or (longer and _shared_words(a, b) < longer - limit):
            continue  # each edit changes at most one word of the longer text
        a, b = _trimmed(a, b)
        todo.append((min(limit, max(8, abs(len(a) - len(b)))), limit, r, a, b))
    while todo:
        todo.sort(key=lambda t: (t[0], len(t[3])))
        again, i = [], 0
        while i < len(todo):
            j, band = i + 1, todo[i][0]
            while j < len(todo) and todo[j][0] == band and (j + 1 - i) * (len(todo[j][3]) + 2 * band + 1) <= ALIGNED_CELLS:
                j += 1
            found = banded_distances([t[3] for t in todo[i:j]], [t[4] for t in todo[i:j]], band)
            for (band, limit, r, a, b), d in zip(todo[i:j], found):
                if d <= limit:
                    out[r] = True
                elif band < limit:
                    again.append((min(limit, band * 4), limit, r, a, b))
            i = j
        todo = again
    return out


def _shingles(words: np.ndarray) -> np.ndarray:
    """The set of hashes of a text's shingles."""
    starts = np.arange(max(0, len(words) - SHINGLE + 1))
    return np.unique(texts.span_hashes(words.astype(np.uint64), starts, starts + SHINGLE, texts.WORD_BASE))


def similar(pairs: list[tuple[np.ndarray, np.ndarray]], similarity: float = SIMILARITY) -> np.ndarray:
    """Whether each pair is similar enough by its shingles and by alignment."""
    out = np.zeros(len(pairs), bool)
    for r, (a, b) in enumerate(pairs):
        x, y = _shingles(a), _shingles(b)
        common = len(np.intersect1d(x, y, assume_unique=True))
        out[r] = common > 0 and common >= similarity * (len(x) + len(y) - common) - 1e-9
    chosen = np.flatnonzero(out)
    out[chosen] = aligned([pairs[r] for r in chosen], similarity)
    return out


def _nodes(words: texts.Words) -> pa.Array:
    """A hash of all the words of each document."""
    return pa.array(texts.span_hashes(words.hashes, words.docs[:-1], words.docs[1:], texts.WORD_BASE).view(np.int64))


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds, values = texts.folded_words()
    for batch in batches:
        data, offsets = texts.utf8(batch.column(1))
        for i, j in texts.slices(offsets):
            at = offsets[i : j + 1]
            words = texts.Words(data[at[0] : at[-1]], at - at[0], kinds, values)
            sketches, size, bitmap = sketch(words)
            lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel().view(np.int64)))
            columns = [batch.column(0).slice(i, j - i), _nodes(words), pa.array(size.astype(np.int32)), lists(sketches), lists(bitmap)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "node", "size", "sketches", "bitmap"])


def _worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words, as numbers, of the rows that are their node."""
    kinds, values = texts.folded_words()
    for batch in batches:
        data, offsets = texts.utf8(batch.column(1))
        for i, j in texts.slices(offsets):
            at = offsets[i : j + 1]
            words = texts.Words(data[at[0] : at[-1]], at - at[0], kinds, values)
            node = _nodes(words)
            numbers = pa.array((words.hashes >> np.uint64(32)).astype(np.uint32).view(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(words.docs.astype(np.int32)), numbers)
            own = pa.array(np.asarray(node) == np.asarray(batch.column(0).slice(i, j - i)))
            yield pa.RecordBatch.from_arrays([node, lists], ["node", "words"]).filter(own)


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = []
        for column in (2, 3):
            lists = batch.column(column)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            pairs.append([flat[a:b] for a, b in zip(at[:-1], at[1:])])
        near = pa.array(similar(list(zip(*pairs))))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(near)


def links(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Of the candidate pairs (a, b) those that are near duplicates."""
    left = words.select(F.col("node").alias("a"), F.col("words").alias("words_a"))
    right = words.select(F.col("node").alias("b"), F.col("words").alias("words_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "words_a", "words_b")
    return texts.mapped(both, _aligned, "a long, b long")


def _last_hubs(members: DataFrame, hubs_of: int) -> DataFrame:
    """(bucket, last): up to which hash the nodes of a bucket are hubs, the first one at least, about ``hubs_of`` of them."""
    most = (1 << 63) - 1
    sizes = members.groupBy("bucket").agg(F.min("order").alias("first"), F.count("*").alias("nodes"))
    share = F.lit(float(hubs_of)) / F.col("nodes")
    reach = (F.col("first").cast("double") + (float(most) - F.col("first").cast("double")) * share).cast("long")
    some = F.greatest("first", reach) if hubs_of > 1 else F.col("first")
    return sizes.select("bucket", F.when(F.col("nodes") <= hubs_of, F.lit(most)).otherwise(some).alias("last"))


def node_classes(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(key, node) of each row, and (node, class_id, kept) of each node; ``kept`` is the one node of its class that stays."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = texts.with_key(rows, "key", "node long, size int, sketches array<long>, bitmap array<long>")
    sketched = texts.stored(texts.mapped(rows, _sketched, schema), "sketches")
    firsts = [F.first(c).alias(c) for c in ("size", "sketches", "bitmap")]
    nodes = texts.stored(sketched.groupBy("node").agg(F.min("key").alias("key"), *firsts), "nodes")
    each = nodes.filter(F.col("size") > 0).select("node", F.posexplode("sketches").alias("k", "sketch"))
    each = each.select(F.xxhash64("k", "sketch").alias("bucket"), "node")
    shared = each.groupBy("bucket").agg(F.count("*").alias("nodes")).filter("nodes > 1").select("bucket")
    # Bitmaps travel only to the buckets where nodes meet.
    met = each.join(shared, "bucket").join(nodes.select("node", "size", "bitmap"), "node")
    order = F.xxhash64("node").alias("order")
    members = texts.stored(met.select("bucket", "node", order, "size", "bitmap", F.col("node").alias("part")), "members")

    involved = members.select("node").distinct().join(nodes.select("node", F.col("key").alias("of")), "node")
    texts_of = rows.join(involved, rows["key"].eqNullSafe(involved["of"])).select("node", "text")
    words = texts.stored(texts.mapped(texts_of, _worded, "node long, words array<int>").dropDuplicates(["node"]), "words")

    parts, hubs_of = None, HUBS
    differing = sum(F.bit_count(F.get("bitmap", i).bitwiseXOR(F.get("bitmap_a", i))) for i in range(BITMAP_LONGS))
    while not members.isEmpty():
        placed = members.join(_last_hubs(members, hubs_of), "bucket")
        hubs = placed.filter(F.col("order") <= F.col("last"))
        hub = hubs.select("bucket", *[F.col(c).alias(f"{c}_a") for c in ("node", "order", "size", "bitmap", "part")])
        behind = (F.col("order") > F.col("order_a")) | ((F.col("order") == F.col("order_a")) & (F.col("node") > F.col("node_a")))
        pairs = (
            members.join(hub, "bucket")
            .filter(behind & (F.col("part") != F.col("part_a")))
            .filter(differing <= (F.col("size") + F.col("size_a")) * ((1 - SIMILARITY) / (1 + SIMILARITY)) + 1e-9)
            .select(F.col("node_a").alias("a"), F.col("node").alias("b"))
            .distinct()
        )
        found = texts.stored(links(pairs, words), "links")
        if parts is None:
            parts = components(found.select("a", "b"))
        else:
            known = parts
            named = found
            for side in ("a", "b"):
                named = named.join(known.select(F.col("node").alias(side), F.col("part").alias(f"part_{side}")), side, "left")
            merged = components(named.select(F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b")))
            renamed = merged.select(F.col("node").alias("part"), F.col("part").alias("new"))
            parts = known.join(renamed, "part", "left").select("node", F.coalesce("new", "part").alias("part"))
            parts = texts.stored(parts.unionByName(merged.join(known, "node", "left_anti")), "parts")
        left = placed.filter(F.col("order") > F.col("last")).drop("last", "part").join(parts, "node", "left")
        left = left.select("bucket", "node", "order", "size", "bitmap", F.coalesce("part", "node").alias("part"))
        several = left.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high").select("bucket")
        members = texts.stored(left.join(several, "bucket"), "members")
        hubs_of *= MORE_HUBS

    if parts is None:
        parts = members.select("node", "part")
    of = nodes.select("node", "key").join(parts, "node", "left").select("node", "key", F.coalesce("part", "node").alias("part"))
    # The least key of a class; a null one only if there is no other.
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "node")).alias("first")
    named = of.join(of.groupBy("part").agg(first), "part")
    named = named.select("node", F.col("first.key").alias("class_id"), (F.col("node") == F.col("first.node")).alias("kept"))
    return sketched.select("key", "node"), texts.stored(named, "classes")


def classes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, class_id) for each row."""
    each, named = node_classes(docs, key, text)
    return each.join(named, "node").select("key", "class_id")


def _noded(text: str):
    def noded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, values = texts.folded_words()
        for batch in batches:
            data, offsets = texts.utf8(batch.column(0).field(text))
            for i, j in texts.slices(offsets):
                at = offsets[i : j + 1]
                words = texts.Words(data[at[0] : at[-1]], at - at[0], kinds, values)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), _nodes(words)], ["key", "node"])

    return noded


def remove(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One document of each class, with all its columns: the one of the least key, of several the least text, then the least row."""
    _, named = node_classes(docs, key, text)
    rows = docs.select(texts.whole_row(docs).alias("row"))
    noded = texts.mapped(rows, _noded(text), texts.with_key(rows, "row", "node long"))
    of = named.filter("kept").select("node", "class_id")
    least = noded.join(of, "node").filter(F.col("key")[key].eqNullSafe(F.col("class_id")))
    value = F.col("key")[text].cast("string")
    order = F.struct(value.isNotNull(), value, F.to_json("key"))
    return least.groupBy("node").agg(F.min_by("key", order).alias("key")).select("key.*")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document: the least doc_id that it is linked to by near duplicates."""
    return classes(texts.table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("key", "doc_id")
