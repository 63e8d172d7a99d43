"""Substring dedup by seed and extend.

Seeds: of the ``WINDOW - SEED + 1`` seeds of ``SEED`` words in a window of ``WINDOW`` words the one with the least hash
is its anchor, the same one wherever the window stands. Documents meet on anchors.

Extension: the windows of one anchor start at neighbouring words. The places of an anchor are first grouped by the hash
of all the words under these windows: two or more places in a group match to both ends, however many they are, as for
copies. Where an anchor has several such surroundings, one place of each is extended to the left and right by each
number of words, and the windows that two surroundings share are the matches there. No two places are ever paired, so a
passage that stands in a third of all documents costs as many rows as it has places.

The matched spans of a document are joined into maximal repeats.

Defined cases: a null text has no words; a document shorter than the window has no repeats; a repeated row is a
copy, and each of its rows is treated so; other columns are ignored, or kept by ``remove``. Keys may repeat and be
null: rows are told apart by key and text. Texts of any length are handled whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as texts
from tidemark.shared import materialized

WINDOW = 35
SEED = 8


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The place of the least, the first if there are several, of each n neighbours: by doubling."""
    value, place, size = x, np.arange(len(x)), 1
    while size < n:
        step = min(size, n - size)
        take = value[step:] < value[:-step]
        value, place = np.where(take, value[step:], value[:-step]), np.where(take, place[step:], place[:-step])
        size += step
    return place


def anchors(words: texts.Words, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The seeds of a slice, and of each anchor its place, the first word of its windows and the end of its last one."""
    seeds, _ = words.grams(seed)
    none = np.zeros(0, np.int64)
    if len(words.hashes) < window:
        return seeds, none, none, none
    place = _least(seeds, window - seed + 1)
    doc = words.doc_of()
    starts = np.flatnonzero(doc[: len(place)] == doc[window - 1 :])
    place = place[starts]
    if not len(place):
        return seeds, none, none, none
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    return seeds, place[first], starts[first], starts[np.append(first[1:], len(place)) - 1] + window


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _places(window: int, seed: int):
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, values = texts.plain_words()
        for batch in batches:
            data, offsets = texts.utf8(batch.column(2))
            for i, j in texts.slices(offsets):
                at = offsets[i : j + 1]
                words = texts.Words(data[at[0] : at[-1]], at - at[0], kinds, values)
                seeds, place, low, high = anchors(words, window, seed)
                if not len(place):
                    continue
                around = texts.span_hashes(words.hashes, low, high, texts.WORD_BASE) + (place - low).astype(np.uint64)
                doc = np.searchsorted(words.docs, place, "right") - 1
                first = words.docs[doc]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(i + doc)), batch.column(1).take(pa.array(i + doc)),
                        _signed(seeds[place]), _signed(texts.mix(around)),
                        pa.array((low - first).astype(np.int32)), pa.array((high - first).astype(np.int32)),
                    ],
                    ["key", "row", "anchor", "around", "low", "high"],
                )

    return places


def _extended(window: int):
    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows of each place with their hashes, two of them as the anchor is not told."""
        kinds, values = texts.plain_words()
        for batch in batches:
            data, offsets = texts.utf8(batch.column(2))
            for r in range(batch.num_rows):
                places = batch.column(3)[r].as_py()
                at = offsets[r : r + 2]
                words = texts.Words(data[at[0] : at[1]], at - at[0], kinds, values)
                low, high, count = (np.array([p[c] for p in places], np.int64) for c in ("low", "high", "n"))
                n = high - low - window + 1
                starts = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                span = texts.span_hashes(words.hashes, starts, starts + window, texts.WORD_BASE)
                check = texts.span_hashes(words.hashes, starts, starts + window, texts.BYTE_BASE) >> np.uint64(33)
                same = pa.array(np.full(len(starts), r))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(same), batch.column(1).take(same), _signed(span), pa.array(check.astype(np.int32)),
                        pa.array(starts.astype(np.int32)), pa.array(np.repeat(count, n)),
                    ],
                    ["key", "row", "span", "check", "low", "n"],
                )

    return extended


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, row, text): ``row`` tells texts of one key apart."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key).alias("key"), F.xxhash64(value).alias("row"), value.alias("text"))


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["key"].eqNullSafe(b["key"]) & (a["row"] == b["row"])


def repeats(rows: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(key, row, spans): the parts of each text, in words, that windows which stand elsewhere too cover."""
    found = texts.mapped(rows, _places(window, seed), texts.with_key(rows, "key", "row long, anchor long, around long, low int, high int"))
    with materialized(found, "places") as places:
        one = [F.first(c).alias(c) for c in ("key", "row", "low", "high")]
        counted = texts.stored(places.groupBy("anchor", "around").agg(F.count("*").alias("n"), *one), "surroundings")
        copies = counted.filter("n > 1").select("anchor", "around")
        whole = texts.stored(places.join(copies, ["anchor", "around"]).select("key", "row", "low", "high"), "whole")
        several = counted.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("anchor")
        per_row = counted.join(several, "anchor").groupBy("key", "row").agg(F.collect_list(F.struct("low", "high", "n")).alias("places"))
        per_row = texts.stored(per_row, "extend")
    # A row that is there twice gives its windows twice, but has no surrounding that stands once.
    with_places = rows.join(per_row, _same_row(rows, per_row)).select(rows["key"], rows["row"], "text", "places")
    schema = texts.with_key(rows, "key", "row long, span long, check int, low int, n long")
    windows = texts.stored(texts.mapped(with_places, _extended(window), schema), "windows")
    shared = windows.groupBy("span", "check").agg(F.sum("n").alias("all")).filter("all > 1").drop("all")
    partial = windows.filter("n = 1").join(shared, ["span", "check"]).select("key", "row", "low", (F.col("low") + window).alias("high"))
    spans = whole.unionByName(partial).groupBy("key", "row").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    return texts.stored(spans, "spans")


def _cut(data: np.ndarray, at: np.ndarray, spans: list, kinds, values) -> tuple[texts.Words, np.ndarray]:
    """The words of one text and which of them stay."""
    words = texts.Words(data[at[0] : at[1]], at - at[0], kinds, values)
    edges = np.zeros(len(words.starts) + 1, np.int64)
    for s in spans or ():
        edges[s["low"]] += 1
        edges[s["high"]] -= 1
    return words, np.cumsum(edges[:-1]) == 0


def kept(docs: DataFrame, key: str, text: str, fields: str, of: Callable, also: Column | None = None, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(key, *fields) for each document; ``of`` gets its bytes, its words and which of them stay.

    ``also`` is a column that comes out as ``key`` instead of the key.
    """
    spans = repeats(_rows(docs, key, text), window, seed)
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = F.col(key) if also is None else also
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(value).alias("row"), value.alias("text"), out.alias("out"))
    joined = rows.join(spans, _same_row(rows, spans), "left").select("out", rows["text"], "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, values = texts.plain_words()
        for batch in batches:
            data, offsets = texts.utf8(batch.column(1))
            for i, j in texts.slices(offsets, 4 * texts.SLICE_BYTES):
                out = []
                for r in range(i, j):
                    at = offsets[r : r + 2]
                    out.append(of(data[at[0] : at[1]].tobytes(), *_cut(data, at, batch.column(2)[r].as_py(), kinds, values)))
                columns = [batch.column(0).slice(i, j - i), *map(pa.array, zip(*out))]
                yield pa.RecordBatch.from_arrays(columns, ["key", *(f.split()[0] for f in fields.split(", "))])

    return texts.mapped(joined, cut, texts.with_key(joined, "out", fields))


def digest(data: bytes, words: texts.Words, stays: np.ndarray) -> tuple[int, int, str]:
    left = b" ".join([data[a:b] for a, b in zip(words.starts[stays].tolist(), words.ends[stays].tolist())])
    return len(stays), int((~stays).sum()), hashlib.sha256(left).hexdigest()


def rest(data: bytes, words: texts.Words, stays: np.ndarray) -> tuple[str, int]:
    """The text without its repeats: white space inside what stays is kept, each gap is one space."""
    if stays.all():
        return data.decode(), 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], stays, [False]])))
    parts = [data[words.starts[a] : words.ends[b - 1]] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
    return b" ".join(parts).decode(), int((~stays).sum())


def remove(docs: DataFrame, key: str, text: str, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """The documents with all their columns, their texts without repeats; a null text stays null."""
    names = docs.columns
    others = F.struct(*[F.col(f"`{c}`") for c in names if c != text], F.col(text).isNull().alias("is null"))
    cut = kept(docs, key, text, "left string, n_removed long", rest, others, window, seed)
    left = F.when(~F.col("key.`is null`"), F.col("left"))
    return cut.select(*[left.alias(c) if c == text else F.col(f"key.`{c}`").alias(c) for c in names])


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document, as a digest."""
    docs = texts.table(spark, sf_dir, "documents")
    return kept(docs, "doc_id", "text", "n_words long, n_removed long, kept_sha256 string", digest).withColumnRenamed("key", "doc_id")


OP7_SQL = r"""
with words as (
  select doc_id, row_number() over () as r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select r, i, array_to_string(w[i : i + 34], ' ') as win
  from (select r, w, unnest(range(1, len(w) - 33)) as i from words where len(w) >= 35)),
repeated as (select win from windows group by win having count(*) > 1),
gone as (select distinct r, unnest(range(i, i + 35)) as p from windows where win in (select win from repeated)),
each as (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from words),
rests as (
  select r, string_agg(word, ' ' order by p) as kept, count(*) as n
  from each anti join gone using (r, p) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from words left join rests using (r)"""
