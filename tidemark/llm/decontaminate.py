"""Benchmark decontamination by suffix arrays of the training documents.

Each slice of documents is a shard. Its suffix array holds the suffixes that can match at all, those whose first
words follow each other in some test item, sorted by their first ``window`` words. Every test suffix is found in it
by binary search, which gives all its places; matches that go on along a diagonal are joined into longest verbatim
matches with their locations. The test items are a stated query set: each (item, text) once, they go to the executors in
blocks of at most ``BLOCK_BYTES`` of text or one longer item, one block after the other, however many there are.

Defined cases: a null text has no words; an item with fewer words than the window is one window of all of them; an
item without words never matches. An item without an id is searched like any other, under a null id, which
the query counts as one id and leaves out of the joined ids. Repeated documents are searched each; equal items match each
under their own id. Other columns of the documents are kept as they are in ``remove`` and left out of ``matches``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as texts

WINDOW = 10
HEAD = 3  # words by which suffixes that cannot match are left out
BLOCK_BYTES = 16 << 20

FOUND = "n_words long, matches array<struct<item:string,item_start:int,start:int,n_words:int>>"


class Tests:
    """The windows of one block of items as sorted rows of word numbers."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        kinds, values = texts.folded_words()
        data, offsets = texts.utf8(pa.array([t for _, t in items], pa.string()))
        words = texts.Words(data, offsets, kinds, values)
        self.names = [k for k, _ in items]
        self.vocabulary = np.unique(words.hashes)
        numbers = np.append(np.searchsorted(self.vocabulary, words.hashes) + 1, np.zeros(window, np.int64))
        sizes = np.diff(words.docs)
        self.item = np.repeat(np.arange(len(sizes)), np.where(sizes < window, np.minimum(sizes, 1), sizes - window + 1))
        first = np.repeat(np.cumsum(np.bincount(self.item, minlength=len(sizes))) - np.bincount(self.item, minlength=len(sizes)), np.bincount(self.item, minlength=len(sizes)))
        self.start = np.arange(len(self.item)) - first
        self.length = np.minimum(sizes, window)[self.item]
        rows = numbers[(words.docs[self.item] + self.start)[:, None] + np.arange(window)]
        rows[np.arange(window) >= self.length[:, None]] = 0
        order = np.lexsort([*rows.T[::-1]])
        self.item, self.start, self.length, rows = self.item[order], self.start[order], self.length[order], rows[order]
        # Equal windows are searched once.
        new = np.append(True, (rows[1:] != rows[:-1]).any(axis=1)) if len(rows) else np.zeros(0, bool)
        self.first_of = np.flatnonzero(new)
        self.rows = rows[new]
        self.count_of = np.diff(np.append(self.first_of, len(rows)))
        self.head = min(HEAD, int(self.length.min())) if len(rows) else 0
        self.heads = np.unique(self.packed(self.rows[:, : self.head])) if self.head else np.zeros(0, np.int64)

    def packed(self, columns: np.ndarray) -> np.ndarray:
        out = np.zeros(len(columns), np.int64)
        for c in columns.T:
            out = out * np.int64(len(self.vocabulary) + 1) + c
        return out


def _bytes(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort as the rows do."""
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").ravel()


def search(tests: Tests, words: texts.Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the shard and entries of ``tests`` whose windows stand there."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(tests.rows) or not len(words.hashes):
        return none
    at = np.minimum(np.searchsorted(tests.vocabulary, words.hashes), len(tests.vocabulary) - 1)
    numbers = np.where(tests.vocabulary[at] == words.hashes, at + 1, 0)
    end = np.repeat(words.docs[1:], np.diff(words.docs))
    numbers = np.append(numbers, np.zeros(window, np.int64))
    may = np.flatnonzero(np.logical_and.reduce([numbers[k : k + len(words.hashes)] > 0 for k in range(tests.head)]))
    head = tests.packed(numbers[may[:, None] + np.arange(tests.head)])
    may = may[tests.heads[np.minimum(np.searchsorted(tests.heads, head), len(tests.heads) - 1)] == head]
    if not len(may):
        return none
    rows = numbers[may[:, None] + np.arange(window)]
    rows[may[:, None] + np.arange(window) >= end[may][:, None]] = 0  # a suffix ends with its document
    keys = _bytes(rows)
    suffixes = np.argsort(keys, kind="stable")
    keys = keys[suffixes]
    low = np.searchsorted(keys, _bytes(tests.rows), "left")
    last = np.where(np.arange(window) < tests.length[tests.first_of][:, None], tests.rows, 0xFFFFFFFF)
    high = np.searchsorted(keys, _bytes(last), "right")
    size = high - low
    test = np.repeat(np.arange(len(size)), size)
    nth = np.arange(len(test)) - np.repeat(np.cumsum(size) - size, size)
    return may[suffixes[low[test] + nth]], test


def _scanner(shared, window: int, text: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, values = texts.folded_words()
        tests = Tests(shared.value, window)
        for batch in batches:
            data, offsets = texts.utf8(batch.column(0).field(text))
            for i, j in texts.slices(offsets, 2 * texts.SLICE_BYTES):
                piece = batch.slice(i, j - i)
                at = offsets[i : j + 1]
                words = texts.Words(data[at[0] : at[-1]], at - at[0], kinds, values)
                place, test = search(tests, words, window)
                # Each place and each item that has this window.
                many = tests.count_of[test]
                entry = np.repeat(tests.first_of[test], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                place = np.repeat(place, many)
                doc = np.searchsorted(words.docs, place, "right") - 1
                item, start, length = tests.item[entry], tests.start[entry], tests.length[entry]
                order = np.lexsort([place, place - start, item, doc])
                doc, place, item, start, length = (x[order] for x in (doc, place, item, start, length))
                joined = np.zeros(len(doc), bool)
                joined[1:] = (doc[1:] == doc[:-1]) & (item[1:] == item[:-1]) & (place[1:] == place[:-1] + 1) & (start[1:] == start[:-1] + 1)
                first = np.flatnonzero(~joined)
                final = np.append(first[1:], len(doc)) - 1 if len(first) else first
                match = pa.StructArray.from_arrays(
                    [
                        pa.array([tests.names[k] for k in item[first]], pa.string()),
                        pa.array(start[first].astype(np.int32)),
                        pa.array((place[first] - words.docs[doc[first]]).astype(np.int32)),
                        pa.array((place[final] + length[final] - place[first]).astype(np.int32)),
                    ],
                    ["item", "item_start", "start", "n_words"],
                )
                ends = np.searchsorted(doc[first], np.arange(j - i + 1)).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(ends), match)
                if batch.num_columns > 2:  # what earlier blocks found
                    found = pa.array([(a or []) + b for a, b in zip(piece.column(2).to_pylist(), found.to_pylist())], found.type)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(np.diff(words.docs)), found], ["key", "n_words", "matches"])

    return scan


def matches(spark: SparkSession, docs: DataFrame, tests: DataFrame, key: str, text: str, item: str, item_text: str, window: int = WINDOW) -> DataFrame:
    """(key, n_words, matches) for each document: its longest verbatim matches of at least a window."""
    row = F.struct(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    found = _matched(spark, docs.select(row.alias("key")), "text", tests, item, item_text, window)
    return found.select("key.key", "n_words", "matches")


def _matched(spark: SparkSession, rows: DataFrame, text: str, tests: DataFrame, item: str, item_text: str, window: int) -> DataFrame:
    """(key, n_words, matches) for rows of one struct ``key`` with a field ``text``."""
    items = tests.select(F.col(item).cast("string").alias("item"), F.col(item_text).cast("string").alias("text")).dropna(subset=["text"])
    items = items.distinct()
    several = (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > BLOCK_BYTES
    schema = texts.with_key(rows, "key", FOUND)
    for some in _blocks(items):
        rows = texts.mapped(rows, _scanner(spark.sparkContext.broadcast(some), window, text), schema)
        if several:
            rows = texts.stored(rows, "decontaminate")
    return rows


def _blocks(items: DataFrame) -> Iterator[list[tuple[str | None, str]]]:
    """The items in blocks of bounded size; one empty block if there are none."""
    some, size = [], 0
    for r in items.orderBy("item", "text").toLocalIterator():
        more = len(r["text"].encode())
        if some and size + more > BLOCK_BYTES:
            yield some
            some, size = [], 0
        some.append((r["item"], r["text"]))
        size += more
    yield some


def n_hit(found: str = "matches"):
    """The number of words that lie in any match, as a column."""
    ordered = F.array_sort(F.transform(found, lambda m: F.struct(m["start"].alias("a"), (m["start"] + m["n_words"]).alias("b"))))
    none = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("to"))
    step = lambda s, m: F.struct(
        (s["hit"] + F.greatest(F.lit(0), m["b"] - F.greatest(s["to"], m["a"]))).alias("hit"), F.greatest(s["to"], m["b"]).alias("to")
    )
    return F.aggregate(ordered, none, step, lambda s: s["hit"].cast("long"))


def remove(spark: SparkSession, docs: DataFrame, tests: DataFrame, text: str, item: str, item_text: str, window: int = WINDOW) -> DataFrame:
    """The documents without a match, with all their columns."""
    found = _matched(spark, docs.select(texts.whole_row(docs).alias("key")), text, tests, item, item_text, window)
    return found.filter(F.size("matches") == 0).select("key.*")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document the words and items of the benchmark that it holds."""
    found = matches(spark, texts.table(spark, sf_dir, "documents"), texts.table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")
    items = F.array_sort(F.array_distinct(F.col("matches.item")))
    return found.select(
        F.col("key").alias("doc_id"), "n_words", n_hit().alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), (F.size("matches") > 0).alias("contaminated"),
    )


OP9_SQL = r"""
with lowered_d as (
  select doc_id, row_number() over () as r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
lowered_i as (
  select cast(item_id as varchar) as item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where text is not null),
sized as (select item, w, least(10, len(w)) as n from lowered_i where len(w) > 0),
item_windows as (
  select distinct item, n, array_to_string(w[i : i + n - 1], ' ') as win
  from (select item, w, n, unnest(range(1, len(w) - n + 2)) as i from sized)),
doc_windows as (
  select r, n, i, array_to_string(w[i : i + n - 1], ' ') as win
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i
        from lowered_d, (select distinct n from sized) where len(w) >= n)),
found as (select r, i, d.n, item from doc_windows d join item_windows t on d.n = t.n and d.win = t.win),
hits as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from found) group by r),
named as (select r, count(*) as n_items, string_agg(item, ',' order by item) as names
          from (select distinct r, item from found) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256,
       n_hit is not null as contaminated
from lowered_d left join hits using (r) left join named using (r)"""
