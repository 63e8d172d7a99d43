"""Token ids in files: each document a zstandard frame of its own, with one dictionary shared by all.

A token table is a folder with two parts, both written by Spark:

* ``dictionary``: one row, the dictionary and its SHA-256;
* ``segments``: rows in the order of the keys, each a segment of some MB with its first and last key, the number of ids
  in its shard before it, and its bytes. Segments of a shard lie in one file, so row groups are skipped by key.

A segment, little-endian: ``TIDESEG1``, the dictionary's SHA-256 (32 bytes), bytes per id (u4), documents (u4); then the
offset index, for each document its key (i8), whether it has one (u1), number of ids (u8) and end of its frame, counted
from the first frame (u8); then the frames. An id takes 2 bytes where the vocabulary allows it.

The dictionary is trained on the serialized ids of at most ``SAMPLE_DOCS`` documents, chosen by a hash of their key, and
at most ``SAMPLE_BYTES`` of each; every document is then compressed whole with it.

Defined cases: null is the empty text and has the end id only; documents of one key follow each other by text; a null
key comes first; an empty table has no segments; other columns are ignored; long texts are one frame. Keys are integers.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as texts
from tidemark.llm.bpe import byte_letters, default_vocabulary
from tidemark.llm.presplit import PATTERN
from tidemark.shared import scratch_path

MAGIC = b"TIDESEG1"
SEGMENT_BYTES = 4 << 20  # of ids before compression
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS = 1000
SAMPLE_BYTES = 16 << 10
LEVEL = 3
ENTRY = np.dtype([("key", "<i8"), ("has_key", "u1"), ("n", "<u8"), ("end", "<u8")])
SEGMENT = "shard int, number int, first_key long, last_key long, n_docs int, before long, n_tokens long, data binary"
UNBROKEN = 2000  # letters of a run that a rank table merges in quadratic time


def ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """The tokens of a byte-level vocabulary file by bytes, and its special strings.

    Rank tables merge by id, vocabulary files by the order of their merges; the two must agree.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    letters = byte_letters()
    raw = lambda word: bytes(map(letters.__getitem__, word))
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    vocab = content["model"]["vocab"]
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in content["model"]["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])):
        raise ValueError("ids do not follow the order of the merges")
    return {raw(w): i for w, i in vocab.items() if w not in special}, special


def encoder(table: dict[bytes, int], special: dict[str, int], content: str) -> Callable[[str], np.ndarray]:
    """Whole texts to ids, as the vocabulary's own library gives them; that library takes over long unbroken runs."""
    import tiktoken
    from tokenizers import Tokenizer

    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens=special)
    library: list[Tokenizer] = []

    def encode(text: str) -> np.ndarray:
        if len(text) >= UNBROKEN and max(map(len, text.split()), default=0) >= UNBROKEN:
            if not library:
                library.append(Tokenizer.from_str(content))
            return np.array(library[0].encode(text, add_special_tokens=False).ids, np.uint32)
        return own.encode_to_numpy(text, allowed_special="all", disallowed_special=())

    return encode


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of the samples, which may be too few to train on: then it is what they hold."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _shared_dictionary(data: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(data) if data else None


def pack(entries: list[tuple[int | None, np.ndarray]], frames: list[bytes], digest: bytes, width: int) -> bytes:
    index = np.zeros(len(entries), ENTRY)
    for row, (key, ids), end in zip(index, entries, accumulate(map(len, frames))):
        row["key"], row["has_key"], row["n"], row["end"] = key or 0, key is not None, len(ids), end
    head = MAGIC + digest + np.array([width, len(entries)], "<u4").tobytes()
    return b"".join([head, index.tobytes(), *frames])


class Segment:
    """Reads one segment; ``ids(k)`` opens the frame of its k-th document only."""

    def __init__(self, data: bytes, dictionary: bytes):
        import zstandard

        if data[:8] != MAGIC or data[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError("no segment of this dictionary")
        self.width, count = np.frombuffer(data, "<u4", 2, 40).tolist()
        self.index = np.frombuffer(data, ENTRY, count, 48)
        self.frames = memoryview(data)[48 + count * ENTRY.itemsize :]
        self.open = zstandard.ZstdDecompressor(dict_data=_shared_dictionary(dictionary)).decompress

    def ids(self, k: int) -> np.ndarray:
        start = int(self.index["end"][k - 1]) if k else 0
        return np.frombuffer(self.open(self.frames[start : int(self.index["end"][k])]), f"<u{self.width}").astype("<u4")

    def key(self, k: int) -> int | None:
        return int(self.index["key"][k]) if self.index["has_key"][k] else None


def write(spark: SparkSession, docs: DataFrame, path: str, key: str, text: str, vocabulary: str, end_id: int = 0) -> None:
    """Write the ids of every text, each followed by ``end_id``, in ascending order of the key."""
    table, special = ranks(vocabulary)
    with open(vocabulary, encoding="utf-8") as file:
        content = file.read()
    shared = spark.sparkContext.broadcast((table, special, content))  # as large as the vocabulary
    width = 2 if max([end_id, *table.values(), *special.values()]) < 1 << 16 else 4
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*shared.value)
        for batch in batches:
            ids = [np.append(encode(t), end_id).astype(f"<u{width}").tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([i[:SAMPLE_BYTES] for i in ids], pa.binary())], ["ids"])

    chosen = texts.hashed_sample(rows, "key", SAMPLE_DOCS)
    dictionary = train_dictionary([r["ids"] for r in texts.mapped(chosen.select("text"), serialized, "ids binary").collect()])
    digest = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(digest, dictionary)], "sha256 binary, data binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encode = encoder(*shared.value)
        close = zstandard.ZstdCompressor(level=LEVEL, dict_data=_shared_dictionary(dictionary)).compress
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        entries, frames, size = [], [], 0

        def finished() -> pa.RecordBatch:
            keys = [k for k, _ in entries if k is not None] or [None]
            row = (shard, number, keys[0], keys[-1], len(entries), before, size, pack(entries, frames, digest, width))
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            names = [f.split()[0] for f in SEGMENT.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(encode(value), end_id)
                entries.append((k, ids))
                frames.append(close(ids.astype(f"<u{width}").tobytes()))
                size += len(ids)
                if size * width >= SEGMENT_BYTES:
                    yield finished()
                    number, before = number + 1, before + size
                    entries, frames, size = [], [], 0
        if entries:
            yield finished()

    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    texts.mapped(ordered, segments, SEGMENT).write.option("compression", "uncompressed").parquet(f"{path}/segments")


def _opened(spark: SparkSession, path: str) -> tuple[bytes, DataFrame]:
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()["data"])
    return dictionary, spark.read.schema(SEGMENT).parquet(f"{path}/segments")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(key, start, ids): the ids of every document as little-endian 32-bit integers, and how many come before them."""
    dictionary, segments = _opened(spark, path)
    # One number for each shard, of which there are as many as the writing job had tasks.
    totals = segments.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    starts = dict(zip([r["shard"] for r in totals], accumulate([r["n"] for r in totals], initial=0)))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, before, data in zip(*(batch.column(c).to_pylist() for c in range(3))):
                segment = Segment(data, dictionary)
                first = starts[shard] + before + np.cumsum(segment.index["n"].astype(np.int64)) - segment.index["n"].astype(np.int64)
                count = len(segment.index)
                keys = pa.array(segment.index["key"], mask=segment.index["has_key"] == 0)
                ids = pa.array([segment.ids(k).tobytes() for k in range(count)], pa.binary())
                yield pa.RecordBatch.from_arrays([keys, pa.array(first), ids], ["key", "start", "ids"])

    return texts.mapped(segments.select("shard", "before", "data"), documents, "key long, start long, ids binary")


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """(key, ids) of some documents: reads the segments that can hold them, and opens no other frame."""
    dictionary, segments = _opened(spark, path)
    wanted = sorted(set(keys))
    may = F.lit(False)
    for k in wanted:
        may = may | ((F.col("first_key") <= k) & (F.col("last_key") >= k))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                segment = Segment(data, dictionary)
                found = np.flatnonzero(np.isin(segment.index["key"], wanted) & (segment.index["has_key"] == 1))
                ids = pa.array([segment.ids(k).tobytes() for k in found], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(segment.index["key"][found]), ids], ["key", "ids"])

    return texts.mapped(segments.filter(may).select("data"), documents, "key long, ids binary")


def op10_token_files(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Writes the ids of all documents and reads them back."""
    path = scratch_path(spark, "tokens")
    write(spark, texts.table(spark, sf_dir, "documents"), path, "doc_id", "text", vocabulary or default_vocabulary())
    return read(spark, path).select(
        F.col("key").alias("doc_id"), "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
