"""Texts and words as numpy arrays over Arrow buffers, shared by the operators of this folder.

Everything here works on one Arrow batch or a slice of it. A slice ends at a document, so that memory is
bounded by ``SLICE_BYTES`` or by the longest single document, whichever is more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.shared import materialize

SLICE_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
FOLDS = 5

# Fixed values of the hashes: an odd base for bytes, one for words, and the multipliers of the final mix.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
MIX_1 = 0xBF58476D1CE4E5B9
MIX_2 = 0x94D049BB133111EB


def held_out(doc_id: Column) -> Column:
    """Whether a document lies in the fold that no model may learn from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train_fold(doc_id: Column) -> Column:
    """Folds 1 to 4 may be learned from; a null id has none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def hashed_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, those with the least hash of their key in a part of about four times as many.

    The part is taken first, by the remainder of the hash, so that no task gathers more than it holds.
    """
    share = max(1, df.count() // (4 * most))
    hashed = F.xxhash64(key)
    return df.filter(F.pmod(hashed, F.lit(share)) == 0).orderBy(hashed, key).limit(most)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, for operators that hand rows through."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def mapped(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` over batches of at most ``BATCH_BYTES``, set in the session if it has more.

    Texts are long: at the default of 64 MB a batch lies several times in the memory of an executor and its workers.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(conf.get(name)).rstrip("b")) > BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there.

    The driver is then asked to collect its garbage, upon which Spark drops the shuffle files of the finished write;
    else they would stay on disk beside all later ones.
    """
    out = materialize(df, name)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_key(df: DataFrame, key: str, fields: str) -> StructType:
    """The schema of a ``key`` column of the type that ``key`` has in ``df``, followed by ``fields``."""
    return StructType([StructField("key", df.schema[key].dataType), *StructType.fromDDL(fields).fields])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows [i, j) that hold at most ``limit`` bytes, or one row that holds more."""
    i, rows = 0, len(offsets) - 1
    while i < rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, rows)
        i = min(j, rows)


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts as code points, with the offsets of the rows among them."""
    firsts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), firsts[offsets]


def lower_table() -> np.ndarray:
    """The lower-case code point of each of the first 65,536, where that is a single one."""
    out = np.arange(1 << 16, dtype=np.uint32)
    for i in range(1 << 16):
        c = chr(i).lower()
        if len(c) == 1 and ord(c) < 1 << 16:
            out[i] = ord(c)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of each span of ``values``, whatever its place: prefix sums of value * base^place."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n), out=sums[1:])
    back = powers(pow(base, -1, 1 << 64), n + 1)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of a slice of documents: byte spans, 64-bit hashes, and the word offsets of each document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray, values: np.ndarray):
        """``kinds``: which bytes belong to words; ``values``: what a byte counts as, 256 values of 64 bits."""
        inside = kinds[data]
        edge = np.zeros(len(data) + 1, np.bool_)
        edge[offsets] = True  # a word ends with its document
        before = np.concatenate([[False], inside])
        after = np.concatenate([inside, [False]])
        self.starts = np.flatnonzero(after & (~before | edge))
        self.ends = np.flatnonzero(before & (~after | edge))
        self.docs = np.searchsorted(self.starts, offsets)
        self.hashes = np.empty(len(self.starts), np.uint64)
        i = 0
        while i < len(self.starts):  # a few hundred KB at a time keeps the temporaries in cache
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + (1 << 18), "right")))
            low, high = self.starts[i], self.ends[j - 1]
            self.hashes[i:j] = span_hashes(values[data[low:high]], self.starts[i:j] - low, self.ends[i:j] - low, BYTE_BASE)
            i = j

    def doc_of(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.docs) - 1), np.diff(self.docs))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the n words from each word on, and whether they lie in one document."""
        count = len(self.hashes)
        starts = np.arange(max(0, count - n + 1))
        doc = self.doc_of()
        return span_hashes(self.hashes, starts, starts + n, WORD_BASE), doc[starts] == doc[starts + n - 1] if len(starts) else np.zeros(0, bool)


def byte_values() -> np.ndarray:
    """A 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BYTE_BASE))


def plain_words() -> tuple[np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``, unchanged."""
    kinds = np.ones(256, np.bool_)
    kinds[[0x20, *range(0x09, 0x0E)]] = False
    return kinds, byte_values()


def folded_words() -> tuple[np.ndarray, np.ndarray]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became lower case."""
    kinds = np.zeros(256, np.bool_)
    kinds[0x30:0x3A] = kinds[0x41:0x5B] = kinds[0x61:0x7B] = kinds[0x80:] = True
    values = byte_values()
    values[0x41:0x5B] = values[0x61:0x7B]
    return kinds, values
