"""Toxicity by class-conditional Kneser-Ney models of character 4-grams.

Both classes smooth their own counts of a 4-gram towards one shared model, whose counts are the numbers of different
left neighbours (continuation counts) over both classes, down to single characters. So a rare expression that one class
never saw falls back to what characters do in general, and its inflected forms still share most of their 4-grams.

A text is compared word by word: the log likelihood of a word under the toxic model minus that under the ordinary one.
Its measures are the ratio divided by its length for the whole text and for its most toxic word, the number of words, and
how many words exceed some levels and by how much, as a long text must not drown a short insult and one chance word is
none. A logistic curve over them gives the score.

Counts come from every labelled text of folds 1 to 3; fold 4 gives the curve, from at most ``CURVE_ROWS`` labelled texts,
chosen by a hash of their key; fold 0 is held out. All counting, backing off and smoothing are Spark
aggregations and joins over distinct n-grams and grow with the text. Every log ratio, of each 4-gram and of each context, is
kept under its exact code. Up to ``TABLE_ENTRIES`` of them are broadcast as one table; more stay a Spark table, and each
slice of documents gets, by a join, those of its own 4-grams and contexts. Both ways give the same measures.

Defined cases: null and empty texts, and others without a word, have measures 0 and the score of that. If the curve's fold
lacks a class, every score is the share of toxic labels there (0 without labels). Labels other than 0 and 1 are ignored;
several labels of one document count each; repeated rows are scored each; other columns are ignored; long texts are whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tidemark.llm import text as texts

ORDER = 4
CHAR_BITS = 12
TABLE_ENTRIES = 1 << 21
DISCOUNT = 0.75
LEVELS = (1.5, 2.5, 3.5)  # of the log ratio of a word
CURVE_ROWS = 50_000
JOINED_BYTES = 1 << 22  # of texts in a row that meets its ratios by a join
COUNT_FOLDS, CURVE_FOLDS = (1, 2, 3), (4,)


def char_classes() -> np.ndarray:
    """For each of the first 65,536 code points the number of its lower-case letter or digit, 0 for what ends words."""
    lower = texts.lower_table()
    out = np.zeros(1 << 16, np.uint64)
    for c in range(1 << 16):
        if chr(c).isalnum():
            out[c] = 1 + int(lower[c]) % ((1 << CHAR_BITS) - 1)
    return out


def _coded(data: np.ndarray, at: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The 4-gram that ends at each character or the end of its word, where words end, and the document of each.

    Characters beyond the first 65,536 are letters numbered by their low bits. Before a word stands a 0.
    """
    codes, offsets = texts.code_points(data[at[0] : at[-1]], at - at[0])
    low = codes < len(classes)
    chars = np.where(low, classes[np.where(low, codes, 0)], 1 + codes.astype(np.uint64) % np.uint64((1 << CHAR_BITS) - 1))
    # A 0 after every document ends its last word.
    chars = np.insert(chars, offsets[1:], 0)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) + 1)
    before = np.append(np.uint64(0), chars[:-1])
    used = (chars > 0) | (before > 0)
    chars, doc = chars[used], doc[used]  # a word and the 0 that ends it, one after the other
    grams = np.zeros(len(chars), np.uint64)
    alive = np.ones(len(chars), bool)
    shifted = chars
    for k in range(ORDER):
        grams |= np.where(alive, shifted, 0) << np.uint64(CHAR_BITS * k)
        shifted = np.append(np.uint64(0), shifted[:-1])
        alive = alive & (shifted > 0)  # nothing from the word before
    return grams, chars == 0, doc


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    classes = char_classes()
    for batch in batches:
        data, offsets = texts.utf8(batch.column(0))
        toxic = np.asarray(batch.column(1)) == 1
        for i, j in texts.slices(offsets):
            grams, _, doc = _coded(data, offsets[i : j + 1], classes)
            found, where = np.unique(grams, return_inverse=True)
            of = toxic[i:j][doc]
            columns = [found.view(np.int64), np.bincount(where[of], minlength=len(found)), np.bincount(where[~of], minlength=len(found))]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["gram", "toxic", "plain"])


def _tail(gram: str, n: int) -> Column:
    return F.col(gram).bitwiseAND((1 << (CHAR_BITS * n)) - 1)


def _head(gram: str) -> Column:
    return F.shiftright(gram, CHAR_BITS)


def _shared(grams: DataFrame) -> DataFrame:
    """(gram, p): the shared probability of the last character of each (ORDER - 1)-gram, from continuation counts."""
    levels = []
    level = grams
    for n in range(ORDER - 1, 0, -1):
        level = level.select(_tail("gram", n).alias("gram")).groupBy("gram").agg(F.count("*").alias("k"))
        levels.append(texts.stored(level, f"continued{n}"))
    singles = levels[-1]
    total = singles.agg(F.sum("k").alias("all"), F.count("*").alias("kinds")).first()
    # A character in no other place is as likely as any.
    even = 1.0 / (1 << CHAR_BITS)
    p = singles.withColumn("all", F.lit(total["all"])).withColumn("kinds", F.lit(total["kinds"]))
    p = p.select("gram", ((F.col("k") - DISCOUNT + DISCOUNT * F.col("kinds") * even) / F.col("all")).alias("p"))
    for n, level in zip(range(2, ORDER), reversed(levels[:-1])):
        context = level.groupBy(_head("gram").alias("context")).agg(F.sum("k").alias("all"), F.count("*").alias("kinds"))
        lower = p.select(F.col("gram").alias("tail"), F.col("p").alias("lower"))
        p = (
            level.withColumn("context", _head("gram"))
            .withColumn("tail", _tail("gram", n - 1))
            .join(context, "context")
            .join(lower, "tail")
            .select("gram", ((F.col("k") - DISCOUNT + DISCOUNT * F.col("kinds") * F.col("lower")) / F.col("all")).alias("p"))
        )
    return p


def _ratios(grams: DataFrame) -> DataFrame:
    """(code, ratio): log ratios of 4-grams (code 2 * gram), and of contexts for what neither class saw (2 * context + 1)."""
    contexts = grams.groupBy(_head("gram").alias("context")).agg(
        F.sum("toxic").alias("all_t"), F.sum("plain").alias("all_p"),
        F.sum((F.col("toxic") > 0).cast("long")).alias("kinds_t"), F.sum((F.col("plain") > 0).cast("long")).alias("kinds_p"),
    )

    def back(c: str) -> Column:
        return F.when(F.col(f"all_{c}") > 0, DISCOUNT * F.col(f"kinds_{c}") / F.col(f"all_{c}")).otherwise(1.0)

    def own(count: str, c: str) -> Column:
        return F.when(F.col(count) > 0, (F.col(count) - DISCOUNT) / F.col(f"all_{c}")).otherwise(0.0) + back(c) * F.col("p")

    shared = _shared(grams).select(F.col("gram").alias("tail"), "p")
    each = grams.withColumn("context", _head("gram")).withColumn("tail", _tail("gram", ORDER - 1)).join(contexts, "context").join(shared, "tail")
    seen = each.select((F.col("gram") * 2).alias("code"), F.log(own("toxic", "t") / own("plain", "p")).cast("float").alias("ratio"))
    unseen = contexts.select((F.col("context") * 2 + 1).alias("code"), F.log(back("t") / back("p")).cast("float").alias("ratio"))
    return seen.unionByName(unseen)


Table = tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass
class Ratios:
    """The log ratios of all codes, as a table to broadcast or, if they are too many, as rows (code, ratio)."""

    table: Table | None
    rows: DataFrame | None = None


def _table(codes: np.ndarray, ratios: np.ndarray) -> Table:
    """The codes, mixed (a bijection) and sorted, their ratios, and where the codes of each leading bits begin."""
    mixed = texts.mix(codes.view(np.uint64))
    order = np.argsort(mixed)
    mixed = mixed[order]
    bits = 1 + max(1, len(mixed)).bit_length()
    begin = np.searchsorted(mixed, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32)
    return mixed, ratios[order].astype(np.float32), begin


def _found(table: Table, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the table has each code, and its ratio or 0."""
    mixed, ratios, begin = table
    known, ratio = np.zeros(len(codes), bool), np.zeros(len(codes), np.float32)
    wanted = texts.mix(codes)
    at = begin[(wanted >> np.uint64(65 - len(begin).bit_length())).astype(np.int64)].astype(np.int64)
    todo = np.flatnonzero(at < len(mixed))
    wanted, at = wanted[todo], at[todo]
    while len(todo):
        there = mixed[at]
        hit = there == wanted
        known[todo[hit]] = True
        ratio[todo[hit]] = ratios[at[hit]]
        on = (there < wanted) & (at + 1 < len(mixed))
        todo, wanted, at = todo[on], wanted[on], at[on] + 1
    return known, ratio


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> Ratios:
    """The log ratios, from the labelled texts of the counting folds."""
    fold = texts.train_fold(F.col(key))
    some = docs.filter(fold.isin(*COUNT_FOLDS)).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    # Texts meet their labels by a sorted join, as few or many as these are.
    rows = some.join(_labelled(labels, key, label).hint("merge"), "key").select("text", "label")
    counted = texts.mapped(rows, _count, "gram long, toxic long, plain long")
    grams = texts.stored(counted.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain")), "grams")
    if grams.isEmpty():
        return Ratios(_table(np.zeros(0, np.int64), np.zeros(0, np.float32)))
    ratios = texts.stored(_ratios(grams), "ratios")
    if ratios.count() > TABLE_ENTRIES:
        return Ratios(None, ratios)
    found = ratios.toPandas()
    return Ratios(_table(found["code"].to_numpy(), found["ratio"].to_numpy()))


def _measures(data: np.ndarray, offsets: np.ndarray, table: Table, classes: np.ndarray) -> np.ndarray:
    """The measures of the texts of one slice."""
    out = np.zeros((len(offsets) - 1, 4 + len(LEVELS)))
    grams, ends, doc = _coded(data, offsets, classes)
    if not len(grams):
        return out
    known, ratio = _found(table, grams * np.uint64(2))
    new = np.flatnonzero(~known)
    ratio[new] = _found(table, (grams[new] >> np.uint64(CHAR_BITS)) * np.uint64(2) + np.uint64(1))[1]
    last = np.flatnonzero(ends)
    first = np.append(0, last[:-1] + 1)
    word, length = np.add.reduceat(ratio, first, dtype=np.float64), last + 1 - first
    of = doc[last]
    start = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    total = lambda x: np.add.reduceat(x, start, dtype=np.float64)
    columns = [
        total(word) / total(length), np.maximum.reduceat(word / length, start), np.log1p(total(np.ones(len(word)))),
        *(np.log1p(total(word > level)) for level in LEVELS), np.log1p(total(np.maximum(0, word - LEVELS[0]))),
    ]
    out[of[start]] = np.stack(columns, axis=1)
    return out


def _lists(out: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))


def measure(spark: SparkSession, docs: DataFrame, ratios: Ratios, key: str, text: str, whole: bool = False) -> DataFrame:
    """(key, measure) of each text: log ratio by length of the text and of its most toxic word, logarithms of the number
    of words, of those above each level, and of how much they exceed the first level.

    With ``whole``, ``key`` is a struct of the whole row and ``text`` its field, so that a text travels once.
    """
    rows = docs.select(F.col(key).alias("key"), *([] if whole else [F.col(text).cast("string").alias("text")]))
    schema = texts.with_key(docs, key, "measure array<double>")
    if ratios.table is None:
        return _measured_by_join(rows, ratios.rows, text if whole else None, schema)
    shared = spark.sparkContext.broadcast(ratios.table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = char_classes()
        for batch in batches:
            data, offsets = texts.utf8(batch.column(0).field(text) if whole else batch.column(1))
            out = [_measures(data, offsets[i : j + 1], shared.value, classes) for i, j in texts.slices(offsets)]
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(np.concatenate(out))], ["key", "measure"])

    return texts.mapped(rows, run, schema)


def _measured_by_join(rows: DataFrame, ratios: DataFrame, field: str | None, schema: StructType) -> DataFrame:
    """The measures with a table of ratios of any size: a slice of documents is a row and meets those of its own codes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            _, offsets = texts.utf8(batch.column(0).field(field) if field else batch.column(1))
            for i, j in texts.slices(offsets, JOINED_BYTES):
                lists = [pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), c.slice(i, j - i)) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([pa.array([number]), *lists], ["slice", *batch.schema.names])
                number += 1

    def cells(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
        """Of each slice its row, keys and texts."""
        for r in range(batch.num_rows):
            keys, last = batch.column(1)[r].values, batch.column(2)[r].values if not field else None
            yield r, keys, *texts.utf8(keys.field(field) if field else last)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = char_classes()
        for batch in batches:
            for r, _, data, offsets in cells(batch):
                grams = np.unique(_coded(data, offsets, classes)[0])
                codes = np.append(grams * np.uint64(2), np.unique(grams >> np.uint64(CHAR_BITS)) * np.uint64(2) + np.uint64(1))
                slices = np.full(len(codes), batch.column(0)[r].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(slices), pa.array(codes.view(np.int64))], ["slice", "code"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = char_classes()
        for batch in batches:
            for r, keys, data, offsets in cells(batch):
                own = batch.column(batch.num_columns - 1)[r].values
                own = pa.array([], pa.struct([("code", pa.int64()), ("ratio", pa.float32())])) if own is None else own
                table = _table(own.field("code").to_numpy(), own.field("ratio").to_numpy())
                yield pa.RecordBatch.from_arrays([keys, _lists(_measures(data, offsets, table, classes))], ["key", "measure"])

    packed = StructType([StructField("slice", LongType()), *[StructField(f.name, ArrayType(f.dataType)) for f in rows.schema.fields]])
    slices = texts.stored(texts.mapped(rows, pack, packed), "slices")
    codes = texts.mapped(slices, code, "slice long, code long")
    own = codes.join(ratios.hint("merge"), "code").groupBy("slice").agg(F.collect_list(F.struct("code", "ratio")).alias("own"))
    return texts.mapped(slices.join(own.hint("merge"), "slice", "left").select(*slices.columns, "own"), run, schema)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights and, last, the offset of the logistic curve, by Newton's method on standardized columns."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    rows = np.hstack([(x - mean) / spread, np.ones((len(x), 1))])
    weights = np.zeros(rows.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (y - p) - ridge * weights
        bend = (rows.T * (p * (1 - p) + 1e-9)) @ rows + ridge * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    out = weights[:-1] / spread
    return np.append(out, weights[-1] - out @ mean)


@dataclass
class Model:
    ratios: Ratios
    weights: np.ndarray

    def score(self) -> Column:
        at = F.lit(float(self.weights[-1]))
        for i, w in enumerate(self.weights[:-1]):
            at = at + F.col("measure")[i] * float(w)
        return 1 / (1 + F.exp(-at))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> Model:
    """The models of both classes and the logistic curve over their measures."""
    ratios = train(docs, labels, key, text, label)
    of = texts.hashed_sample(_labelled(labels, key, label).filter(texts.train_fold(F.col("key")).isin(*CURVE_FOLDS)), "key", CURVE_ROWS)
    some = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(texts.train_fold(F.col("key")).isin(*CURVE_FOLDS))
    # Only what the curve is fitted on is measured; CURVE_ROWS bounds what is broadcast.
    some = some.join(F.broadcast(of.select("key")), "key", "left_semi")
    measured = measure(spark, some, ratios, "key", "text")
    rows = measured.join(of.hint("merge"), "key").select("measure", "label").toPandas()
    y = rows["label"].to_numpy(float)
    share = y.mean() if len(y) else 0.0
    if share in (0.0, 1.0):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(ratios, np.append(np.zeros(4 + len(LEVELS)), np.log(share / (1 - share))))
    return Model(ratios, logistic(np.stack(rows["measure"].to_numpy()), y))


def _labelled(labels: DataFrame, key: str, label: str) -> DataFrame:
    return labels.filter(F.col(label).isin(0, 1)).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))


def scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(key, measure, score) for each document."""
    model = fit(spark, docs, labels, key, text, label)
    return measure(spark, docs, model.ratios, key, text).withColumn("score", model.score())


def remove(spark: SparkSession, docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, limit: float = 0.5) -> DataFrame:
    """The documents with a score below the limit, with all their columns."""
    model = fit(spark, docs, labels, key, text, label)
    rows = docs.select(texts.whole_row(docs).alias("row"))
    return measure(spark, rows, model.ratios, "row", text, whole=True).filter(model.score() < limit).select("key.*")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    found = scores(spark, texts.table(spark, sf_dir, "documents"), texts.table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    return found.select(
        F.col("key").alias("doc_id"), texts.held_out(F.col("key")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
