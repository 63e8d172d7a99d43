"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of every labelled training text inside Spark tasks and sums them by (language, bucket);
the log-probability matrix has a fixed number of buckets for each language, and that is all that is broadcast.
Scoring takes a slice of documents as sparse rows (bucket numbers with row offsets) and sums their log
probabilities with numpy. Languages beyond ``MAX_LANGUAGES`` come in blocks, in order of their names: each block is learned,
broadcast and scored by itself, and each row takes its best language so far, its log probability and the sum of all
probabilities relative to it on to the next block. So any number of languages gives the posterior of one matrix.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing could be
learned. Ties go to the smaller language name. Repeated rows are scored each. Other columns are ignored. Very long
texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as texts

BITS = 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
MAX_LANGUAGES = 100  # of a block: rows of 2^16 numbers, 26 MB in all, which bounds what is collected and broadcast at a time
UNKNOWN = "und"


@dataclass
class Model:
    """A block of languages; ``prior`` is over all blocks."""

    languages: list[str]
    prior: np.ndarray
    logp: np.ndarray  # languages x (buckets + 1); the last column, for n-grams across documents, is 0


def _buckets(codes: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each order the bucket of the n-gram that starts at each character."""
    none = 1 << BITS
    rolling = np.zeros(len(codes), np.uint64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for n in range(1, max(ORDERS) + 1):
        if len(codes) < n:
            return
        head = len(codes) - n + 1
        rolling = rolling[:head] * np.uint64(texts.WORD_BASE) + codes[n - 1 :].astype(np.uint64) + np.uint64(1)
        if n in ORDERS:
            mixed = (rolling ^ (rolling >> np.uint64(29))) * np.uint64(texts.MIX_1)
            out = np.full(len(codes), none, np.int64)
            out[:head] = (mixed >> np.uint64(64 - BITS)).astype(np.int64)
            if n > 1:
                out[:head][row[:head] != row[n - 1 :]] = none
            yield out


def _lowered(data: np.ndarray, at: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes, offsets = texts.code_points(data[at[0] : at[-1]], at - at[0])
    low = codes < len(lower)
    return np.where(low, lower[np.where(low, codes, 0)], codes), offsets


def _counter(languages: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower, width = texts.lower_table(), (1 << BITS) + 1
        sums = np.zeros((len(languages), width), np.int64)
        for batch in batches:
            data, offsets = texts.utf8(batch.column(0))
            langs = np.array(batch.column(1).to_pylist(), object)
            for i, j in texts.slices(offsets):
                codes, at = _lowered(data, offsets[i : j + 1], lower)
                features = list(_buckets(codes, at))
                for k, lang in enumerate(languages):
                    chars = np.repeat(langs[i:j] == lang, np.diff(at))
                    if chars.any():
                        for f in features:
                            sums[k] += np.bincount(f[chars], minlength=width)
        for k, row in enumerate(sums):
            seen = np.flatnonzero(row[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), k, np.int32)), pa.array(seen.astype(np.int32)), pa.array(row[seen])],
                ["lang", "bucket", "n"],
            )

    return count


def train(docs: DataFrame, text: str, label: str) -> Iterator[Model]:
    """Learn from every row whose text and label are not null: one model for each block of languages, made when it is asked for.

    Without languages there is one model without any.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(label).cast("string").alias("lang")).dropna()
    per_lang = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    block = per_lang.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(block) <= MAX_LANGUAGES:
        yield _block(rows, block, sum(r["docs"] for r in block))
        return
    per_lang = texts.stored(per_lang, "languages")
    total = per_lang.agg(F.sum("docs").alias("docs")).first()["docs"]
    block = per_lang.orderBy("lang").limit(MAX_LANGUAGES).collect()
    while block:
        yield _block(rows.where(F.col("lang").isin([r["lang"] for r in block])), block, total)
        block = per_lang.where(F.col("lang") > F.lit(block[-1]["lang"])).orderBy("lang").limit(MAX_LANGUAGES).collect()


def _block(rows: DataFrame, block: list, total: int) -> Model:
    languages = [r["lang"] for r in block]
    counts = np.full((len(languages), 1 << BITS), SMOOTHING)
    found = (
        texts.mapped(rows, _counter(languages), "lang int, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    counts[found["lang"].to_numpy(int), found["bucket"].to_numpy(int)] += found["n"].to_numpy(float)
    logp = np.zeros((len(languages), (1 << BITS) + 1), np.float32)
    docs_of = np.array([r["docs"] for r in block], float)
    if languages:
        logp[:, :-1] = np.log(counts / counts.sum(axis=1, keepdims=True))
    return Model(languages, np.log(docs_of / max(total, 1)), logp)


def _scorer(shared, last: bool):
    """Rows of key, text, and what earlier blocks left: the best language, its log probability, and all mass relative to it."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, prior, logp = shared.value
        lower = texts.lower_table()
        for batch in batches:
            data, offsets = texts.utf8(batch.column(1))
            names = np.array(batch.column(2).to_pylist(), object)
            tops, mass = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in (3, 4))
            for i, j in texts.slices(offsets) if languages else ():
                codes, at = _lowered(data, offsets[i : j + 1], lower)
                full = np.flatnonzero(np.diff(at))
                if not len(full):
                    continue
                total = np.tile(prior, (len(full), 1))
                for f in _buckets(codes, at):
                    for k in range(len(languages)):
                        total[:, k] += np.add.reduceat(logp[k][f], at[full], dtype=np.float64)
                best, here = total.argmax(axis=1), i + full
                top = np.maximum(total.max(axis=1), tops[here])
                mass[here] = mass[here] * np.exp(tops[here] - top) + np.exp(total - top[:, None]).sum(axis=1)
                names[here] = np.where(top > tops[here], np.array(languages, object)[best], names[here])
                tops[here] = top
            if not last:
                columns = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(tops), pa.array(mass)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "text", "lang_pred", "top", "mass"])
                continue
            scores = np.divide(1.0, mass, out=np.zeros(len(mass)), where=mass > 0)
            # texts are looked at one by one only up to their first letter
            for r, value in enumerate(batch.column(1).to_pylist()):
                if names[r] is None or value is None or not any(map(str.isalpha, value)):
                    names[r], scores[r] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)], ["key", "lang_pred", "score"])

    return score


def predict(spark: SparkSession, docs: DataFrame, models: Iterable[Model], key: str, text: str) -> DataFrame:
    """(key, lang_pred, score) for each row; score is the posterior of the predicted language among those of all models.

    Each block but the last is written before its broadcast is given up.
    """
    start = [F.lit(None).cast("string").alias("lang_pred"), F.lit(float("-inf")).alias("top"), F.lit(0.0).alias("mass")]
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), *start)
    models = iter(models)
    model = next(models)
    while True:
        shared = spark.sparkContext.broadcast((model.languages, model.prior, model.logp))
        model = next(models, None)
        if model is None:
            return texts.mapped(rows, _scorer(shared, True), texts.with_key(docs, key, "lang_pred string, score double"))
        state = texts.with_key(docs, key, "text string, lang_pred string, top double, mass double")
        rows = texts.stored(texts.mapped(rows, _scorer(shared, False), state), "language-block")
        shared.unpersist()


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the folds that are not held out."""
    docs = texts.table(spark, sf_dir, "documents")
    models = train(docs.filter(texts.train_fold(F.col("doc_id")) != 0), "text", "lang")
    found = predict(spark, docs, models, "doc_id", "text")
    return found.select(F.col("key").alias("doc_id"), texts.held_out(F.col("key")).alias("held_out"), "lang_pred", "score")
