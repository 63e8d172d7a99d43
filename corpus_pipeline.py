"""The corpus pipeline: documents pass through stages, each written as Parquet and read again.

Toxic documents go, one document of each near-duplicate class stays, repeated passages are cut out of the texts,
documents that hold benchmark passages go, and what is left is encoded. All stages but the last return the columns of
``documents``; ``n_chars`` follows the text.

Defined cases, in every stage: a null text has no words and stays null until it is encoded as an empty one; texts without
a word are copies of each other, so one of them stays. Rows with a null ``doc_id`` pass like others; of repeated rows one
stays, of a class of near duplicates the row of the least id, then of the least text. Very long texts are read whole.
Empty tables give empty tables; without labels no document is toxic. Columns beyond those of ``documents`` are handed
through, whatever their names. The last stage returns ``doc_id, n_tokens, ids_sha256, decoded_sha256, ids``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, neardup, substrings, toxicity
from tidemark.llm import text as texts
from tidemark.shared import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.remove(spark, docs, texts.table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.remove(docs, "doc_id", "text")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.remove(docs, "doc_id", "text").withColumn("n_chars", F.length("text").cast("long"))


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(spark, docs, texts.table(spark, sf_dir, "benchmark"), "text", "item_id", "text")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = bpe.digests(spark, docs, bpe.default_vocabulary(), "doc_id", "text", with_ids=True)
    return found.withColumnRenamed("key", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("benchmarks", benchmarks),
    ("tokens", tokens),
]

# Models, sketches and tokenizers are beyond SQL; tests/llm/test_pipeline_plain.py holds every stage against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
