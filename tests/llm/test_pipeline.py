import corpus_pipeline
import pytest

from tidemark.llm import bpe, decontaminate, neardup, substrings, toxicity


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The documents before and after each stage, each written and read as run() does."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.materialize(stage(spark, out[-1], sf), name))
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_each_stage_does_what_its_operator_says(spark, sf, stages):
    docs, after_toxic, after_near, after_passages, after_benchmarks, tokens = stages
    labels, benchmark = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    scores = toxicity.scores(spark, docs, labels, "doc_id", "text", "toxic")
    assert ids(after_toxic) == {r["key"] for r in scores.filter("score < 0.5").collect()}
    classes = neardup.classes(after_toxic, "doc_id", "text").collect()
    assert ids(after_near) == {r["class_id"] for r in classes} and after_near.count() == len({r["class_id"] for r in classes})
    kept = {r["key"]: r["kept_sha256"] for r in substrings.kept(after_near, "doc_id", "text", "n_words long, n_removed long, kept_sha256 string", substrings.digest).collect()}
    import hashlib

    for r in after_passages.collect():
        assert hashlib.sha256(b" ".join(r["text"].encode().split())).hexdigest() == kept[r["doc_id"]] and r["n_chars"] == len(r["text"])
    found = decontaminate.matches(spark, after_passages, benchmark, "doc_id", "text", "item_id", "text")
    assert ids(after_benchmarks) == {r["key"] for r in found.collect() if not r["matches"]}
    want = {tuple(r) for r in bpe.digests(spark, after_benchmarks, bpe.default_vocabulary(), "doc_id", "text").collect()}
    assert {tuple(r) for r in tokens.drop("ids").collect()} == want
    for before, after in zip(stages[:-2], stages[1:-1]):
        assert before.columns == after.columns and before.dtypes == after.dtypes
    assert all(a.count() >= b.count() > 0 for a, b in zip(stages, stages[1:]))


def test_run_gives_the_last_stage(spark, sf, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).drop("ids").collect())) == sorted(map(tuple, stages[-1].drop("ids").collect()))
