import zlib

import odd
from pyspark.sql import functions as F

from tidemark.llm import langid


def test_held_out_languages_are_recognized(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    found = langid.op1_language_id(spark, sf).join(docs, "doc_id")
    held = found.filter("held_out")
    assert held.count() > 20
    assert held.filter("lang = lang_pred").count() / held.count() > 0.97
    rows = found.select("doc_id", "held_out", "score").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark):
    docs = odd.table(spark).withColumn("lang", F.when(F.col("doc_id") == 7, "xx").otherwise(F.col("lang")))
    models = list(langid.train(docs, "text", "lang"))
    assert [m.languages for m in models] == [["en", "xx"]]
    found = langid.predict(spark, docs, models, "doc_id", "text").collect()
    assert len(found) == len(odd.rows())
    by = {(r["key"], r["lang_pred"]) for r in found}
    assert {(3, "und"), (4, "und"), (5, "und"), (None, "und"), (7, "xx")} <= by
    assert all(r["score"] == 0 for r in found if r["lang_pred"] == "und")


def test_nothing_to_learn_from(spark):
    models = list(langid.train(odd.empty(spark), "text", "lang"))
    found = langid.predict(spark, odd.table(spark), models, "doc_id", "text").collect()
    assert {r["lang_pred"] for r in found} == {"und"}
    assert langid.predict(spark, odd.empty(spark), models, "doc_id", "text").count() == 0


def test_posterior_matches_plain_bayes(spark):
    """Against the same model written with dictionaries of n-grams; on few texts no two n-grams share a bucket."""
    import math
    from collections import Counter

    learn = [("en", "the cat and"), ("en", "that dog"), ("fr", "le chat et"), ("fr", "un chien que")]
    docs = spark.createDataFrame([(k, lang, t) for k, (lang, t) in enumerate(learn)], "doc_id long, lang string, text string")
    models = langid.train(docs, "text", "lang")
    grams = lambda t: [t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)]
    counts = {lang: Counter(g for l2, t in learn if l2 == lang for g in grams(t)) for lang in ("en", "fr")}
    size = 1 << langid.BITS
    text = "the chat"
    logs = {}
    for lang, c in counts.items():
        total = sum(c.values()) + langid.SMOOTHING * size
        logs[lang] = math.log(0.5) + sum(math.log((c[g] + langid.SMOOTHING) / total) for g in grams(text))
    best = max(logs, key=logs.get)
    share = 1 / sum(math.exp(v - logs[best]) for v in logs.values())
    found = langid.predict(spark, spark.createDataFrame([(1, text)], "doc_id long, text string"), models, "doc_id", "text").first()
    assert found["lang_pred"] == best and abs(found["score"] - share) < 1e-3


def test_blocks_of_languages_give_the_posterior_of_one_matrix(spark, monkeypatch):
    """Seven languages, two of them with equal texts, in one block and in blocks of two."""
    words = ["alpha beta", "gamma delta", "epsilon zeta", "eta theta", "iota kappa", "alpha beta", "mu nu"]
    learn = [(i, f"l{i}", w, k) for i, w in enumerate(words) for k in range(3)]
    docs = spark.createDataFrame(learn, "doc_id long, lang string, text string, k int")
    asked = docs.select("doc_id", "text").unionByName(odd.table(spark).select("doc_id", "text"))
    got = lambda: sorted((r["key"] is None, r["key"] or 0, r["lang_pred"], r["score"]) for r in langid.predict(spark, asked, langid.train(docs, "text", "lang"), "doc_id", "text").collect())
    whole = got()
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    assert [m.languages for m in langid.train(docs, "text", "lang")] == [["l0", "l1"], ["l2", "l3"], ["l4", "l5"], ["l6"]]
    parts = got()
    assert [r[:3] for r in whole] == [r[:3] for r in parts] and len(whole) == asked.count()
    assert max(abs(a[3] - b[3]) for a, b in zip(whole, parts)) < 1e-12
    assert {r[2] for r in parts if r[1] == 5 and not r[0]} >= {"l0"}  # equal texts: the smaller name


def test_more_languages_than_a_block_holds(spark):
    """130 labels, each with a letter of its own, at the production size of a block."""
    docs = spark.createDataFrame([(i, f"l{i:03}", chr(0x4E00 + i) * 8) for i in range(130)], "doc_id long, lang string, text string")
    found = langid.predict(spark, docs, langid.train(docs, "text", "lang"), "doc_id", "text").collect()
    assert len(found) == 130 and all(r["lang_pred"] == f"l{r['key']:03}" for r in found)
