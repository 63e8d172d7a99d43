import math
import random
from collections import Counter, defaultdict

import numpy as np
import odd

from tidemark.llm import text as texts
from tidemark.llm import toxicity

N, D = toxicity.ORDER, toxicity.DISCOUNT


def grams_of(text):
    """The 4-grams of each word, short ones at its begin, with the space that ends it."""
    out = []
    for word in "".join(c.lower() if c.isalnum() else " " for c in text).split():
        padded = word + " "
        out.append([padded[max(0, i + 1 - N) : i + 1] for i in range(len(padded))])
    return out


def plain_model(rows):
    """Kneser-Ney by dictionaries: shared continuation counts below, a count of each class on top."""
    counts = {c: Counter(g.rjust(N, "_") for t, label in rows if label == c for w in grams_of(t) for g in w) for c in (1, 0)}
    seen = set(counts[1]) | set(counts[0])
    levels, types = {}, seen
    for n in range(N - 1, 0, -1):
        levels[n] = Counter(g[-n:] for g in types)
        types = set(levels[n])

    def shared(g):
        n = len(g)
        context = [v for k, v in levels[n].items() if k[:-1] == g[:-1]]
        lower = shared(g[1:]) if n > 1 else 1 / (1 << toxicity.CHAR_BITS)
        return (levels[n][g] - D + D * len(context) * lower) / sum(context)

    contexts = {c: defaultdict(list) for c in (1, 0)}
    for c in (1, 0):
        for g, v in counts[c].items():
            contexts[c][g[:-1]].append(v)

    def ratio(g):
        g = g.rjust(N, "_")
        back = {c: D * len(v) / sum(v) if (v := contexts[c].get(g[:-1])) else 1.0 for c in (1, 0)}
        if g not in seen:
            return math.log(back[1] / back[0])
        p = shared(g[1:])
        own = {c: ((counts[c][g] - D) / sum(contexts[c][g[:-1]]) if counts[c][g] else 0) + back[c] * p for c in (1, 0)}
        return math.log(own[1] / own[0])

    def measure(text):
        words = [(sum(map(ratio, w)), len(w)) for w in grams_of(text)]
        if not words:
            return [0.0] * (4 + len(toxicity.LEVELS))
        above = [math.log1p(sum(r > level for r, _ in words)) for level in toxicity.LEVELS]
        over = math.log1p(sum(max(0.0, r - toxicity.LEVELS[0]) for r, _ in words))
        whole = sum(r for r, _ in words) / sum(n for _, n in words)
        return [whole, max(r / n for r, n in words), math.log1p(len(words)), *above, over]

    return measure


def test_measure_matches_plain_kneser_ney(spark):
    rows = [("you stupid clown, be gone", 1), ("what a stupid thing", 1), ("the clown was kind", 0), ("what a day it was", 0), ("gone with the wind", 0)] * 2
    ids = [i for i in range(200) if __import__("zlib").crc32(str(i).encode()) % 5 in toxicity.COUNT_FOLDS][: len(rows)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in zip(ids, rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i, (_, label) in zip(ids, rows)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, "doc_id", "text", "toxic")
    want = plain_model(rows)
    tests = ["stupidity", "a clowns day", "the wind", "unheard", "", "Stupid", "what, then? gone."]
    found = toxicity.measure(spark, spark.createDataFrame(list(enumerate(tests)), "id int, text string"), model, "id", "text").collect()
    for r in found:
        assert np.allclose(r["measure"], want(tests[r["key"]]), atol=1e-4), tests[r["key"]]


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = toxicity.op3_toxicity(spark, sf).filter("held_out").join(labels, "doc_id")
    toxic, plain = held.filter("toxic = 1"), held.filter("toxic = 0")
    assert toxic.filter("predicted = 1").count() / toxic.count() > 0.85
    assert plain.filter("predicted = 0").count() / plain.count() > 0.99


def test_odd_rows(spark):
    docs, labels = odd.table(spark), spark.createDataFrame([(0, 1, "x"), (0, 0, "y"), (1, None, "z"), (None, 1, "q")], "doc_id long, toxic int, text string")
    found = toxicity.scores(spark, docs, labels, "doc_id", "text", "toxic").collect()
    assert len(found) == len(odd.rows()) and all(0 <= r["score"] <= 1 for r in found)
    assert all(not any(r["measure"]) for r in found if r["key"] in (3, 4))
    kept = toxicity.remove(spark, docs, labels, "doc_id", "text", "toxic")
    assert kept.columns == docs.columns
    assert toxicity.scores(spark, odd.empty(spark), labels.limit(0), "doc_id", "text", "toxic").count() == 0


def test_logistic_finds_the_curve():
    x = np.repeat(np.linspace(-2, 2, 41), 2000)[:, None]
    y = (np.tile(np.arange(2000) + 0.5, 41) / 2000 < 1 / (1 + np.exp(-(3 * x[:, 0] - 1)))).astype(float)
    slope, offset = toxicity.logistic(x, y)
    assert abs(slope - 3) < 0.02 and abs(offset + 1) < 0.02


def test_no_gram_crosses_a_document():
    data, offsets = texts.utf8(__import__("pyarrow").array(["ab", "", "cd e"]))
    grams, ends, doc = toxicity._coded(data, offsets, toxicity.char_classes())
    assert ends.sum() == 3 and doc[ends].tolist() == [0, 2, 2] and len(grams) == 3 + 3 + 2


def test_no_ratio_is_lost_among_many(spark):
    """With some 200,000 different 4-grams and contexts every word still has the ratio of plain Kneser-Ney."""
    pick = random.Random(4)
    some = ["".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(40_000)]
    ids = [i for i in range(400) if __import__("zlib").crc32(str(i).encode()) % 5 in toxicity.COUNT_FOLDS][:100]
    rows = [(i, " ".join(some[400 * k : 400 * k + 400]), k % 2) for k, i in enumerate(ids)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i, _, label in rows], "doc_id long, toxic int")
    want = plain_model([(t, label) for _, t, label in rows])
    model = toxicity.train(docs, labels, "doc_id", "text", "toxic")
    found = toxicity.measure(spark, spark.createDataFrame(list(enumerate(some[::400])), "id int, text string"), model, "id", "text").collect()
    assert all(np.allclose(r["measure"], want(some[400 * r["key"]]), atol=1e-4) for r in found)


def test_join_gives_what_the_table_gives(spark, monkeypatch):
    docs = odd.table(spark).unionByName(spark.createDataFrame([(100 + k, odd.prose(k, 60)) for k in range(60)], "doc_id long, text string"), allowMissingColumns=True)
    labels = spark.createDataFrame([(100 + k, k % 2) for k in range(60)], "doc_id long, toxic int")
    want = toxicity.scores(spark, docs, labels, "doc_id", "text", "toxic").collect()
    kept = toxicity.remove(spark, docs, labels, "doc_id", "text", "toxic").collect()
    monkeypatch.setattr(toxicity, "TABLE_ENTRIES", 1)
    monkeypatch.setattr(toxicity, "JOINED_BYTES", 1000)
    assert toxicity.train(docs, labels, "doc_id", "text", "toxic").table is None
    assert sorted(map(repr, toxicity.scores(spark, docs, labels, "doc_id", "text", "toxic").collect())) == sorted(map(repr, want))
    assert sorted(map(repr, toxicity.remove(spark, docs, labels, "doc_id", "text", "toxic").collect())) == sorted(map(repr, kept))
