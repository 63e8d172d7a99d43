import random

import odd
import pytest

from tidemark.llm import decontaminate


def words(text):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(docs, items, window):
    out = {}
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            n = min(window, len(v))
            wins = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i : i + n]) in wins:
                    hit.update(range(i, i + n))
                    found.add(item)
        out[key] = (len(w), len(hit), found)
    return out


@pytest.mark.parametrize("block_bytes", [1 << 24, 60])
def test_matches_scanning_for_windows(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    pick = random.Random(1)
    text = lambda n: " ".join(pick.choice("abcde") for _ in range(n))
    docs = [(k, text(pick.randrange(0, 60))) for k in range(60)]
    items = [(k, text(pick.choice([0, 1, 4, 5, 6, 9, 12, 20]))) for k in range(1, 14)] + [(50, docs[3][1]), (51, docs[3][1])]
    found = decontaminate.matches(
        spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
        "doc_id", "text", "item_id", "text", 5,
    ).withColumn("hit", decontaminate.n_hit()).collect()
    want = plain(docs, [(str(i), t) for i, t in items], 5)
    assert {r["key"]: (r["n_words"], r["hit"], {m["item"] for m in r["matches"]}) for r in found} == want


def test_matches_are_the_longest(spark):
    item = odd.prose(8, 50)
    doc = "x y " + " ".join(item.split()[7:32]) + " z"
    docs, items = spark.createDataFrame([(1, doc.upper())], "doc_id long, text string"), spark.createDataFrame([(5, item)], "item_id long, text string")
    (row,) = decontaminate.matches(spark, docs, items, "doc_id", "text", "item_id", "text").collect()
    assert [tuple(m) for m in row["matches"]] == [("5", 7, 2, 25)]


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, None, 3), (None, "alpha1", 3), (2, "", 3), (3, "One TWO", 3), (4, odd.prose(2, 30_000), 3)], "item_id long, text string, key int")
    docs = odd.table(spark)
    kept = decontaminate.remove(spark, docs, items, "text", "item_id", "text")
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.select("doc_id").collect()) == [
        (False, k) for k in (3, 4, 4, 5, 6, 8, 10)
    ] + [(True, 0)] * 2
    assert decontaminate.remove(spark, odd.empty(spark), items, "text", "item_id", "text").count() == 0
    assert decontaminate.remove(spark, docs, items.limit(0), "text", "item_id", "text").count() == len(odd.rows())


def test_items_without_an_id_are_found(spark):
    docs = spark.createDataFrame([(1, "a secret word here"), (2, "nothing of it")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "secret word"), (7, "secret word"), (8, None)], "item_id long, text string")
    found = {r["key"]: sorted(map(tuple, r["matches"]), key=repr) for r in decontaminate.matches(spark, docs, items, "doc_id", "text", "item_id", "text").collect()}
    assert found == {1: [("7", 0, 1, 2), (None, 0, 1, 2)], 2: []}


def test_blocks_are_bounded_when_an_item_is_repeated(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 40)
    rows = [(1, "one two three")] * 50 + [(k, f"item {k} text") for k in range(2, 12)]
    seen, plain_tests = [], decontaminate._scanner
    monkeypatch.setattr(decontaminate, "_scanner", lambda shared, *a: (seen.append(shared.value), plain_tests(shared, *a))[1])
    docs = spark.createDataFrame([(1, "one two three item 5 text")], "doc_id long, text string")
    found = decontaminate.matches(spark, docs, spark.createDataFrame(rows, "item_id long, text string"), "doc_id", "text", "item_id", "text").collect()
    assert sorted(m["item"] for m in found[0]["matches"]) == ["1", "5"]
    assert len(seen) > 1 and all(sum(len(t) for _, t in block) <= 40 for block in seen) and sum(map(len, seen)) == 11
