import random
from collections import Counter

import odd
import pytest

from tidemark.llm import substrings


def plain(rows, window):
    """What stays of each text, by counting all its windows."""
    words = [(t or "").encode().split() for t in rows]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def kept(docs, window, seed):
    of = lambda data, words, stays: (b" ".join(data[a:b] for a, b in zip(words.starts[stays].tolist(), words.ends[stays].tolist())), len(stays))
    return substrings.kept(docs, "doc_id", "text", "left binary, n long", of, window=window, seed=seed)


@pytest.mark.parametrize("seed", range(4))
def test_matches_counting_all_windows(spark, seed):
    """Few different words give many repeats that begin and end anywhere."""
    pick = random.Random(seed)
    parts = [[pick.choice("abcd") for _ in range(pick.randrange(3, 30))] for _ in range(8)]
    texts = []
    for _ in range(40):
        words = []
        for _ in range(pick.randrange(0, 6)):
            words += pick.choice(parts) if pick.random() < 0.7 else [pick.choice("abcdefgh") for _ in range(10)]
        texts.append((" " * pick.randrange(1, 3)).join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["key"]: bytes(r["left"]) for r in kept(docs, 9, 3).collect()}
    assert [found[k] for k in range(len(texts))] == [b" ".join(w) for w in plain(texts, 9)]


def test_odd_rows(spark):
    rows = odd.rows()
    want = plain([r[1] for r in rows], 35)
    found = kept(odd.table(spark), 35, 8).collect()
    assert sorted((r["key"] is None, r["key"] or 0, bytes(r["left"])) for r in found) == sorted(
        (r[0] is None, r[0] or 0, b" ".join(w)) for r, w in zip(rows, want)
    )
    out = substrings.remove(odd.table(spark), "doc_id", "text")
    assert out.columns == odd.table(spark).columns
    left = out.select("doc_id", "text", "key", "row").collect()
    assert all(r["key"] == "k" and r["row"] == 1 for r in left)
    assert {r["doc_id"]: r["text"] for r in left}[3] is None and {r["doc_id"]: r["text"] for r in left}[7] == rows[11][1]
    assert substrings.remove(odd.empty(spark), "doc_id", "text").count() == 0


def test_rest_keeps_white_space(spark):
    passage = odd.prose(4, 40)
    docs = spark.createDataFrame([(1, f"a\n\tb  c {passage} d\n"), (2, f"x {passage}\ny z"), (3, " as  it \n was ")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in substrings.remove(docs, "doc_id", "text").collect()} == {1: "a\n\tb  c d", 2: "x y z", 3: " as  it \n was "}
