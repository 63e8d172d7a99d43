import random

import numpy as np
import odd
import pyarrow as pa
import pytest

from tidemark.llm import neardup
from tidemark.llm import text as texts
from tidemark.llm.components import components


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def changed(pick, words, edits, alphabet):
    out = list(words)
    for _ in range(edits):
        k, how = pick.randrange(len(out) + 1), pick.randrange(3)
        if how == 0 or not out:
            out.insert(k, pick.randrange(alphabet))
        elif how == 1:
            out[min(k, len(out) - 1)] = pick.randrange(alphabet)
        else:
            del out[min(k, len(out) - 1)]
    return out


@pytest.mark.parametrize("alphabet", [3, 50])
def test_alignment_is_exact(alphabet):
    pick = random.Random(alphabet)
    pairs = []
    for _ in range(500):
        a = [pick.randrange(alphabet) for _ in range(pick.randrange(0, 70))]
        pairs.append((np.array(a, np.int32), np.array(changed(pick, a, pick.randrange(0, 25), alphabet), np.int32)))
    want = [distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9) for a, b in pairs]
    assert 50 < sum(want) < 450
    assert neardup.aligned(pairs).tolist() == want


def test_sketch_minds_occurrences_and_order():
    def of(*values):
        data, offsets = texts.utf8(pa.array(values))
        return neardup.sketch(texts.Words(data, offsets, *texts.folded_words()))[0]

    a, b = odd.prose(5, 40), odd.prose(6, 40)
    same = of(f"{a} {b}", f"{a} {b}", f"{b} {a}", "one two", "")
    assert (same[0] == same[1]).all() and (same[3] == 0).all() and (same[4] == 0).all()
    assert (same[0] != same[2]).any()
    assert (of(a)[0] != of(f"{a} {a}")[0]).any()


def test_shingle_sets_and_order_both_count():
    pick = random.Random(0)
    words = [pick.randrange(10**6) for _ in range(200)]
    again = words[100:] + words[:100]
    repeated = [7, 8] * 300 + [pick.randrange(10**6) for _ in range(60)]
    other = [7, 8] * 300 + [pick.randrange(10**6) for _ in range(60)]
    few = [*words[:50], 5, *words[51:]]
    pairs = [(np.array(a, np.int32), np.array(b, np.int32)) for a, b in ((words, again), (repeated, other), (words, few), (words, words), ([1], [1]))]
    assert neardup.similar(pairs).tolist() == [False, False, True, True, False]


def within(a, b, most):
    """The edit distance by furthest reaching diagonals, or ``most`` + 1 if it is greater."""
    reach = {0: 0}
    for edits in range(most + 1):
        new = {}
        for d in range(-edits, edits + 1):
            x = max(reach.get(d, -1) + (edits > 0), reach.get(d - 1, -1), reach.get(d + 1, -2) + 1) if edits else 0
            if edits and d - 1 in reach:
                x = max(x, reach[d - 1])
            x = min(x, len(a), len(b) - d)
            if x < 0 or x + d < 0:
                continue
            while x < len(a) and x + d < len(b) and a[x] == b[x + d]:
                x += 1
            new[d] = x
        if new.get(len(b) - len(a)) == len(a):
            return edits
        reach = new
    return most + 1


def test_diagonals_give_the_distance():
    pick = random.Random(2)
    for _ in range(300):
        a = [pick.randrange(5) for _ in range(pick.randrange(0, 30))]
        b = changed(pick, a, pick.randrange(0, 12), 5)
        assert within(a, b, 40) == distance(a, b)


def brute(rows):
    """Classes by comparing all pairs of texts."""
    data, offsets = texts.utf8(pa.array([t for _, t in rows], pa.string()))
    words = texts.Words(data, offsets, *texts.folded_words())
    lists = [words.hashes[a:b].astype(np.int64) >> 32 for a, b in zip(words.docs[:-1], words.docs[1:])]
    part = list(range(len(rows)))
    first = {}
    for k, x in enumerate(lists):  # copies, also of fewer than five words
        part[k] = first.setdefault(x.tobytes(), k)

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    shingles = [{tuple(x[k : k + 5].tolist()) for k in range(len(x) - 4)} for x in lists]
    for i in range(len(rows)):
        for j in range(i):
            common = len(shingles[i] & shingles[j])
            if common and root(i) != root(j) and 10 * common >= 8 * len(shingles[i] | shingles[j]):
                longer = max(len(lists[i]), len(lists[j]))
                if 10 * within(lists[i].tolist(), lists[j].tolist(), longer // 5) <= 2 * longer:
                    part[max(root(i), root(j))] = min(root(i), root(j))
    return [rows[root(i)][0] for i in range(len(rows))]


def test_query_matches_all_pairs(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    found = {r["doc_id"]: r["class_id"] for r in neardup.op6_near_duplicates(spark, sf).collect()}
    assert [found[i] for i, _ in rows] == brute(rows)


def test_repeated_lines_match_all_pairs(spark):
    """Near duplicates by their sets whose multisets have little in common: one word of a line replaced in all its repeats."""
    rows = []
    for k in range(12):
        body, line = odd.prose(1000 + k, 60), [f"w{k}x{i}" for i in range(10)]
        rows.append((2 * k, body + " " + " ".join(line * 200)))
        line[4] = "other"
        rows.append((2 * k + 1, body + " " + " ".join(line * 200)))
    # Four and five shingles, four of them the same: exactly at the limit.
    rows += [(100 + 2 * k + more, " ".join(f"s{k}x{i}" for i in range(8 + more))) for k in range(40) for more in (0, 1)]
    found = {r["key"]: r["class_id"] for r in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    assert brute(rows) == [i - i % 2 for i, _ in rows]
    assert [found[i] for i, _ in rows] == brute(rows)


def test_set_sketches_find_pairs_at_the_limit():
    """Sets of 400 shingles at a Jaccard similarity of 0.8: every pair meets in a set sketch, and in about 0.512 of them."""
    data, offsets = texts.utf8(pa.array([t for k in range(300) for t in (odd.prose(k, 360) + " " + odd.prose(k + 5000, 44), odd.prose(k, 360) + " " + odd.prose(k + 9000, 44))]))
    out = neardup.sketch(texts.Words(data, offsets, *texts.folded_words()))[0][:, neardup.SKETCHES :]
    same = out[::2] == out[1::2]
    assert same.any(axis=1).all() and 0.48 < same.mean() < 0.55


def test_groups_need_several_rounds(spark):
    """Texts that share a passage but are no copies, and chains of copies, fall into the right classes."""
    pick = random.Random(9)
    passage = odd.prose(77, 30)
    rows = [(k, passage + " " + odd.prose(100 + k, 12)) for k in range(30)]
    chain = odd.prose(500, 100).split()
    for k in range(30, 50):
        rows.append((k, " ".join(chain)))
        for _ in range(1):
            chain[pick.randrange(len(chain))] = f"new{pick.randrange(10**6)}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["key"]: r["class_id"] for r in neardup.classes(docs, "doc_id", "text").collect()}
    assert [found[i] for i, _ in rows] == brute(rows)
    assert len({found[k] for k in range(30)}) == 30 and len({found[k] for k in range(30, 50)}) == 1


def test_odd_rows(spark):
    found = [(r["key"], r["class_id"]) for r in neardup.classes(odd.table(spark), "doc_id", "text").collect()]
    assert len(found) == len(odd.rows())
    assert sorted(c for k, c in found if k in (0, 1, 2)) == [0] * 4
    assert {c for k, c in found if k in (3, 4)} == {3} and {(9, 9), (10, 10), (7, 7)} <= set(found)
    kept = neardup.remove(odd.table(spark), "doc_id", "text")
    assert kept.columns == odd.table(spark).columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.select("doc_id").collect()) == [(False, k) for k in (0, 3, 5, 6, 7, 8, 9, 10)] + [(True, None)]
    assert neardup.classes(odd.empty(spark), "doc_id", "text").count() == 0
    assert neardup.remove(odd.empty(spark), "doc_id", "text").count() == 0


def test_components(spark):
    pick = random.Random(2)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1100)] + [(5, 5), (2000, 2000)]
    found = {r["node"]: r["part"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    part = {n: n for e in edges for n in e}
    for _ in range(400):
        for a, b in edges:
            part[a] = part[b] = min(part[a], part[b])
    assert found == part
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_the_survivor_does_not_depend_on_chance(spark):
    """One key with three spellings of the same words: the least text stays, wherever its row lies."""
    rows = [(5, "Alpha beta"), (5, "alpha, BETA"), (5, "ALPHA beta"), (6, "alpha beta"), (7, None), (7, "")]
    for parts in (1, 2, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        assert sorted(map(tuple, neardup.remove(df, "doc_id", "text").collect())) == [(5, "ALPHA beta"), (7, None)]
