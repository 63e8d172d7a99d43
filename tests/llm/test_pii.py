import hashlib
import itertools
import re

import numpy as np
import odd
import pytest

from tidemark.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    """The base spans by the patterns as they stand."""
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and plain_luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((kind, *m.span()))
    return out


def valid_card(seed, size=16):
    pick = np.random.default_rng(seed)
    head = "".join(map(str, pick.integers(0, 10, size - 1)))
    return next(head + d for d in "0123456789" if plain_luhn(head + d))


def test_base_spans_of_mixed_characters():
    pick = np.random.default_rng(0)
    pieces = ["@", ".", "a", "_", "é", " ", "-", "+", "1", "25", "300", "(", ")", "a@b.c", "1.2.3.4", "+1 (555) 010-7777", "\n", "0255", valid_card(1), valid_card(2, 19)]
    for _ in range(4000):
        text = "".join(pick.choice(pieces, pick.integers(1, 25)))
        assert pii.base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["a" * 400_000, "1" * 400_000, "1." * 200_000, "@" * 300_000, "a@" * 200_000, "a@b" * 100_000, "+" * 300_000, "+1 (" * 100_000, "1 " * 300_000, "." * 300_000])
def test_time_is_linear(text):
    pii.Tokens(text, pii.base_spans(text))


def brute_marginals(field, scores, joined, groups, observed):
    n, hubs = len(scores), max(groups) + 1
    out = np.zeros((n, pii.STATES))
    for labels in itertools.product(range(pii.STATES), repeat=n):
        if any(o >= 0 and o != s for o, s in zip(observed, labels)):
            continue
        base = sum(scores[i][s] for i, s in enumerate(labels))
        for i, s in enumerate(labels):
            base += field.step[labels[i - 1], s] if joined[i] else field.first[s]
            base += field.last[s] if i == n - 1 or not joined[i + 1] else 0
        weight = 0
        for kinds in itertools.product(range(pii.GROUPS), repeat=hubs):
            agreed = sum(g >= 0 and pii.OF_KIND[s] == kinds[g] for s, g in zip(labels, groups))
            weight += np.exp(base + field.skip * agreed)
        for i, s in enumerate(labels):
            out[i, s] += weight
    return out / out.sum(axis=1, keepdims=True)


def test_messages_are_exact_on_trees():
    """Two chains that one hub connects, every label summed over."""
    pick = np.random.default_rng(5)
    field = pii.Field()
    field.unary, field.step = pick.normal(size=field.unary.shape), pick.normal(size=field.step.shape)
    field.first, field.last, field.skip = pick.normal(size=pii.STATES), pick.normal(size=pii.STATES), 1.7
    found = pick.integers(0, pii.BUCKETS, (5, pii.WIDTH))
    joined, groups = np.array([False, True, False, True, False]), np.array([-1, 0, 0, -1, 0])
    for observed in ([-1] * 5, [-1, -1, -1, -1, 5]):
        expected = brute_marginals(field, field.local(found), joined, groups, observed)
        assert np.allclose(field.marginals(found, joined, groups, np.array(observed)), expected, atol=1e-6)


def corpus(n=120):
    words = "the mill stands by a slow river where barges pass and children count them".split()
    pick = np.random.default_rng(7)
    prose = lambda: " ".join(pick.choice(words, 12))
    docs = []
    for i in range(n):
        phone = f"+1 ({pick.integers(100, 999)}) 555-{pick.integers(1000, 9999)}"
        address = f"{pick.choice(words)}.{pick.integers(10, 99)}@mail{pick.integers(1, 9)}.example.com"
        items = [phone, phone, address, valid_card(i), f"{pick.integers(1, 255)}.{pick.integers(1, 255)}.7.9", str(pick.integers(1, 10**9)), f"{pick.integers(1, 99)}%", "2024-05-01"]
        docs.append(" ".join(f"{prose()} {item}" for item in pick.permutation(items)))
    return docs


@pytest.fixture(scope="module")
def learned(spark):
    return pii.learn(spark.createDataFrame([(t,) for t in corpus()], "text string"), "text")


def added(field, text):
    base = pii.base_spans(text)
    (more,) = pii.added_spans(field, [pii.Tokens(text, base)], [base])
    return [(kind, text[s:e]) for kind, s, e in more]


def test_similar_tokens_far_apart_agree(learned):
    middle = " and so the river went on " * 200
    assert learned.learned and learned.skip > 3
    found = added(learned, f"call +1 (372) 555-4417 today{middle}or (372) 555-4417, as said")
    assert any(kind == "phone" and "555-4417" in text for kind, text in found)
    assert added(learned, f"write to mill.42@mail3.example.com{middle}or ask mill.42 there") == [("email", "mill.42")]


def test_nothing_is_added_where_nothing_is_shared(learned):
    for text in ["", "no token here", "in 1999 there were 372 of 555 mills", "it says 372 555-4417 there", "order 4929123412341234 of 2024-05-01", "v1.2.3 and 300.1.1.1"]:
        assert added(learned, text) == []
    assert [added(learned, t) for t in corpus(40)] == [[]] * 40


def test_unlearned_field_adds_nothing(spark):
    field = pii.learn(spark.createDataFrame([("only 7 numbers 8",), (None,)], "text string"), "text")
    assert added(field, "+1 (372) 555-4417 or (372) 555-4417") == []


def test_odd_rows(spark, learned):
    for field in (learned, pii.learn(odd.empty(spark), "text")):
        found = pii.find(odd.table(spark), "doc_id", "text", field).collect()
        texts = [r[1] for r in odd.rows()]
        assert len(found) == len(texts)
        assert sorted((str(r["key"]), len(r["spans"])) for r in found) == sorted((str(i), len(plain(t))) for i, t, *_ in odd.rows())
    assert pii.find(odd.empty(spark), "doc_id", "text", learned).count() == 0


def test_query(spark, sf):
    """Base spans against the patterns; what is added lies apart from them."""
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = pii.op13_pii(spark, sf).collect()
    assert len(found) == len(docs)
    for r in found:
        base = plain(docs[r["doc_id"]])
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in base) for k in PLAIN]
        every = [tuple(s.split(":")) for s in r["spans"].split(",") if s]
        assert {(k, str(s), str(e)) for k, s, e in base} <= set(every)
        assert every == sorted(every, key=lambda s: (list(PLAIN).index(s[0]), int(s[1])))
