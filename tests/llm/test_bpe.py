import numpy as np
import odd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe
from tidemark.llm.presplit import Presplit

VOCABULARY = bpe.default_vocabulary()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def own():
    automaton = bpe.read_vocabulary(VOCABULARY)
    return automaton, Presplit(bpe.Encoder(automaton).word, automaton.special)


def ids(encode, text):
    return np.frombuffer(encode(text), "<u4").tolist()


PIECES = ["a", "aa", " ", "  ", "\n", "é", "日本", "<|endoftext|>", "'s", "'LL", "1", "²", "!!", "abc", " the", "\t", " ", "　", "😀", "x_y", "\x1c", "\x85", "\x00", "ing"]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(PIECES), max_size=20).map("".join), st.text(max_size=40), st.text("abeinorst ", max_size=60)))
def test_same_ids_and_text_as_the_library(library, own, text):
    automaton, encode = own
    want = library.encode(text, add_special_tokens=False).ids
    assert ids(encode, text) == want
    assert b"".join(automaton.labels[i] for i in want).decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 1500, " " * 999, "=" * 777, "the" * 700, "é" * 300])
def test_long_runs(library, own, text):
    assert ids(own[1], text) == library.encode(text, add_special_tokens=False).ids


def test_automaton_accepts_exactly_what_the_merges_give():
    """Every sequence of tokens over a toy alphabet, against merging from the lowest rank."""
    from itertools import product

    merges = [(b"a", b"a"), (b"a", b"b"), (b"aa", b"b"), (b"b", b"ab"), (b"aa", b"aa")]
    words = [bytes([c]) for c in b"ab"] + [u + v for u, v in merges]
    automaton = bpe.compile_merges(merges, {w: k for k, w in enumerate(words)}, {})
    encoder = bpe.Encoder(automaton)
    token = {automaton.labels[i]: t for t, i in automaton.ids.items()}

    def merged(text):
        parts = [text[i : i + 1] for i in range(len(text))]
        while True:
            found = [(merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
            if not found:
                return parts
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    for n in range(1, 5):
        for path in product(words, repeat=n):
            state, accepted = 0, True
            for w in path:
                accepted = accepted and not encoder.missing(state, token[w])
                state = automaton.target[token[w]]
            assert accepted == (merged(b"".join(path)) == list(path)), path


def test_query_matches_the_library(spark, sf, library):
    import hashlib

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in bpe.op5_bpe(spark, sf).collect():
        want = library.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        text = library.decode(want, skip_special_tokens=False)
        assert r["n_tokens"] == len(want) and r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(spark):
    found = bpe.encode(spark, odd.table(spark), VOCABULARY, "doc_id", "text").collect()
    assert sorted(r["decoded"] for r in found) == sorted(row[1] or "" for row in odd.rows())
    assert bpe.encode(spark, odd.empty(spark), VOCABULARY, "doc_id", "text").count() == 0
