"""Byte-pair encoding by a tokenization automaton, and decoding by the labels of its arcs.

The automaton reads tokens. It accepts exactly the sequences that the merges produce, so a word's encoding is its
only path whose labels spell the word. It starts as one state where every byte loops. Each merge (u, v) -> uv adds
its gadget: arcs labelled u now lead to a copy of their state without the v arc, and wherever u could be read and v
after it, an arc uv leads to where v led. All arcs of one label lead to one state, and a state is its parent
without one label, so both are kept as short tables instead of 50,000 arcs for each of 50,000 states:

* ``target[t]`` is where arcs labelled t lead;
* state s (from merge s on) is ``parent[s]`` without label ``without[s]``;
* a label made after a state is missing there just if its left part is, since it took the left part's place.

Defined cases: null is the empty text; an empty text has no ids. Special strings are ids of their own. Repeated
rows are encoded each; other columns are ignored; very long texts are encoded whole, word by word.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as texts
from tidemark.llm.presplit import Presplit

KNOWN_ARCS = 500_000
HEAD = 4
SHORT = (3, 2, 1)


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: printable ones stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Automaton:
    """Tables by merge rank: token k of a merge is k itself, byte b is -1 - b; state 0 is the first."""

    left: list[int]
    right: list[int]
    target: dict[int, int]  # of a token, the state its arcs lead to
    parent: list[int]
    without: list[int]
    ids: dict[int, int]  # token -> id of the vocabulary
    labels: dict[int, bytes]  # id -> bytes
    special: dict[str, int]


def compile_merges(merges: list[tuple[bytes, bytes]], ids: dict[bytes, int], special: dict[str, int]) -> Automaton:
    """Add the gadget of each merge in order. State k + 1 is the copy that merge k makes."""
    token = {bytes([b]): -1 - b for b in range(256)}
    target = {t: 0 for t in token.values()}
    out = Automaton([], [], target, [0], [0], {}, {}, special)
    for k, (u, v) in enumerate(merges):
        a, b = token[u], token[v]
        token[u + v] = k
        target[k] = target[b]
        out.parent.append(target[a])
        out.without.append(b)
        target[a] = k + 1
        out.left.append(a)
        out.right.append(b)
    out.ids = {t: ids[w] for w, t in token.items() if w in ids}
    out.labels = {ids[w]: w for w in token if w in ids} | {i: s.encode() for s, i in special.items()}
    return out


def read_vocabulary(path: str) -> Automaton:
    """Compile the merges of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    letters = byte_letters()
    raw = lambda word: bytes(map(letters.__getitem__, word))
    model = content["model"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    ids = {raw(w): i for w, i in model["vocab"].items() if w not in special}
    return compile_merges([(raw(a), raw(b)) for a, b in pairs], ids, special)


class Encoder:
    """Finds the path that spells a word: longest arc first, back from dead ends, no place entered twice."""

    def __init__(self, automaton: Automaton):
        self.a = automaton
        self.by_label = {automaton.labels[i]: t for t, i in automaton.ids.items()}
        self.id_bytes = {t: i.to_bytes(4, "little") for t, i in automaton.ids.items()}
        # The lengths of labels that begin with these four bytes, longest first.
        sizes: dict[bytes, set[int]] = {}
        for label in self.by_label:
            if len(label) >= HEAD:
                sizes.setdefault(label[:HEAD], set()).add(len(label))
        self.sizes = {head: (*sorted(n, reverse=True), *SHORT) for head, n in sizes.items()}
        self.arcs: dict[int, dict[int, bool]] = {}
        self.known = 0
        self.without: dict[int, dict[int, int]] = {}

    def missing(self, state: int, token: int) -> bool:
        """Whether a state has no arc of this label: its left parts stand for it in states older than itself."""
        dropped, left, limit = self.dropped(state), self.a.left, state
        while True:
            while token >= limit - 1 and token >= 0:
                token = left[token]
            if dropped.get(token, limit + 1) <= limit:
                return True
            if token < 0:
                return False
            limit = token + 1

    def dropped(self, state: int) -> dict[int, int]:
        """The labels that a state and its parents are without, each with the oldest state that is."""
        found = self.without.get(state)
        if found is None:
            found, at = {}, state
            while at:
                found[self.a.without[at]] = at
                at = self.a.parent[at]
            self.without[state] = found
        return found

    def arc(self, state: int, token: int) -> bool:
        if self.known >= KNOWN_ARCS:
            self.arcs.clear()
            self.known = 0
        self.known += 1
        found = self.arcs.setdefault(state, {})[token] = not self.missing(state, token)
        return found

    def word(self, word: str) -> bytes:
        spelt = word.encode()
        by_label, target, sizes, arcs = self.by_label.get, self.a.target, self.sizes.get, self.arcs.get
        whole = by_label(spelt)
        if whole is not None:
            return self.id_bytes[whole]
        end, at, state, path, dead = len(spelt), 0, 0, [], set()
        choices, known = iter(sizes(spelt[:HEAD], SHORT)), arcs(0, {}).get
        while at < end:
            for n in choices:
                token = by_label(spelt[at : at + n])
                if token is not None:
                    to = at + n
                    if to > end:
                        to = end
                    if to in dead:
                        continue
                    arc = known(token)
                    if arc or arc is None and self.arc(state, token):
                        path.append((at, state, choices, token))
                        at, state = to, target[token]
                        choices, known = iter(sizes(spelt[at : at + HEAD], SHORT)), arcs(state, {}).get
                        break
            else:
                # A prefix has one path, so a place that was reached and left has no way on.
                dead.add(at)
                at, state, choices, _ = path.pop()
                known = arcs(state, {}).get
        ids = self.id_bytes
        return b"".join([ids[p[3]] for p in path])


def encode(spark: SparkSession, docs: DataFrame, vocabulary: str, key: str, text: str) -> DataFrame:
    """(key, ids binary, decoded string) for each row: ids as little-endian 32-bit integers, and their text.

    The automaton is as large as the vocabulary, some MB, and is broadcast.
    """
    return _mapped(spark, docs, vocabulary, key, text, "ids binary, decoded string", lambda ids, decoded: (ids, decoded.decode("utf-8", "replace")))


def _mapped(spark, docs, vocabulary, key, text, fields, of) -> DataFrame:
    shared = spark.sparkContext.broadcast(tuple(vars(read_vocabulary(vocabulary)).values()))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(*shared.value)
        ids_of = Presplit(Encoder(automaton).word, automaton.special)
        label = automaton.labels.__getitem__
        for batch in batches:
            _, offsets = texts.utf8(batch.column(1))
            for i, j in texts.slices(offsets, 4 * texts.SLICE_BYTES):
                rows = []
                for value in batch.column(1).slice(i, j - i).to_pylist():
                    ids = ids_of(value or "")
                    rows.append(of(ids, b"".join(map(label, np.frombuffer(ids, "<u4").tolist()))))
                columns = [batch.column(0).slice(i, j - i), *map(pa.array, zip(*rows))]
                yield pa.RecordBatch.from_arrays(columns, ["key", *(f.split()[0] for f in fields.split(", "))])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return texts.mapped(rows, run, texts.with_key(docs, key, fields))


def digests(spark: SparkSession, docs: DataFrame, vocabulary: str, key: str, text: str, with_ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): the digests are taken beside the texts, which then stay there."""

    def of(ids: bytes, decoded: bytes) -> tuple:
        decoded = decoded.decode("utf-8", "replace").encode()
        out = len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()
        return (*out, ids) if with_ids else out

    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return _mapped(spark, docs, vocabulary, key, text, fields, of)


def op5_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    docs = texts.table(spark, sf_dir, "documents")
    return digests(spark, docs, vocabulary or default_vocabulary(), "doc_id", "text").withColumnRenamed("key", "doc_id")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
