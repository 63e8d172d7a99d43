"""Personal data: patterns, and a skip-chain conditional random field that carries them on to what they miss.

Patterns find the base spans. The field then labels tokens, which are runs without white space that hold a digit or an
``@``; all other words are observed to be none. Neighbouring tokens share a transition potential. Tokens of one document
that are equal or similar (the same last seven digits, the same name before an ``@``), however far apart, share an
agreement potential through a hub, so that a group of m tokens has m edges and not m * m. Loopy message passing over
chains and hubs, with base spans as observed labels, gives each token its marginal. What is sure enough, is similar to a token of a base span (or
continues one that is), and overlaps no base span is added. So a number that once stands with its ``+`` is found where it stands without.

Training is piecewise, with base spans as labels: the chain part by its exact likelihood, on at most ``SEGMENTS`` chains
with and as many without a base span, from about ``DOCUMENTS`` documents that hold a digit or an ``@``; the agreement
weight from how often similar tokens of two base spans have one kind. A token outside all base spans says nothing about
agreement, since the patterns may have missed it. Documents without a digit and without an ``@`` are left alone at once.

Defined cases: a null text is an empty one and has no spans; every row has one result row, also with a null or repeated
key; an empty table has no rows; if nothing can be learned, nothing is added. All patterns take time linear in a text.
Other columns are passed by.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as texts

# The kinds in their order, the characters and patterns of each.
KINDS = ("email", "ip", "card", "phone")
LOCAL = string.ascii_letters + string.digits + "._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
MAYBE = re.compile(r"[0-9@]")
LEADING = "".join(c for c in string.punctuation if c not in "+(")

# Labels of the field: none, email, ip, and first and later tokens of a card and of a phone number.
OF_KIND = np.array([0, 1, 2, 3, 3, 4, 4])
FIRST = {"email": 1, "ip": 2, "card": 3, "phone": 5}
LATER = {"email": 1, "ip": 2, "card": 4, "phone": 6}
STATES, GROUPS = len(OF_KIND), len(KINDS) + 1
AGREES = (OF_KIND[:, None] == np.arange(GROUPS)).astype(float)

BUCKETS, WIDTH = 1 << 12, 8  # of hashed features; features of a token
DOCUMENTS, SEGMENTS, SEGMENT = 20_000, 10_000, 16
EPOCHS, RATE, DECAY = 120, 0.5, 1e-3
MOST_SKIP = 8.0
TURNS = 10
CONFIDENCE = 0.6
SURE = 50.0

Span = tuple[str, int, int]


# ---- base spans ---------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    twice = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    return sum(twice[int(d)] if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each ``@`` the name before it, not reaching into the match before, and the domain behind it."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        low = found.end() if found else at + 1
        at = text.find("@", low)


def octets(text: str) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (part.lstrip("0") for part in text.split(".")))


def base_spans(text: str) -> list[Span]:
    """All base spans, by kind as listed, then by start."""
    found: list[Span] = [("email", *span) for span in _emails(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if octets(m.group())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := _digits(m.group())) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return found


# ---- tokens, their features, and what makes them similar -------------------------------------------


def shape(core: str) -> str:
    """Runs of digits as 9, runs of letters as a, all else as it is."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", core))[:24]


def features(core: str, before: bool, after: bool) -> list[int]:
    """Hashed features: shape, number of digits, lengths of digit runs, checks, and whether neighbours are tokens."""
    digits = _digits(core)
    runs = "-".join(str(min(len(r), 20)) for r in re.findall(r"[0-9]+", core)[:6])
    named = [
        "bias", f"s {shape(core)}", f"n {min(len(digits), 24)}", f"r {runs}", f"b {core[:1] in '+('}{core[:1] == '+'}",
        f"l {16 <= len(digits) <= 19 and len(digits) == len(core.replace('-', '')) and luhn(digits)}",
        f"o {core.count('.') == 3 and core.replace('.', '').isdigit() and octets(core)}", f"a {before}{after}",
    ]
    return [zlib.crc32(name.encode()) % BUCKETS for name in named]


def similar_key(core: str) -> str | None:
    """What tokens must share to be similar, if there is enough of it."""
    if "@" in core:
        name = core.split("@", 1)[0].lower()
        return f"name {name}" if len(name) > 2 else None
    digits = _digits(core)
    if len(digits) > 6:
        return f"digits {digits[-7:]}"
    return f"name {core.lower()}" if re.search(r"[^\W\d_]", core) and "." in core else None


class Tokens:
    """The tokens of one text: spans of their cores, chains of neighbours, labels by base spans (-1: none), keys."""

    def __init__(self, text: str, base: list[Span]):
        self.starts, self.ends, self.cores, joined, last = [], [], [], [], None
        for m in TOKEN.finditer(text):
            left = m.group().lstrip(LEADING)
            core = left.rstrip(string.punctuation)
            if core:
                start = m.end() - len(left)
                joined.append(last is not None and m.start() - last < 3 and text[last : m.start()].isspace())
                self.starts.append(start)
                self.ends.append(start + len(core))
                self.cores.append(core)
                last = m.end()
        self.joined = joined  # to the token before
        self.labels = [-1] * len(self.cores)
        starts, ends = np.array(self.starts), np.array(self.ends)
        for kind, start, end in reversed(base):
            if len(starts):
                low, high = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(starts, end, "left"))
                for i in range(low, high):
                    self.labels[i] = FIRST[kind] if i == low else LATER[kind]
        self.keys = [similar_key(core) for core in self.cores]

    def features(self) -> list[list[int]]:
        after = self.joined[1:] + [False]
        return [features(c, b, a) for c, b, a in zip(self.cores, self.joined, after)]


# ---- the field ---------------------------------------------------------------------------------------


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Field:
    """Weights: features x labels, transitions, first and last labels of a chain, and the agreement weight."""

    def __init__(self):
        self.unary = np.zeros((BUCKETS, STATES))
        self.step = np.zeros((STATES, STATES))
        self.first, self.last = np.zeros(STATES), np.zeros(STATES)
        self.skip = 0.0
        self.learned = False

    def local(self, found: np.ndarray) -> np.ndarray:
        return self.unary[found].sum(axis=1)

    def train(self, chains: list[tuple[list[list[int]], list[int]]], same: int, pairs: int) -> Field:
        """The chain part by gradient steps on the exact likelihood, the agreement weight by its log odds."""
        share = (same + 1) / (pairs + 2)
        self.skip = float(np.clip(np.log(share / (1 - share) * (GROUPS - 1)), 0, MOST_SKIP))
        if not any(any(labels) for _, labels in chains):
            return self
        self.learned = True
        rows, longest = len(chains), max(len(labels) for _, labels in chains)
        found = np.zeros((rows, longest, WIDTH), np.int64)
        truth, there = np.zeros((rows, longest), np.int64), np.zeros((rows, longest), bool)
        for r, (ids, labels) in enumerate(chains):
            found[r, : len(ids)], truth[r, : len(ids)], there[r, : len(ids)] = ids, labels, True
        ends = there.sum(axis=1) - 1
        every = np.arange(rows)
        weights = [self.unary, self.step, self.first, self.last]
        squares = [np.full_like(w, 1e-8) for w in weights]
        seen = [np.zeros_like(w) for w in weights]
        np.add.at(seen[0], (found[there], truth[there][:, None]), 1)
        both = there[:, 1:]
        np.add.at(seen[1], (truth[:, :-1][both], truth[:, 1:][both]), 1)
        np.add.at(seen[2], truth[:, 0], 1)
        np.add.at(seen[3], truth[every, ends], 1)
        for _ in range(EPOCHS):
            scores = self.unary[found].sum(axis=2)
            scores[:, 0] += self.first
            scores[every, ends] += self.last
            ahead, back = np.zeros_like(scores), np.zeros_like(scores)
            ahead[:, 0] = scores[:, 0]
            for t in range(1, longest):
                ahead[:, t] = scores[:, t] + _lse(ahead[:, t - 1, :, None] + self.step, 1)
            for t in range(longest - 2, -1, -1):
                later = _lse(self.step + (scores[:, t + 1] + back[:, t + 1])[:, None, :], 2)
                back[:, t] = np.where(there[:, t + 1, None], later, 0)
            total = _lse(ahead[every, ends], 1)
            marginal = np.exp(ahead + back - total[:, None, None]) * there[:, :, None]
            expected = [np.zeros_like(w) for w in weights]
            np.add.at(expected[0], found[there], marginal[there][:, None, :])
            for t in range(1, longest):
                live = there[:, t]
                pair = ahead[live, t - 1, :, None] + self.step + (scores[live, t] + back[live, t])[:, None, :] - total[live, None, None]
                expected[1] += np.exp(pair).sum(axis=0)
            expected[2] += marginal[:, 0].sum(axis=0)
            expected[3] += marginal[every, ends].sum(axis=0)
            for w, s, q, e in zip(weights, seen, squares, expected):
                slope = (s - e) / rows - DECAY * w
                q += slope * slope
                w += RATE * slope / np.sqrt(q)
        return self

    def marginals(self, found: np.ndarray, joined: np.ndarray, groups: np.ndarray, observed: np.ndarray) -> np.ndarray:
        """Tokens x labels after ``TURNS`` turns of message passing.

        ``joined``: to the token before; ``groups``: the hub of a token or -1; ``observed``: its label or -1.
        """
        n = len(found)
        scores = self.local(found)
        scores[~joined] += self.first
        scores[np.append(~joined[1:], True)] += self.last
        known = np.flatnonzero(observed >= 0)
        scores[known, observed[known]] += SURE
        right = np.flatnonzero(joined)  # the later token of each chain edge
        linked = np.flatnonzero(groups >= 0)
        hubs = groups[linked]
        agree = self.skip * AGREES
        down, up = np.zeros((n, STATES)), np.zeros((n, STATES))  # from the token before, from the one behind
        out, back = np.zeros((len(linked), GROUPS)), np.zeros((n, STATES))  # to the hub, from it
        for _ in range(TURNS):
            belief = scores + down + up + back
            ahead = _lse((belief - up)[right - 1][:, :, None] + self.step, 1) if len(right) else down[right]
            behind = _lse((belief - down)[right][:, None, :] + self.step, 2) if len(right) else up[right]
            if len(linked):
                out = _lse((belief - back)[linked][:, :, None] + agree, 1)
                out -= out.max(axis=1, keepdims=True)
                total = np.zeros((hubs.max() + 1, GROUPS))
                np.add.at(total, hubs, out)
                told = _lse((total[hubs] - out)[:, None, :] + agree, 2)
                back[linked] = told - told.max(axis=1, keepdims=True)
            down[right] = ahead - ahead.max(axis=1, keepdims=True) if len(right) else ahead
            up[right - 1] = behind - behind.max(axis=1, keepdims=True) if len(right) else behind
        belief = scores + down + up + back
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)


def added_spans(field: Field, documents: list[Tokens], bases: list[list[Span]]) -> list[list[Span]]:
    """What the field adds to the base spans of some documents, taken as one graph of separate parts."""
    sizes = [len(d.cores) for d in documents]
    out: list[list[Span]] = [[] for _ in documents]
    if not field.learned or not sum(sizes):
        return out
    found = np.array([f for d in documents for f in d.features()])
    joined = np.array([j for d in documents for j in d.joined])
    observed = np.array([x for d in documents for x in d.labels])
    hubs: dict[tuple[int, str], int] = {}
    groups = np.array([-1 if k is None else hubs.setdefault((at, k), len(hubs)) for at, d in enumerate(documents) for k in d.keys])
    marginal = field.marginals(found, joined, groups, observed)
    kinds = np.zeros((len(marginal), GROUPS))
    for state, kind in enumerate(OF_KIND):
        kinds[:, kind] += marginal[:, state]
    best, label = kinds.argmax(axis=1), marginal.argmax(axis=1)
    best[(kinds.max(axis=1) < CONFIDENCE) | (observed >= 0)] = 0
    vouched = np.zeros(len(hubs) + 1, bool)  # hubs with a base span; the last entry is that of tokens without a hub
    vouched[groups[(observed >= 0) & (groups >= 0)]] = True
    vouched = vouched[groups]
    low = 0
    for at, d in enumerate(documents):
        open_kind, found_here, sure = 0, [], []
        for i in range(sizes[at]):
            kind = int(best[low + i])
            if kind:
                if d.joined[i] and kind == open_kind and label[low + i] in (4, 6):
                    found_here[-1] = (*found_here[-1][:2], d.ends[i])
                    sure[-1] |= vouched[low + i]
                else:
                    found_here.append((KINDS[kind - 1], d.starts[i], d.ends[i]))
                    sure.append(vouched[low + i])
            open_kind = kind
        low += sizes[at]
        out[at] = _clear([s for s, good in zip(found_here, sure) if good], bases[at])
    return out


def _clear(spans: list[Span], base: list[Span]) -> list[Span]:
    """Those that overlap no base span."""
    if not spans or not base:
        return spans
    starts, ends = np.sort([s for _, s, _ in base]), np.sort([e for _, _, e in base])
    return [s for s in spans if np.searchsorted(starts, s[2], "left") == np.searchsorted(ends, s[1], "right")]


# ---- Spark ---------------------------------------------------------------------------------------------


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each chain, cut to ``SEGMENT`` tokens, and one with the agreement counts of a batch."""
    for batch in batches:
        rows, same, pairs = [], 0, 0
        for text in batch.column(0):
            text = text.as_py()
            place = zlib.crc32(text.encode()) << 24
            base = base_spans(text)
            tokens = Tokens(text, base)
            ids, chain = tokens.features(), 0
            last: dict[str, int] = {}
            for i, key in enumerate(tokens.keys):
                kind = int(OF_KIND[tokens.labels[i]]) if tokens.labels[i] >= 0 else 0
                if key is not None and kind:
                    if key in last:
                        pairs, same = pairs + 1, same + (last[key] == kind)
                    last[key] = kind
                if not tokens.joined[i] or i - chain == SEGMENT:
                    chain = i
                    rows.append(([], [], place + i))
                rows[-1][0].extend(ids[i])
                rows[-1][1].append(max(0, tokens.labels[i]))
        rows.append(([], [], 0))
        counts = [0] * (len(rows) - 1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                pa.array([r[2] for r in rows], pa.int64()), pa.array([*counts, same], pa.int64()), pa.array([*counts, pairs], pa.int64()),
            ],
            ["ids", "labels", "place", "same", "pairs"],
        )


def learn(docs: DataFrame, text: str) -> Field:
    """A field from the texts of ``docs``; see the module for its bounds."""
    holding = docs.where(F.col(text).rlike("[0-9@]")).select(F.col(text).alias("text"))
    share = max(1, holding.count() // DOCUMENTS)
    some = holding.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)
    rows = texts.stored(texts.mapped(some, _examples, "ids array<int>, labels array<int>, place long, same long, pairs long"), "pii-examples")
    totals = rows.agg(F.sum("same").alias("same"), F.sum("pairs").alias("pairs")).first()
    chains = rows.where(F.size("labels") > 0).select("ids", "labels", "place")
    marked = F.exists("labels", lambda x: x > 0)
    picked = [r for part in (chains.where(marked), chains.where(~marked)) for r in texts.hashed_sample(part, "place", SEGMENTS).collect()]
    examples = [(np.array(r["ids"]).reshape(-1, WIDTH).tolist(), r["labels"]) for r in picked]
    return Field().train(examples, totals["same"] or 0, totals["pairs"] or 0)


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def _finder(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = texts.utf8(batch.column(1))
            for i, j in texts.slices(offsets):
                some = batch.slice(i, j - i)
                values = some.column(1).to_pylist()
                holding = [at for at, text in enumerate(values) if text and MAYBE.search(text)]
                bases = [base_spans(values[at]) for at in holding]
                more = added_spans(field, [Tokens(values[at], base) for at, base in zip(holding, bases)], bases)
                spans: list[list[dict]] = [[] for _ in values]
                for at, base, added in zip(holding, bases, more):
                    every = [(*s, True) for s in base] + [(*s, False) for s in added]
                    every.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
                    spans[at] = [dict(zip(("kind", "start", "end", "base"), s)) for s in every]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(spans, kind)], ["key", "spans"])

    return run


def find(docs: DataFrame, key: str, text: str, field: Field) -> DataFrame:
    """``key`` and ``spans`` (kind, start, end in code points, whether a base span), by kind as listed, then by start."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return texts.mapped(rows, _finder(field), texts.with_key(docs, key, f"spans {SPANS}"))


def spelled(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    docs = texts.table(spark, sf_dir, "documents")
    found = find(docs, "doc_id", "text", learn(docs, "text"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind))
    counts = [count(kind).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        F.col("key").alias("doc_id"), *counts, F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans")
    )
