"""Texts as sequences of pre-split words, each encoded once for as long as a bounded memory lasts.

A byte-level BPE encodes each pre-split word by itself, and words repeat, so a text is looked up word by word and
only unknown words reach the encoder. Texts are cut at single spaces first: what lies between two spaces, with the
space before it, is split into the same words wherever it stands, unless a run of white space goes on across the
cut; a text with such a run is split as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

import regex

# Fixed value: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_RUN = r"\s \s|\s \Z"
REMEMBERED = 400_000


class Memory(dict):
    """Values of a function, forgotten when ``REMEMBERED`` are held."""

    def __init__(self, of: Callable[[str], bytes]):
        super().__init__()
        self.of = of

    def __missing__(self, key: str) -> bytes:
        value = self.of(key)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(key) <= 64:  # long keys seldom come again
            self[key] = value
        return value


class Presplit:
    """Encodes whole texts given an encoder of single words; ``special``: strings that are ids of their own."""

    def __init__(self, encode_word: Callable[[str], bytes], special: dict[str, int]):
        self.find = regex.compile(PATTERN).findall
        self.long_run = regex.compile(LONG_RUN).search
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.special_ids = {s: i.to_bytes(4, "little") for s, i in special.items()}
        self.encode_word = encode_word
        self.words = Memory(encode_word)
        self.pieces = Memory(self.piece)

    def piece(self, piece: str) -> bytes:
        """What stands after a single space, with that space."""
        if piece.isascii() and piece.isalpha():
            return self.encode_word(" " + piece)
        words = self.find(" " + piece)
        return self.encode_word(words[0]) if len(words) == 1 else b"".join(map(self.words.__getitem__, words))

    def plain(self, text: str) -> bytes:
        if self.long_run(text):
            return b"".join(map(self.words.__getitem__, self.find(text)))
        first, *rest = text.split(" ")
        return b"".join([*map(self.words.__getitem__, self.find(first)), *map(self.pieces.__getitem__, rest)])

    def __call__(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        return b"".join(self.special_ids.get(part) or self.plain(part) for part in self.special.split(text) if part)
