"""Structure counts of a text, shared by the quality classifier and the quality rules."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tidegrid.llm.common import WORD_GAPS, WordHashes, gram_hashes

CONTINUED, GAP, SYMBOL, UPPER, LOWER, DIGIT, SIGN, LEAD = range(8)
SYMBOLS = b"#*$%&|<>"
REPEAT_WORDS = 8


def byte_classes() -> np.ndarray:
    table = np.full(256, SIGN, np.uint8)
    table[0x80:0xC0], table[0xC0:] = CONTINUED, LEAD
    for kind, members in ((GAP, WORD_GAPS), (SYMBOL, SYMBOLS), (DIGIT, b"0123456789")):
        table[list(members)] = kind
    table[ord("A") : ord("Z") + 1], table[ord("a") : ord("z") + 1] = UPPER, LOWER
    return table


CLASSES = byte_classes()


@dataclass
class Counts:
    """Counts of one text; `kinds` are code points by the class of their first byte."""

    words: list[bytes]
    hashes: np.ndarray
    kinds: np.ndarray
    n_lines: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def n_words(self) -> int:
        return len(self.words)

    @property
    def word_chars(self) -> int:
        return int(self.kinds.sum() - self.kinds[CONTINUED] - self.kinds[GAP])


def repeated_words(hashes: np.ndarray, n: int = REPEAT_WORDS) -> int:
    """Words inside n-word windows that occur twice or more in the text."""
    grams = gram_hashes(hashes, n)
    if len(grams) < 2:
        return 0
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    edges[:-n][: len(grams)] += twice[: len(edges) - n]
    edges[n : n + len(grams)] -= twice
    return int((np.cumsum(edges)[:-1] > 0).sum())


def measure(text: bytes, memory: WordHashes) -> Counts:
    words = text.split()
    hashes = memory.of(words)
    kinds = np.bincount(CLASSES[np.frombuffer(text, np.uint8)], minlength=8)
    lines = [line for line in text.split(b"\n") if line.strip(WORD_GAPS)]
    return Counts(words, hashes, kinds, len(lines), len(lines) - len(set(lines)), repeated_words(hashes))
