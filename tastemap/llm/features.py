"""Hashed text features of the trained filters (numpy, inside tasks)."""

from __future__ import annotations

import re

import numpy as np

_WORD = re.compile(r"\w+")
MEMO_WORDS = 100_000
SLICE_ROWS = 256                 # texts of an Arrow batch that are Python strings at a time

# Fixed odd multipliers that mix word hashes into n-gram hashes.
MIX_1 = np.uint64(0x9E3779B97F4A7C15)
MIX_2 = np.uint64(0xC2B2AE3D27D4EB4F)
MIX_3 = np.uint64(0x165667B19E3779F9)


class WordHashes(dict):
    """word -> 64-bit hash, remembered for up to MEMO_WORDS words."""

    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) > MEMO_WORDS:
            self.clear()
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 0)
        if len(word) <= 40:
            self[word] = h
        return h


_HASHES = WordHashes()


def texts_of(column):
    """The texts of an Arrow column, a slice at a time: a batch may hold 10,000 whole texts,
    and workers keep what they once took."""
    for at in range(0, len(column), SLICE_ROWS):
        yield from column.slice(at, SLICE_ROWS).to_pylist()


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def gram_features(words: list[str], bits: int) -> np.ndarray:
    """Buckets (with repeats) of the words, the word pairs and the skip-grams that leave
    one or two words out."""
    h = word_hashes(words)
    shift = np.uint64(64 - bits)
    parts = [h * MIX_1]
    if len(h) > 1:
        pair = h[:-1] * MIX_1 + h[1:] * MIX_2
        parts.append((pair ^ (pair >> np.uint64(29))) * MIX_3)
    for gap in (2, 3):
        if len(h) > gap:
            skip = h[:-gap] * MIX_2 + h[gap:] * MIX_3 + np.uint64(gap)
            parts.append((skip ^ (skip >> np.uint64(31))) * MIX_1)
    return (np.concatenate(parts) >> shift).astype(np.int32)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))
