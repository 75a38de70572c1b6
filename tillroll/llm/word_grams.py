"""Hashes of words and of runs of words, for whole blocks of texts at once."""

from __future__ import annotations

import re

import numpy as np
import xxhash

KNOWN_WORDS = 200_000
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)
MIX = np.uint64(0xD6E8FEB86659FD93)

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def split_words(text: bytes) -> list[bytes]:
    """Words of the contracts: bytes.split would also do, but it takes the same six characters as white space."""
    return text.split()


def hashed_words(texts: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in a row, and where each text ends."""
    found, ends = [], []
    for text in texts:
        found += map(hashes.__getitem__, text.split())
        ends.append(len(found))
    return np.array(found, dtype=np.uint64), np.array(ends, dtype=np.int64)


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, base in enumerate((BASE, INVERSE)):
            table = np.full(size, np.uint64(base), dtype=np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0], _powers[1]


def mixed(values: np.ndarray) -> np.ndarray:
    """A finaliser: every bit of the result hangs on every bit of the value."""
    values = (values ^ (values >> np.uint64(32))) * MIX
    values = (values ^ (values >> np.uint64(32))) * MIX
    return values ^ (values >> np.uint64(32))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from each position on, by differences of one running polynomial sum."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _power_table(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mixed((sums[size:] - sums[:n]) * down[:n])
