"""An FM-index over the word numbers of one shard, with bidirectional extension of intervals.

Words are numbers from 1 on, 0 ends a piece. Suffixes are sorted by their first `depth` symbols only, which is all that
patterns of up to `depth` words need: the rows that begin with a pattern form an interval, and prepending a word c maps
an interval to C[c] + rank(c) of its two ends in the transformed text. The same index over the reversed text holds an
interval for each pattern too; while one interval is extended by the rule above, the other shrinks to a slice of itself,
found by counting smaller symbols. So a pattern can grow on either side, and each interval shows the words beside it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def suffix_order(text: np.ndarray, symbols: int, depth: int) -> np.ndarray:
    """Positions in the order of their next `depth` symbols; what lies behind the end counts as 0."""
    n = len(text)

    def behind(ranks: np.ndarray, shift: int) -> np.ndarray:
        moved = np.zeros(n, np.int64)
        moved[: max(0, n - shift)] = ranks[shift:]
        return moved

    text = text.astype(np.int64)
    ranks, known = text, 1
    while 2 * known < depth:
        ranks = _dense(ranks * max(symbols, n + 1) + behind(ranks, known))
        known *= 2
    # Two runs of `known` symbols may overlap; together they reach over `depth`.
    if known < depth:
        ranks = ranks * max(symbols, n + 1) + behind(ranks, depth - known)
    return np.argsort(ranks, kind="stable")


class Direction:
    """One side of the index: the transformed text, where each symbol's suffixes begin, and ranks of symbols."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int) -> None:
        order = suffix_order(text, symbols, depth)
        self.before = text[order - 1].astype(np.int64)  # the last symbol stands before the first
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        by_symbol = np.argsort(self.before, kind="stable")
        self.rows = self.before[by_symbol] * np.int64(len(text) + 1) + by_symbol

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often a symbol stands in the transformed text above a row."""
        return np.searchsorted(self.rows, symbol * np.int64(len(self.before) + 1) + row) - self.first[symbol]


@dataclass
class Patterns:
    """Patterns of one length and the interval of each in both directions."""

    words: np.ndarray  # (patterns, length)
    low: np.ndarray
    mirror: np.ndarray  # lower end in the reversed text
    count: np.ndarray

    def __len__(self) -> int:
        return len(self.count)

    def only(self, kept: np.ndarray) -> Patterns:
        return Patterns(self.words[kept], self.low[kept], self.mirror[kept], self.count[kept])


class WordIndex:
    """Both directions over one text; it must end with 0."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int) -> None:
        self.symbols, self.depth = symbols, depth
        self.forward = Direction(text, symbols, depth)
        # Reversed, with the end mark last again.
        self.reverse = Direction(np.concatenate([text[:-1][::-1], text[-1:]]), symbols, depth)

    def single_words(self) -> Patterns:
        counts = np.diff(self.forward.first)
        words = np.flatnonzero(counts[1:]) + 1
        start = self.forward.first[words]
        return Patterns(words[:, None], start, start, counts[words])

    def _beside(self, side: Direction, low: np.ndarray, count: np.ndarray):
        """(pattern, symbol, n, smaller): each symbol before the suffixes of an interval, and how many are smaller."""
        pattern = np.repeat(np.arange(len(count)), count)
        begin = np.cumsum(count) - count
        symbol = side.before[np.repeat(low - begin, count) + np.arange(len(pattern))]
        keys, n = np.unique(pattern * np.int64(self.symbols) + symbol, return_counts=True)
        pattern, symbol = keys // self.symbols, keys % self.symbols
        smaller = np.cumsum(n) - n
        return pattern, symbol, n, smaller - begin[pattern]

    def extended(self, found: Patterns, left: bool) -> Patterns:
        """Every pattern with one more word on its left or right, wherever the text has one."""
        side, low, other = (
            (self.forward, found.low, found.mirror) if left else (self.reverse, found.mirror, found.low)
        )
        pattern, word, n, smaller = self._beside(side, low, found.count)
        inside = word > 0
        pattern, word, n, smaller = pattern[inside], word[inside], n[inside], smaller[inside]
        grown = side.first[word] + side.rank(word, low[pattern])
        slice_of = other[pattern] + smaller
        words = np.column_stack([word, found.words[pattern]] if left else [found.words[pattern], word])
        return Patterns(words, grown if left else slice_of, slice_of if left else grown, n)

    def only_neighbour(self, found: Patterns, left: bool) -> np.ndarray:
        """The one word that stands beside every occurrence of a pattern on that side; 0 where there is none."""
        side, low = (self.forward, found.low) if left else (self.reverse, found.mirror)
        pattern, symbol, n, _ = self._beside(side, low, found.count)
        only = np.zeros(len(found), np.int64)
        alone = n == found.count[pattern]
        only[pattern[alone]] = symbol[alone]
        return only
