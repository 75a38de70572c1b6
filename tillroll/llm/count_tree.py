"""An R-tree over count vectors, joined by bounds on set overlap.

A set of tokens becomes a point: its tokens are hashed into groups, and each coordinate counts the tokens of a group. The
overlap of two sets is at most the sum of the smaller of their coordinates; the same sum over the upper corners of two
boxes bounds every pair of points in them. The tree is packed bottom-up: points are sorted by size into slabs and inside a
slab by the coordinate that varies most, neighbours share a leaf, and leaves share inner nodes.

For a join, points and corners are kept as bits: for each value v that occurs, which coordinates reach v. The smaller of two
coordinates reaches v where both do, so the sum of minima is a weighted count of common bits, and the upper corner of a box
has the bits of all its points. One word stands for 64 coordinates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FANOUT = 16
CHUNK = 1 << 12
FEW = 16


def can_overlap(overlap, size_a, size_b) -> np.ndarray:
    """Jaccard similarity of 0.8 is possible with this overlap: 100 * i >= 80 * (a + b - i)."""
    return 9 * overlap >= 4 * (size_a + size_b)


def sizes_fit(low_a, high_a, low_b, high_b) -> np.ndarray:
    return (5 * high_a >= 4 * low_b) & (5 * high_b >= 4 * low_a)


class CountTree:
    """`levels` of boxes over `points` (one row per set) of the given `sizes`; level 0 holds the points themselves."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        m = len(points)
        order = np.argsort(sizes, kind="stable")
        slab = max(FANOUT, int(np.sqrt(m / FANOUT)) * FANOUT)
        for low in range(0, m, slab):
            part = order[low : low + slab]
            order[low : low + slab] = part[np.argsort(points[part][:, points[part].var(axis=0).argmax()], kind="stable")]
        self.rows = order
        self.points = points[order]
        self.sizes = [(sizes[order], sizes[order])]
        while len(self.sizes[-1][0]) > 1:
            least, most = self.sizes[-1]
            cuts = np.arange(0, len(least), FANOUT)
            self.sizes.append((np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts)))
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _values(self) -> np.ndarray:
        """All coordinates that occur; the few below a small largest one are not looked up."""
        most = int(self.points.max(initial=0))
        return np.arange(1, most + 1) if most <= FEW else np.flatnonzero(np.bincount(self.points.ravel()))

    def _box(self, values: np.ndarray) -> None:
        """`levels` of (bits of the upper corners, least size, largest size), for these values."""
        m, groups = self.points.shape
        bits = np.zeros((m, len(values), -(-groups // 64) * 8), np.uint8)
        for i, v in enumerate(values.tolist()):
            bits[:, i, : -(-groups // 8)] = np.packbits(self.points >= v, axis=1)
        corners = [bits.view(np.uint64).reshape(m, -1)]
        for _ in self.sizes[1:]:
            corners.append(np.bitwise_or.reduceat(corners[-1], np.arange(0, len(corners[-1]), FANOUT), axis=0))
        self.levels = [(c, *s) for c, s in zip(corners, self.sizes)]

    def level(self, k: int):
        return self.levels[min(k, len(self.levels) - 1)]

    def join(self, other: CountTree | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows (i, j) whose bound admits similarity 0.8; without `other`, each pair of own rows once."""
        right = other or self
        values = np.unique(np.concatenate([[1], self._values(), right._values()]))
        values = values[values > 0]
        for tree in {id(t): t for t in (self, right)}.values():
            tree._box(values)
        steps = np.diff(values, prepend=0)
        top = max(len(self.levels), len(right.levels)) - 1
        yield from self._descend(right, top, np.zeros(1, np.int64), np.zeros(1, np.int64), other is None, steps)

    def _descend(self, right: CountTree, k: int, a: np.ndarray, b: np.ndarray, own: bool, steps: np.ndarray):
        (bits_a, least_a, most_a), (bits_b, least_b, most_b) = self.level(k), right.level(k)
        for low in range(0, len(a), CHUNK):
            x, y = a[low : low + CHUNK], b[low : low + CHUNK]
            fit = sizes_fit(least_a[x], most_a[x], least_b[y], most_b[y])
            x, y = x[fit], y[fit]
            common = np.bitwise_count(bits_a[x] & bits_b[y]).reshape(len(x), len(steps), bits_a.shape[1] // len(steps))
            overlap = common.sum(axis=2, dtype=np.int64) @ steps
            fit = can_overlap(overlap, least_a[x], least_b[y])
            x, y = x[fit], y[fit]
            if not len(x):
                continue
            if k == 0:
                yield self.rows[x], right.rows[y]
                continue
            p, q = self._children(x, k), right._children(y, k)
            i, j = _pairs(p, q)
            if own:
                keep = i < j if k == 1 else i <= j
                i, j = i[keep], j[keep]
            yield from self._descend(right, k - 1, i, j, own, steps)

    def _children(self, nodes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First child of each node on the level below, and how many there are."""
        if k >= len(self.levels):
            return nodes, np.ones(len(nodes), np.int64)
        first = nodes * FANOUT
        return first, np.minimum(len(self.levels[k - 1][0]) - first, FANOUT)


def _pairs(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All child pairs of each node pair."""
    count = a[1] * b[1]
    node = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(node)) - np.repeat(np.cumsum(count) - count, count)
    return a[0][node] + at // b[1][node], b[0][node] + at % b[1][node]
