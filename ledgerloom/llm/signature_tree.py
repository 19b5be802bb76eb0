"""Signature trees over token sets and the dual traversal that joins two of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF = 16
FEWEST_BITS, MOST_BITS = 1 << 10, 1 << 17


def bitmap(tokens: np.ndarray) -> bytes:
    """One bit for each token's low bits, in two to four bits a token within the limits above."""
    size = min(MOST_BITS, max(FEWEST_BITS, 1 << (2 * len(tokens) - 1).bit_length()))
    bits = np.zeros(size, np.uint8)
    bits[(tokens & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def folded(bitmaps: list[bytes], size: int) -> np.ndarray:
    """Bitmaps of ``size`` bytes or more (powers of two), each ORed down to that size, as rows of 64-bit words."""
    parts = [np.frombuffer(b, np.uint64) if len(b) == size else np.bitwise_or.reduce(np.frombuffer(b, np.uint64).reshape(-1, size // 8)) for b in bitmaps]
    return np.stack(parts)


def pair_overlaps(m: np.ndarray, n: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The largest overlap that bitmaps allow, for rows of pairs: tokens whose bit the other set lacks are not shared."""
    return np.minimum(m - np.bitwise_count(x & ~y).sum(axis=-1, dtype=np.int64), n - np.bitwise_count(y & ~x).sum(axis=-1, dtype=np.int64))


class SignatureTree:
    """Sets in order of size, halved down to leaves.

    A node has the OR and the AND of its sets' bitmaps, the range of their
    sizes, the most tokens that share a bit with others in one set, and its
    group if all its sets are in one.
    """

    def __init__(self, sizes: np.ndarray, bitmaps: np.ndarray, groups: np.ndarray):
        self.order = np.lexsort((groups, sizes))
        self.sizes, self.bitmaps, self.groups = sizes[self.order], bitmaps[self.order], groups[self.order]
        self.shared = self.sizes - np.bitwise_count(self.bitmaps).sum(axis=1, dtype=np.int64)
        self.nodes: list[tuple] = []
        self.root = self._build(0, len(sizes))

    def _build(self, low: int, high: int) -> int:
        if high - low <= LEAF:
            part = slice(low, high)
            either, every = np.bitwise_or.reduce(self.bitmaps[part]), np.bitwise_and.reduce(self.bitmaps[part])
            group = self.groups[low] if (self.groups[part] == self.groups[low]).all() else None
            node = (low, high, -1, -1, either, every, self.sizes[low], self.sizes[high - 1], self.shared[part].max(), group)
        else:
            middle = (low + high) // 2
            a, b = self._build(low, middle), self._build(middle, high)
            x, y = self.nodes[a], self.nodes[b]
            node = (low, high, a, b, x[4] | y[4], x[5] & y[5], x[6], y[7], max(x[8], y[8]), x[9] if x[9] == y[9] else None)
        self.nodes.append(node)
        return len(self.nodes) - 1


def _count(bits: np.ndarray) -> int:
    return int(np.bitwise_count(bits).sum())


def most_overlap(a: tuple, b: tuple) -> int:
    """No set of node a shares more tokens than this with a set of node b."""
    common = _count(a[4] & b[4]) + min(a[8], b[8])
    return min(common, a[7] - _count(a[5] & ~b[4]), b[7] - _count(b[5] & ~a[4]))


def dual_join(left: SignatureTree, right: SignatureTree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of left and right of different groups whose similarity may reach percent.

    A pair of nodes is left out if all their sets are in one group, if even
    their closest sizes are too far apart, or if the largest possible overlap
    is too small for their smallest sets. In leaves the same bounds are taken
    for each pair of sets. A tree that is joined with itself gives each pair once.
    """
    same = left is right
    stack = [(left.root, right.root)]
    while stack:
        i, j = stack.pop()
        a, b = left.nodes[i], right.nodes[j]
        if a[9] is not None and a[9] == b[9]:
            continue
        if 100 * a[7] < percent * b[6] or 100 * b[7] < percent * a[6]:
            continue
        if not (same and i == j) and (100 + percent) * most_overlap(a, b) < percent * (a[6] + b[6]):
            continue
        if a[2] < 0 and b[2] < 0:
            yield from _leaf_pairs(left, right, a, b, percent, same and i == j)
        elif same and i == j:
            stack += [(a[2], a[2]), (a[2], a[3]), (a[3], a[3])]
        elif b[2] < 0 or (a[2] >= 0 and a[1] - a[0] >= b[1] - b[0]):
            stack += [(a[2], j), (a[3], j)]
        else:
            stack += [(i, b[2]), (i, b[3])]


def _leaf_pairs(left: SignatureTree, right: SignatureTree, a: tuple, b: tuple, percent: int, once: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    x, y = left.bitmaps[a[0] : a[1], None], right.bitmaps[None, b[0] : b[1]]
    m, n = left.sizes[a[0] : a[1], None], right.sizes[None, b[0] : b[1]]
    fits = ((100 + percent) * pair_overlaps(m, n, x, y) >= percent * (m + n)) & (left.groups[a[0] : a[1], None] != right.groups[None, b[0] : b[1]])
    if once:
        fits &= np.triu(np.ones(fits.shape, bool), 1)
    p, q = np.nonzero(fits)
    if len(p):
        yield left.order[a[0] + p], right.order[b[0] + q]
