"""Regression trees on binned inputs as flat arrays, and the choice of a node's best split."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LEAF = -1
MASK_BYTES = 32


def mask_of(codes: np.ndarray) -> bytes:
    """The set of codes that go left, one bit each."""
    bits = np.zeros(MASK_BYTES * 8, np.uint8)
    bits[codes] = 1
    return np.packbits(bits, bitorder="little").tobytes()


@dataclass
class Tree:
    """Nodes in the order they were made; node 0 is the root. A leaf has feature ``LEAF`` and a value."""

    feature: list[int] = field(default_factory=lambda: [LEAF])
    mask: list[bytes] = field(default_factory=lambda: [bytes(MASK_BYTES)])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, mask: bytes) -> tuple[int, int]:
        """Two new leaves under a leaf."""
        low = len(self.feature)
        self.feature[node], self.mask[node], self.left[node], self.right[node] = feature, mask, low, low + 1
        for _ in range(2):
            for values, new in ((self.feature, LEAF), (self.mask, bytes(MASK_BYTES)), (self.left, 0), (self.right, 0), (self.value, 0.0)):
                values.append(new)
        return low, low + 1

    @property
    def leaves(self) -> list[int]:
        return [i for i, f in enumerate(self.feature) if f == LEAF]

    @property
    def depth(self) -> int:
        level = {0: 0}
        for i, f in enumerate(self.feature):
            if f != LEAF:
                level[self.left[i]] = level[self.right[i]] = level[i] + 1
        return max(level.values())


class Forest:
    """Trees end to end in arrays; ``apply`` walks one tree for many rows at once.

    The right child of a split stands behind its left one, and a leaf is its own left child, to which
    every code goes: all rows take the same steps.
    """

    def __init__(self, trees: list[Tree]):
        sizes = [len(t.feature) for t in trees]
        self.root = np.cumsum([0, *sizes])[:-1].astype(np.int64)
        self.depth = [t.depth for t in trees]
        cat = lambda name, dtype: np.array([v for t in trees for v in getattr(t, name)], dtype)
        feature = cat("feature", np.int64)
        leaf = feature == LEAF
        self.feature = np.where(leaf, 0, feature)
        self.left = np.where(leaf, np.arange(len(feature)), cat("left", np.int64) + np.repeat(self.root, sizes))
        self.value = cat("value", np.float64)
        masks = np.frombuffer(b"".join(m for t in trees for m in t.mask), np.uint8).reshape(-1, MASK_BYTES)
        bits = np.unpackbits(masks, axis=1, bitorder="little")
        used = np.flatnonzero(bits.any(0))
        # Codes behind the last one that goes left anywhere share a column.
        self.width = int(used[-1]) + 2 if len(used) else 1
        bits = np.append(bits, np.zeros((len(bits), 1), np.uint8), 1)[:, : self.width]
        self.goes_right = (1 - np.where(leaf[:, None], 1, bits)).astype(np.uint8).ravel()

    def apply(self, tree: int, bins: np.ndarray) -> np.ndarray:
        """The leaf (in this forest's numbering) of every row of ``bins``."""
        flat, at = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
        node = np.full(len(bins), self.root[tree], np.int64)
        for _ in range(self.depth[tree]):
            code = np.minimum(flat.take(at + self.feature.take(node)), self.width - 1)
            node = self.left.take(node) + self.goes_right.take(node * self.width + code)
        return node

    def gain(self, tree: int, bins: np.ndarray) -> np.ndarray:
        return self.value.take(self.apply(tree, bins))


def best_split(counts: np.ndarray, q: float, categories: np.ndarray, min_rows: int):
    """(gain, feature, mask) of the best split of a node, or None.

    ``counts`` holds, per input and code, the rows and how many of them lie at or under their
    forecast; they are whole numbers, so the choice does not depend on how rows are partitioned. The
    negative gradient of the pinball loss sums to q * rows - under; a split gains what it adds to the sums'
    squares over the rows. Codes of a category are tried in the order of their share under, other
    codes in their own order; the first of equal splits is taken.
    """
    n, under = counts[..., 0], counts[..., 1]
    total, total_under = n[0].sum(), under[0].sum()
    if total < 2 * min_rows:
        return None
    order = np.tile(np.arange(n.shape[1]), (n.shape[0], 1))
    if categories.any():
        share = under[categories] / np.maximum(n[categories], 1)
        order[categories] = np.argsort(np.where(n[categories] > 0, share, 2.0), axis=1, kind="stable")
    n_left = np.cumsum(np.take_along_axis(n, order, 1), axis=1)
    u_left = np.cumsum(np.take_along_axis(under, order, 1), axis=1)
    n_right, u_right = total - n_left, total_under - u_left
    ok = (n_left >= min_rows) & (n_right >= min_rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (q * n_left - u_left) ** 2 / n_left + (q * n_right - u_right) ** 2 / n_right
    gain = np.where(ok, gain - (q * total - total_under) ** 2 / total, -1.0)
    at = int(np.argmax(gain))
    feature, cut = divmod(at, gain.shape[1])
    if gain[feature, cut] <= 1e-9 * total:
        return None
    return float(gain[feature, cut]), feature, mask_of(order[feature, : cut + 1])


# -- quantiles of residuals from counts of value ranges -----------------------------------------

#: Relative width of a range: a quantile is off by at most half of it.
WIDTH = 0.01
_GROWTH = np.log1p(WIDTH)
_SMALL = 1e-9
_SHIFT = 1 << 14


def ranges_of(residual: np.ndarray) -> np.ndarray:
    """A whole number per residual, in the order of the residuals; equal ones share a range around them."""
    size = np.abs(residual)
    at = np.ceil(np.log(np.maximum(size, _SMALL)) / _GROWTH).astype(np.int64) + _SHIFT
    return np.where(size <= _SMALL, 0, np.sign(residual).astype(np.int64) * at)


def range_value(at: int) -> float:
    """The middle of a range."""
    if at == 0:
        return 0.0
    high = np.exp((abs(at) - _SHIFT) * _GROWTH)
    return float(np.sign(at) * high * (1 + 1 / (1 + WIDTH)) / 2)


def quantile_of(at: np.ndarray, times: np.ndarray, q: float) -> float:
    """The smallest residual with a share ``q`` of all at or under it, from counted ranges."""
    order = np.argsort(at)
    sums = np.cumsum(times[order])
    return range_value(int(at[order][np.searchsorted(sums, q * sums[-1] * (1 - 1e-12), "left")]))
