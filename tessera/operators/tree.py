"""Sums of the Student-t kernel over many points of the plane, to rounding, without all pairs.

num(x, s) = 1 / (1 + |x - s|^2) is analytic in s but for poles at a distance of sqrt(1 + gap^2) from the real
plane, where ``gap`` is the distance of x from a box of sources.  A box of half-width a may stand for its points by
``ORDER`` x ``ORDER`` Chebyshev nodes with weights when sqrt(1 + gap^2) >= 2 a: the error then falls by
2 + sqrt(5) with every node, to 1e-15 of the kernel's size, so this is the sum itself and no parameter trades
it away.  Boxes of side 1 always qualify, however near; larger ones do from afar.  Boxes with fewer points than nodes
are taken point by point.
"""

from __future__ import annotations

import numpy as np

ORDER = 24
TREE_FROM = 8192            # points from which on the tree is taken
_DEPTH = 31                 # levels that a code of 62 bits tells apart
_ROWS = 1 << 15             # points whose polynomials are held at once


def _chebyshev(x: np.ndarray) -> np.ndarray:
    """T_0 .. T_{ORDER - 1} of each x, as rows."""
    t = np.empty((ORDER, len(x)))
    t[0], t[1] = 1.0, x
    for j in range(2, ORDER):
        np.multiply(2.0 * x, t[j - 1], out=t[j])
        t[j] -= t[j - 2]
    return t


_NODES = np.cos((2 * np.arange(ORDER) + 1) * np.pi / (2 * ORDER))
_TO_NODES = _chebyshev(_NODES) * np.where(np.arange(ORDER) == 0, 1.0, 2.0)[:, None] / ORDER


def _spread(v: np.ndarray) -> np.ndarray:
    """The bits of each number below 2^31 at the even places of a 62-bit one."""
    v = v.astype(np.uint64)
    for s, m in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333),
                 (1, 0x5555555555555555)):
        v = (v | v << np.uint64(s)) & np.uint64(m)
    return v


class _Box:
    __slots__ = ("level", "code", "lo", "hi", "centre", "half", "below", "held")

    def __init__(self, level: int, code: int, lo: int, hi: int, centre: tuple[float, float], half: float):
        self.level, self.code, self.lo, self.hi, self.centre, self.half = level, code, lo, hi, centre, half
        self.below = self.held = None


class KernelTree:
    """A quadtree over the finite points ``y`` (n, 2)."""

    def __init__(self, y: np.ndarray):
        low = np.floor(y.min(axis=0))
        top = max(0, int(np.ceil(np.log2(max(1.0, float((y.max(axis=0) - low).max()))))))
        side = 2.0 ** max(0, top - _DEPTH)
        cell = np.clip(np.floor((y - low) / side), 0, (1 << min(top, _DEPTH)) - 1)
        code = _spread(cell[:, 0]) | _spread(cell[:, 1]) << np.uint64(1)
        self.order = np.argsort(code, kind="stable")
        self.code, self.y = code[self.order], y[self.order]
        half = side * 2.0 ** min(top, _DEPTH) / 2
        self.root = _Box(min(top, _DEPTH), 0, 0, len(y), (low[0] + half, low[1] + half), half)

    def _below(self, b: _Box) -> list[_Box]:
        if b.below is None:
            level, h = b.level - 1, b.half / 2
            edges = np.array([(4 * b.code + q) << 2 * level for q in range(1, 4)], np.uint64)
            cut = [b.lo, *(b.lo + np.searchsorted(self.code[b.lo:b.hi], edges)).tolist(), b.hi]
            b.below = [_Box(level, 4 * b.code + q, cut[q], cut[q + 1],
                            (b.centre[0] + (h if q & 1 else -h), b.centre[1] + (h if q & 2 else -h)), h)
                       for q in range(4) if cut[q] < cut[q + 1]]
        return b.below

    @staticmethod
    def _is_leaf(b: _Box) -> bool:
        return b.level == 0 or b.hi - b.lo <= ORDER * ORDER

    def _sources(self, b: _Box, smooth: bool) -> tuple[np.ndarray, np.ndarray]:
        """(places, weights) that stand for the points of a box; of its nodes when it is ``smooth`` and full."""
        if not smooth or b.hi - b.lo <= ORDER * ORDER:
            return self.y[b.lo:b.hi], np.ones(b.hi - b.lo)
        if b.held is None:
            m = np.zeros((ORDER, ORDER))
            for s in range(b.lo, b.hi, _ROWS):
                u = (self.y[s:min(b.hi, s + _ROWS)] - b.centre) / b.half
                m += _chebyshev(u[:, 0]) @ _chebyshev(u[:, 1]).T
            x, z = np.meshgrid(b.centre[0] + b.half * _NODES, b.centre[1] + b.half * _NODES, indexing="ij")
            b.held = np.stack((x.ravel(), z.ravel()), axis=1), (_TO_NODES.T @ m @ _TO_NODES).ravel()
        return b.held

    def sums(self, at: np.ndarray, pair_sums) -> tuple[np.ndarray, np.ndarray]:
        """For the points ``at`` (places in ``y``): sum of num and of num^2 (y_i - y_j) over all other points."""
        back = np.empty(len(self.order), np.int64)
        back[self.order] = np.arange(len(self.order))
        place = back[at]
        by = np.argsort(place, kind="stable")
        place = place[by]
        z, rep = np.zeros(len(at)), np.zeros((len(at), 2))
        todo = [self.root]
        while todo:
            b = todo.pop()
            s, e = np.searchsorted(place, (b.lo, b.hi))
            if s == e:
                continue
            if not self._is_leaf(b):
                todo += self._below(b)
                continue
            own, mine, full = place[s:e], by[s:e], b.hi - b.lo > ORDER * ORDER and b.half <= 0.5
            targets = self.y[own]
            far = [self._sources(c, smooth) for c, smooth in self._met(b) if c is not b]
            if full:
                far.append(self._sources(b, True))
            if far:
                places, weights = (np.concatenate(x) for x in zip(*far))
                z[mine], rep[mine] = pair_sums(targets, places, weights=weights)
            if full:
                z[mine] -= 1.0  # its own part in the nodes
            else:
                nz, nr = pair_sums(targets, self.y[b.lo:b.hi], skip=own - b.lo)
                z[mine] += nz
                rep[mine] += nr
        return z, rep

    def _met(self, target: _Box) -> list[tuple[_Box, bool]]:
        """Boxes that hold every point once, and whether nodes may stand for them, as seen from all of ``target``."""
        out, todo = [], [self.root]
        (x, y), half = target.centre, target.half
        while todo:
            b = todo.pop()
            gap = max(0.0, abs(b.centre[0] - x) - half - b.half, abs(b.centre[1] - y) - half - b.half)
            # an ancestor of the target, or the target itself, has no gap
            smooth = 1.0 + gap * gap >= 4.0 * b.half * b.half
            if b is target:
                out.append((b, smooth))
            elif smooth and not (b.lo <= target.lo and target.hi <= b.hi) or self._is_leaf(b):
                out.append((b, smooth))
            else:
                todo += self._below(b)
        return out
