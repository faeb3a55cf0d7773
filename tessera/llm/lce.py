"""Longest common extensions of a word sequence by a difference cover.

A difference cover D modulo V holds, for every difference, two members that differ by it; so for any two
positions there is a shift below V that moves both onto sampled positions, those whose remainder is in D.
Only the suffixes at sampled positions are sorted.  A query compares the words up to the shift, and from
there takes the range minimum over the common prefixes of neighbouring sampled suffixes.
"""

from __future__ import annotations

import numpy as np

# A perfect difference set.
V = 31
COVER = (1, 5, 11, 24, 25, 27)
_D = len(COVER)

_PLACE = np.full(V, -1, np.int64)
_PLACE[list(COVER)] = np.arange(_D)
_IN = _PLACE >= 0
#: least shift that brings both remainders into the cover
_SHIFT = np.array([[next(t for t in range(V) if _IN[(a + t) % V] and _IN[(b + t) % V]) for b in range(V)]
                   for a in range(V)], np.int64)


class CoverLCE:
    """lcp(i, j): how many equal items follow i and j (i != j) in a sequence of integers >= 0.

    A sampled suffix takes 4 V bytes for its first words, 4 bytes a round of doubling and 4 a level of the
    range minima: some 40 bytes an item of the sequence.
    """

    def __init__(self, seq: np.ndarray):
        n = len(seq)
        blocks = n // V + 1
        # past the end every place has a value of its own, so that no two suffixes are equal
        self.seq = np.concatenate((seq.astype(np.int32), -1 - np.arange(blocks * V + 2 * V - n, dtype=np.int32)))
        at = (np.arange(blocks, dtype=np.int64)[:, None] * V + np.array(COVER)).ravel()
        m = len(at)
        heads = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(self.seq, V)[at])
        rank = np.unique(heads.view(np.dtype((np.void, 4 * V))).ravel(), return_inverse=True)[1].astype(np.int32)
        rounds = [rank]
        step = _D  # V items on are _D sampled suffixes on
        while rank.max() + 1 < m:
            key = rank.astype(np.int64) * (m + 1)
            key[:-step] += rank[step:] + 1
            rank = np.unique(key, return_inverse=True)[1].astype(np.int32)
            rounds.append(rank)
            step *= 2
        self.rank = rank
        order = np.empty(m, np.int64)
        order[rank] = np.arange(m)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(m - 1, np.int64)
        for k in range(len(rounds) - 2, -1, -1):
            r, s = rounds[k], _D << k
            same = r[a] == r[b]
            a[same] += s
            b[same] += s
            common[same] += V << k
        common += (heads[a] != heads[b]).argmax(axis=1)
        self.least = [common.astype(np.int32)]
        while (w := 1 << (len(self.least) - 1)) * 2 <= m - 1:
            low = self.least[-1]
            self.least.append(np.minimum(low[:-w], low[w:]))

    def lcp(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        shift = _SHIFT[i % V, j % V]
        out = np.zeros(len(i), np.int64)
        alive = np.arange(len(i))
        for t in range(int(shift.max(initial=0))):
            alive = alive[shift[alive] > t]
            alive = alive[self.seq[i[alive] + t] == self.seq[j[alive] + t]]
            out[alive] += 1
        far = np.flatnonzero(out == shift)
        if len(far):
            p, q = (x[far] + shift[far] for x in (i, j))
            a, b = (self.rank[x // V * _D + _PLACE[x % V]] for x in (p, q))
            lo, hi = np.minimum(a, b), np.maximum(a, b)  # the minimum over lo .. hi - 1
            level = np.log2(hi - lo).astype(np.int64)
            best = np.empty(len(far), np.int64)
            for k in np.unique(level):
                x = level == k
                best[x] = np.minimum(self.least[k][lo[x]], self.least[k][hi[x] - (1 << k)])
            out[far] += best
        return out
