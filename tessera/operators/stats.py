"""Per-point statistics over all partners (J1 + P6 over packed blocks).

For every point: the number of partners, and the sum, minimum and maximum of the squared Euclidean distance
to every other point.  The sum needs no pairs: it follows from the number, the sum and the squares of all points.
The smallest and the largest of each row are chosen by rough distances with a margin above their error and measured
again as sum((a-b)^2).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.operators.blocks import Rough, floats, longs, pieces, plan_owners, run_stripes, to_all_owners

_TILE = 1 << 20


class _Stats:
    """One owner of the statistics pass."""

    def __init__(self, rows: list[dict]):
        self.ids = np.concatenate([longs(r["ids"]) for r in rows])
        self.A = np.concatenate([floats(r["x"]) for r in rows]).reshape(len(self.ids), -1)
        self.rough = Rough(self.A)
        m = len(self.ids)
        self.n, self.first, self.second = 0, np.zeros(self.A.shape[1]), 0.0
        self.min, self.max = np.full(m, np.inf), np.full(m, -np.inf)
        self.at, start = {}, 0
        for r in rows:
            self.at[r["piece"].as_py()] = start
            start += len(longs(r["ids"]))

    def _edge(self, at: slice, B: np.ndarray, D: np.ndarray, error: np.ndarray, sign: int) -> None:
        """The least (sign 1) or greatest (sign -1) distances, measured for the rows that may have a better one in B."""
        best = self.min if sign > 0 else self.max
        edge = sign * (D.min(axis=1, initial=np.inf) if sign > 0 else D.max(axis=1, initial=-np.inf)).astype(float)
        rows = np.flatnonzero(edge - error <= sign * best[at])
        if not len(rows):
            return
        limit = np.minimum(edge + 2 * error, sign * best[at] + error)[rows]
        r, c = np.nonzero(sign * D[rows] <= limit[:, None])
        step = max(1, _TILE // B.shape[1])
        for s in range(0, len(r), step):
            i, j = at.start + rows[r[s:s + step]], c[s:s + step]
            d = np.square(self.A[i] - B[j]).sum(axis=1)
            (np.minimum if sign > 0 else np.maximum).at(best, i, d)

    def feed(self, row: dict) -> None:
        B = floats(row["x"]).reshape(len(longs(row["ids"])), -1)
        same, Y = self.at.get(row["piece"].as_py()), B - self.rough.mean
        self.n += len(B)
        self.first += Y.sum(axis=0)
        self.second += np.einsum("ij,ij->", Y, Y)
        distances, error = self.rough.against(B)
        step = max(1, _TILE // max(1, len(B)))
        for s in range(0, len(self.A), step):
            at = slice(s, min(s + step, len(self.A)))
            D = distances(at.start, at.stop)
            own = np.zeros(0, np.int64)
            if same is not None:
                own = np.arange(max(s, same), min(at.stop, same + len(B)))
            for sign in (1, -1):
                D[own - s, own - same if len(own) else own] = sign * np.inf
                self._edge(at, B, D, error[at], sign)

    def finish(self) -> pa.RecordBatch:
        n = np.full(len(self.ids), self.n - 1, np.int64)
        total = np.maximum(self.n * self.rough.a2 + self.second - 2.0 * (self.rough.X @ self.first), 0.0)
        some = n > 0
        return pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (self.ids, n, total, self.min, self.max)],
                                          ["row_id", "partners", "d_sum", "d_min", "d_max"])


def pair_row_stats(vectors: DataFrame, block_rows: int | None = None, n: int | None = None) -> DataFrame:
    """(row_id, partners, d_sum, d_min, d_max) over all j != i; points without partners are left out."""
    if n is None:
        n = vectors.count()
    first = vectors.select("features").first()
    owners = plan_owners(n, len(first[0]) if first and first[0] else 1, block_rows)
    dealt = to_all_owners(pieces(vectors, owners, n, "row_id", "features"), owners)
    return run_stripes(dealt, owners, _Stats, "row_id bigint, partners bigint, d_sum double, d_min double, d_max double", ("piece",))
