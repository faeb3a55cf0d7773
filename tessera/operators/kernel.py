"""Student-t kernel on the embedding.

num_ij = 1 / (1 + |y_i - y_j|^2), zero on the diagonal; Z = sum_{i != j} num.
The all-pairs part runs over packed blocks -- by a tree of weighted nodes (``tree.py``) where there are many points
of the plane, pair by pair otherwise -- and returns, per point,

    zrow_i  = sum_j num_ij                      (row of the normaliser)
    rep_i,c = sum_j num_ij^2 (y_ic - y_jc)      (unnormalised repulsion)

so the n x n Q, P - Q and difference matrices are never formed.  Edge-level
quantities (q on the edges of P, p - q) only need the scalar Z.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.blocks import floats, longs, pieces, plan_owners, run_stripes, to_all_owners
from tessera.operators.tree import TREE_FROM, KernelTree

_TILE = 1 << 19  # pairs held at once


def pair_sums(A: np.ndarray, B: np.ndarray, same: int | None = None, weights: np.ndarray | None = None,
              skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each row of A over the rows of B: sum of num, and sum of num^2 (a - b) per coordinate.

    ``same`` is the row of A that B's first row equals, when B is a part of A: those pairs do not count.  ``skip``
    names a row of B that does not count for each row of A.  ``weights`` are of the rows of B.
    """
    m, k = A.shape
    z, rep = np.zeros(m), np.zeros((m, k))
    step = max(1, _TILE // max(1, len(B)))
    for s in range(0, m, step):
        a = A[s:s + step]
        diff = [a[:, c][:, None] - B[:, c][None, :] for c in range(k)]
        num = np.ones((len(a), len(B)))
        for x in diff:
            num += x * x
        np.reciprocal(num, out=num)
        if same is not None:
            i = np.arange(max(s, same), min(s + len(a), same + len(B)))
            num[i - s, i - same] = 0.0
        if skip is not None:
            num[np.arange(len(a)), skip[s:s + step]] = 0.0
        z[s:s + step] = num.sum(axis=1) if weights is None else num @ weights
        num *= num
        if weights is not None:
            num *= weights
        for c, x in enumerate(diff):
            rep[s:s + step, c] = np.einsum("ij,ij->i", num, x)
    return z, rep


def all_sums(y: np.ndarray, parts: list[tuple[np.ndarray, int | None]]) -> tuple[np.ndarray, np.ndarray]:
    """``pair_sums`` of the rows of y over all points, which come in ``parts``: (points, ``same`` in y)."""
    n = sum(len(p) for p, _ in parts)
    if y.shape[1] == 2 and n >= TREE_FROM and all(np.isfinite(p).all() for p, _ in parts):
        at, first = np.empty(len(y), np.int64), 0
        for p, same in parts:
            if same is not None:
                at[same:same + len(p)] = np.arange(first, first + len(p))
            first += len(p)
        return KernelTree(np.concatenate([p for p, _ in parts])).sums(at, pair_sums)
    z, rep = np.zeros(len(y)), np.zeros(y.shape)
    for p, same in parts:
        dz, dr = pair_sums(y, p, same)
        z += dz
        rep += dr
    return z, rep


class _Kernel:
    """One owner of the kernel pass."""

    def __init__(self, k: int, rows: list[dict]):
        self.k = k
        self.ids = np.concatenate([longs(r["ids"]) for r in rows])
        self.y = np.concatenate([floats(r["x"]) for r in rows]).reshape(-1, k)
        self.at, start = {}, 0
        for r in rows:
            self.at[r["piece"].as_py()] = start
            start += len(longs(r["ids"]))
        self.parts = []

    def feed(self, row: dict) -> None:
        self.parts.append((floats(row["x"]).reshape(-1, self.k).copy(), self.at.get(row["piece"].as_py())))

    def finish(self) -> pa.RecordBatch:
        z, rep = all_sums(self.y, self.parts)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids), pa.array(z), *(pa.array(np.ascontiguousarray(c)) for c in rep.T)],
            ["row_id", "zrow", *(f"rep{c}" for c in range(self.k))])


def kernel_row_sums(y: DataFrame, k: int, block_rows: int | None = None, n: int | None = None) -> DataFrame:
    """(row_id, zrow, rep0..rep{k-1}) over all partners j != i (K4 + J3, per point).

    ``y`` has columns row_id, y0..y{k-1}.  Points are dealt to owners and packed, and the packed pieces are sent to
    every owner, which ends with its points' sums; it holds all coordinates, 8 k bytes a point.
    """
    if n is None:
        n = y.count()
    owners = plan_owners(n, k, block_rows)
    dealt = to_all_owners(pieces(y, owners, n, "row_id", f"array({', '.join(f'y{c}' for c in range(k))})"), owners)
    schema = "row_id bigint, zrow double, " + ", ".join(f"rep{c} double" for c in range(k))
    return run_stripes(dealt, owners, lambda rows: _Kernel(k, rows), schema, ("piece",))


def normalizer(row_sums: DataFrame) -> float:
    """Z = sum_{i != j} num_ij (A6 on the kernel)."""
    v = row_sums.agg(F.sum("zrow").alias("z")).first()["z"]
    return float(v) if v is not None else 0.0


def divisor(z: float) -> float:
    """Z as a divisor: with fewer than two points there are no pairs, every
    numerator it divides is 0, and 1.0 avoids an ANSI divide-by-zero."""
    return z if z > 0.0 else 1.0


def edge_kernel(edges: DataFrame, y: DataFrame, k: int) -> DataFrame:
    """Each edge (i, j, ...) with its columns, the differences y_i - y_j and num_ij.

    Two equi-joins with the n-row embedding; Catalyst/AQE broadcasts it when
    its measured size is under the threshold and shuffles otherwise.
    """
    yi = y.selectExpr("row_id AS i", *[f"y{c} AS yi{c}" for c in range(k)])
    yj = y.selectExpr("row_id AS j", *[f"y{c} AS yj{c}" for c in range(k)])
    e = edges.join(yj, "j").join(yi, "i").selectExpr(*edges.columns, *[f"yi{c} - yj{c} AS dy{c}" for c in range(k)])
    return e.withColumn("num", F.lit(1.0) / (F.lit(1.0) + sum((F.col(f"dy{c}") * F.col(f"dy{c}") for c in range(k)), F.lit(0.0))))


def edge_affinity(edges: DataFrame, y: DataFrame, k: int, z: float, floor_q: bool = False) -> DataFrame:
    """q_ij = num_ij / Z on the edges of P (K5 on the support of P): (i, j, ..., num, q), other columns kept."""
    e = edge_kernel(edges, y, k)
    q = F.col("num") / F.lit(divisor(z))
    if floor_q:
        q = F.greatest(q, F.lit(1e-12))
    return e.select(*edges.columns, "num", q.alias("q"))
