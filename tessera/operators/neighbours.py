"""Exact k-nearest neighbours over all pairs, without forming the pairs.

Points are assigned to the nearest of some pivots, which cuts the table into cells; large cells are split
into blocks that share their pivot.  Let u bound the squared distance of a point x of pivot p to its k-th
neighbour.  All points of another pivot's cell lie behind the plane half way between the two pivots, so a
cell q is skipped for x when (|x - q|^2 - |x - p|^2) / (2 |p - q|) > sqrt(u), and a block is sent only to the
blocks that hold a point for which it is not.  The owner streams the blocks that it is sent past its own,
lowers u as it goes, tests each by its centre c and radius R first (|x - c| - R > sqrt(u), the triangle
inequality), and ends with the final neighbours of its points: no candidates are shuffled or merged.

u starts as the smaller of two bounds: the k-th distance inside the point's own block, and that to a
fixed-size sample of the table, which also gives the pivots.  On data without clusters no pair of cells can be
skipped and every block meets every other one; the result is exact either way.

Blocks are dealt to tasks in groups of neighbouring cells, and a block goes once to each group that holds an owner
that asked for it: what is sent is the table a bounded number of times, not once per block.

Distances are squared Euclidean, as the original's entropy search uses them.  Candidates are chosen by rough
distances (``blocks.Rough``) with a margin above their error and measured again as sum((a-b)^2); ties are broken by
the smaller id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.blocks import MIN_BLOCKS, OWNERS, Rough, floats, longs, matrix, plan_blocks, run_stripes

SAMPLE_ROWS = 1024                  # expected rows of the sample for pivots and first bounds
MAX_CELLS = 1024                    # pivots: they go to every task
SLACK = 1e-9                        # of Gram forms and roots, relative to the squared norms; they err by far less
ELEMENTS = 1 << 22                  # numbers held at once when distances are measured
TILE = 1 << 20                      # rough distances held at once
GROUP = 8                           # blocks of a task, when there are more than OWNERS groups of as many
NEIGHBOURS = "i bigint, j bigint, d double, rank int"


def _sq(A: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", A, A)


def _gram(A, a2, B, b2):
    return a2[:, None] + b2[None, :] - 2.0 * (A @ B.T)


def sample_points(vectors: DataFrame, n: int, id_col: str, feat_col: str, sample_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) of a hash sample: about ``sample_rows`` rows at any n, k and mode."""
    share = min(1.0, sample_rows / max(1, n))
    keep = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    rows = vectors.select(F.col(id_col).cast("bigint"), F.col(feat_col).cast("array<double>")).where(keep).toArrow()
    if not rows.num_rows:  # none fell into it: of the table's width all the same
        first = vectors.select(F.col(feat_col).cast("array<double>")).first()
        return np.zeros(0, np.int64), np.zeros((0, len(first[0]) if first else 1))
    return rows.column(0).to_numpy(), matrix(rows.column(1).combine_chunks())


def choose_pivots(S: np.ndarray, cells: int) -> np.ndarray:
    """``cells`` pivots of a sample: the farthest point first, then a few rounds of means."""
    if len(S) == 0:
        return S
    P = S[:1]
    near = _sq(S - P[0])
    while len(P) < min(cells, len(S)) and near.max() > 0:
        P = np.concatenate((P, S[near.argmax()][None]))
        near = np.minimum(near, _sq(S - P[-1]))
    s2 = _sq(S)
    for _ in range(4):
        at = _gram(S, s2, P, _sq(P)).argmin(axis=1)
        P = np.stack([S[at == c].mean(axis=0) if (at == c).any() else P[c] for c in range(len(P))])
    return P


class _Best:
    """The k nearest (distance, id) of each row of a block so far."""

    def __init__(self, k: int, m: int):
        self.k, self.m = k, m
        self.d, self.j, self.r = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, r, j, d) -> None:
        r, j, d = (np.concatenate(x) for x in ((self.r, r), (self.j, j), (self.d, d)))
        order = np.lexsort((j, d, r))
        r, j, d = r[order], j[order], d[order]
        first = np.searchsorted(r, np.arange(self.m))
        self.rank = np.arange(len(r)) - first[r]
        keep = self.rank < self.k
        self.r, self.j, self.d, self.rank = r[keep], j[keep], d[keep], self.rank[keep]

    def kth(self) -> np.ndarray:
        """The k-th distance of each row, infinite where there are fewer."""
        out = np.full(self.m, np.inf)
        last = self.rank == self.k - 1
        out[self.r[last]] = self.d[last]
        return out


class _Neighbours:
    """One owner of the k-nearest-neighbour pass."""

    def __init__(self, k: int, row: dict):
        self.k = k
        self.ids = longs(row["ids"])
        self.A = floats(row["x"]).reshape(len(self.ids), -1)
        self.a2 = _sq(self.A)
        self.rough = Rough(self.A)
        self.u = floats(row["bound"])
        self.best = _Best(k, len(self.ids))
        self.wait, self.rows = [], 0
        self.found, self.held = [], 0
        self._take(self.A, self.ids, True)
        self._merge()

    def feed(self, ids: np.ndarray, B: np.ndarray, c: np.ndarray, reach: float) -> None:
        c2 = c @ c
        to = np.sqrt(np.maximum(_gram(self.A, self.a2, c[None], np.array([c2]))[:, 0], 0.0))
        if not (to - reach <= np.sqrt(self.u) + math.sqrt(SLACK) * np.sqrt(self.a2 + c2)).any():
            return
        self.wait.append((ids, B))
        self.rows += len(ids)
        if self.rows >= 8192:
            self._flush()

    def _flush(self) -> None:
        if self.wait:
            ids, B = (np.concatenate(x) for x in zip(*self.wait))
            self.wait, self.rows = [], 0
            self._take(B, ids, False)

    def _merge(self) -> None:
        if self.found:
            self.best.add(*(np.concatenate(x) for x in zip(*self.found)))
            self.found, self.held = [], 0
            self.u = np.minimum(self.u, self.best.kth())

    def _take(self, B: np.ndarray, ids: np.ndarray, own: bool) -> None:
        distances, error = self.rough.against(B)
        if not np.isfinite(error).all():
            raise ValueError("squared distances overflow: scale the vectors")
        step, others = max(1, TILE // max(1, len(B))), len(B) - own
        for s in range(0, len(self.A), step):
            e = min(s + step, len(self.A))
            D, limit = distances(s, e), self.u[s:e] + error[s:e]
            if own:
                D[np.arange(e - s), np.arange(s, e)] = np.nan
            at = np.flatnonzero(D <= _above(limit, D.dtype)[:, None])
            if len(at) > 4 * self.k * (e - s) and others > self.k:
                near = np.partition(D, self.k - 1, axis=1)[:, self.k - 1] + 2 * error[s:e]
                at = np.flatnonzero(D <= _above(np.minimum(limit, near), D.dtype)[:, None])
            r, c = np.divmod(at, len(B))
            r += s
            d = np.empty(len(r))
            cut = max(1, ELEMENTS // max(1, B.shape[1]))
            for t in range(0, len(r), cut):
                d[t:t + cut] = _sq(self.A[r[t:t + cut]] - B[c[t:t + cut]])
            good = d <= self.u[r]
            self.found.append((r[good], ids[c[good]], d[good]))
            self.held += int(good.sum())
            if self.held > self.k * len(self.A) or np.isinf(self.u[s:e]).any():
                self._merge()

    def finish(self) -> pa.RecordBatch:
        self._flush()
        self._merge()
        b = self.best
        return pa.RecordBatch.from_arrays([pa.array(self.ids[b.r]), pa.array(b.j), pa.array(b.d),
                                           pa.array((b.rank + 1).astype(np.int32))], ["i", "j", "d", "rank"])


def _above(x: np.ndarray, kind) -> np.ndarray:
    """``x`` rounded up to a number of this kind."""
    return np.nextafter(x.astype(kind), np.array(np.inf, kind))


class _Group:
    """The owners of a task, each fed the blocks that it asked for."""

    def __init__(self, k: int, rows: list[dict]):
        self.own = {r["blk"].as_py(): _Neighbours(k, r) for r in rows}

    def feed(self, row: dict) -> None:
        ids = longs(row["ids"]).copy()  # a copy, so that no batch is held
        B, c, reach = floats(row["x"]).reshape(len(ids), -1).copy(), floats(row["centre"]), row["radius"].as_py()
        for blk in np.frombuffer(row["asked"].as_buffer(), np.int32).tolist():
            if blk in self.own:  # else it is a block without points
                self.own[blk].feed(ids, B, c, reach)

    def finish(self) -> pa.RecordBatch:
        done = pa.Table.from_batches([self.own[b].finish() for b in sorted(self.own)]).combine_chunks()
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in done.columns], names=done.column_names)


def _pack_cells(k: int, sid: np.ndarray, S: np.ndarray, P: np.ndarray, base: np.ndarray, probes: int | None):
    """A block's row for its own place -- its points, a first bound for each, its centre and radius -- and a
    request, without points, for every block of the cells that it must meet."""
    s2, p2 = _sq(S), _sq(P)

    def fn(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        ids = t.column("id").combine_chunks().to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        X, ids = matrix(t.column("f").combine_chunks())[order], ids[order].astype(np.int64)
        x2 = _sq(X)
        if not np.isfinite(x2).all():
            raise ValueError("vectors must be finite, and their squared distances must not overflow")
        cell = int(t.column("cell")[0].as_py())
        gap = 2.0 * np.sqrt(_sq(P - P[cell]))
        bound, meets = np.full(len(X), np.inf), np.zeros(len(P), bool)
        step = max(1, ELEMENTS // max(1, len(S), len(X), len(P)))
        for s in range(0, len(X), step):
            A, a2 = X[s:s + step], x2[s:s + step]
            for D, ban in ((_gram(A, a2, S, s2), ids[s:s + step, None] == sid[None, :]),
                           (_gram(A, a2, X, x2), ids[s:s + step, None] == ids[None, :])):
                if D.shape[1] > k:
                    D[ban] = np.inf
                    far = np.partition(D, k - 1, axis=1)[:, k - 1]
                    bound[s:s + step] = np.minimum(bound[s:s + step], far + SLACK * (4 * a2 + 4 * np.abs(far) + 1e-300))
            # to the plane between the own pivot and another: everything of the other's cell lies behind it
            to = _gram(A, a2, P, p2)
            if probes is not None:  # the cells of each point's nearest pivots, and its own
                near = np.argpartition(to, min(probes, len(P)) - 1, axis=1)[:, :probes]
                meets[near.ravel()] = True
                meets[cell] = True
                continue
            beyond = to - to[:, [cell]] - SLACK * (a2[:, None] + p2[None, :] + p2[cell])
            reach = np.minimum(np.sqrt(bound[s:s + step]), 1e150)  # not infinite: its product with 0 is no number
            meets |= (beyond <= reach[:, None] * gap * (1 + SLACK)).any(axis=0)
        c, blk = X.mean(axis=0), int(t.column("blk")[0].as_py())
        asked = np.concatenate([np.arange(base[q], base[q + 1]) for q in np.flatnonzero(meets)])
        asked = asked[asked != blk].astype(np.int32)
        none = [None] * len(asked)
        yield pa.RecordBatch.from_arrays([
            pa.array([blk, *asked], pa.int32()), pa.array(np.full(1 + len(asked), blk, np.int32)),
            pa.array([ids.tobytes(), *none], pa.binary()), pa.array([X.tobytes(), *none], pa.binary()),
            pa.array([bound.tobytes(), *none], pa.binary()), pa.array([c.tobytes(), *none], pa.binary()),
            pa.array([math.sqrt(_sq(X - c).max()) * (1 + SLACK), *none], pa.float64())],
            ["place", "owner", "ids", "x", "bound", "centre", "radius"])
    return fn


def _send(blocks: int, groups: int):
    """At one place: its block for its own group (side 0) and, without bounds, once for each group that holds
    owners that asked for it (side 1), with their numbers."""
    def fn(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        mine = t.filter(pc.is_valid(t.column("ids")))
        asked = t.filter(pc.is_null(t.column("ids"))).column("owner").combine_chunks().to_numpy(zero_copy_only=False)
        if not mine.num_rows:  # asked for by its cell, but without points
            return
        block = {c: mine.column(c)[0].as_py() for c in ("place", "ids", "x", "bound", "centre", "radius")}

        def row(group: int, side: int, bound: bytes | None, who: bytes | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"owner": group, "blk": block["place"], "side": side, "asked": who, "bound": bound}
                                               | {c: block[c] for c in ("ids", "x", "centre", "radius")}], SENT)

        yield row(block["place"] * groups // blocks, 0, block["bound"], None)
        group = asked.astype(np.int64) * groups // blocks
        for g in np.unique(group).tolist():
            yield row(g, 1, None, np.sort(asked[group == g]).astype(np.int32).tobytes())
    return fn


PLACED = "place int, owner int, ids binary, x binary, bound binary, centre binary, radius double"
DEALT = "owner int, blk int, side int, asked binary, ids binary, x binary, bound binary, centre binary, radius double"
SENT = pa.schema([(c.split()[0], {"int": pa.int32(), "double": pa.float64()}.get(c.split()[1], pa.binary()))
                  for c in DEALT.split(", ")])


def cell_blocks(vectors: DataFrame, k: int, n: int, block_rows: int | None = None, id_col: str = "row_id",
                feat_col: str = "features", sample_rows: int = SAMPLE_ROWS, probes: int | None = None,
                cells: int | None = None) -> tuple[DataFrame, int]:
    """(blocks and the requests between them, number of blocks): every point in a block of its nearest pivot's cell.

    A row with ids is a block at its own place; one without asks the block at ``place`` for the block ``owner``.
    """
    sid, S = sample_points(vectors, n, id_col, feat_col, sample_rows)
    blocks = plan_blocks(n, S.shape[1], block_rows)
    P = choose_pivots(S, min(MAX_CELLS, max(cells or 0, blocks))) if len(S) else np.zeros((1, S.shape[1]))
    # cells are split into blocks by the sample's estimate of their size
    at = _gram(S, _sq(S), P, _sq(P)).argmin(axis=1)
    share = (np.bincount(at, minlength=len(P)) + 1) / (len(at) + len(P))
    parts = np.maximum(1, np.rint(share * max(blocks, MIN_BLOCKS)).astype(np.int64))
    base = np.concatenate(([0], np.cumsum(parts)))
    p2 = _sq(P)
    step = max(1, ELEMENTS // len(P))

    def assign(batches):
        for b in batches:
            X = matrix(b.column(1))
            if not len(X):
                continue
            cell = np.concatenate([_gram(X[s:s + step], _sq(X[s:s + step]), P, p2).argmin(axis=1)
                                   for s in range(0, len(X), step)])
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            spread = (ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)  # ids are unique: no hot key
            blk = base[cell] + (spread % parts[cell].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell.astype(np.int32)),
                                              pa.array(blk.astype(np.int32))], ["id", "f", "cell", "blk"])

    v = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(feat_col).cast("array<double>").alias("f"))
    dealt = v.mapInArrow(assign, "id bigint, f array<double>, cell int, blk int")
    placed = dealt.repartitionById(int(base[-1]), "blk").mapInArrow(_pack_cells(k, sid, S, P, base, probes), PLACED)
    return placed, int(base[-1])


def knn(vectors: DataFrame, k: int, block_rows: int | None = None, n: int | None = None,
        id_col: str = "row_id", feat_col: str = "features", sample_rows: int | None = None) -> DataFrame:
    """Exact k nearest neighbours: (i, j, d squared distance, rank from 1).

    Ties in distance are broken by the smaller j.  ``k >= n - 1`` gives all pairs (the original's non-kNN
    mode), which is quadratic by definition.  Nothing but the sample, of a fixed size, is collected.  An
    empty table gives an empty result.
    """
    if n is None:
        n = vectors.count()
    m = SAMPLE_ROWS if sample_rows is None else sample_rows
    placed, blocks = cell_blocks(vectors, k, n, block_rows, id_col, feat_col, m)
    return neighbours_of(placed, blocks, k)


def approximate_knn(vectors: DataFrame, k: int, probes: int, cells: int | None = None, block_rows: int | None = None,
                    n: int | None = None, id_col: str = "row_id", feat_col: str = "features",
                    sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Approximate k nearest neighbours (E1): as ``knn``, but a block meets only the cells of the ``probes``
    pivots nearest to each of its points.  Distances and ranks are exact among the points that it meets.

    Work grows with n * probes * n / cells instead of n^2, with at most ``MAX_CELLS`` cells; large cells are
    split into blocks, so none is hot.  ``probes`` of all cells gives the exact result.
    """
    if n is None:
        n = vectors.count()
    placed, blocks = cell_blocks(vectors, k, n, block_rows, id_col, feat_col, sample_rows, probes, cells)
    return neighbours_of(placed, blocks, k)


def neighbours_of(placed: DataFrame, blocks: int, k: int) -> DataFrame:
    groups = min(blocks, max(OWNERS, math.ceil(blocks / GROUP)))
    dealt = placed.repartitionById(blocks, "place").mapInArrow(_send(blocks, groups), DEALT)
    return run_stripes(dealt, groups, lambda rows: _Group(k, rows), NEIGHBOURS)


def neighbour_lists(knn_df: DataFrame) -> DataFrame:
    """Group to one sorted neighbour list per point (A3): (i, nb array<struct<d, j>>).

    The list holds at most k entries, so the group is bounded.
    """
    return knn_df.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("d", "j"))).alias("nb"))
