"""Packed blocks for the quadratic steps: one row holds a block of points as a binary matrix.

A pass over all pairs gives each block an owner task.  The block's own row and a copy of every block that it
must meet travel there as packed rows -- at most B * B rows for n points, not n * B points -- and the task
streams the copies past its own block, so it keeps per-point results only and ends with them: no pair leaves a
task, and nothing is merged afterwards.  Blocks get their size in bytes, so B and the task's memory follow the
width of the points; points are dealt to blocks by a hash of their unique ids (no hot key can form), or by the
caller's own cells.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Blocks at any size, so that small inputs take the same path as large ones.
MIN_BLOCKS = 8
BLOCK_BYTES = 2 << 20
#: Tasks of a pass in which every point meets all others, and the bytes of points that one of them owns at most.
OWNERS = 48
OWNER_BYTES = 16 << 20

PIECES = "owner int, piece bigint, ids binary, x binary"


def plan_blocks(n: int, width: int, block_rows: int | None = None) -> int:
    """Number of blocks of about ``BLOCK_BYTES`` at ``width`` doubles a point (or of ``block_rows`` points if
    that is fewer), and never fewer than ``MIN_BLOCKS``."""
    rows = max(1, BLOCK_BYTES // (8 * max(1, width)))
    if block_rows is not None:
        rows = max(1, min(rows, block_rows))
    return max(MIN_BLOCKS, math.ceil(n / rows))


def plan_owners(n: int, width: int, block_rows: int | None = None) -> int:
    """Number of owners of a pass that sends every point to each: as ``plan_blocks``, but ``OWNERS`` at most while
    an owner's points stay below ``OWNER_BYTES``, so that what is sent grows with n and not with its square."""
    return min(plan_blocks(n, width, block_rows), max(OWNERS, math.ceil(8 * n * max(1, width) / OWNER_BYTES)))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal width as an (n, d) matrix of doubles."""
    n = len(column)
    if n == 0:
        return np.zeros((0, 0))
    width = column.value_lengths()
    if column.null_count or pc.min(width) != pc.max(width):
        raise ValueError("vectors must not be null and must be of one width")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat, dtype=np.float64).reshape(n, -1)


def floats(cell) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), np.float64)


def longs(cell) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), np.int64)


def pieces(points: DataFrame, blocks: int, n: int, id_col: str, features: str, slot_col: str | None = None,
           rest: str | None = None) -> DataFrame:
    """(owner, piece, ids, x[, rest]): the rows of ``points`` in packed pieces.

    ``features`` and ``rest`` are SQL expressions of arrays of doubles.  Without ``slot_col`` the rows are dealt to
    owners one by one, whatever partitions they come in, and a piece has at most n / blocks of them; with it they
    are packed where they are, and a piece holds rows of one batch and one slot, which is its owner.
    """
    rows = max(1, math.ceil(n / blocks))
    if not slot_col:
        points = points.repartition(blocks)
    src = points.selectExpr(f"CAST({id_col} AS BIGINT) AS id", f"CAST({features} AS ARRAY<DOUBLE>) AS f",
                            f"{slot_col or '0'} AS slot", *([f"{rest} AS rest"] if rest else []))

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        made = 0
        for b in batches:
            ids, x = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), matrix(b.column(1))
            more = matrix(b.column(3)) if rest else None
            if slot_col:
                slot = b.column(2).to_numpy(zero_copy_only=False)
                order = np.lexsort((ids, slot))
                cuts = np.flatnonzero(np.diff(slot[order], prepend=-1, append=-1))
                parts = [(int(slot[order[s]]), order[s:e]) for s, e in zip(cuts[:-1], cuts[1:])]
            else:
                parts = [(part, slice(s, s + rows)) for s in range(0, len(ids), rows)]
            for owner, at in parts:
                yield pa.RecordBatch.from_arrays([
                    pa.array([owner], pa.int32()), pa.array([(part << 32) + made], pa.int64()),
                    pa.array([ids[at].tobytes()], pa.binary()), pa.array([x[at].tobytes()], pa.binary()),
                    *([pa.array([more[at].tobytes()], pa.binary())] if rest else [])],
                    ["owner", "piece", "ids", "x", *(["rest"] if rest else [])])
                made += 1

    return src.mapInArrow(fn, PIECES + (", rest binary" if rest else ""))


class Rough:
    """Squared distances from the rows of A in single precision where their size allows it, and their error's bound.

    Points are taken about the mean of A and a distance is one product of matrices, |a|^2 + |b|^2 - 2ab with the
    norms as two more columns, so it errs by less than (width + 6) 2^-24 (2 |a||b| + |a|^2 + |b|^2).
    """

    def __init__(self, A: np.ndarray):
        self.mean = A.mean(axis=0)
        self.X = A - self.mean
        self.a2 = np.einsum("ij,ij->i", self.X, self.X)
        self.top = self.a2.max(initial=0.0)
        self.left = {}

    def against(self, B: np.ndarray):
        """(distances of the rows s:e of A from those of B, as a function; the error of each row of A)."""
        Y = B - self.mean
        b2 = np.einsum("ij,ij->i", Y, Y)
        size = self.top + b2.max(initial=0.0)
        kind = np.float32 if 1e-24 < size < 1e30 else np.float64
        if kind not in self.left:
            self.left[kind] = np.column_stack((-2.0 * self.X, self.a2, np.ones(len(self.X)))).astype(kind)
        left, right = self.left[kind], np.ascontiguousarray(np.column_stack((Y, np.ones(len(Y)), b2)).astype(kind).T)
        error = 2.0 * (B.shape[1] + 8) * float(np.finfo(kind).eps) * (self.a2 + b2.max(initial=0.0))
        return (lambda s, e: left[s:e] @ right), error + 1e-300


class Stripe(Protocol):
    """What an owner does: made from its own rows, fed the rows of others, then asked for its points' results."""

    def feed(self, row: dict) -> None: ...

    def finish(self) -> pa.RecordBatch: ...


def stream(batches: Iterator[pa.RecordBatch], stripe) -> Iterator[pa.RecordBatch]:
    """One owner's rows, those with side 0 first: ``stripe(own rows)``, fed the rows with side 1."""
    own, work = [], None
    for b in batches:
        at = {c: b.column(i) for i, c in enumerate(b.schema.names)}
        side = at["side"].to_pylist()
        for r in range(b.num_rows):
            row = {c: v[r] for c, v in at.items()}
            if side[r] == 0:
                own.append(row)
                continue
            if not own:
                return
            work = work or stripe(own)
            work.feed(row)
    if own:
        yield (work or stripe(own)).finish()


def run_stripes(dealt: DataFrame, blocks: int, stripe, schema: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``stripe`` over the rows (owner int, side int, ...) of each owner.

    Owners are numbers below ``blocks`` and each gets a partition of its own (hashing would put several in
    one, and adaptive execution would merge them by bytes); inside it the own rows come first and the others
    are streamed, so a task holds its block and one Arrow batch.
    """
    return (dealt.repartitionById(blocks, "owner").sortWithinPartitions("side", *by)
            .mapInArrow(lambda batches: stream(batches, stripe), schema))


def to_all_owners(packed: DataFrame, blocks: int, rest: bool = False, key: str | None = None) -> DataFrame:
    """Every piece once as its owner's (side 0, with ``rest``) and once for every owner (side 1).

    ``key`` is one more column, an expression over t.owner.
    """
    to = (f"explode(concat(array(named_struct('owner', owner, 'side', 0)), transform(sequence(0, {blocks - 1}), "
          "o -> named_struct('owner', int(o), 'side', 1)))) AS t")
    return packed.selectExpr(to, "piece", "ids", "x", *(["rest"] if rest else [])).selectExpr(
        *([key] if key else []), "t.owner AS owner", "t.side AS side", "piece", "ids", "x",
        *(["IF(t.side = 0, rest, NULL) AS rest"] if rest else []))


def blocks_for(df: DataFrame, n: int | None, width: int, block_rows: int | None) -> tuple[int, int]:
    """(n, B) for a point table; counts it when n is not known."""
    if n is None:
        n = df.count()
    return n, plan_blocks(n, width, block_rows)
