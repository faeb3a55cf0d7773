"""The gradient's sums for every point in one pass.

For each point i of an embedding y the pass gives

    zrow_i  = sum_j num_ij                              over all j != i  (its row of Z)
    rep_i   = sum_j num_ij^2 (y_i - y_j)                over all j != i, or over the edges of P
    att_i   = sum_j p_ij num_ij (y_i - y_j)             over the edges of P
    klrow_i = sum_j p_ij log num_ij                     over the edges of P

so that dy_i = att_i - rep_i / Z.  The edges of P are stored once, packed and keyed by the owner of i; a pass
ships the coordinates in packed pieces to every owner and reduces there, in place: P is never exchanged, and no
partial sums are.  A task holds its block, its edges and all coordinates (8 k bytes a point).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.layout import KeyedTable, bucket_count, placement_keys, write_keyed
from tessera.operators.blocks import floats, longs, pieces, plan_owners, to_all_owners
from tessera.operators.kernel import all_sums

P_FLOOR = 1e-12
EDGES_A_ROW = 1 << 20


@dataclass
class EdgeStore:
    """P by owner: rows (key, owner, i, j, p) of packed edges, an owner's in one bucket."""

    table: KeyedTable
    keys: list[int]         # key of each owner
    blocks: int             # owners
    n: int                  # points
    rows: DataFrame         # the table

    def owner(self, col: str = "row_id") -> str:
        return f"CAST(pmod(xxhash64({col}), {self.blocks}) AS INT)"

    def drop(self) -> None:
        self.table.drop()


def _pack_edges(keys: list[int]):
    def fn(batches):
        held: dict[int, list] = {}

        def row(owner, parts):
            cols = [np.concatenate(x) for x in zip(*parts)]
            return pa.RecordBatch.from_arrays(
                [pa.array([keys[owner]], pa.int64()), pa.array([owner], pa.int32()),
                 *(pa.array([c.tobytes()], pa.binary()) for c in cols)], ["key", "owner", "i", "j", "p"])

        for b in batches:
            owner, i, j, p = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            for o in np.unique(owner).tolist():
                at = owner == o
                held.setdefault(o, []).append((i[at], j[at], p[at]))
                if sum(len(x[0]) for x in held[o]) >= EDGES_A_ROW:
                    yield row(o, held.pop(o))
        for o, parts in held.items():
            yield row(o, parts)
    return fn


def store_edges(p: DataFrame, n: int, k: int, block_rows: int | None = None) -> EdgeStore:
    """Pack P (i, j, p) once: one shuffle by the owner of i, an owner to a bucket."""
    spark = p.sparkSession
    blocks = plan_owners(n, k, block_rows)
    buckets = max(bucket_count(spark), blocks)
    keys = placement_keys(spark, buckets)
    dealt = (p.selectExpr(f"CAST(pmod(xxhash64(i), {blocks}) AS INT) AS owner", "CAST(i AS BIGINT) AS i",
                          "CAST(j AS BIGINT) AS j", "CAST(p AS DOUBLE) AS p").repartitionById(blocks, "owner"))
    rows = dealt.mapInArrow(_pack_edges(keys), "key bigint, owner int, i binary, j binary, p binary")
    table = write_keyed(rows, "key", buckets, "edges", dealt=True)
    return EdgeStore(table, keys[:blocks], blocks, n, table.read())


def field_schema(k: int, rest: int = 0) -> str:
    return ", ".join(["row_id bigint", "blk int", *(f"y{c} double" for c in range(k)),
                      *(f"rest{c} double" for c in range(rest)), "zrow double", *(f"rep{c} double" for c in range(k)),
                      *(f"att{c} double" for c in range(k)), "klrow double"])


def _owner_pass(k: int, rest: int, exaggeration: float, floor_p: bool, repulsion: str):
    names = [x.split()[0] for x in field_schema(k, rest).split(", ")]

    def fn(sent: pa.Table, edges: pa.Table) -> pa.Table:
        sent = sent.sort_by("piece")  # so that sums are taken in the same order each time
        side = sent.column("side").to_numpy()
        rows = [{c: sent.column(c)[r] for c in sent.column_names} for r in range(sent.num_rows)]
        own = [r for r, s in zip(rows, side) if s == 0]
        if not own:
            return pa.table({c: pa.array([], t) for c, t in zip(names, [pa.int64(), pa.int32()] + [pa.float64()] * len(names))})
        ids = np.concatenate([longs(r["ids"]) for r in own])
        y = np.concatenate([floats(r["x"]) for r in own]).reshape(-1, k)
        more = np.concatenate([floats(r["rest"]) for r in own]).reshape(len(ids), rest) if rest else np.zeros((len(ids), 0))
        start = dict(zip((r["piece"].as_py() for r in own), np.cumsum([0, *(len(longs(r["ids"])) for r in own)])))
        all_rows = [r for r, s in zip(rows, side) if s == 1]
        z, rep = all_sums(y, [(floats(r["x"]).reshape(-1, k), start.get(r["piece"].as_py())) for r in all_rows])
        att, kl = np.zeros(y.shape), np.zeros(len(ids))
        if repulsion == "graph":
            rep[:] = 0.0
        if edges.num_rows:
            all_ids = np.concatenate([longs(r["ids"]) for r in all_rows])
            all_y = np.concatenate([floats(r["x"]) for r in all_rows]).reshape(-1, k)
            by, mine = np.argsort(all_ids), np.argsort(ids)
            all_ids, all_y, sorted_ids = all_ids[by], all_y[by], ids[mine]
            for r in range(edges.num_rows):
                i, j, p = (edges.column(c)[r] for c in ("i", "j", "p"))
                i, p = mine[np.searchsorted(sorted_ids, longs(i))], floats(p)
                diff = y[i] - all_y[np.searchsorted(all_ids, longs(j))]
                num = 1.0 / (1.0 + np.einsum("ij,ij->i", diff, diff))
                pe = np.maximum(p * exaggeration, P_FLOOR) if floor_p else p * exaggeration
                for c in range(k):
                    att[:, c] += np.bincount(i, pe * num * diff[:, c], len(ids))
                    if repulsion == "graph":
                        rep[:, c] += np.bincount(i, num * num * diff[:, c], len(ids))
                kl += np.bincount(i, p * np.log(num), len(ids))
        cols = [ids, np.full(len(ids), own[0]["owner"].as_py(), np.int32), *y.T, *more.T, z, *rep.T, *att.T, kl]
        return pa.table({c: pa.array(np.ascontiguousarray(v)) for c, v in zip(names, cols)})

    return fn


def field(points: DataFrame, store: EdgeStore, k: int, exaggeration: float = 1.0, floor_p: bool = False,
          repulsion: str = "full", rest: list[str] | None = None) -> DataFrame:
    """(row_id, blk, y*, rest*, zrow, rep*, att*, klrow) of points (row_id, blk, y*[, rest columns]).

    ``repulsion`` "full" sums rep over all pairs, "graph" over the edges of P only; zrow is over all pairs.
    """
    rest = rest or []
    packed = pieces(points, store.blocks, store.n, "row_id", f"array({', '.join(f'y{c}' for c in range(k))})", "blk",
                    f"array({', '.join(rest)})" if rest else None)
    key = f"element_at(array({', '.join(f'{x}L' for x in store.keys)}), t.owner + 1) AS key"
    left = to_all_owners(packed, store.blocks, bool(rest), key).groupBy("key")
    return left.cogroup(store.rows.groupBy("key")).applyInArrow(
        _owner_pass(k, len(rest), exaggeration, floor_p, repulsion), field_schema(k, len(rest)))


def entropy_of(p: DataFrame) -> tuple[float, float]:
    """(sum p log p, sum p) over p > 0: what KL(P || Q) takes from P alone."""
    r = p.where("p > 0").agg(F.sum(F.col("p") * F.log("p")), F.sum("p")).first()
    return float(r[0] or 0.0), float(r[1] or 0.0)


def kl_from(plogp: float, psum: float, klsum: float, z: float) -> float:
    """KL(P || Q) = sum p log p - sum p log num + log Z * sum p, for q = num / Z."""
    return plogp - klsum + psum * math.log(z) if z > 0 else 0.0
