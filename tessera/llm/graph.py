"""Connected components of an edge table by rounds of large-star and small-star.

Every round is two joins with a pre-aggregated minimum per node, so a hub
never becomes one group; the edges are written to the session's checkpoint
folder after each round, which cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import drop_table, write_table

_EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64())])


class UnionFind:
    """Union by smaller label over any hashable labels."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        up, r = self.up, x
        while (p := up.get(r, r)) != r:
            r = p
        while (p := up.get(x, x)) != r:
            up[x], x = r, p
        return r

    def union(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        return True


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the edges of each batch by a star per component: never more rows than nodes."""
    for b in batches:
        uf = UnionFind()
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            uf.union(u, v)
        nodes = list(uf.up)
        roots = [uf.find(x) for x in nodes]
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], schema=_EDGE)


def _star(e: DataFrame) -> DataFrame:
    und = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = und.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (und.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    low2 = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low2, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(low2.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u long, v long); root is the smallest node of its component.

    Nulls and loops are ignored; an empty table gives an empty result.
    """
    spark = edges.sparkSession
    e = (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
         .filter("u is not null and v is not null and u <> v")
         .mapInArrow(_forest, "u long, v long"))
    e, path = write_table(e, "cc")
    before = None
    while True:
        now, new = write_table(_star(e), "cc")
        drop_table(spark, path)
        e, path = now, new
        mark = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def star_edges(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For rows (key, id): one (key, smallest id) per key, and the links (id, smallest id) of the others."""
    order = np.lexsort((ids, keys))
    k, d = keys[order], ids[order]
    head = np.ones(len(k), bool)
    head[1:] = k[1:] != k[:-1]
    first = d[head][np.cumsum(head) - 1] if len(k) else d
    rest = ~head & (d != first)
    return k[head], d[head], d[rest], first[rest]
