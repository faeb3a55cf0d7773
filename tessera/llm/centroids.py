"""Centroid clustering by dimension-sharded Lloyd rounds, in exact integers.

Vectors are cut into blocks of rows and of columns.  In each round a task that holds a column block measures
its part of the squared distance of every row to every centroid, from the centroids' slices alone; the parts of
a row block are added by key and the nearest centroid taken; the labels go back to the column blocks, each of
which adds up its own rows and so updates its own slice of the centroids.  The blocks are stored by key: per
round only partial distances, labels and sums are exchanged, never vectors.  The driver holds the centroids
(k times d numbers) and nothing of the vectors; a round starts from the stored blocks, so no lineage grows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.layout import bucket_count, write_keyed
from tessera.llm.common import read_table
from tessera.session import drop_table, write_table

SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
BLOCK_ROWS = 4096
BLOCK_DIMS = 16
SEED = 3


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, d: int) -> DataFrame:
    """(id long, vec array<double>) of the rows whose vector has ``d`` components, none null or not finite."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return v.where((F.size("vec") == d) & ~bad)


def _whole(x: np.ndarray, scale: int, d: int) -> np.ndarray:
    q = np.floor(scale * x)
    limit = math.isqrt((1 << 62) // d) // 2
    if len(q) and np.abs(q).max() > limit:
        raise ValueError(f"a scaled component is beyond {limit}: squared distances would not fit a long")
    return q.astype(np.int64)


def start_vectors(whole: DataFrame, k: int, seed: int, scale: int) -> np.ndarray:
    """The vectors of the k smallest SHA-256 of ``seed:id``, ascending; null ids never start, equal ids by vector."""
    first = (whole.where("id is not null")
             .select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("h"), "vec")
             .orderBy("h", "vec").limit(k).collect())
    x = np.array([r["vec"] for r in first], np.float64)
    return _whole(x, scale, x.shape[1] if len(x) else 1)


def _cut(scale: int, d: int, rows: int, dims: int):
    """Row blocks of each partition, cut into column blocks; ids travel with the first."""
    cuts = range(0, d, dims)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId() << 32
        for b in batches:
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False)
            q = _whole(flat.reshape(-1, d), scale, d).astype(np.int32)
            for s in range(0, b.num_rows, rows):
                part = q[s:s + rows]
                yield pa.RecordBatch.from_arrays([
                    pa.array([group * len(cuts) + c for c in range(len(cuts))], pa.int64()),
                    pa.array([group] * len(cuts), pa.int64()), pa.array(range(len(cuts)), pa.int32()),
                    pa.array([np.ascontiguousarray(part[:, c:c + dims]).tobytes() for c in cuts], pa.binary()),
                    pa.array([b.column(0).slice(s, rows).to_pylist()] + [None] * (len(cuts) - 1), pa.list_(pa.int64()))],
                    ["key", "grp", "blk", "x", "ids"])
                group += 1
    return fn


def _slice(centroids: np.ndarray, blk: int, dims: int) -> np.ndarray:
    return centroids[:, blk * dims:(blk + 1) * dims]


def _partial(centroids: np.ndarray, dims: int):
    """Per block: the rows' squared distances to the centroids' slices, an (n, k) matrix of longs."""
    def fn(batches):
        for b in batches:
            for grp, blk, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                c = _slice(centroids, blk, dims)
                x = np.frombuffer(x.as_buffer(), np.int32).reshape(-1, c.shape[1]).astype(np.int64)
                out = np.stack([np.square(x - y).sum(axis=1) for y in c], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([grp], pa.int64()), pa.array([out.tobytes()], pa.binary())],
                                                 ["grp", "part"])
    return fn


def _nearest(k: int):
    """Adds the blocks of a row group: (grp, label, dist), the smallest number first among equals."""
    def fn(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_buffer(), np.int64) for p in table.column("part")).reshape(-1, k)
        label = total.argmin(axis=1)
        return pa.table({"grp": pa.array([table.column("grp")[0].as_py()], pa.int64()),
                         "label": pa.array([label.astype(np.int32).tobytes()], pa.binary()),
                         "dist": pa.array([total[np.arange(len(label)), label].tobytes()], pa.binary())})
    return fn


def _sums(k: int, d: int, dims: int):
    """Per task: each block's sums by cluster, a row per (block, cluster) that it met."""
    def fn(batches):
        acc: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for blk, x, label in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                w = min(dims, d - blk * dims)
                s, n = acc.setdefault(blk, (np.zeros((k, w), np.int64), np.zeros(k, np.int64)))
                label = np.frombuffer(label.as_buffer(), np.int32)
                np.add.at(s, label, np.frombuffer(x.as_buffer(), np.int32).reshape(-1, w))
                n += np.bincount(label, minlength=k)
        rows = [(blk, c, s[c].tolist(), int(n[c])) for blk, (s, n) in acc.items() for c in range(k) if n[c]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                zip(*rows), (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64()))], ["blk", "c", "s", "n"])
    return fn


class Lloyd:
    """The blocks of one table of vectors and the rounds over them."""

    def __init__(self, whole: DataFrame, d: int, scale: int, block_rows: int, block_dims: int):
        spark = whole.sparkSession
        self.d, self.dims, self.cuts = d, block_dims, -(-d // block_dims)
        blocks = whole.mapInArrow(_cut(scale, d, block_rows, block_dims),
                                  "key long, grp long, blk int, x binary, ids array<long>")
        # written as they come first: their size decides the number of buckets
        blocks, path = write_table(blocks, "lloydcut")
        size = blocks.agg(F.sum(F.octet_length("x"))).first()[0] or 0
        self.names, self.names_path = write_table(blocks.where("blk = 0").select("grp", "ids"), "lloydnames")
        self.blocks = write_keyed(blocks.select("key", "grp", "blk", "x"), "key", bucket_count(spark, size), "lloyd")
        drop_table(spark, path)

    def labels(self, centroids: np.ndarray) -> DataFrame:
        """(grp, label, dist): exact nearest centroids of each row group."""
        part = self.blocks.read().select("grp", "blk", "x").mapInArrow(_partial(centroids, self.dims),
                                                                       "grp long, part binary")
        return part.groupBy("grp").applyInArrow(_nearest(len(centroids)), "grp long, label binary, dist binary")

    def update(self, centroids: np.ndarray) -> np.ndarray:
        """The centroids after one round: componentwise floor of the means, empty clusters as they were."""
        k = len(centroids)
        keys = F.transform(F.sequence(F.lit(0), F.lit(self.cuts - 1)), lambda c: F.col("grp") * self.cuts + c)
        back = self.labels(centroids).select(F.explode(keys).alias("key"), "label")
        both = self.blocks.read().join(back.hint("shuffle_hash"), "key").select("blk", "x", "label")
        part = both.mapInArrow(_sums(k, self.d, self.dims), "blk int, c int, s array<long>, n long")
        total = (part.select("blk", "c", "n", F.posexplode("s").alias("pos", "s")).groupBy("blk", "c", "pos")
                 .agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
        out = centroids.copy()
        for r in total.select("blk", "c", "pos", F.expr("(s - pmod(s, n)) div n").alias("mean")).collect():
            out[r["c"], r["blk"] * self.dims + r["pos"]] = r["mean"]
        return out

    def rows(self, centroids: np.ndarray) -> DataFrame:
        """(id, cluster, distance) of every vector."""
        def fn(batches):
            for b in batches:
                for ids, label, dist in zip(*b.columns):
                    yield pa.RecordBatch.from_arrays([
                        ids.values, pa.array(np.frombuffer(label.as_buffer(), np.int32)),
                        pa.array(np.frombuffer(dist.as_buffer(), np.int64))], ["id", "cluster", "distance"])
        return (self.names.join(self.labels(centroids), "grp").select("ids", "label", "dist")
                .mapInArrow(fn, "id long, cluster int, distance long"))

    def drop(self) -> None:
        self.blocks.drop()
        drop_table(self.names.sparkSession, self.names_path)


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", d: int = 64,
                    k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE,
                    block_rows: int = BLOCK_ROWS, block_dims: int = BLOCK_DIMS) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) of every whole vector, the final centroids).

    Components become floor(scale * x).  Nulls and edges: vectors that are null, of another width or hold null
    or non-finite components are left out; rows with a null id or a repeated id are clustered like others, but
    a null id never starts a centroid; fewer vectors than ``k`` give fewer centroids, none an empty result; a
    centroid that coincides with a smaller one stays empty.  Components so large that a squared distance
    would not fit a long (131,072 at 64 components) raise a ValueError.  Other columns are not read.
    A task holds one row group's partial distances: block_rows * k * 8 bytes for each column block.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, id_col, vec_col, d)
    centroids = start_vectors(whole, k, seed, scale)
    if not len(centroids):
        return spark.createDataFrame([], "id long, cluster int, distance long"), np.zeros((0, d), np.int64)
    lloyd = Lloyd(whole, d, scale, block_rows, block_dims)
    for _ in range(rounds):
        centroids = lloyd.update(centroids)
    out, _ = write_table(lloyd.rows(centroids), "clusters")
    lloyd.drop()
    return out, centroids


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids = cluster_vectors(read_table(spark, sf_dir, "embeddings"))
    spread = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    by = F.array(*[F.struct(F.lit(spread.get(c, 0)).cast("long").alias("s"), F.lit(x).alias("sha"))
                   for c, x in enumerate(sha)] or [F.struct(F.lit(0).cast("long").alias("s"), F.lit("").alias("sha"))])
    mine = F.element_at(by, F.col("cluster") + 1)
    return rows.select(F.col("id").alias("vec_id"), "cluster", "distance", mine["s"].alias("cluster_inertia"),
                       F.lit(sum(spread.values())).cast("long").alias("inertia"), mine["sha"].alias("centroid_sha256"))


def _sql(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    def near(t):
        return f"""
b{t} AS MATERIALIZED (
  SELECT rid, vec_id, q, (m).c AS cluster, (m).d AS distance FROM (
    SELECT rid, any_value(vec_id) AS vec_id, any_value(v.q) AS q, min({{'d': CAST(list_sum(list_transform(list_zip(v.q, c.q),
             lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), 'c': c.c}}) AS m
    FROM v, c{t} c GROUP BY rid))"""

    def mean(t):
        return f"""
c{t + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.q, c.q) AS q FROM c{t} c LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS q FROM (
      SELECT cluster, pos, sum(x) AS s, count(*) AS n
      FROM (SELECT cluster, unnest(q) AS x, unnest(range(64)) AS pos FROM b{t}) GROUP BY ALL) GROUP BY cluster) m
  ON m.cluster = c.c)"""

    steps = [x for t in range(rounds) for x in (near(t), mean(t))]
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), q) - 1 AS INTEGER) AS c, q FROM v
  WHERE vec_id IS NOT NULL QUALIFY c < {k}),{",".join(steps)},{near(rounds)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM b{rounds} b JOIN c{rounds} c ON b.cluster = c.c
"""


SQL = _sql()
