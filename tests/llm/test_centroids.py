"""op13 against Lloyd rounds in plain NumPy."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.centroids import Lloyd, cluster_vectors, op13_centroid_clusters, whole_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, d, k=8, rounds=10, seed=3):
    """rows: (id, vector); a Counter of (id, cluster, distance) and the centroids."""
    kept = [(i, np.floor(1024 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)) for i, v in rows
            if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), q.tolist()) for i, q in kept if i is not None)
    cent = [np.array(q) for _, q in first[:k]]
    if not cent:
        return Counter(), []

    def near(q):
        return min((int(((q - c) ** 2).sum()), n) for n, c in enumerate(cent))

    for _ in range(rounds):
        at = [near(q)[1] for _, q in kept]
        for n in range(len(cent)):
            own = [q for (_, q), a in zip(kept, at) if a == n]
            if own:
                cent[n] = sum(own) // len(own)  # floor of the exact mean
    return Counter((i, near(q)[1], near(q)[0]) for i, q in kept), [c.tolist() for c in cent]


def vectors(n=300, d=10):
    r = np.random.RandomState(4)
    rows = [(i, (r.randn(d) + 3 * (i % 4)).astype(np.float32).tolist(), i % 3) for i in range(n)]
    rows += [(5, rows[5][1], 0)] * 120  # repeated rows
    rows += [(7, rows[9][1], 0), (None, rows[2][1], 0), (1000, [0.0] * d, 0), (1001, [0.0] * d, 0)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [1.0] * (d - 1), 1), (2003, [None] + [1.0] * (d - 1), 1),
             (2004, [float("nan")] * d, 1), (2005, [float("inf")] + [0.0] * (d - 1), 1), (2006, [1.0] * (d + 1), 1)]
    return rows


@pytest.mark.parametrize("k,rounds,block_rows,block_dims", [(8, 10, 64, 4), (3, 2, 7, 10), (5, 4, 4096, 1)])
def test_rounds_match_numpy(spark, k, rounds, block_rows, block_dims):
    df = spark.createDataFrame(vectors(), SCHEMA).repartition(3).withColumn("cluster", F.lit("x")).withColumn("id", F.lit(0))
    got, cent = cluster_vectors(df, d=10, k=k, rounds=rounds, block_rows=block_rows, block_dims=block_dims)
    want, cents = brute([r[:2] for r in vectors()], 10, k, rounds)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert cent.tolist() == cents


def test_few_vectors_and_none(spark):
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (9, [-0.0004, 5.0], 0)]
    got, cent = cluster_vectors(spark.createDataFrame(rows, SCHEMA), d=2)
    want, cents = brute([r[:2] for r in rows], 2)
    assert Counter(tuple(r) for r in got.collect()) == want and cent.tolist() == cents and len(cents) == 3
    none, cent = cluster_vectors(spark.createDataFrame([], SCHEMA), d=2)
    assert none.count() == 0 and len(cent) == 0
    null_ids, _ = cluster_vectors(spark.createDataFrame([(None, [1.0, 2.0], 0)], SCHEMA), d=2)
    assert null_ids.count() == 0  # nothing starts a centroid


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 2), 0.0], 0) for i in range(40)]
    got, _ = cluster_vectors(spark.createDataFrame(rows, SCHEMA), d=2, rounds=0)
    want, _ = brute([r[:2] for r in rows], 2, rounds=0)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert {r["cluster"] for r in got.collect()} == {min(c for i, c, _ in want if i % 2 == b) for b in (0, 1)}


def test_too_large_components_raise(spark):
    with pytest.raises(Exception, match="beyond"):
        cluster_vectors(spark.createDataFrame([(1, [1e30, 0.0], 0)], SCHEMA), d=2)


def test_blocks_are_not_exchanged(spark):
    """A round exchanges partial distances, labels and sums; the stored blocks are joined in place."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(vectors(), SCHEMA)
        lloyd = Lloyd(whole_vectors(df, "vec_id", "embedding", 10), 10, 1024, 64, 4)
        keys = lloyd.blocks.read().select("key").withColumn("label", F.lit(b"")).groupBy("key").agg(F.max("label").alias("label"))
        plan = lloyd.blocks.read().join(keys.hint("shuffle_hash"), "key")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 0  # both are bucketed here
        labels = lloyd.labels(np.zeros((2, 10), np.int64)).select(F.explode(F.array(F.col("grp"))).alias("key"), "label")
        plan = lloyd.blocks.read().join(labels.hint("shuffle_hash"), "key")._jdf.queryExecution().executedPlan().toString()
        side = plan[plan.index("ShuffledHashJoin"):]
        assert "FileScan" in side.split("Exchange")[0]  # the blocks' side ends in its scan
        lloyd.drop()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_query_matches_numpy(spark):
    sf = "/root/testdata/sf0.001"
    got = op13_centroid_clusters(spark, sf).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want, cents = brute(rows, 64)
    assert Counter((r["vec_id"], r["cluster"], r["distance"]) for r in got) == want
    total = Counter()
    for (_, c, dist), n in want.items():
        total[c] += dist * n
    for r in got:
        assert r["cluster_inertia"] == total[r["cluster"]] and r["inertia"] == sum(total.values())
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, cents[r["cluster"]])).encode()).hexdigest()
