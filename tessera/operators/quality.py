"""Quality checks of an embedding (extras E2, E3 -- not part of the original job).

E3: KL(P || Q) over the edges of P, with Q from the tiled normaliser.
E2: share of each point's input-space k nearest neighbours that are also
    among its k nearest neighbours in the embedding (both exact, tiled).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.kernel import edge_affinity, kernel_row_sums, normalizer
from tessera.operators.neighbours import knn


def kl_divergence(p: DataFrame, y: DataFrame, k: int, n: int, block_rows: int | None = None) -> DataFrame:
    """One row: KL(P || Q) = sum_ij p_ij log(p_ij / q_ij) over p_ij > 0 (P normalised)."""
    z = normalizer(kernel_row_sums(y, k, block_rows, n))
    e = edge_affinity(p.where("p > 0"), y, k, z)
    return e.agg(F.sum(F.col("p") * F.log(F.col("p") / F.col("q"))).alias("kl"))


def neighbour_preservation(vectors: DataFrame, y: DataFrame, k: int, n: int, n_neighbours: int = 10,
                           block_rows: int | None = None) -> DataFrame:
    """(i, kept, share): how many of the input-space neighbours stay neighbours in y."""
    hi = knn(vectors, n_neighbours, block_rows, n).select("i", "j")
    ya = y.select("row_id", F.array(*[F.col(f"y{c}") for c in range(k)]).alias("features"))
    lo = knn(ya, n_neighbours, block_rows, n).select("i", "j").withColumn("hit", F.lit(1))
    j = hi.join(lo, ["i", "j"], "left")
    return j.groupBy("i").agg(F.count("hit").alias("kept")).select(
        "i", "kept", (F.col("kept") / F.lit(float(n_neighbours))).alias("share"))
