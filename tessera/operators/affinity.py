"""High-dimensional affinities: perplexity search and the joint P."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.entropy import perplexity_search
from tessera.operators.neighbours import neighbour_lists
from tessera.session import cut_lineage

P_FLOOR = 1e-12


def beta_search(knn_df: DataFrame, perplexity: float = 30.0, tol: float = 1e-5, max_tries: int = 50) -> DataFrame:
    """Per-point precision search (K2).

    Returns (i, js array<bigint>, ds array<double>, beta, h, tries, converged,
    p array<double>); lists hold at most k entries in (d, j) order.
    """
    nb = neighbour_lists(knn_df)
    lists = nb.select("i", F.transform("nb", lambda x: x["j"]).alias("js"),
                      F.transform("nb", lambda x: x["d"]).alias("ds"))
    s = perplexity_search(F.col("ds"), perplexity, tol, max_tries)
    return lists.withColumn("s", s).select("i", "js", "ds", "s.beta", "s.h", "s.tries", "s.converged", "s.p")


def conditional_affinity(search: DataFrame) -> DataFrame:
    """p(j | i) edges from a beta search (K2): (i, j, p)."""
    z = search.select("i", F.explode(F.arrays_zip(F.col("js").alias("j"), F.col("p").alias("p"))).alias("e"))
    return z.select("i", F.col("e.j").alias("j"), F.col("e.p").alias("p"))


def transpose(edges: DataFrame, value: str = "p") -> DataFrame:
    """(i, j, v) -> (j, i, v)."""
    return edges.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col(value))


def with_diagonal(edges: DataFrame, value: float = 0.0) -> DataFrame:
    """Add (i, i, value) for every row id present, as a set (P7 + A8).

    Edges are unique, so only the diagonal needs to be made distinct: one row per i, but for those that
    ``edges`` has already.
    """
    diag = edges.select("i").distinct().select("i", F.col("i").alias("j"), F.lit(float(value)).alias("p"))
    have = edges.where("i = j").select("i", "p")
    return edges.select("i", "j", "p").unionByName(diag.join(have, ["i", "p"], "left_anti").select("i", "j", "p"))


def symmetrize(edges: DataFrame) -> DataFrame:
    """P + P^T by a keyed sum (U1 + A5): (i, j, p).  Partial aggregation
    before the shuffle keeps hub points (in many lists) cheap."""
    both = edges.select("i", "j", "p").unionByName(transpose(edges))
    return both.groupBy("i", "j").agg(F.sum("p").alias("p"))


def total(edges: DataFrame, value: str = "p") -> float:
    """Global sum (A6), returned as one scalar."""
    v = edges.agg(F.sum(value).alias("s")).first()["s"]
    return float(v) if v is not None else 0.0


def floor_values(edges: DataFrame, value: str = "p", floor: float = P_FLOOR) -> DataFrame:
    """max(v, 1e-12)."""
    return edges.withColumn(value, F.greatest(F.col(value), F.lit(floor)))


def scale(edges: DataFrame, factor: float, value: str = "p") -> DataFrame:
    """Multiply by a constant, e.g. early exaggeration."""
    return edges.withColumn(value, F.col(value) * F.lit(float(factor)))


def joint_probabilities(cond: DataFrame) -> DataFrame:
    """Normalised joint P = (P + P^T) / sum, without exaggeration: sums to 1.

    Off-diagonal edges only (the diagonal is 0 and cannot reach a gradient).
    """
    sym = cut_lineage(symmetrize(cond).where(F.col("i") != F.col("j")), "sym")  # summed, then divided
    s = total(sym)
    return sym.withColumn("p", F.col("p") / F.lit(s if s != 0.0 else 1.0))


def joint_affinity(cond: DataFrame, exaggeration: float = 4.0, floor_p: bool = True,
                   diagonal: float | None = None) -> DataFrame:
    """Joint affinity output (K3): exaggeration * (P + P^T) / sum, optional floor and diagonal."""
    p = scale(joint_probabilities(cond), exaggeration)
    if floor_p:
        p = floor_values(p)
    if diagonal is not None:
        p = with_diagonal(p, diagonal)
    return p
