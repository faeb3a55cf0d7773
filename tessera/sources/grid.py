"""Cell grids over the point ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.vector import hash_normal


def grid_zeros(ids: DataFrame, k: int, id_col: str = "row_id") -> DataFrame:
    """One cell per (row, col < k) holding 0.0 (S4): (row_id, col int, v double)."""
    return ids.select(F.col(id_col).alias("row_id"),
                      F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("col"),
                      F.lit(0.0).alias("v"))


def init_normal(ids: DataFrame, k: int, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """Standard-normal cells from a hash of (seed, row, col) (S5): (row_id, col, v).

    Deterministic under any partitioning, so a recomputed task redraws the
    same values.
    """
    cells = grid_zeros(ids, k, id_col).drop("v")
    return cells.withColumn("v", hash_normal(seed, F.col("row_id"), F.col("col")))


def normal_columns(ids: DataFrame, k: int, seed: int, prefix: str = "y", id_col: str = "row_id") -> DataFrame:
    """Same values as ``init_normal`` in wide form: (row_id, y0 .. y{k-1})."""
    return ids.select(F.col(id_col).alias("row_id"),
                      *[hash_normal(seed, F.col(id_col), F.lit(c)).alias(f"{prefix}{c}") for c in range(k)])
