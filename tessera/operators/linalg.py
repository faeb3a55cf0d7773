"""Column statistics, centring, covariance and PCA.

Sums over the table are taken of whole vectors: one buffer of d (means) or d x d (covariance) numbers per
task, added up by tasks that hold a row of it each.  No cell of a vector becomes a row of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.vector import l2_norm
from tessera.operators.blocks import matrix


def _width(vectors: DataFrame) -> int:
    first = vectors.select("features").first()
    return len(first[0]) if first and first[0] is not None else 0


def mean_array(vectors: DataFrame) -> DataFrame:
    """One row, one column m: the element-wise mean as an array."""
    return vectors.select(array_to_vector(F.col("features").cast("array<double>")).alias("v")).agg(
        vector_to_array(Summarizer.mean(F.col("v"))).alias("m"))


def column_means(vectors: DataFrame) -> DataFrame:
    """Element-wise mean of the vectors (A1): (pos int, mean double); no rows for an empty table.

    Vectors are added up per task, then the sums of the tasks; the d rows are read off the one that results.
    """
    spark = vectors.sparkSession
    return spark.range(_width(vectors)).select(F.col("id").cast("int").alias("pos"), F.element_at(
        mean_array(vectors).scalar(), (F.col("id") + 1).cast("int")).alias("mean"))


def mean_vector(vectors: DataFrame) -> list[float]:
    """The d column means as a driver list (bounded by the width, not by n)."""
    return list(mean_array(vectors).first()[0]) if _width(vectors) else []


def center(vectors: DataFrame, means: list[float] | None = None) -> DataFrame:
    """Subtract the column mean from every component (P5), the mean being a scalar of the same plan."""
    m = mean_array(vectors).scalar() if means is None else F.array(*[F.lit(v) for v in means])
    return vectors.withColumn("m", m).select("row_id", F.zip_with("features", "m", lambda x, mu: x - mu).alias("features"))


def vector_norms(vectors: DataFrame) -> DataFrame:
    """(row_id, l2_norm)."""
    return vectors.select("row_id", l2_norm("features").alias("l2_norm"))


def _gram_rows(shift: np.ndarray):
    """Per task: the Gram matrix and the sums of its rows less ``shift``, a row of the matrix to a row."""
    d = len(shift)

    def fn(batches):
        G, s, n = np.zeros((d, d)), np.zeros(d), 0
        for b in batches:
            if b.num_rows:
                X = matrix(b.column(0)) - shift
                G += X.T @ X
                s += X.sum(axis=0)
                n += len(X)
        if n:
            rows = np.concatenate((G, s[:, None], np.full((d, 1), n)), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(list(rows))], ["a", "r"])
    return fn


def _moments(vectors: DataFrame, shift: np.ndarray) -> DataFrame:
    """(a, r): the a-th row of the shifted Gram matrix, then the a-th shifted sum, then n."""
    x = vectors.select(F.col("features").cast("array<double>").alias("f"))
    parts = x.mapInArrow(_gram_rows(shift), "a int, r array<double>")
    return parts.groupBy("a").agg(vector_to_array(Summarizer.sum(array_to_vector("r"))).alias("r"))


def _shift(vectors: DataFrame) -> np.ndarray:
    """The first vector: sums of differences from it do not lose digits to a mean far from 0."""
    first = vectors.select(F.col("features").cast("array<double>")).first()
    return np.array(first[0] if first and first[0] is not None else [], np.float64)


def covariance(vectors: DataFrame, d: int) -> DataFrame:
    """Sample covariance of the components (the matrix K0 decomposes): (a, b, cov).

    One pass over the vectors; every task adds up one d x d buffer, and d rows of d numbers per task are
    exchanged.  One vector has no covariance (null).
    """
    if not d:
        return vectors.sparkSession.createDataFrame([], "a int, b int, cov double")
    m = _moments(vectors, _shift(vectors))
    sums = m.agg(F.transform(F.array_sort(F.collect_list(F.struct("a", F.element_at("r", d + 1).alias("s")))),
                             lambda x: x["s"]).alias("s")).scalar()
    cells = m.withColumn("s", sums).select("a", F.col("r")[d].alias("sa"), F.col("r")[d + 1].alias("n"), "s",
                                           F.posexplode(F.slice("r", 1, d)).alias("b", "g"))
    cov = (F.col("g") - F.col("sa") * F.col("s")[F.col("b")] / F.col("n")) / F.nullif(F.col("n") - 1, F.lit(0.0))
    return cells.select("a", "b", cov.alias("cov"))


class Components:
    """Mean, principal directions (d x dims, sign fixed) and their variances, on the driver (bounded by d)."""

    def __init__(self, mean: np.ndarray, directions: np.ndarray, variances: np.ndarray):
        self.mean, self.directions, self.variances = mean, directions, variances


def pca_model(vectors: DataFrame, dims: int, d: int | None = None) -> Components:
    """Centring + PCA of the covariance, from one pass; refuses ``dims`` above the width."""
    shift = _shift(vectors)
    d = len(shift) if d is None else d
    if dims > d:
        raise ValueError(f"pca_dims={dims} is larger than the vector width {d}")
    rows = sorted(_moments(vectors, shift).collect())
    r = np.array([x[1] for x in rows]).reshape(d, d + 2)
    n, s = r[0, d + 1], r[:, d]
    cov = (r[:, :d] - np.outer(s, s) / n) / max(n - 1, 1)
    values, vectors_ = np.linalg.eigh((cov + cov.T) / 2)
    top = np.argsort(-values, kind="stable")[:dims]
    pc = vectors_[:, top]
    # Fix the sign of each component: its largest-magnitude loading is positive.
    signs = np.sign(pc[np.abs(pc).argmax(axis=0), np.arange(dims)])
    signs[signs == 0] = 1.0
    return Components(shift + s / n, pc * signs, values[top])


def project(vectors: DataFrame, model: Components) -> DataFrame:
    """(row_id, features): centred vectors along the model's directions, a batch at a time."""
    def fn(batches):
        for b in batches:
            if b.num_rows:
                y = (matrix(b.column(1)) - model.mean) @ model.directions
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(y), pa.list_(pa.float64()))], ["row_id", "features"])

    x = vectors.select(F.col("row_id").cast("bigint"), F.col("features").cast("array<double>"))
    return x.mapInArrow(fn, "row_id bigint, features array<double>")


def pca_project(vectors: DataFrame, dims: int, d: int | None = None) -> DataFrame:
    """Centre, project on the top ``dims`` principal components (K0): (row_id, features).

    Nothing but the d x d moments reaches the driver.
    """
    return project(vectors, pca_model(vectors, dims, d))
