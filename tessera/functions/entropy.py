"""Gaussian entropy at a precision and the per-row perplexity search (K1, K2).

The search is an iterative bisection whose length depends on the data; it
runs as one Arrow-batched pandas UDF that advances *all rows of a batch* at
once with NumPy masks, so no Python code runs per row.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def entropy_np(D: np.ndarray, beta: np.ndarray, mask: np.ndarray | None = None):
    """Row-wise entropy H and normalised p of exp(-beta * D).

    ``D`` is (m, K) with padding where ``mask`` is False.  A row whose
    exponentials all underflow gets H = 0 and p = 0 (as the original does).
    Sums are sequential (cumsum) to keep the summation order of a plain loop.
    """
    if mask is None:
        mask = np.ones(D.shape, dtype=bool)
    Dz = np.where(mask, D, 0.0)
    P = np.where(mask, np.exp(-Dz * beta[:, None]), 0.0)
    sumP = np.cumsum(P, axis=1)[:, -1] if P.shape[1] else np.zeros(P.shape[0])
    sumDP = np.cumsum(Dz * P, axis=1)[:, -1] if P.shape[1] else np.zeros(P.shape[0])
    ok = sumP != 0.0
    safe = np.where(ok, sumP, 1.0)
    H = np.where(ok, np.log(safe) + beta * sumDP / safe, 0.0)
    Pn = np.where(ok[:, None], P / safe[:, None], 0.0)
    return H, Pn


def search_np(D: np.ndarray, mask: np.ndarray, perplexity: float, tol: float, max_tries: int):
    """Vectorised bisection for beta with H(beta) = log(perplexity).

    Test before update: at most ``max_tries`` updates; the final p is taken at
    the last beta.  Returns beta, H, p, tries, converged.
    """
    m = D.shape[0]
    logU = math.log(perplexity)
    beta = np.ones(m)
    lo = np.full(m, -np.inf)
    hi = np.full(m, np.inf)
    tries = np.zeros(m, dtype=np.int32)
    H, P = entropy_np(D, beta, mask)
    active = np.abs(H - logU) > tol
    while active.any():
        diff = H - logU
        up = active & (diff > 0)
        dn = active & ~(diff > 0)
        lo = np.where(up, beta, lo)
        beta = np.where(up, np.where(np.isinf(hi), beta * 2.0, (beta + hi) / 2.0), beta)
        hi = np.where(dn, beta, hi)
        beta = np.where(dn, np.where(np.isinf(lo), beta / 2.0, (beta + lo) / 2.0), beta)
        tries = tries + active.astype(np.int32)
        idx = np.nonzero(active)[0]
        h_a, p_a = entropy_np(D[idx], beta[idx], mask[idx])
        H[idx] = h_a
        P[idx] = p_a
        active = active & (np.abs(H - logU) > tol) & (tries < max_tries)
    converged = np.abs(H - logU) <= tol
    return beta, H, P, tries, converged


SEARCH_SCHEMA = T.StructType([
    T.StructField("beta", T.DoubleType()),
    T.StructField("h", T.DoubleType()),
    T.StructField("tries", T.IntegerType()),
    T.StructField("converged", T.BooleanType()),
    T.StructField("p", T.ArrayType(T.DoubleType())),
])


def _pad(series: pd.Series):
    lens = series.map(len).to_numpy()
    width = int(lens.max()) if len(lens) else 0
    D = np.zeros((len(series), width))
    mask = np.arange(width)[None, :] < lens[:, None]
    if width:
        D[mask] = np.concatenate([np.asarray(v, dtype=float) for v in series]) if len(series) else []
    return D, mask, lens


def perplexity_search(distances: Column, perplexity: float, tol: float, max_tries: int) -> Column:
    """Column struct(beta, h, tries, converged, p) for an array<double> of distances."""

    @F.pandas_udf(SEARCH_SCHEMA)
    def _search(ds: pd.Series) -> pd.DataFrame:
        D, mask, lens = _pad(ds)
        beta, H, P, tries, conv = search_np(D, mask, perplexity, tol, max_tries)
        p_lists = [P[r, : lens[r]] for r in range(len(lens))]
        return pd.DataFrame({"beta": beta, "h": H, "tries": tries, "converged": conv, "p": p_lists})

    return _search(distances)


def entropy_at_beta(distances: Column, beta) -> Column:
    """H of exp(-beta*D) as a Catalyst expression (K1); 0 when all underflow."""
    b = beta if isinstance(beta, Column) else F.lit(float(beta))
    w = F.transform(distances, lambda d: F.exp(-d * b))
    s = F.aggregate(w, F.lit(0.0), lambda acc, v: acc + v)
    sdp = F.aggregate(F.zip_with(distances, w, lambda d, v: d * v), F.lit(0.0), lambda acc, v: acc + v)
    return F.when(s == 0.0, F.lit(0.0)).otherwise(F.log(s) + b * sdp / s)
