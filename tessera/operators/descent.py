"""Gradient descent with momentum and adaptive gains.

The state is one row per point with k scalar columns each for the coordinates, the momentum and the gains:
(row_id, y0.., m0.., g0..).  The gradient comes from one field pass; gains, momentum and update are
projections of the pass's own rows (``stepped``), in the fit and in the one-step operators alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.field import P_FLOOR, EdgeStore, field, store_edges
from tessera.operators.kernel import divisor, edge_kernel


def ycols(k: int) -> list[str]:
    return [f"y{c}" for c in range(k)]


def state_cols(k: int) -> list[str]:
    return [f"{x}{c}" for x in "ymg" for c in range(k)]


def initial_state(y0: DataFrame, k: int) -> DataFrame:
    """Start: momentum 0 (S4), gains 1 (row_id, y*, m*, g*)."""
    return y0.selectExpr("row_id", *ycols(k), *[f"0.0D AS m{c}" for c in range(k)], *[f"1.0D AS g{c}" for c in range(k)])


def effective_p(p, exaggeration: float, floor_p: bool):
    v = p * F.lit(float(exaggeration))
    return F.greatest(v, F.lit(P_FLOOR)) if floor_p else v


def gradient_terms(edges: DataFrame, y: DataFrame, k: int, z: float, exaggeration: float = 1.0,
                   floor_p: bool = False, repulsion: str = "graph") -> DataFrame:
    """Per-edge gradient terms (J5): (i, j, t0..) with

    graph: t = (p - q) * num * (y_i - y_j)      (the original's inner join of P and Q)
    full:  t = p * num * (y_i - y_j)            (repulsion over all pairs added per point)
    """
    e = edge_kernel(edges.select("i", "j", "p"), y, k)
    z = divisor(z)
    pe = effective_p(F.col("p"), exaggeration, floor_p)
    w = (pe - F.col("num") / F.lit(z)) * F.col("num") if repulsion == "graph" else pe * F.col("num")
    return e.select("i", "j", *[(w * F.col(f"dy{c}")).alias(f"t{c}") for c in range(k)])


def in_field(points: DataFrame, store: EdgeStore, k: int, exaggeration: float, floor_p: bool, repulsion: str,
             rest: list[str] | None = None) -> DataFrame:
    """The field pass over points that are in no order yet: a shuffle to their blocks, then ``field``."""
    own = points.selectExpr("row_id", f"{store.owner()} AS blk", *ycols(k), *(rest or [])).repartitionById(store.blocks, "blk")
    return field(own, store, k, exaggeration, floor_p, repulsion, rest)


def gradient(edges: DataFrame, y: DataFrame, k: int, z: float, exaggeration: float = 1.0, floor_p: bool = False,
             repulsion: str = "full", n: int | None = None, block_rows: int | None = None) -> DataFrame:
    """g_i = sum_j (p_ij - q_ij) num_ij (y_i - y_j) (K6): (row_id, dy0..).

    Attraction over the edges minus 1 / Z times the repulsion, over all pairs (``full``) or over the edges
    (``graph``); points without edges get 0 attraction.
    """
    store = store_edges(edges, y.count() if n is None else n, k, block_rows)
    f = in_field(y, store, k, exaggeration, floor_p, repulsion)
    return f.selectExpr("row_id", *gradient_exprs(k, z))


def gradient_exprs(k: int, z: float) -> list[str]:
    return [f"att{c} - rep{c} / {_d(divisor(z))} AS dy{c}" for c in range(k)]


def gain_sql(grad: str, mom: str, gain: str, min_gain: float) -> str:
    """+0.2 when the signs of gradient and old momentum differ (each tested as > 0),
    else *0.8; never below min_gain (K7)."""
    return (f"greatest({_d(min_gain)}, CASE WHEN ({grad} > 0.0D) <> ({mom} > 0.0D) "
            f"THEN {gain} + {_d(0.2)} ELSE {gain} * {_d(0.8)} END)")


def stepped(rows: DataFrame, k: int, momentum: float, lr: float, min_gain: float, keep: list[str],
            grad: list[str] | None = None, old: dict[str, str] | None = None) -> DataFrame:
    """Rows (keep.., y*, m*, g*, dy*) after one step: gains (K7), momentum m <- mu m - lr gain dy (K8) and
    y <- y + m (K9), as projections of the row: (keep.., y*, m*, g*), not centred.

    ``grad`` gives the dy* as expressions, ``old`` the columns that hold m* and g* under other names.
    """
    rng, old = range(k), old or {}
    m, g = ([old.get(f"{x}{c}", f"{x}{c}") for c in rng] for x in "mg")
    # each alias is used by those after it
    new = rows.selectExpr(*keep, *(grad or [f"dy{c}" for c in rng]),
                          *[f"{gain_sql(f'dy{c}', m[c], g[c], min_gain)} AS new_g{c}" for c in rng],
                          *[f"{_d(momentum)} * {m[c]} - {_d(lr)} * new_g{c} * dy{c} AS new_m{c}" for c in rng],
                          *[f"y{c} + new_m{c} AS new_y{c}" for c in rng])
    return new.selectExpr(*keep, *[f"new_{x}{c} AS {x}{c}" for x in "ymg" for c in rng])


def step(state: DataFrame, grad: DataFrame, k: int, momentum: float, lr: float, min_gain: float) -> DataFrame:
    """One step of a state (row_id, y*, m*, g*) by a gradient table; a missing gradient counts as 0."""
    s = state.join(grad, "row_id", "left").selectExpr("row_id", *state_cols(k), *[f"coalesce(dy{c}, 0.0D) AS dy{c}" for c in range(k)])
    return stepped(s, k, momentum, lr, min_gain, ["row_id"])


def column_means(df: DataFrame, cols: list[str]) -> list[float]:
    """Column means as k scalars (A2)."""
    r = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return [float(r[c]) if r[c] is not None else 0.0 for c in cols]


def recenter(df: DataFrame, k: int, means: list[float] | None = None) -> DataFrame:
    """Subtract the column means of y (K9); other columns pass through."""
    if means is None:
        means = column_means(df, ycols(k))
    shift = {f"y{c}": f"y{c} - {_d(means[c])} AS y{c}" for c in range(k)}
    return df.selectExpr(*[shift.get(n, n) for n in df.columns])


def _d(x: float) -> str:
    """A double literal for Spark SQL (plain decimals parse as DECIMAL)."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"
