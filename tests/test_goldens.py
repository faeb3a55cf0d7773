"""Hand-worked goldens (G1-G14 of FIXTURES.md)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.entropy import entropy_np, search_np
from tessera.operators import affinity as aff
from tessera.operators import descent as ds
from tessera.operators.kernel import edge_affinity, kernel_row_sums, normalizer
from tessera.operators.trajectory import running_frame_limits
from tessera.params import AS_EXECUTED
from tessera.plans.fit import descend


def _y(spark, pts):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "row_id bigint, y0 double, y1 double")


def _edges(spark, triples):
    return spark.createDataFrame([(int(i), int(j), float(p)) for i, j, p in triples], "i bigint, j bigint, p double")


def test_g1_one_full_step(spark):
    y = _y(spark, [(0, 0), (1, 0)])
    p = _edges(spark, [(0, 1, 2.0), (1, 0, 2.0)])
    rows = kernel_row_sums(y, 2, 2048, 2)
    z = normalizer(rows)
    assert z == pytest.approx(1.0)
    q = {(r.i, r.j): (r.num, r.q) for r in edge_affinity(p, y, 2, z).collect()}
    assert q[(0, 1)] == pytest.approx((0.5, 0.5))
    for rep in ("graph", "full"):
        g = {r.row_id: (r.dy0, r.dy1) for r in ds.gradient(p, y, 2, z, 1.0, False, rep).collect()}
        assert g[0] == pytest.approx((-0.75, 0.0)) and g[1] == pytest.approx((0.75, 0.0))
    state = ds.initial_state(y, 2)
    grad = ds.gradient(p, y, 2, z, 1.0, False, "graph")
    raw = ds.step(state, grad, 2, 0.5, 500.0, 0.01)
    got = {r.row_id: r for r in raw.collect()}
    assert (got[0].g0, got[0].g1, got[1].g0, got[1].g1) == pytest.approx((0.8, 0.8, 1.2, 0.8))
    assert (got[0].m0, got[1].m0) == pytest.approx((300.0, -450.0))
    c = {r.row_id: (r.y0, r.y1) for r in ds.recenter(raw, 2).collect()}
    assert c[0] == pytest.approx((374.5, 0.0)) and c[1] == pytest.approx((-374.5, 0.0))


def test_g1_one_iteration_of_the_fit(spark):
    y = _y(spark, [(0, 0), (1, 0)])
    p = _edges(spark, [(0, 1, 2.0), (1, 0, 2.0)])
    params = AS_EXECUTED.with_(exaggeration=1.0, initial_momentum=0.5)
    got = {r.row_id: r for r in descend(p, y, 2, params, max_iter=1).state.collect()}
    assert (got[0].m0, got[1].m0) == pytest.approx((300.0, -450.0))
    assert (got[0].y0, got[1].y0) == pytest.approx((374.5, -374.5))  # 300 and -449, centred


def test_g2_g3_g4_entropy():
    H, P = entropy_np(np.array([[1.0, 1.0]]), np.array([1.0]))
    assert H[0] == pytest.approx(math.log(2)) and P[0] == pytest.approx([0.5, 0.5])
    H, P = entropy_np(np.array([[0.0, 1.0, 2.0]]), np.array([1.0]))
    assert H[0] == pytest.approx(0.8323955818)
    assert P[0] == pytest.approx([0.6652409558, 0.2447284711, 0.0900305732])
    H, P = entropy_np(np.array([[1000.0, 1000.0]]), np.array([1.0]))
    assert H[0] == 0.0 and list(P[0]) == [0.0, 0.0]


def _search(d):
    D = np.array([d], dtype=float)
    return search_np(D, np.ones_like(D, dtype=bool), 30.0, 1e-5, 50)


def test_g5_underflow():
    beta, H, P, tries, conv = _search([1000.0, 1000.0])
    assert tries[0] == 50 and beta[0] == 2.0 ** -50 and not conv[0]
    assert P[0] == pytest.approx([0.5, 0.5])


def test_g6_one_neighbour():
    beta, H, P, tries, conv = _search([1.0])
    assert tries[0] == 50 and beta[0] == 2.0 ** -50 and P[0] == pytest.approx([1.0]) and not conv[0]


def test_g7_duplicates():
    beta, H, P, tries, conv = _search([0.0] * 40)
    assert tries[0] == 50 and beta[0] == 2.0 ** 50 and not conv[0]
    assert P[0] == pytest.approx([0.025] * 40) and H[0] == pytest.approx(math.log(40))


def test_g8_ramp():
    beta, H, P, tries, conv = _search([0.1 * i for i in range(1, 101)])
    assert tries[0] == 14 and beta[0] == 0.90533447265625 and conv[0]
    assert P[0][:3] == pytest.approx([0.08656635, 0.07907349, 0.07222919], abs=1e-8)


def test_g8_through_spark_udf(spark):
    from tessera.functions.entropy import perplexity_search
    df = spark.createDataFrame([([0.1 * i for i in range(1, 101)],)], "ds array<double>")
    r = df.select(perplexity_search(F.col("ds"), 30.0, 1e-5, 50).alias("s")).first().s
    assert r.tries == 14 and r.beta == 0.90533447265625 and r.converged


def test_g9_joint_affinity(spark):
    cond = _edges(spark, [(0, 1, 1.0), (1, 0, 0.5), (1, 2, 0.5), (2, 1, 1.0)])
    p = {(r.i, r.j): r.p for r in aff.joint_affinity(cond, 4.0, floor_p=False, diagonal=0.0).collect()}
    for e in [(0, 1), (1, 0), (1, 2), (2, 1)]:
        assert p[e] == pytest.approx(1.0)
    assert sum(p.values()) == pytest.approx(4.0)
    assert p[(0, 0)] == p[(1, 1)] == p[(2, 2)] == 0.0


def test_g10_kernel_unit_square(spark):
    y = _y(spark, [(0, 0), (1, 0), (1, 1), (0, 1)])
    rows = kernel_row_sums(y, 2, 2048, 4)
    z = normalizer(rows)
    assert z == pytest.approx(16.0 / 3.0)
    e = _edges(spark, [(0, 1, 0.0), (0, 2, 0.0)])
    q = {(r.i, r.j): (r.num, r.q) for r in edge_affinity(e, y, 2, z).collect()}
    assert q[(0, 1)] == pytest.approx((0.5, 0.09375)) and q[(0, 2)] == pytest.approx((1 / 3, 0.0625))


def test_g11_gradient_graph_vs_full(spark):
    cond = _edges(spark, [(0, 1, 1.0), (1, 0, 0.5), (1, 2, 0.5), (2, 1, 1.0)])
    p = aff.joint_affinity(cond, 4.0, floor_p=False)
    y = _y(spark, [(0, 0), (1, 0), (3, 0)])
    rows = kernel_row_sums(y, 2, 2048, 3)
    z = normalizer(rows)
    for rep, want in (("graph", [-0.34375, -0.00625, 0.35]), ("full", [-0.325, -0.00625, 0.33125])):
        g = {r.row_id: (r.dy0, r.dy1) for r in ds.gradient(p, y, 2, z, 1.0, False, rep).collect()}
        assert [g[i][0] for i in range(3)] == pytest.approx(want)
        assert all(abs(g[i][1]) < 1e-15 for i in range(3))
        assert sum(g[i][0] for i in range(3)) == pytest.approx(0.0, abs=1e-12)


def test_g12_g13_gains(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (1.0, -1.0, 1.0), (-1.0, 1.0, 1.0), (-1.0, -1.0, 1.0),
                                (0.0, 0.0, 1.0), (1.0, 1.0, 0.011)], "g double, m double, gain double")
    got = [r.v for r in df.selectExpr(ds.gain_sql("g", "m", "gain", 0.01) + " AS v").collect()]
    assert got == pytest.approx([0.8, 1.2, 1.2, 0.8, 0.8, 0.01])


def test_g14_running_limits(spark):
    lim = spark.createDataFrame([(1, 3.0, 1.0), (2, 1.0, 2.0), (3, 5.0, 0.5)], "iter int, xmax double, ymax double")
    got = [r.xmax for r in running_frame_limits(lim).orderBy("iter").collect()]
    assert got == [3.0, 3.0, 5.0]
