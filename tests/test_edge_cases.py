"""Awkward inputs from FIXTURES.md section 4: one row, identical vectors,
non-dense ids, fewer rows than neighbours, k = 3."""

import pytest
from pyspark.sql import functions as F

from tessera.params import INTENDED
from tessera.plans.fit import affinities, descend, init_y, tsne_fit


def _vec(spark, rows):
    return spark.createDataFrame(rows, "row_id bigint, features array<double>")


def test_one_row_gives_empty_p_and_a_fit(spark):
    v = _vec(spark, [(7, [1.0, 2.0, 3.0])])
    a = affinities(v, INTENDED)
    assert a.p.count() == 0
    r = descend(a.p, init_y(v.select("row_id"), INTENDED), 1, INTENDED, max_iter=2)
    row = r.y.first()
    assert row.row_id == 7 and row.y0 == 0.0 and row.y1 == 0.0


def test_identical_vectors_and_sparse_ids(spark):
    v = _vec(spark, [(i * 10 + 3, [0.5, 0.5]) for i in range(12)])
    a = affinities(v, INTENDED)
    s = a.search.collect()
    # 11 equal neighbours: H = ln 11 < ln 30 at every beta, so beta halves 50 times
    assert all(r.tries == 50 and r.beta == 2.0 ** -50 and not r.converged for r in s)
    assert all(p == pytest.approx(1 / 11) for r in s for p in r.p)
    assert a.p.count() == 12 * 11
    r = descend(a.p, init_y(v.select("row_id"), INTENDED), 12, INTENDED, max_iter=3)
    assert sorted(x.row_id for x in r.y.collect()) == [i * 10 + 3 for i in range(12)]


def test_fewer_rows_than_neighbours_and_k3(spark, vectors):
    small = vectors.where("row_id < 25")
    params = INTENDED.with_(k=3)
    r = tsne_fit(small, params, max_iter=3)
    st = r.state
    assert set(st.columns) >= {"y0", "y1", "y2", "m2", "g2"}
    m = st.agg(*[F.avg(f"y{c}") for c in range(3)]).first()
    assert all(abs(x) < 1e-9 for x in m)
    assert r.p.groupBy("i").count().agg(F.min("count")).first()[0] == 24


def test_cell_address_and_state_arrays(spark):
    from tessera.functions.vector import cell_address
    from tessera.operators.descent import initial_state
    from tessera.plans.fit import state_arrays
    df = spark.range(7).withColumnRenamed("id", "i")
    row, col = cell_address("i", 3)
    got = [(r.row, r.col) for r in df.select(row.alias("row"), col.alias("col")).orderBy("i").collect()]
    assert got == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 0)]
    y = spark.createDataFrame([(0, 1.0, 2.0, 3.0)], "row_id bigint, y0 double, y1 double, y2 double")
    st = state_arrays(initial_state(y, 3), 3).first()
    assert st.y == [1.0, 2.0, 3.0] and st.mom == [0.0, 0.0, 0.0] and st.gain == [1.0, 1.0, 1.0]


def test_preset_switches_change_only_their_step(spark):
    from tessera.operators import affinity as aff
    from tessera.operators.kernel import edge_affinity
    from tessera.params import AS_EXECUTED, INTENDED
    cond = spark.createDataFrame([(0, 1, 1.0), (1, 0, 1.0), (1, 2, 1e-20), (2, 1, 0.5)], "i bigint, j bigint, p double")
    # floor_p: only the tiny entry moves, to 1e-12
    a = {(r.i, r.j): r.p for r in aff.joint_affinity(cond, 4.0, floor_p=AS_EXECUTED.floor_p).collect()}
    b = {(r.i, r.j): r.p for r in aff.joint_affinity(cond, 4.0, floor_p=INTENDED.floor_p).collect()}
    assert [k for k in a if a[k] != b[k]] == []      # symmetrised tiny + 0.5 is not below the floor
    tiny = spark.createDataFrame([(0, 1, 1e-20), (1, 0, 1e-20), (0, 2, 1.0), (2, 0, 1.0)], "i bigint, j bigint, p double")
    a = {(r.i, r.j): r.p for r in aff.joint_affinity(tiny, 1.0, floor_p=False).collect()}
    b = {(r.i, r.j): r.p for r in aff.joint_affinity(tiny, 1.0, floor_p=True).collect()}
    assert {k for k in a if a[k] != b[k]} == {(0, 1), (1, 0)} and b[(0, 1)] == 1e-12
    # diagonal value: only the (i, i) entries differ
    d0 = {(r.i, r.j): r.p for r in aff.joint_affinity(cond, 4.0, False, AS_EXECUTED.diagonal_value).collect()}
    d1 = {(r.i, r.j): r.p for r in aff.joint_affinity(cond, 4.0, False, INTENDED.diagonal_value).collect()}
    assert {k for k in d0 if d0[k] != d1[k]} == {(0, 0), (1, 1), (2, 2)} and d1[(0, 0)] == 1e-12
    # floor_q: only q below 1e-12 moves
    y = spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 0.0), (2, 1e7, 0.0)], "row_id bigint, y0 double, y1 double")
    e = spark.createDataFrame([(0, 1), (0, 2)], "i bigint, j bigint")
    q0 = {(r.i, r.j): r.q for r in edge_affinity(e, y, 2, 1.0, floor_q=False).collect()}
    q1 = {(r.i, r.j): r.q for r in edge_affinity(e, y, 2, 1.0, floor_q=True).collect()}
    assert q0[(0, 1)] == q1[(0, 1)] == 0.5 and q0[(0, 2)] < 1e-12 and q1[(0, 2)] == 1e-12
