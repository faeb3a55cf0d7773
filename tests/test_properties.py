"""Properties of the operators on the sf0.001 vectors (500 x 64)."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import affinity as aff
from tessera.operators import descent as ds
from tessera.operators.kernel import kernel_row_sums, normalizer
from tessera.operators.neighbours import knn
from tessera.operators.stats import pair_row_stats
from tessera.params import AS_EXECUTED, INTENDED
from tessera.plans.fit import affinities, descend, init_y


@pytest.fixture(scope="module")
def aff_intended(vectors):
    return affinities(vectors, INTENDED)


def _rows(df, key):
    return {tuple(r[k] for k in key): r for r in df.collect()}


def test_knn_independent_of_tiling(vectors):
    one = _rows(knn(vectors, 90, block_rows=4096, n=500), ("i", "rank"))
    many = _rows(knn(vectors, 90, block_rows=64, n=500), ("i", "rank"))   # 8 blocks, 36 tiles
    assert one.keys() == many.keys() and len(one) == 500 * 90
    assert all(one[k].j == many[k].j and one[k].d == pytest.approx(many[k].d, abs=1e-12) for k in one)


def test_knn_all_pairs_mode(vectors):
    small = vectors.where("row_id < 40")
    nn = knn(small, 1000, block_rows=16, n=40)
    assert nn.count() == 40 * 39
    assert nn.agg(F.max("rank")).first()[0] == 39


def test_pair_stats_independent_of_tiling(vectors):
    a = _rows(pair_row_stats(vectors, 4096, 500), ("row_id",))
    b = _rows(pair_row_stats(vectors, 100, 500), ("row_id",))
    assert all(a[k].partners == b[k].partners == 499 for k in a)
    assert all(a[k].d_sum == pytest.approx(b[k].d_sum) and a[k].d_min == b[k].d_min for k in a)


def test_joint_p_sums_to_one_and_is_symmetric(aff_intended):
    p = aff_intended.p
    assert p.agg(F.sum("p")).first()[0] == pytest.approx(1.0)
    t = aff.transpose(p).withColumnRenamed("p", "pt")
    j = p.join(t, ["i", "j"], "full")
    assert j.where("p IS NULL OR pt IS NULL OR abs(p - pt) > 1e-18").count() == 0
    assert p.where("i = j").count() == 0
    ex = aff.joint_affinity(aff.conditional_affinity(aff_intended.search), 4.0, floor_p=False)
    assert ex.agg(F.sum("p")).first()[0] == pytest.approx(4.0)


def test_search_converges_to_perplexity(aff_intended):
    s = aff_intended.search
    assert s.where("NOT converged").count() == 0
    assert s.where(f"abs(h - ln(30.0D)) > 1e-5").count() == 0
    sums = s.select(F.aggregate("p", F.lit(0.0), lambda a, b: a + b).alias("s"))
    assert sums.where("abs(s - 1.0D) > 1e-12").count() == 0


def test_kernel_independent_of_tiling_and_gradient_sums_to_zero(spark, vectors, aff_intended):
    y = init_y(vectors.select("row_id"), INTENDED)
    r1 = _rows(kernel_row_sums(y, 2, 4096, 500), ("row_id",))
    r2 = _rows(kernel_row_sums(y, 2, 50, 500), ("row_id",))   # 10 blocks, 55 tiles
    assert all(r1[k].zrow == pytest.approx(r2[k].zrow) and r1[k].rep0 == pytest.approx(r2[k].rep0) for k in r1)
    rows = kernel_row_sums(y, 2, 4096, 500)
    z = normalizer(rows)
    g = ds.gradient(aff_intended.p, y, 2, z, 4.0, False, "full")
    tot = g.agg(F.sum("dy0"), F.sum("dy1"), F.max(F.abs("dy0"))).first()
    assert abs(tot[0]) < 1e-12 * max(1.0, tot[2] * 500) and abs(tot[1]) < 1e-12 * max(1.0, tot[2] * 500)


def test_graph_equals_full_when_all_pairs_are_edges(spark, vectors):
    small = vectors.where("row_id < 30")
    a = affinities(small, INTENDED.with_(neighbours="all", perplexity=5.0))
    assert a.p.count() == 30 * 29
    y = init_y(small.select("row_id"), INTENDED)
    rows = kernel_row_sums(y, 2, 2048, 30)
    z = normalizer(rows)
    g1 = _rows(ds.gradient(a.p, y, 2, z, 4.0, False, "graph"), ("row_id",))
    g2 = _rows(ds.gradient(a.p, y, 2, z, 4.0, False, "full"), ("row_id",))
    assert all(g1[k].dy0 == pytest.approx(g2[k].dy0, rel=1e-9, abs=1e-15) for k in g1)


def test_fit_properties_and_presets(spark, vectors, aff_intended):
    y0 = init_y(vectors.select("row_id"), INTENDED)
    for params in (INTENDED, AS_EXECUTED):
        r = descend(aff_intended.p, y0, 500, params, max_iter=4)
        st = r.state
        m = st.agg(F.avg("y0"), F.avg("y1"), F.min("g0"), F.min("g1"), F.count(F.lit(1))).first()
        assert abs(m[0]) < 1e-9 and abs(m[1]) < 1e-9
        assert m[2] >= params.min_gain and m[3] >= params.min_gain
        assert m[4] == 500


def test_exaggeration_stop_changes_only_late_iterations(spark, vectors, aff_intended):
    y0 = init_y(vectors.select("row_id"), INTENDED)
    a = _rows(descend(aff_intended.p, y0, 500, INTENDED.with_(stop_exaggeration_at=None), max_iter=2).y, ("row_id",))
    b = _rows(descend(aff_intended.p, y0, 500, INTENDED.with_(stop_exaggeration_at=2), max_iter=2).y, ("row_id",))
    c = _rows(descend(aff_intended.p, y0, 500, INTENDED.with_(stop_exaggeration_at=1), max_iter=2).y, ("row_id",))
    assert all(a[k].y0 == pytest.approx(b[k].y0, rel=1e-11, abs=1e-14) for k in a)
    assert any(abs(a[k].y0 - c[k].y0) > 1e-6 for k in a)


def test_fit_same_for_any_partition_count(spark, vectors, aff_intended):
    y0 = init_y(vectors.select("row_id"), INTENDED)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = _rows(descend(aff_intended.p, y0, 500, INTENDED, max_iter=3).y, ("row_id",))
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        b = _rows(descend(aff_intended.p, y0.repartition(5), 500, INTENDED.with_(block_rows=128), max_iter=3).y,
                  ("row_id",))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert all(a[k].y0 == pytest.approx(b[k].y0, abs=1e-9) and a[k].y1 == pytest.approx(b[k].y1, abs=1e-9) for k in a)


def _clusters(spark, n=1200, d=8, centres=12):
    """Tight groups far apart, with some copies of one point."""
    import numpy as np
    rng = np.random.RandomState(3)
    at = rng.randn(centres, d) * 50
    x = at[np.arange(n) % centres] + rng.randn(n, d) * 0.1
    x[:40] = x[0]
    return spark.createDataFrame([(i * 3, v.tolist()) for i, v in enumerate(x)], "row_id bigint, features array<double>"), x


def _brute_knn(x, ids, k):
    import numpy as np
    d = np.square(x[:, None, :] - x[None, :, :]).sum(axis=-1)
    np.fill_diagonal(d, np.inf)
    return {(int(ids[r]), q + 1): (int(ids[c]), d[r, c]) for r in range(len(x)) for q, c in enumerate(np.lexsort((ids, d[r]))[:k])}


@pytest.mark.parametrize("k,rows,sample", [(5, 60, 1024), (5, 60, 0), (20, 30, 150), (90, 400, 1024)])
def test_knn_by_cells_is_exact(spark, k, rows, sample):
    import numpy as np
    v, x = _clusters(spark)
    got = {(r.i, r["rank"]): (r.j, r.d) for r in knn(v, k, rows, 1200, sample_rows=sample).collect()}
    want = _brute_knn(x, np.arange(1200) * 3, k)
    assert got.keys() == want.keys()
    assert all(got[a][0] == want[a][0] and got[a][1] == pytest.approx(want[a][1], abs=1e-9) for a in want)


def test_knn_skips_cells_on_clustered_data(spark):
    """Blocks are sent to far fewer owners than all: the triangle inequality rules the rest out."""
    from tessera.operators.neighbours import cell_blocks
    v, _ = _clusters(spark)
    placed, blocks = cell_blocks(v, 5, 1200, 60)
    asked = placed.where("ids IS NULL").count()
    assert blocks >= 16 and asked < blocks * blocks / 4  # of blocks * (blocks - 1), and less than half of B^2 / 2


def test_all_mode_collects_a_bounded_sample(spark, vectors):
    from tessera.operators.neighbours import sample_points
    big = vectors.crossJoin(spark.range(20)).selectExpr("row_id * 20 + id AS row_id", "features")
    ids, _ = sample_points(big, 10000, "row_id", "features", 1024)
    assert len(ids) < 1500  # whatever k is
    few = knn(vectors, 499, 64, 500)
    assert few.count() == 500 * 499


def test_vectors_of_other_widths_and_nulls_raise(spark):
    for rows in ([(1, [1.0, 2.0]), (2, [1.0])], [(1, [1.0, 2.0]), (2, None)], [(1, [1.0, float("inf")]), (2, [1.0, 2.0])]):
        with pytest.raises(Exception):
            knn(spark.createDataFrame(rows, "row_id bigint, features array<double>"), 1, n=2).collect()


def test_approximate_knn_meets_few_blocks_and_finds_most(spark):
    """Clustered data: a small share of the blocks is sent, at least nine in ten neighbours are found."""
    from tessera.operators.neighbours import approximate_knn, cell_blocks
    v, x = _clusters(spark, 1200, 8, 40)
    got = approximate_knn(v, 10, 2, cells=40, block_rows=60, n=1200).collect()
    want = _brute_knn(x, range(0, 3600, 3), 10)
    pairs = {(i, j) for (i, _), (j, _) in want.items()}
    assert len(got) == 12000
    assert sum((r.i, r.j) in pairs for r in got) >= 0.9 * 12000
    placed, blocks = cell_blocks(v, 10, 1200, 60, probes=2, cells=40)
    assert placed.where("ids IS NULL").count() < blocks * blocks / 5
    every = {(r.i, r["rank"]): r.j for r in approximate_knn(v, 10, 40, cells=40, block_rows=60, n=1200).collect()}
    assert every == {a: j for a, (j, _) in want.items()}  # all probes: exact


def test_fit_on_approximate_neighbours(spark, vectors):
    a = affinities(vectors, INTENDED.with_(neighbours="approximate", probes=4))
    assert a.p.agg(F.sum("p")).first()[0] == pytest.approx(1.0)
