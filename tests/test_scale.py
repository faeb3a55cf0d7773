"""The passes over all points: what they send, how evenly they deal, and that their short cuts change no result."""

import numpy as np
import pytest

from tessera.operators.blocks import pieces, plan_owners
from tessera.operators.kernel import kernel_row_sums, pair_sums
from tessera.operators.neighbours import DEALT, _send, cell_blocks, knn
from tessera.operators.stats import pair_row_stats
from tessera.operators.tree import KernelTree

RNG = np.random.default_rng(5)
NORMAL = RNG.normal(size=(9000, 2))


@pytest.mark.parametrize("y", [NORMAL, NORMAL * 40, NORMAL * np.where(np.arange(9000) % 2, 1.0, 1e7)[:, None],
                               np.repeat(NORMAL[:90], 100, axis=0), np.zeros((9000, 2)),
                               np.concatenate((NORMAL * 0.01 + 5, NORMAL + 100, NORMAL * 1e12))],
                         ids=["normal", "wide", "half-far", "copies", "equal", "mixed"])
def test_kernel_tree_gives_the_sums_over_all_pairs(y):
    at = RNG.choice(len(y), 400, replace=False)
    z, rep = KernelTree(y).sums(at, pair_sums)
    want_z, want = pair_sums(y[at], y, skip=at)
    assert np.allclose(z, want_z, rtol=1e-12, atol=1e-12)
    scale = np.abs(want).max() + want_z.max()
    assert np.abs(rep - want).max() <= 1e-13 * scale


def test_kernel_pass_by_the_tree(spark):
    y = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(NORMAL)], "row_id bigint, y0 double, y1 double")
    got = kernel_row_sums(y, 2, 2048, len(NORMAL)).orderBy("row_id").toPandas().to_numpy()
    z, rep = pair_sums(NORMAL, NORMAL, 0)
    assert np.allclose(got[:, 1], z, rtol=1e-12) and np.allclose(got[:, 2:], rep, rtol=0, atol=1e-10)


def test_owners_do_not_grow_with_the_points():
    assert plan_owners(615_000, 2, 2048) == plan_owners(100_000, 2, 2048) == 48
    assert plan_owners(615_000, 64, 2048) == 48
    assert plan_owners(500, 2, 50) == 10


def test_points_are_dealt_to_owners_evenly_whatever_their_partitions(spark):
    v = spark.range(6000).coalesce(3).selectExpr("id AS row_id", "array(double(id), 1.0D) AS features")
    dealt = pieces(v, 30, 6000, "row_id", "features").selectExpr("owner", "length(ids) / 8 AS n").groupBy("owner").sum("n").collect()
    assert len(dealt) == 30 and max(r[1] for r in dealt) <= 2 * 200


def test_a_block_is_sent_once_to_each_group_of_owners(spark):
    x = np.random.default_rng(9).normal(size=(1500, 16))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "row_id bigint, features array<double>")
    placed, blocks = cell_blocks(v, 5, 1500, 10)
    assert blocks > 120
    sent = placed.repartitionById(blocks, "place").mapInArrow(_send(blocks, 48), DEALT).where("side = 1").count()
    assert sent <= 48 * blocks < placed.where("ids IS NULL").count()
    got = {(r.i, r["rank"]): r.j for r in knn(v, 5, 10, 1500).collect()}
    d = np.square(x[:, None] - x[None]).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :5]
    assert got == {(i, q + 1): int(near[i, q]) for i in range(1500) for q in range(5)}


@pytest.mark.parametrize("shift,scale", [(0.0, 1.0), (1e6, 1.0), (0.0, 1e-30), (0.0, 1e40), (3.0, 0.0)])
def test_rough_distances_lose_no_neighbour_and_no_extreme(spark, shift, scale):
    x = np.concatenate((NORMAL[:300], NORMAL[:40])).repeat(4, axis=1) * scale + shift  # some points twice
    x[:, 1] *= 3
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "row_id bigint, features array<double>")
    d = np.square(x[:, None] - x[None]).sum(axis=2)
    off = ~np.eye(len(x), dtype=bool)
    stats = pair_row_stats(v, 40, len(x)).orderBy("row_id").collect()
    for r, (lo, hi, total) in zip(stats, [(row[o].min(), row[o].max(), row[o].sum()) for row, o in zip(d, off)], strict=True):
        assert (r.partners, r.d_min, r.d_max) == (len(x) - 1, pytest.approx(lo, rel=1e-12), pytest.approx(hi, rel=1e-12))
        assert r.d_sum == pytest.approx(total, rel=1e-9, abs=1e-300)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :7]
    got = {(r.i, r["rank"]): r.d for r in knn(v, 7, 40, len(x)).collect()}
    assert got == {(i, q + 1): pytest.approx(d[i, near[i, q]], rel=1e-12) for i in range(len(x)) for q in range(7)}
