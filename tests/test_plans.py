"""Plan shape: no cross products anywhere, top-k planned as a partial + final limit,
column pruning and filter pushdown reach the Parquet scan."""

import pytest

import __spark_entry__ as E
from tessera.operators.neighbours import knn
from tessera.sources.vectors import read_vectors

SF = "/root/testdata/sf0.001"
JOINING = ["knn_topk", "gradient_full", "gradient_graph", "embedding_affinity", "pq_residual_graph",
           "label_join", "center_columns", "covariance", "neighbour_preservation", "kl_divergence",
           "symmetrize_affinity", "affinity_with_diagonal", "momentum_step", "pairwise_sq_dist"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", JOINING)
def test_no_cross_product(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_iteration_does_not_exchange_p(spark, vectors):
    """With broadcasts off, the loop's plan exchanges packed coordinates only; P is read where it is stored."""
    from tessera.operators.descent import in_field, initial_state
    from tessera.operators.field import store_edges
    from tessera.params import INTENDED
    from tessera.plans.fit import affinities, init_y
    a = affinities(vectors, INTENDED)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = store_edges(a.p, 500, 2)
        plan = _plan(in_field(initial_state(init_y(vectors.select("row_id"), INTENDED), 2), store, 2, 4.0, True, "full"))
        points, edges = plan.split("\n   +- Sort")
        assert "tessera_edges" in edges and "Exchange" not in edges and "Bucketed: true" in edges
        assert "Join" not in plan and points.count("Exchange") == 2  # to blocks (first iteration only), to owners
        store.drop()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_knn_ships_packed_blocks(spark, vectors):
    """No join, no window and no group: blocks are placed, sent and streamed."""
    plan = _plan(knn(vectors, 90, 64, 500))
    assert "Join" not in plan and "Window" not in plan and "FlatMapGroups" not in plan
    assert plan.count("Exchange") == 3


def test_scan_prunes_and_pushes(spark):
    v = read_vectors(spark, f"{SF}/embeddings.parquet", limit_rows=100)
    plan = _plan(v)
    assert "PushedFilters: [IsNotNull(vec_id), LessThan(vec_id,100)]" in plan
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in plan


def test_vector_sums_make_no_cells(spark, vectors):
    """Means and centring add up whole vectors: nothing is exploded, and the covariance reads the table once."""
    from tessera.operators.linalg import center, column_means, covariance
    for df in (column_means(vectors), center(vectors)):
        plan = _plan(df)
        assert "Generate" not in plan and "Join" not in plan
    plan = _plan(covariance(vectors, 64))
    assert plan.index("Generate") < plan.index("MapInArrow")  # only of the d rows of the result
