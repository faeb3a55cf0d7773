"""Named queries over the test tables: each is (spark, sf_dir) -> DataFrame.

Every query reads the whole ``embeddings`` table (or data Spark derives
from it); none restricts ids.  Outputs are scalar columns rounded so that
the DuckDB oracle in ``oracle.py`` can compare them by value.  Quantities
shared by several queries (neighbours, P, the start) are computed once per
session and sf folder and kept as checkpointed tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.entropy import entropy_at_beta
from tessera.functions.vector import cell_address, rnd
from tessera.operators import affinity as aff
from tessera.operators import descent as ds
from tessera.operators.kernel import edge_affinity, kernel_row_sums, normalizer
from tessera.operators.linalg import center, column_means, covariance, pca_model, pca_project, project, vector_norms
from tessera.operators.neighbours import approximate_knn, knn, neighbour_lists
from tessera.operators.quality import kl_divergence, neighbour_preservation
from tessera.operators.stats import pair_row_stats
from tessera.operators.trajectory import frame_limits, label_join, natural_order, running_frame_limits
from tessera.params import INTENDED
from tessera.plans.fit import descend, embed_table
from tessera.session import cut_lineage, scratch_path
from tessera.sinks import write_labels_text, write_snapshot_text, write_vector_text
from tessera.sources.grid import grid_zeros, init_normal, normal_columns
from tessera.sources.vectors import (numbered_lines, read_labels, read_labels_text, read_snapshots, read_snapshots_text,
                                     read_vector_text, read_vectors)

K = 2
N_NEIGHBOURS = INTENDED.n_neighbours          # floor(3 * 30) = 90
EXAGGERATION = INTENDED.exaggeration
SEED = INTENDED.seed
MOMENTUM_SEED = 7                             # old momentum for the one-step queries
FIT_ITERS = 3
PIPELINE_ITERS = 10                           # the shipped configuration's iteration count
PCA_DIMS = INTENDED.pca_dims

_CACHE: dict = {}


def _memo(spark: SparkSession, sf: str, key: str, build):
    ck = (id(spark), spark.sparkContext.applicationId, sf.rstrip("/"), key)
    if ck not in _CACHE:
        _CACHE[ck] = build()
    return _CACHE[ck]


def _vectors(spark, sf) -> DataFrame:
    return read_vectors(spark, f"{sf.rstrip('/')}/embeddings.parquet")


def _n(spark, sf) -> int:
    return _memo(spark, sf, "n", lambda: _vectors(spark, sf).count())


def _knn(spark, sf) -> DataFrame:
    return _memo(spark, sf, "knn", lambda: cut_lineage(knn(_vectors(spark, sf), N_NEIGHBOURS, INTENDED.block_rows,
                                                           _n(spark, sf))))


def _search(spark, sf) -> DataFrame:
    return _memo(spark, sf, "search", lambda: cut_lineage(aff.beta_search(_knn(spark, sf), INTENDED.perplexity,
                                                                          INTENDED.tol, INTENDED.max_tries)))


def _cond(spark, sf) -> DataFrame:
    return aff.conditional_affinity(_search(spark, sf))


def _p(spark, sf) -> DataFrame:
    """Normalised joint P (sums to 1), off-diagonal."""
    return _memo(spark, sf, "p", lambda: cut_lineage(aff.joint_probabilities(_cond(spark, sf))))


def _p_ex(spark, sf) -> DataFrame:
    """Exaggerated joint P as the original stores it (x4, no floor)."""
    return aff.scale(_p(spark, sf), EXAGGERATION)


def _y0(spark, sf) -> DataFrame:
    return _memo(spark, sf, "y0", lambda: cut_lineage(normal_columns(_vectors(spark, sf).select("row_id"), K, SEED)))


def _rows0(spark, sf) -> DataFrame:
    return _memo(spark, sf, "rows0", lambda: cut_lineage(kernel_row_sums(_y0(spark, sf), K, INTENDED.block_rows,
                                                                         _n(spark, sf))))


def _z0(spark, sf) -> float:
    return _memo(spark, sf, "z0", lambda: normalizer(_rows0(spark, sf)))


def _grad0(spark, sf, repulsion: str) -> DataFrame:
    floor = repulsion == "full"
    return ds.gradient(_p(spark, sf), _y0(spark, sf), K, _z0(spark, sf), EXAGGERATION, floor, repulsion, _n(spark, sf),
                       INTENDED.block_rows)


def _state_with_momentum(spark, sf) -> DataFrame:
    """Y0 with a non-zero old momentum (seeded normals) and gains 1."""
    mom = normal_columns(_vectors(spark, sf).select("row_id"), K, MOMENTUM_SEED, prefix="m")
    return _y0(spark, sf).join(mom, "row_id").select(
        "row_id", *ds.ycols(K), *[f"m{c}" for c in range(K)], *[F.lit(1.0).alias(f"g{c}") for c in range(K)])


def _one_step(spark, sf) -> DataFrame:
    return _memo(spark, sf, "step1", lambda: cut_lineage(
        ds.step(_state_with_momentum(spark, sf), _grad0(spark, sf, "full"), K, INTENDED.initial_momentum,
                INTENDED.lr, INTENDED.min_gain)))


def _fit_snapshots(spark, sf) -> str:
    def build():
        path = scratch_path(spark, "snapshots")
        params = INTENDED.with_(snapshot_every=1)
        descend(_p(spark, sf), _y0(spark, sf), _n(spark, sf), params, path, max_iter=FIT_ITERS)
        return path
    return _memo(spark, sf, "snapshots", build)


def _snapshots(spark, sf) -> DataFrame:
    return read_snapshots(spark, _fit_snapshots(spark, sf))


# ---------------------------------------------------------------- sources

def q_vectors_scan(spark, sf):
    v = _vectors(spark, sf)
    return v.select("row_id", F.posexplode("features").alias("pos", "x")).select("row_id", "pos", rnd("x", 9).alias("x"))


def q_vectors_text_scan(spark, sf):
    path = _memo(spark, sf, "vector_text", lambda: write_vector_text(_vectors(spark, sf),
                                                                     scratch_path(spark, "vectors_text")))
    v = read_vector_text(spark, f"{path}/part-*")
    return v.select("row_id", F.posexplode("features").alias("pos", "x")).select("row_id", "pos", rnd("x", 9).alias("x"))


def q_labels_scan(spark, sf):
    return read_labels(spark, f"{sf.rstrip('/')}/embeddings.parquet")


def q_grid_zeros(spark, sf):
    return grid_zeros(_vectors(spark, sf).select("row_id"), K)


def q_init_normal(spark, sf):
    return init_normal(_vectors(spark, sf).select("row_id"), K, SEED).select("row_id", "col", rnd("v", 9).alias("v"))


def q_preview_cells(spark, sf):
    cells = init_normal(_vectors(spark, sf).select("row_id"), K, SEED)
    return cells.orderBy("row_id", "col").limit(40).select("row_id", "col", rnd("v", 9).alias("v"))


# ---------------------------------------------------------------- projections

def q_vectors_to_cells(spark, sf):
    arr = _y0(spark, sf).select("row_id", F.array(*ds.ycols(K)).alias("y"))
    return arr.select("row_id", F.posexplode("y").alias("col", "v")).select("row_id", "col", rnd("v", 9).alias("v"))


def q_cells_to_vectors(spark, sf):
    cells = _vectors(spark, sf).select("row_id", F.posexplode("features").alias("pos", "x"))
    vec = cells.groupBy("row_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("f"))
    wsum = F.aggregate(F.transform("f", lambda x, i: x * (i + 1).cast("double")), F.lit(0.0), lambda a, b: a + b)
    return vec.select("row_id", F.size("f").cast("int").alias("dims"), rnd(wsum, 9).alias("wsum"))


def q_transpose_affinity(spark, sf):
    return aff.transpose(_p_ex(spark, sf)).select("i", "j", rnd("p", 10).alias("p"))


def q_center_columns(spark, sf):
    c = center(_vectors(spark, sf))
    return c.select("row_id", F.posexplode("features").alias("pos", "x")).select("row_id", "pos", rnd("x", 9).alias("x"))


def q_affinity_with_diagonal(spark, sf):
    # tiny values are told apart from 0 by their own column
    return aff.with_diagonal(_p_ex(spark, sf), INTENDED.diagonal_value).select(
        "i", "j", rnd("p", 10).alias("p"), F.when(F.col("p") < 1e-9, rnd(F.col("p") * 1e12, 3)).alias("tiny_e12"))


def q_affinity_floor(spark, sf):
    # scaled down until the floor acts on part of the table
    small = aff.scale(_p_ex(spark, sf), 1e-8)
    return aff.floor_values(small).select("i", "j", rnd(F.col("p") * 1e12, 4).alias("p_e12"))


def q_exaggerate_affinity(spark, sf):
    p = _p(spark, sf)
    return p.select("i", "j", rnd("p", 10).alias("p"), rnd(F.col("p") * F.lit(EXAGGERATION), 10).alias("p_ex"))


# ---------------------------------------------------------------- joins / pairs

def q_pairwise_sq_dist(spark, sf):
    s = pair_row_stats(_vectors(spark, sf), INTENDED.block_rows, _n(spark, sf))
    return s.select("row_id", "partners", rnd("d_sum", 9).alias("d_sum"), rnd("d_min", 9).alias("d_min"),
                    rnd("d_max", 9).alias("d_max"))


def q_embedding_kernel(spark, sf):
    return _rows0(spark, sf).select("row_id", rnd("zrow", 9).alias("zrow"))


def q_embedding_repulsion(spark, sf):
    r = _rows0(spark, sf)
    return r.select("row_id", *[rnd(f"rep{c}", 9).alias(f"rep{c}") for c in range(K)])


def q_kernel_normalizer(spark, sf):
    return _rows0(spark, sf).agg(rnd(F.sum("zrow"), 6).alias("z"))


def q_embedding_affinity(spark, sf):
    e = edge_affinity(_p(spark, sf), _y0(spark, sf), K, _z0(spark, sf), floor_q=INTENDED.floor_q)
    return e.select("i", "j", rnd("num", 10).alias("num"), rnd("q", 14).alias("q"))


def q_embedding_affinity_floor(spark, sf):
    """K5 where the floor acts: every other point far out, so that most pairs are below 1e-12 and some are not."""
    y = _y0(spark, sf).select("row_id", *[(F.col(f"y{c}") * F.when(F.col("row_id") % 2 == 0, 1e7).otherwise(1.0)).alias(f"y{c}")
                                          for c in range(K)])
    z = normalizer(kernel_row_sums(y, K, INTENDED.block_rows, _n(spark, sf)))
    e = edge_affinity(_p(spark, sf), y, K, z, floor_q=INTENDED.floor_q)
    return e.select("i", "j", rnd(F.least(F.col("q") * 1e12, F.lit(1000.0)), 6).alias("q_e12"))


def q_grid_cells(spark, sf):
    """the flat places of an n x 2 grid and the row and column of each."""
    flat = _vectors(spark, sf).select(F.explode(F.sequence(F.col("row_id") * K, F.col("row_id") * K + (K - 1))).alias("flat"))
    row, col = cell_address("flat", K)
    return flat.select("flat", row.alias("row_id"), col.alias("col"))


def q_pq_residual_graph(spark, sf):
    e = edge_affinity(_p_ex(spark, sf), _y0(spark, sf), K, _z0(spark, sf))
    return e.select("i", "j", rnd(F.col("p") - F.col("q"), 10).alias("pq"))


def q_gradient_terms(spark, sf):
    t = ds.gradient_terms(_p(spark, sf), _y0(spark, sf), K, _z0(spark, sf), EXAGGERATION, False, "graph")
    return t.select("i", "j", *[rnd(f"t{c}", 12).alias(f"t{c}") for c in range(K)])


def q_gradient_graph(spark, sf):
    g = _grad0(spark, sf, "graph")
    return g.select("row_id", *[rnd(f"dy{c}", 12).alias(f"dy{c}") for c in range(K)])


def q_gradient_full(spark, sf):
    g = _grad0(spark, sf, "full")
    return g.select("row_id", *[rnd(f"dy{c}", 12).alias(f"dy{c}") for c in range(K)])


def q_gains_update(spark, sf):
    s = _one_step(spark, sf)
    return s.select("row_id", *[rnd(f"g{c}", 9).alias(f"g{c}") for c in range(K)])


def q_momentum_step(spark, sf):
    s = _one_step(spark, sf)
    return s.select("row_id", *[rnd(f"m{c}", 9).alias(f"m{c}") for c in range(K)])


def q_apply_update(spark, sf):
    s = _one_step(spark, sf)
    return s.select("row_id", *[rnd(f"y{c}", 9).alias(f"y{c}") for c in range(K)])


def q_recenter(spark, sf):
    s = ds.recenter(_one_step(spark, sf), K)
    return s.select("row_id", *[rnd(f"y{c}", 9).alias(f"y{c}") for c in range(K)])


def q_vector_norms(spark, sf):
    return vector_norms(_vectors(spark, sf)).select("row_id", rnd("l2_norm", 9).alias("l2_norm"))


def q_label_join(spark, sf):
    lab = read_labels(spark, f"{sf.rstrip('/')}/embeddings.parquet")
    j = label_join(_snapshots(spark, sf), lab)
    return j.select("iter", "row_id", "label", rnd("x", 6).alias("x"), rnd("y", 6).alias("y"))


# ---------------------------------------------------------------- aggregates

def q_column_means(spark, sf):
    return column_means(_vectors(spark, sf)).select("pos", rnd("mean", 9).alias("mean"))


def q_embedding_means(spark, sf):
    return _y0(spark, sf).agg(*[rnd(F.avg(f"y{c}"), 9).alias(f"y{c}_mean") for c in range(K)])


def q_neighbour_lists(spark, sf):
    nb = neighbour_lists(_knn(spark, sf))
    d = F.transform("nb", lambda x: x["d"])
    return nb.select("i", F.size("nb").cast("int").alias("n_nb"),
                     rnd(F.aggregate(d, F.lit(0.0), lambda a, b: a + b), 9).alias("d_sum"),
                     rnd(F.element_at(d, -1), 9).alias("d_max"),
                     F.col("nb")[0]["j"].alias("j_first"))


def q_knn_topk(spark, sf):
    return _knn(spark, sf).select("i", "j", rnd("d", 9).alias("d"), "rank")


APPROXIMATE_CELLS, PROBES = 32, 8


def q_approximate_knn(spark, sf):
    """Neighbours by probes: whether nine in ten of the exact ones are found, and how far their distances are off."""
    nn = _memo(spark, sf, "approximate", lambda: cut_lineage(approximate_knn(
        _vectors(spark, sf), N_NEIGHBOURS, PROBES, APPROXIMATE_CELLS, INTENDED.block_rows, _n(spark, sf))))
    exact = _knn(spark, sf).select("i", "j", F.col("d").alias("exact"))
    both = nn.join(exact, ["i", "j"], "left").groupBy("i").agg(
        F.count("exact").alias("hits"), F.max(F.abs(F.col("d") - F.col("exact"))).alias("off"))
    found = F.expr(f"sum(hits) >= 0.9 * count(1) * least(count(1) - 1, {N_NEIGHBOURS})")
    return both.agg(F.count(F.lit(1)).alias("n"), found.alias("recall_90"), rnd(F.max("off"), 9).alias("off"))


def q_symmetrize_affinity(spark, sf):
    return aff.symmetrize(_cond(spark, sf)).select("i", "j", rnd("p", 10).alias("p"))


def q_affinity_total(spark, sf):
    s = aff.symmetrize(_cond(spark, sf))
    return s.agg(rnd(F.sum("p"), 9).alias("total"), F.count(F.lit(1)).alias("n_entries"))


def q_matrix_profile(spark, sf):
    p = aff.with_diagonal(_p_ex(spark, sf), 0.0)
    return p.agg(F.count(F.lit(1)).alias("n_entries"), F.max("i").alias("max_i"), F.max("j").alias("max_j"),
                 F.countDistinct("i").alias("n_rows"), rnd(F.sum("p"), 9).alias("p_sum"))


def q_frame_limits(spark, sf):
    f = frame_limits(_snapshots(spark, sf))
    return f.select("iter", rnd("xmax", 6).alias("xmax"), rnd("ymax", 6).alias("ymax"))


def q_running_frame_limits(spark, sf):
    f = running_frame_limits(frame_limits(_snapshots(spark, sf)))
    return f.select("iter", rnd("xmax", 6).alias("xmax"), rnd("ymax", 6).alias("ymax"))


def q_snapshot_name_order(spark, sf):
    # the third frame counts as the tenth: text order and number order differ
    no = F.when(F.col("iter") == 3, 10).otherwise(F.col("iter"))
    names = _snapshots(spark, sf).select(F.concat(F.lit("exportIter_"), no.cast("string")).alias("name")).distinct()
    place = Window.orderBy(F.monotonically_increasing_id())  # as sorted; one row per frame
    return natural_order(names.coalesce(1)).select("name", F.col("num").alias("iter_no"),
                                                   F.row_number().over(place).alias("place"))


def q_fit_snapshots(spark, sf):
    s = _snapshots(spark, sf)
    return s.select("iter", "row_id", *[rnd(f"y{c}", 6).alias(f"y{c}") for c in range(K)])


# ---------------------------------------------------------------- composite

def q_entropy_at_beta(spark, sf):
    nb = neighbour_lists(_knn(spark, sf))
    d = F.transform("nb", lambda x: x["d"])
    return nb.select("i", rnd(entropy_at_beta(d, 1.0), 9).alias("h"))


def q_perplexity_beta(spark, sf):
    s = _search(spark, sf)
    return s.select("i", rnd("beta", 12).alias("beta"), rnd("h", 9).alias("h"), "tries", "converged")


def q_conditional_affinity(spark, sf):
    return _cond(spark, sf).select("i", "j", rnd("p", 10).alias("p"))


def q_joint_affinity_knn(spark, sf):
    return _p_ex(spark, sf).select("i", "j", rnd("p", 10).alias("p"))


def q_covariance(spark, sf):
    c = covariance(_vectors(spark, sf), 64)
    return c.select("a", "b", rnd("cov", 12).alias("cov"))


def _pca_full(spark, sf) -> DataFrame:
    return _memo(spark, sf, "pca64", lambda: cut_lineage(pca_project(_vectors(spark, sf), 64, 64)))


def q_pca_full_rank_distances(spark, sf):
    nn = knn(_pca_full(spark, sf), N_NEIGHBOURS, INTENDED.block_rows, _n(spark, sf))
    return nn.select("i", "j", rnd("d", 9).alias("d"), "rank")


def q_pca_variance_trace(spark, sf):
    x = _pca_full(spark, sf)
    cells = x.select(F.posexplode("features").alias("pos", "x"))
    var = cells.groupBy("pos").agg(F.var_samp("x").alias("v"))
    return var.agg(rnd(F.sum("v"), 9).alias("trace"))


def q_pca_project(spark, sf):
    x = pca_project(_vectors(spark, sf), PCA_DIMS, 64)
    return x.select("row_id", F.posexplode("features").alias("pc", "x")).select("row_id", "pc", rnd("x", 9).alias("x"))


def q_pca_residual(spark, sf):
    """K0 truncated: what 50 components keep and what they leave add up to the centred vector's square."""
    v = _vectors(spark, sf)
    model = pca_model(v, PCA_DIMS)
    kept, back = project(v, model).withColumnRenamed("features", "p"), F.array(*[
        F.array(*[F.lit(float(x)) for x in row]) for row in model.directions])
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    both = center(v).join(kept, "row_id").withColumn("back", F.transform(back, lambda row: dot(row, F.col("p"))))
    left = F.zip_with("features", "back", lambda x, y: x - y)
    return both.select("row_id", rnd(dot(F.col("p"), F.col("p")) + dot(left, left), 8).alias("sq"))


def q_pca_components(spark, sf):
    """K0 truncated: each component's length, how far C v is from lambda v, and the projection's variance from lambda."""
    v = _vectors(spark, sf)
    model = pca_model(v, PCA_DIMS)
    parts = spark.createDataFrame([(c, b, float(model.directions[b, c]), float(model.variances[c]))
                                   for c in range(PCA_DIMS) for b in range(len(model.mean))], "pc int, b int, v double, l double")
    cv = (covariance(v, len(model.mean)).join(parts, "b").groupBy("pc", "a").agg(F.sum(F.col("cov") * F.col("v")).alias("cv")))
    off = (parts.withColumnRenamed("b", "a").join(cv, ["pc", "a"]).groupBy("pc")
           .agg(F.sum(F.col("v") * F.col("v")).alias("length"), F.max(F.abs(F.col("cv") - F.col("l") * F.col("v"))).alias("off"),
                F.max("l").alias("l")))
    var = (project(v, model).select(F.posexplode("features").alias("pc", "x")).groupBy("pc").agg(F.var_samp("x").alias("var")))
    return off.join(var, "pc").select("pc", rnd("length", 9).alias("length"), rnd("off", 9).alias("off"),
                                      rnd(F.col("var") - F.col("l"), 9).alias("gap"))


def q_tsne_fit_3(spark, sf):
    return _fit3(spark, sf).select("row_id", *[rnd(f"y{c}", 6).alias(f"y{c}") for c in range(K)])


def _fit3(spark, sf) -> DataFrame:
    return _memo(spark, sf, "fit3", lambda: cut_lineage(
        descend(_p(spark, sf), _y0(spark, sf), _n(spark, sf), INTENDED, max_iter=FIT_ITERS).y))


def q_tsne_fit_3_as_executed(spark, sf):
    """K10 under the AS_EXECUTED preset: repulsion over the edges of P only,
    no floors, exaggeration kept."""
    from tessera.params import AS_EXECUTED
    r = descend(_p(spark, sf), _y0(spark, sf), _n(spark, sf), AS_EXECUTED, max_iter=FIT_ITERS)
    return r.y.select("row_id", *[rnd(f"y{c}", 6).alias(f"y{c}") for c in range(K)])


def q_tsne_fit_3_schedule(spark, sf):
    """K10 with both switches inside the run: momentum after one iteration,
    exaggeration off after two."""
    params = INTENDED.with_(momentum_switch_iter=1, stop_exaggeration_at=2)
    r = descend(_p(spark, sf), _y0(spark, sf), _n(spark, sf), params, max_iter=FIT_ITERS)
    return r.y.select("row_id", *[rnd(f"y{c}", 6).alias(f"y{c}") for c in range(K)])


def q_snapshot_text_scan(spark, sf):
    """S7 text form: the first frame as "y0, y1" lines in id order, read back
    by line number (W2) and parsed (F6)."""
    def build():
        path = scratch_path(spark, "exportIter_1")
        frame = _snapshots(spark, sf).where(F.col("iter") == 1).select("row_id", "y0", "y1")
        write_snapshot_text(frame, K, path)
        return path
    path = _memo(spark, sf, "snapshot_text", build)
    lines = numbered_lines(spark, f"{path}/part-*")
    vals = F.split(F.col("line"), ", ").cast("array<double>")
    return lines.select(F.col("line_no").alias("row_id"), rnd(vals[0], 6).alias("y0"), rnd(vals[1], 6).alias("y1"))


def _text_frames(spark, sf) -> str:
    def build():
        path = scratch_path(spark, "export")
        descend(_p(spark, sf), _y0(spark, sf), _n(spark, sf), INTENDED.with_(snapshot_every=1), path, max_iter=FIT_ITERS,
                snapshot_text=True)
        return path
    return _memo(spark, sf, "snapshot_text_frames", build)


def q_snapshot_text_frames(spark, sf):
    """S7 and S8, text form: the fit writes every frame as a folder of lines, and the frames that the folder
    holds are read back with their numbers, in number order."""
    s = read_snapshots_text(spark, _text_frames(spark, sf), K).orderBy("iter", "row_id")
    return s.select("iter", "row_id", *[rnd(f"y{c}", 6).alias(f"y{c}") for c in range(K)])


def q_label_text_join(spark, sf):
    """S6 and J11, text form: labels by their place in a text file, joined to the frames."""
    path = _memo(spark, sf, "label_text", lambda: write_labels_text(
        read_labels(spark, f"{sf.rstrip('/')}/embeddings.parquet"), scratch_path(spark, "labels_text")))
    j = label_join(_snapshots(spark, sf), read_labels_text(spark, path))
    return j.select("iter", "row_id", "label", rnd("x", 6).alias("x"), rnd("y", 6).alias("y"))


def q_fit_trace(spark, sf):
    """E3 and A10 per iteration: KL(P || Q) and the largest |y| of each centred axis, observed by the fit itself."""
    r = descend(_p(spark, sf), _y0(spark, sf), _n(spark, sf), INTENDED, max_iter=FIT_ITERS)
    return r.trace(spark).select("iter", rnd("kl", 8).alias("kl"), rnd("ymax0", 6).alias("xmax"), rnd("ymax1", 6).alias("ymax"))


def q_tsne_fit_3_resumed(spark, sf):
    """K10 with a lost driver: stopped after two iterations, then run again with the same manifest."""
    path = scratch_path(spark, "resumed")

    class Lost(Exception):
        pass

    def stop(it):
        if it == 1:
            raise Lost

    args = (_p(spark, sf), _y0(spark, sf), _n(spark, sf), INTENDED)
    try:
        descend(*args, max_iter=FIT_ITERS, on_iteration=stop, manifest_path=path)
    except Lost:
        pass
    r = descend(*args, max_iter=FIT_ITERS, manifest_path=path)
    return r.y.select("row_id", *[rnd(f"y{c}", 6).alias(f"y{c}") for c in range(K)])


def q_kl_divergence(spark, sf):
    """Extra E3: KL(P || Q) after three iterations."""
    return kl_divergence(_p(spark, sf), _fit3(spark, sf), K, _n(spark, sf)).select(rnd("kl", 9).alias("kl"))


def q_neighbour_preservation(spark, sf):
    """Extra E2: input-space top-10 neighbours kept in the embedding after three iterations."""
    r = neighbour_preservation(_vectors(spark, sf), _fit3(spark, sf), K, _n(spark, sf), 10)
    return r.select("i", "kept", rnd("share", 9).alias("share"))


def q_embed_pipeline(spark, sf):
    r = embed_table(_vectors(spark, sf), INTENDED, max_iter=PIPELINE_ITERS)
    return r.y.select("row_id", *[rnd(f"y{c}", 6).alias(f"y{c}") for c in range(K)])



def q_embed_pipeline_full_rank(spark, sf):
    """K11 with as many components as coordinates: distances, and so the map,
    are those of the raw vectors."""
    r = embed_table(_vectors(spark, sf), INTENDED.with_(pca_dims=64), max_iter=FIT_ITERS)
    return r.y.select("row_id", *[rnd(f"y{c}", 6).alias(f"y{c}") for c in range(K)])


QUERIES = {
    # sources / sinks
    "vectors_scan": q_vectors_scan,
    "vectors_text_scan": q_vectors_text_scan,
    "labels_scan": q_labels_scan,
    "grid_zeros": q_grid_zeros,
    "grid_cells": q_grid_cells,
    "init_normal": q_init_normal,
    "preview_cells": q_preview_cells,
    "fit_snapshots": q_fit_snapshots,
    # projections
    "vectors_to_cells": q_vectors_to_cells,
    "cells_to_vectors": q_cells_to_vectors,
    "transpose_affinity": q_transpose_affinity,
    "center_columns": q_center_columns,
    "affinity_with_diagonal": q_affinity_with_diagonal,
    "affinity_floor": q_affinity_floor,
    "exaggerate_affinity": q_exaggerate_affinity,
    # pairs and joins
    "pairwise_sq_dist": q_pairwise_sq_dist,
    "embedding_kernel": q_embedding_kernel,
    "embedding_repulsion": q_embedding_repulsion,
    "embedding_affinity": q_embedding_affinity,
    "embedding_affinity_floor": q_embedding_affinity_floor,
    "pq_residual_graph": q_pq_residual_graph,
    "gradient_terms": q_gradient_terms,
    "vector_norms": q_vector_norms,
    "label_join": q_label_join,
    # aggregates, windows, ordering
    "column_means": q_column_means,
    "embedding_means": q_embedding_means,
    "neighbour_lists": q_neighbour_lists,
    "knn_topk": q_knn_topk,
    "approximate_knn": q_approximate_knn,
    "symmetrize_affinity": q_symmetrize_affinity,
    "affinity_total": q_affinity_total,
    "kernel_normalizer": q_kernel_normalizer,
    "matrix_profile": q_matrix_profile,
    "frame_limits": q_frame_limits,
    "running_frame_limits": q_running_frame_limits,
    "snapshot_name_order": q_snapshot_name_order,
    # composite
    "entropy_at_beta": q_entropy_at_beta,
    "perplexity_beta": q_perplexity_beta,
    "conditional_affinity": q_conditional_affinity,
    "joint_affinity_knn": q_joint_affinity_knn,
    "gradient_graph": q_gradient_graph,
    "gradient_full": q_gradient_full,
    "gains_update": q_gains_update,
    "momentum_step": q_momentum_step,
    "apply_update": q_apply_update,
    "recenter": q_recenter,
    "covariance": q_covariance,
    "pca_full_rank_distances": q_pca_full_rank_distances,
    "pca_variance_trace": q_pca_variance_trace,
    "pca_project": q_pca_project,
    "pca_residual": q_pca_residual,
    "pca_components": q_pca_components,
    "tsne_fit_3": q_tsne_fit_3,
    "tsne_fit_3_as_executed": q_tsne_fit_3_as_executed,
    "tsne_fit_3_schedule": q_tsne_fit_3_schedule,
    "snapshot_text_scan": q_snapshot_text_scan,
    "snapshot_text_frames": q_snapshot_text_frames,
    "label_text_join": q_label_text_join,
    "fit_trace": q_fit_trace,
    "tsne_fit_3_resumed": q_tsne_fit_3_resumed,
    "embed_pipeline": q_embed_pipeline,
    "embed_pipeline_full_rank": q_embed_pipeline_full_rank,
    # extras (not in the original job): quality of the embedding
    "kl_divergence": q_kl_divergence,
    "neighbour_preservation": q_neighbour_preservation,
}
