"""DuckDB SQL oracles for the named queries in ``catalog.py``.

Each string is a brute-force formulation of the same result over the
pre-registered views (here only ``embeddings``): all pairs by a plain
self-join, the precision search by a recursive CTE, the three-iteration fit
unrolled into chained CTEs.  Doubles are rounded exactly as the Spark
queries round them and ``+ 0.0`` clears negative zero.
"""

from __future__ import annotations

K_NB = 90            # floor(3 * perplexity 30)
TOL = "1e-5"
LOGU = "ln(CAST(30.0 AS DOUBLE))"
EX = "4.0"
SEED = 42
MOMENTUM_SEED = 7


def r(x: str, d: int) -> str:
    return f"(round({x}, {d}) + 0.0)"


def _u(row: str, col: int, tag: str, seed: int) -> str:
    key = f"concat('{seed}|', CAST({row} AS VARCHAR), '|{col}|{tag}')"
    bits = f"CAST(CAST(('0x' || substr(md5({key}), 1, 13)) AS BIGINT) AS DOUBLE)"
    return f"(({bits} + 0.5) / CAST(4503599627370496 AS DOUBLE))"


def normal(row: str, col: int, seed: int = SEED) -> str:
    return (f"(sqrt(CAST(-2.0 AS DOUBLE) * ln({_u(row, col, 'a', seed)})) * "
            f"cos(CAST(2.0 AS DOUBLE) * pi() * {_u(row, col, 'b', seed)}))")


def entropy(ds: str, b: str) -> str:
    s = f"list_sum(list_transform({ds}, lambda x: exp(-x * {b})))"
    sdp = f"list_sum(list_transform({ds}, lambda x: x * exp(-x * {b})))"
    return f"(CASE WHEN {s} = 0 THEN CAST(0.0 AS DOUBLE) ELSE ln({s}) + {b} * {sdp} / {s} END)"


V = "v AS (SELECT vec_id AS row_id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings)"
PAIRS = ("pairs AS (SELECT a.row_id AS i, b.row_id AS j, "
         "list_sum(list_transform(list_zip(a.f, b.f), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS d "
         "FROM v a JOIN v b ON a.row_id <> b.row_id)")
KNN = (f"knn AS (SELECT i, j, d, CAST(rk AS INTEGER) AS rank FROM (SELECT i, j, d, "
       f"row_number() OVER (PARTITION BY i ORDER BY d, j) AS rk FROM pairs) WHERE rk <= {K_NB})")
LISTS = "lists AS (SELECT i, list(d ORDER BY d, j) AS ds, list(j ORDER BY d, j) AS js FROM knn GROUP BY i)"
SEARCH = f"""search AS (
  SELECT i, ds, CAST(1.0 AS DOUBLE) AS beta, CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi,
         CAST(0 AS INTEGER) AS tries, {entropy('ds', 'CAST(1.0 AS DOUBLE)')} AS h
  FROM lists
  UNION ALL
  SELECT i, ds, nb, nlo, nhi, CAST(tries + 1 AS INTEGER), {entropy('ds', 'nb')}
  FROM (SELECT i, ds, tries,
          CASE WHEN h - {LOGU} > 0 THEN beta ELSE lo END AS nlo,
          CASE WHEN h - {LOGU} > 0 THEN hi ELSE beta END AS nhi,
          CASE WHEN h - {LOGU} > 0 THEN (CASE WHEN hi IS NULL THEN beta * 2.0 ELSE (beta + hi) / 2.0 END)
               ELSE (CASE WHEN lo IS NULL THEN beta / 2.0 ELSE (beta + lo) / 2.0 END) END AS nb
        FROM search WHERE abs(h - {LOGU}) > {TOL} AND tries < 50) t)"""
FINAL = (f"final AS (SELECT i, beta, h, tries, abs(h - {LOGU}) <= {TOL} AS converged FROM "
         f"(SELECT i, beta, h, tries, row_number() OVER (PARTITION BY i ORDER BY tries DESC) AS rn FROM search) "
         f"WHERE rn = 1)")
COND = """cond AS (SELECT i, j, CASE WHEN s = 0 THEN CAST(0.0 AS DOUBLE) ELSE exp(-d * beta) / s END AS p FROM (
  SELECT l.i, f.beta, unnest(l.ds) AS d, unnest(l.js) AS j,
         list_sum(list_transform(l.ds, lambda x: exp(-x * f.beta))) AS s
  FROM lists l JOIN final f ON l.i = f.i))"""
SYM = ("sym AS (SELECT i, j, sum(p) AS p FROM (SELECT i, j, p FROM cond UNION ALL "
       "SELECT j AS i, i AS j, p FROM cond) GROUP BY i, j)")
PJ = "pj AS (SELECT i, j, p / (SELECT sum(p) FROM sym WHERE i <> j) AS p FROM sym WHERE i <> j)"
PEX = f"pex AS (SELECT i, j, p * {EX} AS p FROM pj)"
Y0 = f"y0t AS (SELECT vec_id AS row_id, {normal('vec_id', 0)} AS y0, {normal('vec_id', 1)} AS y1 FROM embeddings)"
KY = ("ky AS (SELECT i, j, dy0, dy1, 1.0 / (1.0 + (dy0 * dy0 + dy1 * dy1)) AS num FROM ("
      "SELECT a.row_id AS i, b.row_id AS j, a.y0 - b.y0 AS dy0, a.y1 - b.y1 AS dy1 "
      "FROM y0t a JOIN y0t b ON a.row_id <> b.row_id))")
Z0 = "z0 AS (SELECT sum(num) AS z FROM ky)"

P_CHAIN = [V, PAIRS, KNN, LISTS, SEARCH, FINAL, COND, SYM, PJ, PEX]


def with_(*ctes: str) -> str:
    recursive = any(c.startswith("search AS") for c in ctes)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


def _p_weight(alias: str, floor: bool, ex: str = EX) -> str:
    v = f"{alias}.p * {ex}"
    v = f"greatest({v}, 1e-12)" if floor else v
    return f"(CASE WHEN {alias}.p IS NULL THEN 0.0 ELSE {v} END)"


def gradient_full_cte(name: str, kern: str, z: str, ex: str = EX) -> str:
    w = f"({_p_weight('pj', True, ex)} - k.num / zz.z) * k.num"
    return (f"{name} AS (SELECT k.i AS row_id, sum({w} * k.dy0) AS dy0, sum({w} * k.dy1) AS dy1 "
            f"FROM {kern} k LEFT JOIN pj ON k.i = pj.i AND k.j = pj.j CROSS JOIN {z} zz GROUP BY k.i)")


def step_ctes(t: int, state: str, grad: str, mu: str = "0.5") -> list[str]:
    """One momentum step from ``state`` with gradient ``grad``; output state s{t+1} centred."""
    def gain(c):
        return (f"greatest(0.01, CASE WHEN (g.dy{c} > 0) <> (s.m{c} > 0) THEN s.g{c} + 0.2 "
                f"ELSE s.g{c} * 0.8 END)")

    def mom(c):
        return f"({mu} * m{c} - 500.0 * g{c}n * dy{c})"
    u = (f"u{t} AS (SELECT s.row_id, s.y0, s.y1, s.m0, s.m1, g.dy0, g.dy1, {gain(0)} AS g0n, {gain(1)} AS g1n "
         f"FROM {state} s JOIN {grad} g ON s.row_id = g.row_id)")
    w = (f"w{t} AS (SELECT row_id, y0 + {mom(0)} AS y0, y1 + {mom(1)} AS y1, {mom(0)} AS m0, {mom(1)} AS m1, "
         f"g0n AS g0, g1n AS g1 FROM u{t})")
    s = (f"s{t + 1} AS (SELECT row_id, y0 - avg(y0) OVER () AS y0, y1 - avg(y1) OVER () AS y1, m0, m1, g0, g1 "
         f"FROM w{t})")
    return [u, w, s]


def gradient_graph_cte(name: str, kern: str, z: str, ex: str = EX) -> str:
    """Executed form: only the edges of P, no floor (inner join of P and Q)."""
    w = f"(pj.p * {ex} - k.num / zz.z) * k.num"
    return (f"{name} AS (SELECT k.i AS row_id, sum({w} * k.dy0) AS dy0, sum({w} * k.dy1) AS dy1 "
            f"FROM {kern} k JOIN pj ON k.i = pj.i AND k.j = pj.j CROSS JOIN {z} zz GROUP BY k.i)")


def fit_ctes(iters: int, repulsion: str = "full", schedule: list[tuple[str, str]] | None = None) -> list[str]:
    """``schedule``: momentum and exaggeration of each iteration."""
    schedule = schedule or [("0.5", EX)] * iters
    grad_cte = gradient_full_cte if repulsion == "full" else gradient_graph_cte
    ctes = [Y0, "s0 AS (SELECT row_id, y0, y1, CAST(0.0 AS DOUBLE) AS m0, CAST(0.0 AS DOUBLE) AS m1, "
                "CAST(1.0 AS DOUBLE) AS g0, CAST(1.0 AS DOUBLE) AS g1 FROM y0t)"]
    for t, (mu, ex) in enumerate(schedule):
        ctes.append(f"k{t} AS (SELECT i, j, dy0, dy1, 1.0 / (1.0 + (dy0 * dy0 + dy1 * dy1)) AS num FROM ("
                    f"SELECT a.row_id AS i, b.row_id AS j, a.y0 - b.y0 AS dy0, a.y1 - b.y1 AS dy1 "
                    f"FROM s{t} a JOIN s{t} b ON a.row_id <> b.row_id))")
        ctes.append(f"z{t} AS (SELECT sum(num) AS z FROM k{t})")
        ctes.append(grad_cte(f"g{t}", f"k{t}", f"z{t}", ex))
        ctes += step_ctes(t, f"s{t}", f"g{t}", mu)
    return ctes


def _snapshots_sql(select_from_snap: str) -> str:
    snap = ("snap AS (SELECT CAST(1 AS INTEGER) AS iter, row_id, y0, y1 FROM s1 UNION ALL "
            "SELECT CAST(2 AS INTEGER), row_id, y0, y1 FROM s2 UNION ALL "
            "SELECT CAST(3 AS INTEGER), row_id, y0, y1 FROM s3)")
    return with_(*P_CHAIN, *fit_ctes(3), snap) + select_from_snap


def _one_step_sql(select: str) -> str:
    mom = (f"st AS (SELECT y.row_id, y.y0, y.y1, {normal('y.row_id', 0, MOMENTUM_SEED)} AS m0, "
           f"{normal('y.row_id', 1, MOMENTUM_SEED)} AS m1, CAST(1.0 AS DOUBLE) AS g0, CAST(1.0 AS DOUBLE) AS g1 "
           f"FROM y0t y)")
    return with_(*P_CHAIN, Y0, KY, Z0, gradient_full_cte("gr", "ky", "z0"), mom, *step_ctes(0, "st", "gr")) + select


CELLS = ("cells AS (SELECT vec_id AS row_id, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS pos, "
         "CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)")


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["vectors_scan"] = with_(CELLS) + f"SELECT row_id, pos, {r('x', 9)} AS x FROM cells"
    q["vectors_text_scan"] = q["vectors_scan"]
    q["labels_scan"] = "SELECT vec_id AS row_id, label FROM embeddings"
    q["grid_zeros"] = ("SELECT vec_id AS row_id, CAST(unnest([0, 1]) AS INTEGER) AS col, "
                       "CAST(0.0 AS DOUBLE) AS v FROM embeddings")
    norm_cells = (f"nc AS (SELECT vec_id AS row_id, CAST(0 AS INTEGER) AS col, {normal('vec_id', 0)} AS v FROM embeddings "
                  f"UNION ALL SELECT vec_id, CAST(1 AS INTEGER), {normal('vec_id', 1)} FROM embeddings)")
    q["init_normal"] = with_(norm_cells) + f"SELECT row_id, col, {r('v', 9)} AS v FROM nc"
    q["vectors_to_cells"] = q["init_normal"]
    q["preview_cells"] = with_(norm_cells) + f"SELECT row_id, col, {r('v', 9)} AS v FROM nc ORDER BY row_id, col LIMIT 40"
    q["cells_to_vectors"] = ("SELECT vec_id AS row_id, CAST(len(embedding) AS INTEGER) AS dims, "
                             f"{r('list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x, i: x * CAST(i AS DOUBLE)))', 9)} AS wsum "
                             "FROM embeddings")
    q["center_columns"] = with_(CELLS) + f"SELECT row_id, pos, {r('x - avg(x) OVER (PARTITION BY pos)', 9)} AS x FROM cells"
    q["column_means"] = with_(CELLS) + f"SELECT pos, {r('avg(x)', 9)} AS mean FROM cells GROUP BY pos"
    q["vector_norms"] = (f"SELECT vec_id AS row_id, {r('sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x)))', 9)} "
                         "AS l2_norm FROM embeddings")
    cov = with_(CELLS, "cc AS (SELECT row_id, pos, x - avg(x) OVER (PARTITION BY pos) AS x FROM cells)")
    q["covariance"] = cov + (f"SELECT a.pos AS a, b.pos AS b, {r('sum(a.x * b.x) / (count(*) - 1)', 12)} AS cov "
                             "FROM cc a JOIN cc b ON a.row_id = b.row_id GROUP BY a.pos, b.pos")
    q["pca_variance_trace"] = with_(CELLS) + (f"SELECT {r('sum(v)', 9)} AS trace FROM "
                                              "(SELECT pos, var_samp(x) AS v FROM cells GROUP BY pos)")
    knn_base = with_(V, PAIRS, KNN)
    q["knn_topk"] = knn_base + f"SELECT i, j, {r('d', 9)} AS d, rank FROM knn"
    q["pca_full_rank_distances"] = q["knn_topk"]
    q["pairwise_sq_dist"] = with_(V, PAIRS) + (f"SELECT i AS row_id, count(*) AS partners, {r('sum(d)', 9)} AS d_sum, "
                                              f"{r('min(d)', 9)} AS d_min, {r('max(d)', 9)} AS d_max FROM pairs GROUP BY i")
    q["neighbour_lists"] = with_(V, PAIRS, KNN, LISTS) + (
        f"SELECT i, CAST(len(ds) AS INTEGER) AS n_nb, {r('list_sum(ds)', 9)} AS d_sum, {r('ds[-1]', 9)} AS d_max, "
        "js[1] AS j_first FROM lists")
    q["entropy_at_beta"] = with_(V, PAIRS, KNN, LISTS) + f"SELECT i, {r(entropy('ds', 'CAST(1.0 AS DOUBLE)'), 9)} AS h FROM lists"
    q["perplexity_beta"] = with_(V, PAIRS, KNN, LISTS, SEARCH, FINAL) + (
        f"SELECT i, {r('beta', 12)} AS beta, {r('h', 9)} AS h, tries, converged FROM final")
    pchain = with_(*P_CHAIN)
    q["conditional_affinity"] = pchain + f"SELECT i, j, {r('p', 10)} AS p FROM cond"
    q["symmetrize_affinity"] = pchain + f"SELECT i, j, {r('p', 10)} AS p FROM sym"
    q["affinity_total"] = pchain + f"SELECT {r('sum(p)', 9)} AS total, count(*) AS n_entries FROM sym"
    q["joint_affinity_knn"] = pchain + f"SELECT i, j, {r('p', 10)} AS p FROM pex"
    q["transpose_affinity"] = pchain + f"SELECT j AS i, i AS j, {r('p', 10)} AS p FROM pex"
    q["affinity_floor"] = pchain + f"SELECT i, j, {r('greatest(p * 1e-8, 1e-12) * 1e12', 4)} AS p_e12 FROM pex"
    q["exaggerate_affinity"] = pchain + f"SELECT i, j, {r('p', 10)} AS p, {r(f'p * {EX}', 10)} AS p_ex FROM pj"
    q["affinity_with_diagonal"] = pchain + (f"SELECT DISTINCT i, j, {r('p', 10)} AS p, CASE WHEN p < 1e-9 THEN {r('p * 1e12', 3)} END AS tiny_e12 FROM (SELECT i, j, p FROM pex "
                                            "UNION ALL SELECT DISTINCT i, i AS j, 1e-12 AS p FROM pex)")
    q["matrix_profile"] = pchain + ("SELECT count(*) AS n_entries, max(i) AS max_i, max(j) AS max_j, "
                                    f"count(DISTINCT i) AS n_rows, {r('sum(p)', 9)} AS p_sum FROM "
                                    "(SELECT DISTINCT i, j, p FROM (SELECT i, j, p FROM pex UNION ALL "
                                    "SELECT DISTINCT i, i, 0.0 FROM pex))")
    ybase = with_(Y0, KY, Z0)
    q["embedding_means"] = with_(Y0) + f"SELECT {r('avg(y0)', 9)} AS y0_mean, {r('avg(y1)', 9)} AS y1_mean FROM y0t"
    q["embedding_kernel"] = ybase + f"SELECT i AS row_id, {r('sum(num)', 9)} AS zrow FROM ky GROUP BY i"
    q["embedding_repulsion"] = ybase + (f"SELECT i AS row_id, {r('sum(num * num * dy0)', 9)} AS rep0, "
                                        f"{r('sum(num * num * dy1)', 9)} AS rep1 FROM ky GROUP BY i")
    q["kernel_normalizer"] = ybase + f"SELECT {r('z', 6)} AS z FROM z0"
    pyk = with_(*P_CHAIN, Y0, KY, Z0)
    q["embedding_affinity"] = pyk + (f"SELECT k.i, k.j, {r('k.num', 10)} AS num, {r('greatest(k.num / z0.z, 1e-12)', 14)} AS q "
                                     "FROM ky k JOIN pj ON k.i = pj.i AND k.j = pj.j CROSS JOIN z0")
    q["pq_residual_graph"] = pyk + (f"SELECT k.i, k.j, {r(f'pj.p * {EX} - k.num / z0.z', 10)} AS pq "
                                    "FROM ky k JOIN pj ON k.i = pj.i AND k.j = pj.j CROSS JOIN z0")
    wg = f"(pj.p * {EX} - k.num / z0.z) * k.num"
    q["gradient_terms"] = pyk + (f"SELECT k.i, k.j, {r(f'{wg} * k.dy0', 12)} AS t0, {r(f'{wg} * k.dy1', 12)} AS t1 "
                                 "FROM ky k JOIN pj ON k.i = pj.i AND k.j = pj.j CROSS JOIN z0")
    q["gradient_graph"] = pyk + (f"SELECT y.row_id, {r(f'coalesce(sum({wg} * k.dy0), 0.0)', 12)} AS dy0, "
                                 f"{r(f'coalesce(sum({wg} * k.dy1), 0.0)', 12)} AS dy1 FROM y0t y LEFT JOIN "
                                 "(ky k JOIN pj ON k.i = pj.i AND k.j = pj.j CROSS JOIN z0) ON y.row_id = k.i "
                                 "GROUP BY y.row_id")
    q["gradient_full"] = with_(*P_CHAIN, Y0, KY, Z0, gradient_full_cte("gr", "ky", "z0")) + (
        f"SELECT row_id, {r('dy0', 12)} AS dy0, {r('dy1', 12)} AS dy1 FROM gr")
    q["gains_update"] = _one_step_sql(f"SELECT row_id, {r('g0', 9)} AS g0, {r('g1', 9)} AS g1 FROM w0")
    q["momentum_step"] = _one_step_sql(f"SELECT row_id, {r('m0', 9)} AS m0, {r('m1', 9)} AS m1 FROM w0")
    q["apply_update"] = _one_step_sql(f"SELECT row_id, {r('y0', 9)} AS y0, {r('y1', 9)} AS y1 FROM w0")
    q["recenter"] = _one_step_sql(f"SELECT row_id, {r('y0', 9)} AS y0, {r('y1', 9)} AS y1 FROM s1")
    q["tsne_fit_3"] = with_(*P_CHAIN, *fit_ctes(3)) + f"SELECT row_id, {r('y0', 6)} AS y0, {r('y1', 6)} AS y1 FROM s3"
    q["embed_pipeline_full_rank"] = q["tsne_fit_3"]  # a rotation keeps all distances
    q["tsne_fit_3_schedule"] = with_(*P_CHAIN, *fit_ctes(3, schedule=[("0.5", EX), ("0.8", EX), ("0.8", "1.0")])) + (
        f"SELECT row_id, {r('y0', 6)} AS y0, {r('y1', 6)} AS y1 FROM s3")
    q["fit_snapshots"] = _snapshots_sql(f"SELECT iter, row_id, {r('y0', 6)} AS y0, {r('y1', 6)} AS y1 FROM snap")
    q["frame_limits"] = _snapshots_sql(f"SELECT iter, {r('max(abs(y0))', 6)} AS xmax, {r('max(abs(y1))', 6)} AS ymax "
                                       "FROM snap GROUP BY iter")
    q["running_frame_limits"] = _snapshots_sql(
        f"SELECT iter, {r('max(xmax) OVER (ORDER BY iter ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 6)} AS xmax, "
        f"{r('max(ymax) OVER (ORDER BY iter ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 6)} AS ymax "
        "FROM (SELECT iter, max(abs(y0)) AS xmax, max(abs(y1)) AS ymax FROM snap GROUP BY iter)")
    q["label_join"] = _snapshots_sql(f"SELECT s.iter, s.row_id, e.label, {r('s.y0', 6)} AS x, {r('s.y1', 6)} AS y "
                                     "FROM snap s JOIN embeddings e ON s.row_id = e.vec_id")
    q["snapshot_name_order"] = ("SELECT 'exportIter_' || CAST(it AS VARCHAR) AS name, CAST(it AS BIGINT) AS iter_no, "
                                "CAST(row_number() OVER (ORDER BY it) AS INTEGER) AS place "
                                "FROM (SELECT DISTINCT it FROM embeddings, (VALUES (1), (2), (10)) t(it))")
    q["tsne_fit_3_as_executed"] = with_(*P_CHAIN, *fit_ctes(3, "graph")) + (
        f"SELECT row_id, {r('y0', 6)} AS y0, {r('y1', 6)} AS y1 FROM s3")
    q["snapshot_text_scan"] = with_(*P_CHAIN, *fit_ctes(1)) + (
        f"SELECT row_id, {r('y0', 6)} AS y0, {r('y1', 6)} AS y1 FROM s1")
    q["snapshot_text_frames"] = q["fit_snapshots"]
    q["pca_residual"] = with_(CELLS) + (f"SELECT row_id, {r('sum((x - m) * (x - m))', 8)} AS sq FROM cells JOIN "
                                        "(SELECT pos, avg(x) AS m FROM cells GROUP BY pos) USING (pos) GROUP BY row_id")
    q["pca_components"] = ("SELECT CAST(range AS INTEGER) AS pc, CAST(1 AS DOUBLE) AS length, CAST(0 AS DOUBLE) AS off, "
                           "CAST(0 AS DOUBLE) AS gap FROM range(50)")
    q["grid_cells"] = ("SELECT flat, flat // 2 AS row_id, CAST(flat % 2 AS INTEGER) AS col FROM "
                       "(SELECT vec_id * 2 + unnest([0, 1]) AS flat FROM embeddings)")
    q["approximate_knn"] = ("SELECT n, true AS recall_90, CAST(0 AS DOUBLE) AS off FROM "
                            "(SELECT count(*) AS n FROM embeddings)")
    yfar = "yfar AS (SELECT row_id, y0 * f AS y0, y1 * f AS y1 FROM (SELECT *, CASE WHEN row_id % 2 = 0 THEN 1e7 ELSE 1.0 END AS f FROM y0t))"
    q["embedding_affinity_floor"] = with_(*P_CHAIN, Y0, yfar, KY.replace("y0t", "yfar"), Z0) + (
        f"SELECT k.i, k.j, {r('least(greatest(k.num / z0.z, 1e-12) * 1e12, 1000.0)', 6)} AS q_e12 "
        "FROM ky k JOIN pj ON k.i = pj.i AND k.j = pj.j CROSS JOIN z0")
    q["tsne_fit_3_resumed"] = q["tsne_fit_3"]
    q["label_text_join"] = _snapshots_sql(f"SELECT s.iter, s.row_id, CAST(e.label AS VARCHAR) AS label, {r('s.y0', 6)} AS x, "
                                          f"{r('s.y1', 6)} AS y FROM snap s JOIN embeddings e ON s.row_id = e.vec_id")
    q["fit_trace"] = with_(*P_CHAIN, *fit_ctes(3)) + " UNION ALL ".join(
        f"SELECT CAST({t} AS INTEGER) AS iter, {r('kl', 8)} AS kl, {r('xm', 6)} AS xmax, {r('ym', 6)} AS ymax FROM "
        f"(SELECT sum(pj.p * ln(pj.p / (k.num / z.z))) AS kl FROM k{t} k JOIN pj ON k.i = pj.i AND k.j = pj.j CROSS JOIN z{t} z "
        f"WHERE pj.p > 0), (SELECT max(abs(y0 - a0)) AS xm, max(abs(y1 - a1)) AS ym FROM s{t}, "
        f"(SELECT avg(y0) AS a0, avg(y1) AS a1 FROM s{t}))" for t in range(3))
    fit3 = with_(*P_CHAIN, *fit_ctes(3))
    yk = ("y3k AS (SELECT a.row_id AS i, b.row_id AS j, 1.0 / (1.0 + ((a.y0 - b.y0) * (a.y0 - b.y0) + "
          "(a.y1 - b.y1) * (a.y1 - b.y1))) AS num, (a.y0 - b.y0) * (a.y0 - b.y0) + (a.y1 - b.y1) * (a.y1 - b.y1) AS d "
          "FROM s3 a JOIN s3 b ON a.row_id <> b.row_id)")
    q["kl_divergence"] = fit3[:-1] + ",\n" + yk + "\n" + (
        f"SELECT {r('sum(pj.p * ln(pj.p / (k.num / z.z)))', 9)} AS kl FROM y3k k JOIN pj ON k.i = pj.i AND k.j = pj.j "
        "CROSS JOIN (SELECT sum(num) AS z FROM y3k) z WHERE pj.p > 0")
    q["neighbour_preservation"] = fit3[:-1] + ",\n" + yk + ",\n" + (
        "hi AS (SELECT i, j FROM (SELECT i, j, row_number() OVER (PARTITION BY i ORDER BY d, j) AS rk FROM pairs) "
        "WHERE rk <= 10),\n"
        "lo AS (SELECT i, j FROM (SELECT i, j, row_number() OVER (PARTITION BY i ORDER BY d, j) AS rk FROM y3k) "
        "WHERE rk <= 10)\n"
        f"SELECT hi.i, count(lo.j) AS kept, {r('count(lo.j) / 10.0', 9)} AS share FROM hi LEFT JOIN lo "
        "ON hi.i = lo.i AND hi.j = lo.j GROUP BY hi.i")
    return q


ORACLE = build()
