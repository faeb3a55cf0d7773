"""Bench: headline stages of the embedding on $BENCH_SF_DIR (default sf0.1).

Prints one JSON line.  The headline metric is the median seconds per
descent iteration of the fit (the survey's self-set target); the other entries
time the affinity stage and single passes of the two tiled kernels.  A
short warm-up on the smallest table starts the JVM and Python workers
first, so the numbers measure the operators, not process start-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.operators.kernel import kernel_row_sums, normalizer  # noqa: E402
from tessera.operators.neighbours import knn  # noqa: E402
from tessera.params import INTENDED  # noqa: E402
from tessera.plans.fit import affinities, descend, embed_table, init_y  # noqa: E402
from tessera.session import cut_lineage, get_session  # noqa: E402
from tessera.sources.vectors import read_vectors  # noqa: E402

FIT_ITERS = int(os.environ.get("BENCH_ITERS", "10"))


def timed(fn):
    t = time.perf_counter()
    out = fn()
    return time.perf_counter() - t, out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    params = INTENDED

    # warm-up (not reported)
    warm = read_vectors(spark, "/root/testdata/sf0.001/embeddings.parquet")
    a_w = affinities(warm, params)
    descend(a_w.p, init_y(warm.select("row_id"), params), a_w.n, params, max_iter=1).y.count()

    vec = read_vectors(spark, f"{sf_dir.rstrip('/')}/embeddings.parquet")
    n = vec.count()
    q = {}
    q["knn_topk"], _ = timed(lambda: knn(vec, params.n_neighbours, params.block_rows, n)
                             .write.format("noop").mode("overwrite").save())
    q["affinity_stage"], aff = timed(lambda: affinities(vec, params, n))
    y0 = cut_lineage(init_y(vec.select("row_id"), params))
    q["kernel_pass"], _ = timed(lambda: normalizer(kernel_row_sums(y0, params.k, params.block_rows, n)))
    marks = [time.perf_counter()]
    t_fit, fit = timed(lambda: descend(aff.p, y0, n, params, max_iter=FIT_ITERS,
                                       on_iteration=lambda it: marks.append(time.perf_counter())))
    fit.y.count()
    steps = sorted(b - a for a, b in zip(marks, marks[1:]))
    q[f"tsne_fit_{FIT_ITERS}"] = t_fit
    q["tsne_fit_sec_per_iter_mean"] = t_fit / max(1, FIT_ITERS)
    per_iter = steps[len(steps) // 2] if steps else t_fit
    q["tsne_fit_sec_per_iter"] = per_iter
    q["embed_pipeline_3"], _ = timed(lambda: embed_table(vec, params, max_iter=3).y.count())
    print(json.dumps({"metric": "tsne_fit_sec_per_iter", "value": round(per_iter, 4), "unit": "sec",
                      "queries": {k: round(v, 4) for k, v in q.items()},
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "n_points": n,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
