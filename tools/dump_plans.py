"""Write the physical plans of the key operators to PLANS.md.

usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.operators.descent import in_field, initial_state  # noqa: E402
from tessera.operators.field import store_edges  # noqa: E402
from tessera.operators.kernel import kernel_row_sums  # noqa: E402
from tessera.operators.neighbours import knn  # noqa: E402
from tessera.params import INTENDED  # noqa: E402
from tessera.plans.fit import affinities, init_y  # noqa: E402
from tessera.session import get_session  # noqa: E402
from tessera.sources.vectors import read_vectors  # noqa: E402


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()       # run it, so AQE shows its final plan
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 8)
    v = read_vectors(spark, f"{sf}/embeddings.parquet")
    n = v.count()
    a = affinities(v, INTENDED, n)
    y = init_y(v.select("row_id"), INTENDED)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    store = store_edges(a.p, n, 2, 256)
    sections = [
        ("Vector scan with a row limit (pushdown and pruning)", read_vectors(spark, f"{sf}/embeddings.parquet", limit_rows=100)),
        ("Exact kNN, 256-row blocks (placed, sent on request, streamed)", knn(v, 90, 256, n)),
        ("Kernel row sums, 256-row blocks", kernel_row_sums(y, 2, 256, n)),
        ("First iteration of the fit (later ones read the loop's table in place of the shuffle to blocks)",
         in_field(initial_state(y, 2), store, 2, 4.0, True, "full", ["m0", "m1", "g0", "g1"])),
    ]
    out = [f"# Physical plans (`tools/dump_plans.py`, {os.path.basename(sf)}, n = {n}, local[8], AQE on, broadcasts off)\n",
           "Generated; blocks of 256 rows.\n"]
    for title, df in sections:
        out.append(f"## {title}\n\n```\n{plan(df)}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
