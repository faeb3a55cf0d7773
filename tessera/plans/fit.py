"""The full embedding (K10) and the end-to-end pipeline.

A driver loop runs one job per iteration: the field pass over the current points, written with the points'
momentum and gains as the next table of the loop.  The step itself is a projection of that table, fused into
the scan of the next iteration, and Z comes out of the same job as an observed metric, so nothing is joined
and P is never exchanged.  The table lives in the session's checkpoint folder: lineage never grows, a lost
executor costs at most one iteration, and with a manifest a lost driver does too.  Per iteration the driver
receives a row of scalars.
"""

from __future__ import annotations

from dataclasses import dataclass, field as dataclass_field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.operators import affinity as aff
from tessera.operators.descent import gradient_exprs, in_field, initial_state, recenter, state_cols, stepped, ycols
from tessera.operators.field import entropy_of, field, field_schema, kl_from, store_edges
from tessera.operators.linalg import pca_project
from tessera.operators.neighbours import approximate_knn, knn
from tessera.params import INTENDED, TsneParams
from tessera.session import cut_lineage, drop_table, ensure_checkpoint_dir, scratch_path, write_table
from tessera.sources.grid import normal_columns
from tessera.sources.vectors import require_valid
from tessera.sinks import write_snapshot, write_snapshot_text


@dataclass
class Affinities:
    p: DataFrame            # (i, j, p) normalised joint P, off-diagonal, sums to 1
    search: DataFrame       # per-point beta search result
    n: int


def affinities(vectors: DataFrame, params: TsneParams = INTENDED, n: int | None = None) -> Affinities:
    """kNN (or all pairs) -> beta search -> joint P, checkpointed once."""
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    checked = require_valid(vectors)
    if n is None:
        n = checked["n"]
    k_nb = max(1, n - 1) if params.neighbours == "all" else params.n_neighbours
    if params.neighbours == "approximate":
        nn = approximate_knn(vectors, k_nb, params.probes, params.cells, params.block_rows, n)
    else:
        nn = knn(vectors, k_nb, params.block_rows, n)
    search = cut_lineage(aff.beta_search(nn, params.perplexity, params.tol, params.max_tries))
    cond = aff.conditional_affinity(search)
    p = aff.joint_probabilities(cond)
    p = cut_lineage(p)
    return Affinities(p=p, search=search, n=n)


def init_y(ids: DataFrame, params: TsneParams) -> DataFrame:
    return normal_columns(ids, params.k, params.seed)


@dataclass
class FitResult:
    y: DataFrame            # (row_id, y0..y{k-1}) after the last iteration, centred
    state: DataFrame        # (row_id, y*, m*, g*)
    p: DataFrame
    snapshot_path: str | None
    iterations: int
    #: per iteration, of the points that it starts from: iter, z, kl, and the largest |y| of each centred axis
    history: list[dict] = dataclass_field(default_factory=list)

    def trace(self, spark: SparkSession) -> DataFrame:
        """``history`` as a table: (iter, z, kl, ymax0..)."""
        cols = list(self.history[0]) if self.history else ["iter", "z", "kl"]
        schema = ", ".join(f"{c} {'int' if c == 'iter' else 'double'}" for c in cols)
        return spark.createDataFrame([tuple(h[c] for c in cols) for h in self.history], schema)


class _Manifest:
    """The last whole loop table of a fit, named in a folder of one-row tables: one per iteration, read at the start."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}/manifest"

    def last(self) -> dict | None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        if not p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return None
        done = self.spark.read.schema("iter int, table string, blocks int, n bigint, z double, rows bigint").parquet(self.path)
        row = done.orderBy(F.desc("iter")).first()
        return row.asDict() if row else None

    def add(self, **row) -> None:
        """Written after the table that it names is whole."""
        df = self.spark.range(1).select(*[F.lit(v).alias(c) for c, v in row.items()])
        df.selectExpr("CAST(iter AS INT) AS iter", "table", "CAST(blocks AS INT) AS blocks", "CAST(n AS BIGINT) AS n",
                      "CAST(z AS DOUBLE) AS z", "CAST(rows AS BIGINT) AS rows").coalesce(1).write.mode("append").parquet(self.path)


def _sums(k: int) -> str:
    per = "".join(f", 'lo{c}', min(y{c}), 'hi{c}', max(y{c}), 'mid{c}', avg(y{c})" for c in range(k))
    return f"named_struct('rows', count(1), 'z', sum(zrow), 'kl', sum(klrow){per}) AS seen"


def _written(rows: DataFrame, k: int, rest: int, n: int) -> tuple[DataFrame, str, dict]:
    """``rows`` of a pass as a table, with their sums out of the same job."""
    spark, seen = rows.sparkSession, Observation()
    path = scratch_path(spark, "loop")
    rows.observe(seen, F.expr(_sums(k))).write.parquet(path)
    table = spark.read.schema(field_schema(k, rest)).parquet(path)
    got = seen.get["seen"]
    if got["rows"] != n:  # an observed metric may count a repeated task twice
        got = table.agg(F.expr(_sums(k))).first()["seen"]
    return table, path, got.asDict()


def descend(p: DataFrame, y0: DataFrame, n: int, params: TsneParams = INTENDED,
            snapshot_path: str | None = None, max_iter: int | None = None, on_iteration=None,
            manifest_path: str | None = None, snapshot_text: bool = False) -> FitResult:
    """Run the momentum descent from ``y0`` (row_id, y0..) on joint P.

    Centring (K9) commutes with the update -- the kernel and the gradient only see differences y_i - y_j, and
    momentum and gains never read y -- so the loop carries un-centred y and every emitted frame (snapshots,
    result) subtracts its column means.

    ``manifest_path`` names a shared folder of this fit: a run that finds a manifest there goes on after the
    last iteration whose table is whole, given the same P, start and parameters.  ``snapshot_text`` writes
    frames as text, ``exportIter_<n>`` folders of "y0, y1" lines in id order.
    """
    spark, k = p.sparkSession, params.k
    iters = params.max_iter if max_iter is None else max_iter
    store = store_edges(p, n, k, params.block_rows)
    plogp, psum = entropy_of(p)
    carried = [c for c in state_cols(k) if c[0] != "y"]
    manifest = _Manifest(spark, manifest_path) if manifest_path else None
    done, table, path, z, history = 0, None, None, 0.0, []

    def exaggeration(it: int) -> float:
        return params.exaggeration if params.stop_exaggeration_at is None or it < params.stop_exaggeration_at else 1.0

    def after(it: int) -> DataFrame:
        """The state after iteration ``it``, a projection of its table."""
        mu = params.initial_momentum if it < params.momentum_switch_iter else params.final_momentum
        return stepped(table, k, mu, params.lr, params.min_gain, ["row_id", "blk"], gradient_exprs(k, z),
                       {c: f"rest{i}" for i, c in enumerate(carried)})

    last = manifest.last() if manifest else None
    if last:
        if last["blocks"] != store.blocks or last["n"] != n:
            raise ValueError("the manifest belongs to a fit of another size")
        done, path, z = last["iter"], last["table"], last["z"]
        table = spark.read.parquet(path)
        if done > iters or table.count() != last["rows"]:
            raise ValueError(f"the manifest's table of iteration {done} cannot be continued")
    for it in range(done, iters):
        args = (store, k, exaggeration(it), params.floor_p, params.repulsion, carried)
        rows = field(after(it - 1), *args) if table is not None else in_field(initial_state(y0, k), *args)
        new, new_path, got = _written(rows, k, len(carried), n)
        old, table, path, z = path, new, new_path, float(got["z"] or 0.0)
        if manifest:
            manifest.add(iter=it + 1, table=path, blocks=store.blocks, n=n, z=z, rows=got["rows"])
        if old:
            drop_table(spark, old)
        history.append({"iter": it, "z": z, "kl": kl_from(plogp, psum, float(got["kl"] or 0.0), z)} | {
            f"ymax{c}": max(got[f"hi{c}"] - got[f"mid{c}"], got[f"mid{c}"] - got[f"lo{c}"]) if got["rows"] else 0.0
            for c in range(k)})
        if snapshot_path and params.snapshot_every and (it + 1) % params.snapshot_every == 0:
            frame = recenter(after(it).select("row_id", *ycols(k)), k)
            if snapshot_text:
                write_snapshot_text(frame, k, f"{snapshot_path.rstrip('/')}/exportIter_{it + 1}")
            else:
                write_snapshot(frame, snapshot_path, it + 1)
        if on_iteration is not None:
            on_iteration(it)
    end = after(iters - 1).drop("blk") if table is not None else initial_state(y0, k)
    state, _ = write_table(end, "state")
    if path and not manifest:
        drop_table(spark, path)
    store.drop()
    final = recenter(state, k)
    return FitResult(y=final.select("row_id", *ycols(k)), state=final, p=p, snapshot_path=snapshot_path,
                     iterations=iters, history=history)


def tsne_fit(vectors: DataFrame, params: TsneParams = INTENDED, snapshot_path: str | None = None,
             n: int | None = None, max_iter: int | None = None, **kw) -> FitResult:
    """Affinities of ``vectors`` (row_id, features) then descent from the seeded start."""
    a = affinities(vectors, params, n)
    y0 = init_y(vectors.select("row_id"), params)
    return descend(a.p, y0, a.n, params, snapshot_path, max_iter, **kw)


def embed_table(vectors: DataFrame, params: TsneParams = INTENDED, snapshot_path: str | None = None,
                max_iter: int | None = None, **kw) -> FitResult:
    """Source -> validation -> PCA -> fit (K11).  The projection is written once; all later passes read it."""
    info = require_valid(vectors)
    n, d = int(info["n"]), int(info["dmax"] or 0)
    x = vectors
    if params.pca_dims is not None:
        if params.pca_dims > d:
            raise ValueError(f"pca_dims={params.pca_dims} is larger than the vector width {d}")
        x = cut_lineage(pca_project(vectors, params.pca_dims, d), "pca")
    return tsne_fit(x, params, snapshot_path, n, max_iter, **kw)


def state_arrays(state: DataFrame, k: int) -> DataFrame:
    """Descent state with array columns (row_id, y, mom, gain), each of length k.

    Inside the loop the state keeps k scalar columns per quantity so every
    update stays in generated code; arrays are built only here.
    """
    return state.select("row_id", F.array(*[f"y{c}" for c in range(k)]).alias("y"),
                        F.array(*[f"m{c}" for c in range(k)]).alias("mom"),
                        F.array(*[f"g{c}" for c in range(k)]).alias("gain"))
