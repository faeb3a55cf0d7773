"""Near-copies among vectors by an epsilon grid order join.

Unit vectors are projected on their leading principal directions and sorted by
the cells of a grid as wide as the join distance.  The sequence is cut into
intervals of about ``INTERVAL`` vectors by range partitioning; two intervals
meet in a task only if the boxes of their cells are not more than a cell apart,
and the task halves them recursively, skipping halves that are provably too far
apart, down to small blocks that one matrix product compares.  Equal vectors
are one class throughout, so a very common vector costs one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batch_of, read_table
from tessera.llm.graph import connected_components
from tessera.session import write_table

INTERVAL = 1024
LEAF = 256
#: Leading directions that make the grid, found among this many coordinates at most.
DIRECTIONS, WIDTH = 4, 256


def _matrix(col: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of doubles; shorter vectors are filled with zeros."""
    n = len(col)
    lengths = np.array([len(x) for x in col], np.int64) if n else np.zeros(0, np.int64)
    width = width or (int(lengths.max()) if n else 0)
    out = np.zeros((n, width))
    if n:
        flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        at = np.repeat(np.arange(n), lengths)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[at, place] = flat
    return out


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow of squares
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def principal_directions(vectors: DataFrame, width: int) -> np.ndarray:
    """(width, DIRECTIONS) orthonormal leading directions of the unit vectors, over all rows.

    The driver receives sums: one row of width * (width + 1) numbers per ``n`` partitions.
    """
    w = min(width, WIDTH)
    schema = pa.schema([("one", pa.int32()), ("part", pa.binary())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((w + 1, w + 1))
        for b in batches:
            x = _unit(_matrix(b.column(0), width))[:, :w]
            x = np.hstack((x, np.ones((len(x), 1))))
            total += x.T @ x
        yield batch_of(schema, [[0], [total.tobytes()]])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((w + 1, w + 1))
        for b in batches:
            for part in b.column(1):
                total += np.frombuffer(part.as_py()).reshape(w + 1, w + 1)
        yield batch_of(schema, [[0], [total.tobytes()]])

    # sums of a partition each, added up in one task: partitions * (w + 1)**2 numbers
    total = (vectors.select("vec").mapInArrow(sums, "one int, part binary").repartitionById(1, "one")
             .mapInArrow(add, "one int, part binary").first())
    out = np.zeros((width, DIRECTIONS))
    if total is not None:
        t = np.frombuffer(total["part"]).reshape(w + 1, w + 1)
        n = max(1.0, t[w, w])
        cov = t[:w, :w] / n - np.outer(t[:w, w], t[:w, w]) / n**2
        _, v = np.linalg.eigh(cov)
        v = v[:, ::-1][:, :DIRECTIONS]
        out[:w, :v.shape[1]] = v
    return out


def _cells(directions: np.ndarray, eps: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _unit(_matrix(b.column(b.schema.get_field_index("vec")), len(directions))) @ directions
            cell = np.floor(x / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(cell[:, j]) for j in range(DIRECTIONS)]],
                                             names=[*b.schema.names, *[f"c{j}" for j in range(DIRECTIONS)]])

    return run


def _components(mask: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Labels of rows and columns of a link matrix: numbers shared by what is connected."""
    n, m = mask.shape
    if same:
        mask = mask | mask.T | np.eye(n, dtype=bool)
    big = n + m
    rows = np.arange(n)
    cols = rows if same else np.full(m, big)
    while True:
        c = np.where(mask, rows[:, None], big).min(axis=0, initial=big)
        r = np.minimum(rows, np.where(mask, c[None, :], big).min(axis=1, initial=big))
        if (r == rows).all() and (c == cols).all():
            return r, c
        rows, cols = r, c


class _Side:
    def __init__(self, cls, count, vec, cells):
        order = np.lexsort((cls, *[cells[:, j] for j in range(DIRECTIONS - 1, -1, -1)]))
        self.cls, self.count, self.cells = cls[order], count[order], cells[order]
        self.raw = vec[order]
        self.unit = _unit(self.raw)
        self.links = np.zeros(len(cls), np.int64)


def _near(a: _Side, i: int, j: int, b: _Side, k: int, m: int) -> bool:
    """Whether cells of a[i:j] and b[k:m] may be a cell apart at most."""
    x, y = a.cells[i:j], b.cells[k:m]
    return bool(((x.min(0) <= y.max(0) + 1) & (y.min(0) <= x.max(0) + 1)).all())


def _join(a: _Side, i: int, j: int, b: _Side, k: int, m: int, least: float, edges: list) -> None:
    """Links of a[i:j] with b[k:m] (of each pair once, if these are the same)."""
    if i == j or k == m or not _near(a, i, j, b, k, m):
        return
    same = a is b and i == k and j == m
    if max(j - i, m - k) <= LEAF:
        cos = a.unit[i:j] @ b.unit[k:m].T
        mask = cos >= least
        for r, c in zip(*np.nonzero(np.abs(cos - least) < 1e-9)):  # as the plain quotient has it
            x, y = a.raw[i + r], b.raw[k + c]
            x, y = x / np.abs(x).max(), y / np.abs(y).max()
            mask[r, c] = float(x @ y) / (float(np.sqrt(x @ x)) * float(np.sqrt(y @ y))) >= least
        if same:
            np.fill_diagonal(mask, False)
            mask |= mask.T
        a.links[i:j] += mask @ b.count[k:m]
        if not same:
            b.links[k:m] += a.count[i:j] @ mask
        if mask.any():
            r, c = _components(mask, same)
            names = a.cls[i:j]
            linked = mask.any(axis=1) & (r != np.arange(j - i))
            edges += zip(names[linked].tolist(), names[r[linked]].tolist())
            if not same:
                hit = mask.any(axis=0)
                edges += zip(b.cls[k:m][hit].tolist(), names[c[hit]].tolist())
        return
    p, q = (i + j) // 2 if j - i > 1 else j, (k + m) // 2 if m - k > 1 else m
    _join(a, i, p, b, k, q, least, edges)
    _join(a, i, p, b, q, m, least, edges)
    if not same:
        _join(a, p, j, b, k, q, least, edges)
    _join(a, p, j, b, q, m, least, edges)


_OUT = pa.schema([("kind", pa.int32()), ("u", pa.int64()), ("v", pa.int64())])


def _units(least: float, width: int):
    """Rows (unit, side, cls, n, vec, c0...) sorted by unit.  Out: kind 0: class u has v links; 1: link u, v."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(t: pa.Table) -> pa.RecordBatch:
            t = t.combine_chunks()
            side = t["side"].to_numpy()
            vec = _matrix(pa.concat_arrays(t["vec"].chunks) if t["vec"].num_chunks != 1 else t["vec"].chunk(0), width)
            cells = np.stack([t[f"c{j}"].to_numpy() for j in range(DIRECTIONS)], axis=1)
            cls, n = t["cls"].to_numpy(), t["n"].to_numpy()
            a, b = (_Side(cls[side == s], n[side == s], vec[side == s], cells[side == s]) for s in (0, 1))
            if not len(b.cls):
                b = a
            edges: list = []
            _join(a, 0, len(a.cls), b, 0, len(b.cls), least, edges)
            u = [x.cls[x.links > 0] for x in ((a,) if a is b else (a, b))]
            v = [x.links[x.links > 0] for x in ((a,) if a is b else (a, b))]
            eu, ev = (np.array([e[s] for e in edges], np.int64) for s in (0, 1))
            return batch_of(_OUT, [np.concatenate([np.zeros(sum(map(len, u)), np.int32), np.ones(len(eu), np.int32)]),
                                   np.concatenate([*u, eu]), np.concatenate([*v, ev])])

        held: list[pa.RecordBatch] = []
        unit = None
        for b in batches:
            ids = b.column(0).to_pylist()
            at = 0
            for i in range(1, len(ids) + 1):
                if i == len(ids) or ids[i] != ids[at]:
                    if ids[at] != unit and held:
                        yield solve(pa.Table.from_batches(held))
                        held = []
                    unit = ids[at]
                    held.append(b.slice(at, i - at))
                    at = i
        if held:
            yield solve(pa.Table.from_batches(held))

    return run


def vector_components(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                      least: float = 0.98) -> DataFrame:
    """(id, n_links, component_id, kept) per row of ``vectors``: links are pairs of one label with cosine >= ``least``.

    Cosines are in double precision.  Nulls and edges: a vector that is null, zero, empty or holds null or
    non-finite components, or whose label or id is null, links with nothing and is a component of its own;
    vectors of different lengths do not link; repeated rows are vectors of their own; ``least`` is in (0, 1].
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    fine = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
            & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("vec", lambda x: x != 0))
    keyed = v.withColumn("ok", F.coalesce(fine, F.lit(False))).withColumns(
        {"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(1), "vec")})
    classes = (keyed.filter("ok").groupBy("label", "h1", "h2")
               .agg(F.min("id").alias("cls"), F.count("*").alias("n"), F.first("vec").alias("vec")))
    # ids may repeat with different vectors, so classes get numbers of their own
    classes, _ = write_table(classes, "vecclasses")
    classes = classes.withColumn("cls", F.monotonically_increasing_id()).withColumn("dim", F.size("vec"))
    classes, _ = write_table(classes, "vecclasses")
    stats = classes.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    count, width = stats["n"], stats["dim"] or 1
    directions = principal_directions(classes, width)
    eps = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-6
    names = [f"c{j}" for j in range(DIRECTIONS)]
    slim = classes.select("cls", "label", "dim", "n", "vec")
    celled = slim.mapInArrow(_cells(directions, eps), ", ".join(
        [f"{f.name} {f.dataType.simpleString()}" for f in slim.schema] + [f"{c} int" for c in names]))
    parts = max(1, -(-count // INTERVAL))
    seq, _ = write_table(celled.repartitionByRange(parts, "label", "dim", *names, "cls")
                         .withColumn("part", F.spark_partition_id()), "vecsequence")
    boxes = seq.groupBy("label", "dim", "part").agg(
        *[F.min(c).alias(c + "a") for c in names], *[F.max(c).alias(c + "b") for c in names])
    boxes, _ = write_table(boxes, "vecboxes")
    # one row per interval and first cell it reaches, and the next: boxes less than two cells apart meet there
    left = boxes.withColumn("at", F.explode(F.sequence(F.col("c0a"), F.col("c0b") + 1)))
    right = boxes.withColumn("at", F.explode(F.sequence(F.col("c0a"), F.col("c0b") + 1)))
    right = right.select("label", "dim", "at", F.col("part").alias("part2"),
                         *[F.col(c + x).alias(f"{c}{x}2") for c in names for x in "ab"])
    near = " and ".join(f"{c}a <= {c}b2 + 1 and {c}a2 <= {c}b + 1" for c in names)
    pairs = left.join(right, ["label", "dim", "at"]).filter(f"part <= part2 and {near}").select("label", "dim", "part", "part2").distinct()
    pairs, _ = write_table(pairs.withColumn("unit", F.concat_ws(":", "label", "dim", "part", "part2")), "vecpairs")
    sides = (pairs.select("unit", F.lit(0).alias("side"), F.col("label").alias("l"), F.col("dim").alias("m"), F.col("part").alias("p"))
             .unionByName(pairs.filter("part <> part2").select("unit", F.lit(1).alias("side"), F.col("label").alias("l"),
                                                               F.col("dim").alias("m"), F.col("part2").alias("p"))))
    rows = (seq.join(sides, (seq["part"] == sides["p"]) & (seq["label"] == sides["l"]) & (seq["dim"] == sides["m"]))
            .select("unit", "side", "cls", "n", "vec", *names))
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found, _ = write_table(rows.repartition(n_parts, "unit").sortWithinPartitions("unit")
                           .mapInArrow(_units(least, width), "kind int, u long, v long"), "veclinks")
    roots, _ = write_table(connected_components(found.filter("kind = 1").select("u", "v")), "vecroots")
    links = found.filter("kind = 0").groupBy("u").agg(F.sum("v").alias("more"))
    info = (classes.join(roots, classes["cls"] == roots["node"], "left").join(links, classes["cls"] == links["u"], "left")
            .select("label", "h1", "h2", (F.coalesce("more", F.lit(0)) + F.col("n") - 1).alias("links"),
                    F.coalesce("root", "cls").alias("root")))
    info, _ = write_table(info, "vecinfo")
    least_id = (keyed.filter("ok").groupBy("label", "h1", "h2").agg(F.min("id").alias("id")).join(info, ["label", "h1", "h2"])
                .groupBy("root").agg(F.min("id").alias("first")))
    info, _ = write_table(info.join(least_id, "root").select(F.col("label").alias("l"), F.col("h1").alias("a"),
                                                             F.col("h2").alias("b"), "links", "first"), "vecinfo")
    own = (F.col("label") == F.col("l")) & (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b")) & F.col("ok")
    return (keyed.join(info, own, "left")
            .select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("first", "id").alias("component_id"))
            .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))))


def op7_vector_near_copies(spark, sf_dir: str) -> DataFrame:
    return vector_components(read_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y <> 0)) > 0
    AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
p AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
n AS (SELECT u, count(*) AS n FROM p GROUP BY u),
r AS (SELECT vec_id AS node, vec_id AS root FROM embeddings UNION SELECT p.v, r.root FROM r JOIN p ON r.node = p.u),
f AS (SELECT node, min(root) AS root FROM r GROUP BY node)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, f.root AS component_id, e.vec_id = f.root AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.u JOIN f ON e.vec_id = f.node
"""
