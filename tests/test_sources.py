"""Sources, sinks and awkward inputs (FIXTURES.md section 4)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.operators.linalg import column_means, covariance, pca_project
from tessera.sinks import write_snapshot, write_vector_text
from tessera.sources.grid import grid_zeros, init_normal
from tessera.sources.vectors import (read_labels_text, read_snapshots, read_vector_text, require_valid,
                                     validate_vectors)
from tessera.operators.trajectory import natural_order


def _tmp():
    return tempfile.mkdtemp(prefix="tessera-test-")


def test_text_source_awkward_lines(spark):
    d = _tmp()
    with open(os.path.join(d, "x.txt"), "w") as f:
        f.write("  1.0 2.0\t3.0  \n\n\t4 5 6\n7e-1 8 9\n")
    v = read_vector_text(spark, os.path.join(d, "x.txt")).orderBy("row_id").collect()
    assert [r.row_id for r in v] == [0, 1, 2]
    assert v[0].features == [1.0, 2.0, 3.0] and v[2].features == [0.7, 8.0, 9.0]


def test_text_roundtrip_keeps_ids(spark, vectors):
    d = _tmp()
    write_vector_text(vectors, os.path.join(d, "v"))
    back = read_vector_text(spark, os.path.join(d, "v", "part-*"))
    j = vectors.join(back.withColumnRenamed("features", "f2"), "row_id")
    assert j.count() == 500 and j.where("features <> f2").count() == 0


def test_ragged_and_null_rows_refused(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0]), (2, None)], "row_id bigint, features array<double>")
    info = validate_vectors(df)
    assert info["bad"] == 1 and info["dmin"] == 1 and info["dmax"] == 2
    with pytest.raises(ValueError):
        require_valid(df)


def test_labels_text(spark):
    d = _tmp()
    with open(os.path.join(d, "l.txt"), "w") as f:
        f.write("3\n1\n\n4\n")
    got = [(r.row_id, r.label) for r in read_labels_text(spark, os.path.join(d, "l.txt")).orderBy("row_id").collect()]
    assert got == [(0, "3"), (1, "1"), (2, "4")]


def test_grids(spark, vectors):
    ids = vectors.select("row_id")
    assert grid_zeros(ids, 3).count() == 1500
    a = init_normal(ids, 2, 42)
    b = init_normal(ids.repartition(7), 2, 42)
    assert a.exceptAll(b).count() == 0
    st = a.agg(F.avg("v"), F.stddev("v")).first()
    assert abs(st[0]) < 0.15 and 0.85 < st[1] < 1.15


def test_snapshot_roundtrip_and_natural_order(spark, vectors):
    d = _tmp()
    y = init_normal(vectors.select("row_id"), 2, 1).groupBy("row_id").pivot("col", [0, 1]).agg(F.first("v"))
    y = y.withColumnRenamed("0", "y0").withColumnRenamed("1", "y1")
    for it in (1, 2, 10):
        write_snapshot(y, d, it)
    s = read_snapshots(spark, d)
    assert sorted(r.iter for r in s.select("iter").distinct().collect()) == [1, 2, 10]
    assert s.where("iter = 10").count() == 500
    names = spark.createDataFrame([("exportIter_10",), ("exportIter_2",), ("exportIter_1",)], "name string")
    assert [r.name for r in natural_order(names).collect()] == ["exportIter_1", "exportIter_2", "exportIter_10"]


def test_pca_refuses_too_many_dims(vectors):
    with pytest.raises(ValueError):
        pca_project(vectors, 65, 64)


def test_pca_full_rank_keeps_distances(spark, vectors):
    x = pca_project(vectors, 64, 64)
    a = vectors.where("row_id IN (0, 1)").orderBy("row_id").collect()
    b = x.where("row_id IN (0, 1)").orderBy("row_id").collect()
    da = sum((p - q) ** 2 for p, q in zip(a[0].features, a[1].features))
    db = sum((p - q) ** 2 for p, q in zip(b[0].features, b[1].features))
    assert da == pytest.approx(db, rel=1e-9)
    m = column_means(x).agg(F.max(F.abs("mean"))).first()[0]
    assert m < 1e-9


def test_covariance_symmetric(vectors):
    c = {(r.a, r.b): r.cov for r in covariance(vectors, 64).collect()}
    assert len(c) == 64 * 64
    assert all(c[(a, b)] == pytest.approx(c[(b, a)]) for a in range(64) for b in range(64))


def test_numbered_lines_and_text_snapshot(spark, vectors):
    from tessera.sinks import write_snapshot_text
    from tessera.sources.grid import normal_columns
    from tessera.sources.vectors import numbered_lines
    d = _tmp()
    y = normal_columns(vectors.select("row_id"), 2, 3)
    write_snapshot_text(y, 2, os.path.join(d, "exportIter_1"))
    lines = numbered_lines(spark, os.path.join(d, "exportIter_1", "part-*"))
    got = {r.line_no: r.line for r in lines.collect()}
    want = {r.row_id: f"{r.y0}, {r.y1}" for r in y.collect()}
    assert len(got) == 500
    for i in (0, 1, 250, 499):
        a = [float(x) for x in got[i].split(", ")]
        b = [float(x) for x in want[i].split(", ")]
        assert a == b


def test_all_text_frames_are_read_back(spark):
    from tessera.plans import catalog
    sf = "/root/testdata/sf0.001"
    got = catalog.q_snapshot_text_frames(spark, sf).collect()
    want = catalog.q_fit_snapshots(spark, sf).collect()
    assert {r["iter"] for r in got} == {1, 2, 3}
    assert [r["iter"] for r in got] == sorted(r["iter"] for r in want)
    assert sorted((r["iter"], r.row_id, r.y0, r.y1) for r in got) == sorted((r["iter"], r.row_id, r.y0, r.y1) for r in want)


def test_text_frames_are_found_in_the_folder(spark, vectors):
    """Frames 1, 2 and 10 with 3 to 9 absent; other folders are left alone."""
    from tessera.sinks import write_snapshot_text
    from tessera.sources.grid import normal_columns
    from tessera.sources.vectors import read_snapshots_text
    d = _tmp()
    want = set()
    for it in (1, 2, 10):
        y = normal_columns(vectors.select("row_id"), 2, it)
        write_snapshot_text(y, 2, os.path.join(d, f"exportIter_{it}"))
        want |= {(it, r.row_id, r.y0, r.y1) for r in y.collect()}
    write_snapshot_text(normal_columns(vectors.select("row_id"), 2, 5), 2, os.path.join(d, "other_5"))
    assert {tuple(r) for r in read_snapshots_text(spark, d).collect()} == want


def test_lines_of_split_files_are_numbered_in_order(spark):
    """Files of many splits: places follow the file, not the order of reading; nothing runs in Python."""
    from tessera.sources.vectors import numbered_lines
    d = _tmp()
    lines = [f"line {i} " + "x" * (i % 50) for i in range(20000)]
    for part, (a, b) in enumerate(((0, 12000), (12000, 12001), (12001, 20000))):
        with open(os.path.join(d, f"part-{part:05d}"), "w") as f:
            f.write("".join(x + "\n" for x in lines[a:b]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        df = numbered_lines(spark, d)
        assert df.rdd.getNumPartitions() > 3
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ExistingRDD" not in plan
        got = {r.line_no: r.line for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == dict(enumerate(lines))


def test_resume_refuses_another_fit(spark, vectors):
    from tessera.params import INTENDED
    from tessera.plans.fit import affinities, descend, init_y
    a = affinities(vectors.where("row_id < 60"), INTENDED.with_(perplexity=5.0))
    y0, path = init_y(vectors.where("row_id < 60").select("row_id"), INTENDED), os.path.join(_tmp(), "fit")
    one = descend(a.p, y0, 60, INTENDED, max_iter=2, manifest_path=path)
    again = descend(a.p, y0, 60, INTENDED, max_iter=2, manifest_path=path)  # nothing left to do
    assert {tuple(r) for r in one.y.collect()} == {tuple(r) for r in again.y.collect()} and again.history == []
    with pytest.raises(ValueError):
        descend(a.p, y0, 61, INTENDED, max_iter=3, manifest_path=path)
