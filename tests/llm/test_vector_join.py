import numpy as np
import pytest

from tessera.llm import vector_join as vj
from tessera.llm.graph import UnionFind


def brute(rows, least):
    ok = [r[0] is not None and r[2] is not None and r[1] is not None and len(r[1]) > 0 and all(x is not None for x in r[1])
          and np.isfinite(np.array(r[1], float)).all() and any(x != 0 for x in r[1]) for r in rows]
    uf, links = UnionFind(), [0] * len(rows)
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and ok[i] and ok[j] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(np.float32(a[1]), float), np.array(np.float32(b[1]), float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= least:
                    links[i] += 1
                    uf.union(("i", i), ("i", j))
    least_id: dict = {}
    for i, r in enumerate(rows):
        if ok[i]:
            root = uf.find(("i", i))
            least_id[root] = min(least_id.get(root, r[0]), r[0])
    comp = [least_id[uf.find(("i", i))] if ok[i] else r[0] for i, r in enumerate(rows)]
    return sorted(((r[0], n, c, r[0] == c) for r, n, c in zip(rows, links, comp)), key=repr)


def made():
    rng = np.random.default_rng(7)
    rows, i = [], 0
    for _ in range(40):
        c = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((i, (c + rng.normal(size=16) * rng.choice([0.02, 0.08, 0.12])).tolist(), int(rng.integers(0, 2))))
            i += 1
    rows += [(1000 + j, rows[3][1], rows[3][2]) for j in range(30)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [], 1), (2003, [float("nan")] * 16, 1),
             (2004, [float("inf")] + [1.0] * 15, 1), (2005, [None] + [1.0] * 15, 1), (2006, rows[0][1], None),
             (None, rows[0][1], rows[0][2]), (2007, rows[0][1][:8], rows[0][2]), (2008, rows[0][1][:8], rows[0][2]),
             (5, rows[5][1], rows[5][2]), (6, rows[0][1], rows[0][2]), (2009, [1e30] * 16, 0), (2010, [2e30] * 16, 0)]
    return rows


@pytest.mark.parametrize("interval,leaf", [(1024, 256), (16, 3)])
@pytest.mark.parametrize("least", [0.98, 0.5])
def test_matches_all_pairs(spark, monkeypatch, interval, leaf, least):
    monkeypatch.setattr(vj, "INTERVAL", interval)
    monkeypatch.setattr(vj, "LEAF", leaf)
    df = spark.createDataFrame(made(), "vec_id long, embedding array<float>, label int").repartition(4)
    got = sorted((tuple(r) for r in vj.vector_components(df, least=least).collect()), key=repr)
    assert got == brute(made(), least)


def test_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, l int, id int, h1 int")
    assert vj.vector_components(df).count() == 0
