from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm.lines import drop_repeated_lines
from tessera.llm.mixing import emit_copies, mix_sources

from .conftest import docs_rows

WS = " \t\n\x0b\x0c\r"


def brute_lines(rows, min_len=10, min_docs=2):
    def key(x):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(WS))

    held = defaultdict(set)
    for r in rows:
        if r[0] is not None:
            for x in (r[1] or "").split("\n"):
                held[key(x)].add(r[0])
    out = []
    for r in rows:
        parts = (r[1] or "").split("\n")
        keep = [x for x in parts if r[0] is None or len(key(x)) < min_len or len(held[key(x)]) < min_docs
                or r[0] == min(held[key(x)])]
        out.append((r[0], len(parts), len(parts) - len(keep), "\n".join(keep)))
    return Counter(out)


@pytest.mark.parametrize("min_docs", [2, 3])
def test_lines_match_brute_force(docs, clashing, min_docs):
    for d in (docs, clashing):
        got = drop_repeated_lines(d, min_docs=min_docs)
        assert set(d.columns) <= set(got.columns)
        rows = Counter(tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "kept_text").collect())
        assert rows == brute_lines(docs_rows(), min_docs=min_docs)


def test_lines_of_nothing(no_docs):
    assert drop_repeated_lines(no_docs).count() == 0


def waterfill(sizes, weights, cap):
    """Reshare the excess round by round."""
    target, full, total = dict.fromkeys(sizes, 0.0), set(), sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in full]
        rest = total - sum(cap * sizes[s] for s in full)
        for s in free:
            target[s] = rest * weights[s] / sum(weights[x] for x in free)
        over = {s for s in free if target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over
        target |= {s: cap * sizes[s] for s in over}


def test_mix_targets_and_copies(spark, docs, clashing):
    rows = docs_rows()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = waterfill(dict(sizes), {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, 3)
    for d in (docs, clashing):
        got = mix_sources(d).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r["source_size"] == sizes[r["source"]]
            assert r["target"] == pytest.approx(want[r["source"]])
            assert 0 <= r["copies"] <= 3
        again = mix_sources(d.repartition(5)).collect()
        assert Counter(got) == Counter(again)


def test_mix_copies_follow_the_target(spark):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', int(1 + id % 97))").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    per = (mix_sources(df).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("copies") * F.col("size")).alias("x"),
                                                F.sum("copies").alias("n")).collect())
    for r in per:
        assert abs(r["x"] - r["t"]) <= 200
    out = emit_copies(df)
    assert out.columns == df.columns
    assert out.count() == sum(r["n"] for r in per)


def test_emit_copies_edges(docs, clashing, no_docs):
    for d in (docs, clashing):
        n = mix_sources(d).agg(F.sum("copies")).first()[0]
        out = emit_copies(d)
        assert out.columns == d.columns and out.count() == n
    assert emit_copies(no_docs).count() == 0 and mix_sources(no_docs).count() == 0
