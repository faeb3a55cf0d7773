import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import repeats

from .conftest import DOC_SCHEMA, docs_rows


def brute(rows, k):
    texts = [(r[1] or "").encode().split() for r in rows]
    n = Counter(tuple(t[i:i + k]) for t in texts for i in range(len(t) - k + 1))
    out = Counter()
    for r, t in zip(rows, texts):
        gone = {j for i in range(len(t) - k + 1) if n[tuple(t[i:i + k])] > 1 for j in range(i, i + k)}
        out[(r[0], len(t), len(gone), b" ".join(w for j, w in enumerate(t) if j not in gone).decode())] += 1
    return out


def rows_of(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_text").collect())


@pytest.mark.parametrize("k", [35, 5])
def test_edges_match_brute_force(docs, clashing, no_docs, k):
    for d in (docs, clashing):
        got = repeats.remove_repeated_windows(d, k=k)
        assert rows_of(got) == brute(docs_rows(), k)
        assert set(d.columns) <= set(got.columns)
    assert repeats.remove_repeated_windows(no_docs).count() == 0


@pytest.mark.parametrize("k,bits", [(12, 29), (3, 18)])
def test_random_texts_match_brute_force(spark, monkeypatch, k, bits):
    rng = random.Random(k)
    monkeypatch.setattr(repeats, "PIECE_BYTES", 500)
    monkeypatch.setattr(repeats, "MOST_BITS", bits)
    vocab = [f"x{i}" for i in range(30)]
    passages = [rng.choices(vocab, k=rng.randint(2, 40)) for _ in range(6)]
    rows = []
    for i in range(120):
        t = rng.choices(vocab, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(t))
            t[at:at] = rng.choice(passages)
        if i % 11 == 0:
            t = t[:4] * 20  # overlapping repeats
        rows.append((i, " ".join(t), "en", "s", 1))
    df = spark.createDataFrame(rows, DOC_SCHEMA).repartition(4)
    assert rows_of(repeats.remove_repeated_windows(df, k=k)) == brute(rows, k)


def test_sliding():
    x = np.random.default_rng(0).integers(0, 100, 50)
    for n in (1, 2, 3, 7, 8, 28, 50):
        assert repeats.sliding(x, n, np.minimum).tolist() == [min(x[i:i + n]) for i in range(50 - n + 1)]


def test_many_repeated_rows_of_one_id(spark):
    """Their starts are kept once: work and memory grow with the rows, not with their square."""
    text = " ".join(f"w{i}" for i in range(400))
    other = " ".join(f"v{i}" for i in range(100))
    d = (spark.range(8000).selectExpr("cast(null as long) as doc_id", f"'{text}' as text")
         .unionByName(spark.range(4000).selectExpr("7L as doc_id", f"'{text}' as text"))
         .unionByName(spark.range(1).selectExpr("8L as doc_id", f"'{other}' as text"))).repartition(6)
    out = repeats.remove_repeated_windows(d).groupBy("doc_id", "n_words", "n_removed", "kept_text").count().collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_text, r["count"]) for r in out) == [
        (0, 400, 400, "", 8000), (7, 400, 400, "", 4000), (8, 100, 0, other, 1)]
