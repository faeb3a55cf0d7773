"""op12 against brute force: every period of every text, one after the other."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.lce import COVER, V, CoverLCE
from tessera.llm.periods import op12_periodic_runs, periodic_runs, repeat_tails, runs_of

from .conftest import docs_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, exponent=4, least=6):
    code = {}
    s = np.array([code.setdefault(w, len(code)) for w in words], np.int64)
    out, seen = [], set()
    for q in range(1, len(s) // exponent + 1):
        edge = np.flatnonzero(np.diff(np.concatenate(([0], (s[:-q] == s[q:]).astype(np.int8), [0]))))
        for i, j in zip(edge[0::2].tolist(), edge[1::2].tolist()):
            if j - i + q >= max(least, exponent * q) and (i, j - i + q) not in seen:
                seen.add((i, j - i + q))
                out.append((i, j - i + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {k for i, n, q in runs for k in range(i + q, i + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def repeated(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest(doc_id, text):
    words = repeated(doc_id, WORD.findall(text or ""))
    runs = brute(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{i},{n},{q}\n" for i, n, q in runs)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapse(words, runs))]
    return (doc_id, len(runs), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2], *sha)


def test_cover_meets_every_difference():
    assert {(a - b) % V for a in COVER for b in COVER} == set(range(V))


def test_extensions_match_a_scan():
    rng = random.Random(3)
    for letters, n in ((1, 200), (2, 700), (3, 31), (40, 90), (2, 1)):
        s = [rng.randrange(letters) for _ in range(n)]
        index = CoverLCE(np.array(s))
        pairs = [(i, j) for i in range(n) for j in range(n) if i != j][::max(1, n * n // 3000)]
        if pairs:
            i, j = map(np.array, zip(*pairs))
            want = [next((t for t in range(n) if max(a, b) + t >= n or s[a + t] != s[b + t]), n) for a, b in pairs]
            assert index.lcp(i, j).tolist() == want


@pytest.mark.parametrize("exponent", [3, 4, 6])
def test_runs_match_brute_force(exponent):
    rng = random.Random(exponent)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 4)):
            s = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randint(0, rng.choice([12, 80, 500])))]
            if rng.random() < 0.6 and s:
                a = rng.randrange(len(s))
                p = 1 + (len(s) - a) // rng.randint(3, 10)
                s = s[:a] + [s[a + k % p] for k in range(len(s) - a)]
            texts.append(s)
        codes = np.array([x for s in texts for x in s], np.int64)
        first = np.cumsum([0, *map(len, texts)])
        want = [(d, *r) for d, s in enumerate(texts) for r in brute(s, exponent)]
        assert [tuple(r) for r in runs_of(codes, first, exponent).tolist()] == want


def test_copies_side_by_side_make_no_runs():
    s = list(range(50))
    assert len(runs_of(np.array(s * 6), np.arange(0, 301, 50))) == 0


def test_long_repetition_ends_in_bounded_work():
    r = runs_of(np.zeros(60000, np.int64), np.array([0, 60000]))
    assert r.tolist() == [[0, 0, 60000, 1]]


def test_operator_keeps_rows_and_columns(docs, clashing):
    for d in (docs, clashing.withColumn("runs", F.lit("x")).withColumn("best", F.lit(1))):
        got = periodic_runs(d).collect()
        assert len(got) == len(docs_rows())
        assert set(periodic_runs(d).columns) == set(d.columns) | {"n_words", "runs", "collapsed"}
        for r in got:
            words = WORD.findall(r["text"] or "")
            assert r["n_words"] == len(words)
            runs = [tuple(x) for x in r["runs"]]
            assert runs == brute(words) and r["collapsed"] == collapse(words, runs)
    assert any(r["runs"] for r in got)


def test_nothing(no_docs):
    assert periodic_runs(repeat_tails(no_docs)).count() == 0


def test_tails_repeat(docs):
    for r, t in zip(repeat_tails(docs).select("doc_id", "text").collect(), docs.collect()):
        words = WORD.findall(t["text"] or "")
        want = repeated(t["doc_id"], words)
        assert WORD.findall(r["text"] or "") == want


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in op12_periodic_runs(spark, sf).collect())
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted(digest(*r) for r in rows)
    assert sum(r[1] > 0 for r in got) > 10
