import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import ngram_join as nj
from tessera.llm.graph import UnionFind, connected_components

from .conftest import DOC_SCHEMA, docs_rows


def words_of(text):
    return [bytes(w) for w in (text or "").encode().lower().split()]


def brute(rows, k, num, den):
    sets = []
    for r in rows:
        w = words_of(r[1])
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    uf = UnionFind()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and den * len(a & b) >= num * len(a | b):
                uf.union(rows[i][0], rows[j][0])
    return Counter((r[0], len(s), uf.find(r[0])) for r, s in zip(rows, sets) if r[0] is not None)


def made(seed, n=160):
    """Chains and clusters of edited copies, and passages shared by unlike texts."""
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(400)]
    passage = rng.choices(vocab, k=25)
    texts = []
    while len(texts) < n:
        t = rng.choices(vocab, k=rng.choice([1, 2, 3, 4, 8, 30, 60, 120]))
        if rng.random() < 0.3:
            t = passage + t
        for _ in range(rng.choice([1, 1, 1, 3, 12])):
            t = list(t)
            for _ in range(rng.choice([0, 1, 1, 2])):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            if rng.random() < 0.3:
                t.append(rng.choice(vocab))
            texts.append(" ".join(t))
    rng.shuffle(texts)
    return [(i, t.title() if i % 7 == 0 else t, "en", "s", 1) for i, t in enumerate(texts)]


@pytest.mark.parametrize("k,num,den,block", [(3, 90, 100, 256), (3, 90, 100, 4), (5, 4, 5, 256), (2, 1, 2, 8)])
def test_components_match_brute_force(spark, monkeypatch, k, num, den, block):
    monkeypatch.setattr(nj, "BLOCK", block)
    rows = made(k * num + block)
    df = spark.createDataFrame(rows, DOC_SCHEMA).repartition(4)
    got = Counter(tuple(r) for r in nj.jaccard_components(df, k=k, num=num, den=den).collect())
    assert got == brute(rows, k, num, den)


def test_edge_rows(docs, clashing, no_docs):
    want = brute(docs_rows(), 3, 90, 100)
    for d in (docs, clashing):
        got = nj.jaccard_components(d).collect()
        assert len(got) == len(docs_rows())
        assert Counter(tuple(r) for r in got if r["doc"] is not None) == want
    assert nj.jaccard_components(no_docs).count() == 0


def test_drop_near_copies(docs, clashing, no_docs):
    for d in (docs, clashing):
        out = nj.drop_near_copies(d)
        assert out.columns == d.columns
        ids = Counter(r["doc_id"] for r in out.select("doc_id").collect())
        # 6 has the words of 5, 8 and 9 those of 7 or nearly; rows without an id stay
        assert ids == Counter([1, 2, 3, 4, 5, 7, None, None, 10, 11, 12, 13, 14, 15])
    assert nj.drop_near_copies(no_docs).count() == 0


def test_drop_near_copies_decides_by_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a, "x"), (1, a, "x"), (1, a, "y"), (2, a + " more", "x"), (2, b, "x"), (3, b, "x"), (3, b, "x"), (4, c, "x"),
            (4, c + " more", "x"), (5, "", "x"), (5, "", "x"), (6, None, "x"), (None, c, "x"), (None, c, "x")]
    out = nj.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string, __row string").repartition(5))
    assert out.columns == ["doc_id", "text", "__row"]
    got = Counter((r.doc_id, r.text) for r in out.collect())
    kept_of_4 = [k for k in got if k[0] == 4]
    assert len(kept_of_4) == 1 and kept_of_4[0][1].startswith(c) and got.pop(kept_of_4[0]) == 1
    assert got == Counter([(1, a), (2, b), (5, ""), (5, ""), (6, None), (None, c), (None, c)])


@pytest.mark.parametrize("num,den", [(90, 100), (4, 5), (1, 2)])
def test_linked_sets_have_an_equal_part(num, den):
    rng = np.random.default_rng(7)
    for n in [*range(1, 40), 60, 99, 100, 125, 211, 300, 1000]:
        for _ in range(12):
            a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            take = rng.integers(-(-num * n // den), n + 1)  # the smaller set is a part of it, or both have some alone
            b = rng.permutation(a)[:take]
            more = max(0, (den * len(b) - num * n) // num)  # so many others that the pair still links
            b = np.unique(np.concatenate([b, rng.integers(0, 1 << 62, more).astype(np.uint64)]))
            assert den * len(np.intersect1d(a, b)) >= num * len(np.union1d(a, b))
            if len(a) == len(b) == len(np.intersect1d(a, b)):
                continue
            keys, whose = nj.part_keys([a, b], num, den)
            assert set(keys[whose == 0].tolist()) & set(keys[whose == 1].tolist()), n


def test_unlike_sets_share_no_part():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 40_000, rng.integers(50, 400)).astype(np.uint64)) for _ in range(400)]
    keys, whose = nj.part_keys(sets, 90, 100)
    _, copies = np.unique(keys, return_counts=True)
    assert copies.max() == 1


def test_trie_finds_what_all_pairs_find():
    rng = np.random.default_rng(3)
    base = [np.sort(rng.choice(300, 40, replace=False)).astype(np.uint64) for _ in range(12)]
    sets = []
    for b in base:
        for _ in range(4):
            x = b.copy()
            x[rng.integers(0, 40, 2)] = rng.integers(300, 400, 2)
            sets.append(np.unique(x))
    ids = list(range(len(sets)))
    uf = UnionFind()
    nj.trie_links(sets, ids, sets, ids, uf, 4, 5)
    want = UnionFind()
    for i in ids:
        for j in range(i):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            if 5 * len(a & b) >= 4 * len(a | b):
                want.union(i, j)
    assert [uf.find(i) for i in ids] == [want.find(i) for i in ids]


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, x) for x in range(201, 240)] + [(5, 5), (None, 3)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    rng.shuffle(edges)
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect())
    uf = UnionFind()
    for u, v in edges:
        if u is not None and u != v:
            uf.union(u, v)
    assert got == {x: uf.find(x) for u, v in edges if u is not None and u != v for x in (u, v)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keys_are_sent_packed(spark):
    """A partition gets a row per flush, 14 bytes a key, and every key comes out with its class."""
    keys = np.random.default_rng(3).integers(-1 << 63, (1 << 63) - 1, 20_000)
    classes = keys * 7
    rows = nj.packed_keys(keys, classes, 64)
    assert rows.num_rows == 64 and sum(len(x) for x in rows.column(5).to_pylist()) == 14 * len(keys)
    got = [nj.unpacked_keys(x) for x in rows.column(5).to_pylist()]
    low = (1 << 48) - 1
    assert sorted(zip(*[np.concatenate(x).tolist() for x in zip(*got)])) == sorted(zip((keys & low).tolist(), classes.tolist()))
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(200))) for i in range(40)]
    docs = spark.createDataFrame(texts + [(100 + i, t) for i, t in texts], "doc long, text string")
    sent = docs.coalesce(1).mapInArrow(nj._class_rows(5, 4, 5, 8), nj._ROWS_SQL).where(f"kind = {nj.KEY}").count()
    assert 0 < sent <= 8


@pytest.mark.parametrize("num,den", [(90, 100), (4, 5), (1, 2), (1, 9)])
def test_linked_sets_share_as_many_keys_as_each_needs(num, den):
    rng = np.random.default_rng(11)
    for n in [*range(1, 40), 60, 99, 100, 125, 211, 300, 1000]:
        for _ in range(8):
            a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            b = rng.permutation(a)[:rng.integers(-(-num * n // den), n + 1)]
            more = max(0, (den * len(b) - num * n) // num)
            b = np.unique(np.concatenate([b, rng.integers(0, 1 << 62, more).astype(np.uint64)]))
            if len(a) == len(b) == len(np.intersect1d(a, b)):
                continue
            key, whose, slot, need = nj.banded_keys([a, b], num, den)
            both = np.isin(key, np.intersect1d(key[whose == 0], key[whose == 1]))
            for x in (0, 1):
                shared = np.bincount(slot[both & (whose == x)].astype(int), minlength=nj.SLOTS)
                assert ((need[x] > 0) & (shared >= need[x])).any(), n


def test_texts_that_share_a_few_shingles_ship_no_set(spark, monkeypatch):
    """Chance sharing grows with the corpus; only classes that may have a partner are read again."""
    rng = random.Random(5)
    phrases = [[f"p{i}x{j}" for j in range(6)] for i in range(40)]
    texts = [[w for p in rng.sample(phrases, 10) for w in [*p, *(f"d{d}n{rng.random()}" for _ in range(20))]] for d in range(100)]
    texts.append([*texts[0][:-9], *"nine words that are found in one text alone".split()])
    rows = [(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)]
    read, old = [], nj.set_rows

    def set_rows(docs, members, *rest):
        read.append(members.count())
        return old(docs, members, *rest)

    monkeypatch.setattr(nj, "set_rows", set_rows)
    df = spark.createDataFrame(rows, DOC_SCHEMA).repartition(4)
    assert Counter(tuple(r) for r in nj.jaccard_components(df, k=5, num=4, den=5).collect()) == brute(rows, 5, 4, 5)
    assert read == [2]
