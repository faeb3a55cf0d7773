import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark import cloudpickle
from tokenizers import Tokenizer

from tessera.llm import common, packing, secrets
from tessera.llm import fingerprints as fp

from .conftest import docs_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


def sample_texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    return [r[0] for r in rows] + [r[1] for r in docs_rows()]


def test_word_by_word_ids_are_the_whole_texts(spark):
    texts = [*sample_texts(spark), "a<|endoftext|>b <|startoftext|> it's we'll 12 3x é ́ a \x1c\x85 b", "ΣΑΣ Σ σς"]
    tok = Tokenizer.from_file(PATH)
    for t, ids in zip(texts, packing.WordEncoder(PATH).encode(texts)):
        assert tok.encode(t or "", add_special_tokens=False).ids == ids.tolist()


@pytest.mark.parametrize("case", ["docs", "clashing"])
def test_pack_is_whole_and_gapless(request, spark, case):
    rows = packing.pack_documents(request.getfixturevalue(case), PATH).collect()
    tok = Tokenizer.from_file(PATH)
    want = Counter()
    for r in docs_rows():
        ids = np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        for p, s in enumerate(range(0, len(ids), 2048)):
            cut = ids[s:s + 2048]
            want[(r[0], p, s, len(cut), zlib.crc32(cut.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for places in seqs.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 2048


def test_pack_replaces_columns_of_its_own_names(spark):
    d = spark.createDataFrame([(5, "a", "b", 7), (2000, None, "c", None)], "length long, offset string, sequence_id string, n int")
    rows = packing.pack_pieces(d).collect()
    assert sorted((r.length, r.n, r.offset) for r in rows if r.n) == [(5, 7, 2000)] and len({r.sequence_id for r in rows}) == 1


def test_pack_nothing(no_docs):
    assert packing.pack_documents(no_docs, PATH).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_local_search_keeps_pieces_and_never_adds_bins(seed):
    rng = random.Random(seed)
    top = [100, 700, 1500, 2047][seed]
    x = np.array([rng.randint(1, top) for _ in range(600)])
    first = packing.best_fit(x, 2048)
    done = packing.improve([list(b) for b in first], x, 2048)
    assert sorted(i for b in done for i in b) == list(range(600))
    assert all(x[b].sum() <= 2048 for b in done)
    assert packing.lower_bound(x, 2048) <= len(done) <= len(first)


def test_local_search_empties_a_bin():
    # best fit leaves three bins; exchanging 6 for 4 + ... fills two
    x = np.array([6, 5, 4, 3, 2])
    bins = packing.improve([[0, 2], [1, 3], [4]], x, 10)
    assert len(bins) == 2


def test_local_search_on_thirds_ends_near_the_bound():
    x = np.random.default_rng(1).integers(600, 761, 4000)
    done = packing.improve(packing.best_fit(x, 2048), x, 2048)
    assert sorted(i for b in done for i in b) == list(range(4000)) and max(x[b].sum() for b in done) <= 2048
    assert len(done) <= 1.045 * packing.lower_bound(x, 2048)


def test_equal_pieces_end_at_once():
    x = np.full(3000, 700)
    assert len(packing.improve(packing.best_fit(x, 2048), x, 2048)) == 1500


def test_secrets_match_plain_patterns(spark, docs, clashing):
    rng = random.Random(5)
    parts = ["password", "PassWD", "secret", "ToKeN", "api_key", "apikey", "=", ":", " ", "  ", '"', "'", "\n", "\t",
             "abcdefgh", "x", "AKIA", "akia", "ABCDEFGHIJKL0", "0a", "deadbeef" * 4, "é", "ſ", "K", "漢", "_", "-", "."]
    made = ["".join(rng.choices(parts, k=60)) for _ in range(300)]
    scan = secrets.Scanner()
    for t in [*made, *sample_texts(spark)]:
        assert [s for s in scan.spans(t) if s[0] in secrets.KINDS[:3]] == secrets.base_spans_brute(t)
    for d in (docs, clashing):
        got = Counter((r["doc"], r["base"]) for r in secrets.find_secrets(d).collect())
        assert got == Counter((r[0], secrets.joined(secrets.base_spans_brute(r[1]))) for r in docs_rows())


def test_checksum_decides():
    body = b"0123456789abcdefghijABCDEFGHIJ"
    good = b"ghp_" + body + secrets.checksum62(body)
    scan = secrets.Scanner()
    assert scan.spans(f"x {good.decode()} y") == [("github", 2, 42)]
    bad = good[:-1] + (b"0" if good[-1:] != b"0" else b"1")
    assert scan.spans(f"x {bad.decode()} y") == []


def test_find_secrets_of_nothing(no_docs):
    assert secrets.find_secrets(no_docs).count() == 0


def brute_gear(a):
    h, out = 0, []
    for x in a:
        h = ((h << 1) + int(fp._GEAR[x])) & 0xFFFFFFFF
        out.append(h)
    return out


def test_gear_and_cuts():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, 5000).astype(np.uint8)
    h = brute_gear(a)
    assert fp.gear_hashes(a).tolist() == h
    want, start = [], 0
    for i in range(len(a)):
        n = i + 1 - start
        hard, easy = h[i] >> 26 == 0, h[i] >> 28 == 0
        if n == fp.MAX_CHUNK or n >= fp.USUAL_CHUNK and easy or n >= fp.MIN_CHUNK and hard:
            want.append(i + 1)
            start = i + 1
    if start < len(a):
        want.append(len(a))
    assert fp.cut_points(a) == want
    old, fp.BLOCK = fp.BLOCK, 777
    try:
        assert fp.cut_points(a) == want
    finally:
        fp.BLOCK = old


def test_next_rows(spark, docs, clashing, no_docs):
    rows = docs_rows()
    for d in (docs, clashing):
        got = fp.compare_with_next(d).collect()
        assert len(got) == len(rows)
    distinct = [r for r in rows if r[0] is not None and r[0] != 9]
    df = spark.createDataFrame(distinct, docs.schema)
    order = sorted(distinct, key=lambda r: -r[0])
    for n in (1, 3, 8):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        got = {r.doc_id: r for r in fp.compare_with_next(df.repartition(4)).collect()}
        spark.conf.set("spark.sql.shuffle.partitions", old)
        for i, r in enumerate(order):
            t, u = r[1] or "", order[(i + 1) % len(order)][1] or ""
            k = len(t) // 3
            e = (t[:len(t) - k] if k else t) + u[:k]
            g = got[r[0]]
            assert g.n_chars == len(t)
            assert g.edited_sha256 == __import__("hashlib").sha256(e.encode()).hexdigest()
            assert g.fingerprint == fp.as_text(fp.fingerprint(t)) and g.edited_fingerprint == fp.as_text(fp.fingerprint(e))
            assert g.near_next == pytest.approx(fp.containment(fp.fingerprint(t), fp.fingerprint(u)))
    assert fp.compare_with_next(no_docs).count() == 0
    one = fp.compare_with_next(spark.createDataFrame(rows[:1], docs.schema)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_fingerprint_survives_a_shift(spark):
    text = max((t for t in sample_texts(spark) if t), key=lambda t: len(set(t.split())))
    a, b = fp.fingerprint(text), fp.fingerprint("some words in front " + text)
    assert fp.containment(a, b) > 0.8


def test_a_task_frees_what_others_keep():
    """In a worker, where functions arrive pickled, the memory of words goes when a task of another kind starts."""
    def sent(*keeps):
        return cloudpickle.loads(cloudpickle.dumps(common.trimmed(lambda batches: batches, *keeps)))

    packing._encoder(public_tokenizers.path("word_bpe_49k.json"))
    common._POW[common._B1].upto(1000)
    assert list(sent("encoder")(iter([]))) == [] and packing._ENCODERS and len(common._POW[common._B1].up) == 1
    assert list(sent()(iter([]))) == [] and not packing._ENCODERS
