import tracemalloc
from collections import Counter, defaultdict

import corpus_pipeline as cp
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import packing
from tessera.llm import toxicity as tx
from tessera.llm.common import BATCH_ROWS
from tessera.llm.ngram_join import _class_rows
from tessera.session import write_table

from .conftest import DOC_SCHEMA, docs_rows
from .test_lines_mixing import brute_lines, waterfill
from .test_ngram_join import brute

SF = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = docs.columns

    def step(k, d):
        out, _ = write_table(cp.STAGES[k][1](spark, d, SF), "test")
        return out

    clean = step(0, docs)
    model = tx.fit_on(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [tuple(r) for r in docs.collect()]
    scores = [tx.score(model, p) for p in tx.Tagger(model).tag([r[1] for r in rows])]
    want = Counter(r for r, s in zip(rows, scores) if s < tx.THRESHOLD)
    assert clean.columns == cols and Counter(tuple(r) for r in clean.collect()) == want

    lines = step(1, clean)
    rows = [tuple(r) for r in clean.collect()]
    kept = {r[0]: r[3] for r in brute_lines(rows)}
    assert lines.columns == cols
    assert Counter(tuple(r) for r in lines.collect()) == Counter((r[0], kept[r[0]], r[2], r[3], len(kept[r[0]])) for r in rows)

    alone = step(2, lines)
    rows = [tuple(r) for r in lines.collect()]
    stay = {d for d, _, c in brute(rows, 5, 4, 5) if d == c}
    assert alone.columns == cols and Counter(tuple(r) for r in alone.collect()) == Counter(r for r in rows if r[0] in stay)

    mixed = step(3, alone)
    rows = [tuple(r) for r in alone.collect()]
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(r[1].encode().split())
    target = waterfill(dict(sizes), {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}, 3)
    got, n = defaultdict(int), Counter()
    for r in mixed.collect():
        assert tuple(r) in set(rows)
        n[r[0]] += 1
        got[r[3]] += len(r[1].encode().split())
    assert mixed.columns == cols and max(n.values()) <= 3
    longest = max(len(r[1].encode().split()) for r in rows)
    assert all(abs(got[s] - target[s]) <= 2 * longest for s in sizes)

    packed = step(4, mixed).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = sum(len(tok.encode(r[1], add_special_tokens=False).ids) + 1 for r in mixed.collect())
    fill = defaultdict(int)
    for r in packed:
        fill[r.sequence_id] += r.length
    assert sum(fill.values()) == total and max(fill.values()) <= 2048


def test_stages_take_edge_rows(spark, clashing, no_docs):
    for k in range(4):
        for d in (clashing, no_docs):
            out, _ = write_table(cp.STAGES[k][1](spark, d, SF), "test")
            assert out.columns == d.columns
            assert out.count() >= (d.count() > 0)
    assert cp.STAGES[4][1](spark, no_docs, SF).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 3, DOC_SCHEMA)
    out = cp.line_dedup(spark, nulls, SF).collect()
    assert [r.text for r in out] == [None] * 3 and len(docs_rows()) > 0
    assert cp.ngram_jaccard(spark, nulls, SF).count() == 3
    assert cp.best_fit_packing(spark, nulls, SF).agg(F.sum("length")).first()[0] == 3


def test_stages_send_small_batches(spark, monkeypatch):
    """Whole texts go to a worker by a bounded number of rows, and the session's own setting stands again after the run."""
    name, sent = "spark.sql.execution.arrow.maxRecordsPerBatch", []

    def probe(spark, docs, sf_dir):
        return (spark.range(4 * BATCH_ROWS, numPartitions=1)
                .mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"rows": [b.num_rows]}) for b in batches), "rows long"))

    def keep(out, _):
        sent.extend(r.rows for r in out.collect())
        return out, ""

    monkeypatch.setattr(cp, "STAGES", [("probe", probe)])
    monkeypatch.setattr(cp, "write_table", keep)
    before = spark.conf.get(name)
    cp.run(spark, SF)
    assert sum(sent) == 4 * BATCH_ROWS and max(sent) <= BATCH_ROWS and spark.conf.get(name) == before


def test_packing_sends_small_batches(spark, monkeypatch):
    """The stage, called by itself, sends its encoder a bounded number of whole texts at once."""
    def probe(docs, path):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"doc": b.column(0), "ids_crc32": [b.num_rows] * b.num_rows})

        rows = docs.mapInArrow(run, "doc long, ids_crc32 long")
        return rows.withColumns({"piece": F.lit(0), "start": F.lit(0), "length": F.lit(1), "ids": F.lit(None).cast("binary")})

    monkeypatch.setattr(packing, "token_pieces", probe)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    out = cp.best_fit_packing(spark, spark.range(4 * BATCH_ROWS, numPartitions=1), SF)
    assert spark.conf.get(name) == before
    sent = [r.ids_crc32 for r in out.collect()]
    assert len(sent) == 4 * BATCH_ROWS and max(sent) <= BATCH_ROWS


def test_near_copies_read_small_batches(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(cp, "drop_near_copies", lambda d: seen.append(int(spark.conf.get(
        "spark.sql.execution.arrow.maxRecordsPerBatch"))) or d)
    cp.ngram_jaccard(spark, spark.range(1), SF)
    assert 0 < seen[0] <= BATCH_ROWS


def test_encoder_is_bounded(monkeypatch):
    """What an encoder remembers and takes for a slice does not follow the number of different words."""
    monkeypatch.setattr(packing, "CACHE_WORDS", 200_000)
    enc = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = pa.array([" ".join(f"w{i}x{j}" for j in range(1500)) for i in range(300)])
    tracemalloc.start()
    try:
        got = [enc.flat(part) for _, part in packing._slices(texts)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60 << 20
    some = [enc.tok.encode(t, add_special_tokens=False).ids for t in texts[:20].to_pylist()]
    assert got[0][0][:got[0][1][19]].tolist() == [x for ids in some for x in ids]


def test_shingles_are_hashed_by_small_slices():
    """What a task takes to hash a batch of texts does not follow the batch."""
    texts = [" ".join(f"w{i}x{j}" for j in range(1500)) for i in range(300)]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(300)), "text": texts})
    tracemalloc.start()
    try:
        rows = sum(r.num_rows for r in _class_rows(5, 4, 5, 7)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows >= 300 and peak < 40 << 20
