"""Removal of word passages that occur more than once, by a count-min prefilter and an exact second pass.

Pass 1: each partition counts its windows in a sketch, and the sketches are added up.  A window is counted
through its minimiser, the smallest hash of its ``GRAM``-word runs, at each place where that run occurs;
equal windows have the same minimiser at different places, so the sketch never counts a repeated window
once.  There are about 2 / (k - GRAM + 2) such places a word, so the sketch is a fraction of the windows.
Pass 2: windows that the sketch estimates as repeated are grouped exactly by 96 bits of hash, dealt by
hash; within one piece of text only one window of a kind is sent.  Sketch cells decide only how many
windows pass 2 exchanges, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Words, as_signed, batch_of, mix64, read_table, span_hash, text_slices
from tessera.session import drop_table, write_table

GRAM = 8
ROWS = 2
SLICE_BITS = 18
#: Cells of a sketch row: a power of two, one per 8 bytes of text, within these bounds (2**29 cells are 64 MB of flags).
LEAST_BITS, MOST_BITS = SLICE_BITS, 29
PIECE_BYTES = 2 << 20
#: Windows that one task of pass 2 groups at most, on average.
GROUPED = 3_000_000
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def sliding(x: np.ndarray, n: int, pick) -> np.ndarray:
    """pick over each run of n entries, by doubling."""
    span, out = 1, x
    while 2 * span <= n:
        out = pick(out[:-span], out[span:])
        span *= 2
    return pick(out[:len(out) - (n - span)], out[n - span:]) if n > span else out


class Windows:
    """The k-word windows of some texts: ``valid`` start words, and the minimiser of each start."""

    def __init__(self, texts: list[str | None], k: int):
        self.words = Words(texts)
        self.k = k
        n = len(self.words.starts)
        gram = min(GRAM, k)
        self.valid = np.zeros(max(0, n - k + 1), bool)
        for a, b in zip(self.words.first[:-1].tolist(), self.words.first[1:].tolist()):
            if b - a >= k:
                self.valid[a:b - k + 1] = True
        self.hash = self.words.hashes() if self.valid.any() else np.zeros(0, np.uint64)
        if not self.valid.any():
            self.least = self.gram = np.zeros(0, np.uint64)
            return
        s = np.arange(n - gram + 1)
        self.gram = span_hash(self.hash, s, s + gram)
        self.least = sliding(self.gram, k - gram + 1, np.minimum)

    def minimisers(self) -> np.ndarray:
        """The hash at every place that is the minimiser of a window."""
        if not len(self.least):
            return self.least
        wide = len(self.gram) - len(self.least)
        own = np.where(self.valid, self.least, np.uint64(0))
        pad = np.zeros(wide, np.uint64)
        top = sliding(np.concatenate((pad, own, pad)), wide + 1, np.maximum)  # over the windows that hold a place
        return self.gram[top == self.gram]

    def digests(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 and 32 bits of hash of the windows that start at ``at``."""
        a = span_hash(self.hash, at, at + self.k)
        b = span_hash(mix64(self.hash), at, at + self.k, 0xD1342543DE82EF95)
        return a, (b >> np.uint64(32)).astype(np.uint32)


def _cell(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (h * _ODD[row]) >> np.uint64(64 - bits)


def repeat_sketch(docs: DataFrame, k: int, bits: int) -> list[np.ndarray]:
    """Per sketch row the packed flags of the cells counted twice or more."""
    slices = 1 << (bits - SLICE_BITS)
    schema = pa.schema([("slice", pa.int32()), ("part", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in text_slices(b.column(0), PIECE_BYTES):
                h = Windows(texts, k).minimisers()
                for row in range(ROWS):
                    cell, n = np.unique(_cell(h, row, bits), return_counts=True)
                    code = (cell & np.uint64((1 << SLICE_BITS) - 1)).astype(np.uint32) << np.uint32(1) | (n > 1)
                    of = (cell >> np.uint64(SLICE_BITS)).astype(np.int64)
                    ids, start = np.unique(of, return_index=True)
                    parts = np.split(code.astype(np.uint32), start[1:]) if len(ids) else []
                    # sorted codes: their differences are small numbers, and their bytes by place compress well
                    rows = [np.diff(p, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes() for p in parts]
                    if rows:
                        yield batch_of(schema, [(ids + row * slices).astype(np.int32), rows])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for s, part in zip(b.column(0).to_pylist(), b.column(1)):
                raw = np.frombuffer(part.as_py(), np.uint8)
                code = np.cumsum(np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel(), dtype=np.uint32)
                t = totals.setdefault(s, np.zeros(1 << SLICE_BITS, np.uint8))
                cell = code >> np.uint32(1)
                t[cell] = np.minimum(2, t[cell] + 1 + (code & np.uint32(1)).astype(np.uint8))
        yield batch_of(schema, [list(totals), [np.packbits(t > 1).tobytes() for t in totals.values()]])

    parts = (docs.select("text").mapInArrow(count, "slice int, part binary")
             .repartitionById(ROWS * slices, "slice").mapInArrow(merge, "slice int, part binary"))
    out = [np.zeros(1 << (bits - 3), np.uint8) for _ in range(ROWS)]
    size = 1 << (SLICE_BITS - 3)
    for r in parts.collect():  # 2 * 2**bits flags in all
        i = r["slice"] % slices
        out[r["slice"] // slices][i * size:(i + 1) * size] = np.frombuffer(r["part"], np.uint8)
    return out


def _flagged(h: np.ndarray, sketch: list[np.ndarray], bits: int) -> np.ndarray:
    ok = np.ones(len(h), bool)
    for row, flags in enumerate(sketch):
        c = _cell(h, row, bits)
        ok &= (flags[(c >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (c & np.uint64(7))).astype(np.uint8) & 1) == 1
    return ok


_FOUND = pa.schema([("slice", pa.int32()), ("doc", pa.int64()), ("th", pa.int64()), ("n", pa.int32()), ("part", pa.binary())])


def _candidates(k: int, bits: int, n_slices: int, sketch):
    """slice >= 0: windows to be grouped, as columns of hashes, documents and starts in ``part``;
    slice -1: starts of windows of (doc, th) that are known to be repeated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = sketch.value
        for b in batches:
            ids, ths = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for at, texts in text_slices(b.column(2), PIECE_BYTES):
                w = Windows(texts, k)
                if not len(w.least):
                    continue
                head = np.concatenate(([True], w.least[1:] != w.least[:-1]))
                ok = _flagged(w.least[head], flags, bits)[np.cumsum(head) - 1] & w.valid
                p = np.flatnonzero(ok)
                if not len(p):
                    continue
                h1, h2 = w.digests(p)
                order = np.lexsort((h2, h1))
                a, c = h1[order], h2[order]
                new = np.concatenate(([True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])))
                many = np.append(np.diff(np.flatnonzero(new)), len(a) - np.flatnonzero(new)[-1]) > 1
                doc = np.searchsorted(w.words.first, p, "right") - 1
                start = p - w.words.first[doc]
                rows = []
                again = np.sort(order[many[np.cumsum(new) - 1]])  # repeated within this piece
                for d, s in _by_doc(doc[again], start[again]):
                    rows.append((-1, ids[at + d], ths[at + d], len(s), s.astype("<u4").tobytes()))
                send = np.sort(order[new])  # one of each kind, in text order
                of = (h1[send] % np.uint64(n_slices)).astype(np.int64)
                by = np.argsort(of, kind="stable")
                cuts, first = np.unique(of[by], return_index=True)
                for s, i in zip(cuts.tolist(), np.split(send[by], first[1:])):
                    own, which = np.unique(doc[i], return_inverse=True)
                    part = b"".join((h1[i].astype("<u8").tobytes(), h2[i].astype("<u4").tobytes(), start[i].astype("<u4").tobytes(),
                                     which.astype("<u4").tobytes(), ids[at + own].astype("<i8").tobytes(),
                                     ths[at + own].astype("<i8").tobytes()))
                    rows.append((s, None, None, len(i), part))
                yield batch_of(_FOUND, [list(x) for x in zip(*rows)])

    return run


def _by_doc(doc: np.ndarray, start: np.ndarray) -> Iterator[tuple]:
    """(document, starts) of rows sorted by document."""
    if len(doc):
        keys, first = np.unique(doc, return_index=True)
        yield from zip(keys.tolist(), np.split(start, first[1:]))


def _grouped(n_slices: int):
    """Starts of the windows whose hash another row of the slice has too, dealt to slices by document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list[np.ndarray]] = [[], [], [], [], []]
        for b in batches:
            for n, part in zip(b.column(0).to_pylist(), b.column(1)):
                raw = part.as_py()
                which = np.frombuffer(raw, "<u4", n, 16 * n)
                own = np.frombuffer(raw, "<i8", -1, 20 * n)
                own, ths = own[:len(own) // 2], own[len(own) // 2:]
                for c, x in zip(cols, (np.frombuffer(raw, "<u8", n), np.frombuffer(raw, "<u4", n, 8 * n),
                                       np.frombuffer(raw, "<u4", n, 12 * n), own[which], ths[which])):
                    c.append(x)
        if not cols[0]:
            return
        h1, h2, start, doc, th = (np.concatenate(c) for c in cols)
        order = np.lexsort((h2, h1))
        a, c = h1[order], h2[order]
        same = (a[1:] == a[:-1]) & (c[1:] == c[:-1])
        hit = np.zeros(len(a), bool)
        hit[1:] = same
        hit[:-1] |= same
        i = order[hit]
        to = (mix64((doc[i] ^ th[i]).view(np.uint64)) % np.uint64(n_slices)).astype(np.int64)
        i = i[np.argsort(to, kind="stable")]
        keys, first = np.unique(np.sort(to), return_index=True)
        for s, j in zip(keys.tolist(), np.split(i, first[1:])):
            part = b"".join((doc[j].astype("<i8").tobytes(), th[j].astype("<i8").tobytes(), start[j].astype("<u4").tobytes()))
            yield batch_of(_FOUND, [[s], [None], [None], [len(j)], [part]])

    return run


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row (doc, th) with its starts for each document of the slice."""
    cols: list[list[np.ndarray]] = [[], [], []]
    for b in batches:
        for n, part in zip(b.column(0).to_pylist(), b.column(1)):
            raw = part.as_py()
            for c, x in zip(cols, (np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<i8", n, 8 * n), np.frombuffer(raw, "<u4", n, 16 * n))):
                c.append(x)
    if not cols[0]:
        return
    doc, th, start = (np.concatenate(c) for c in cols)
    i = np.lexsort((start, th, doc))
    d, t, s = doc[i], th[i], start[i]
    again = (d[1:] == d[:-1]) & (t[1:] == t[:-1]) & (s[1:] == s[:-1])  # of repeated rows, which are one document here
    i = i[np.concatenate(([True], ~again))] if len(i) else i
    new = np.flatnonzero(np.concatenate(([True], (doc[i][1:] != doc[i][:-1]) | (th[i][1:] != th[i][:-1])))) if len(i) else i
    for j in range(0, len(new), 20_000):
        rows = new[j:j + 20_000]
        ends = np.append(new[j + 1:j + 1 + len(rows)], len(i))[:len(rows)]
        yield batch_of(_FOUND, [np.full(len(rows), -1, np.int32), doc[i[rows]], th[i[rows]], (ends - rows).astype(np.int32),
                                [start[i[x:y]].astype("<u4").tobytes() for x, y in zip(rows.tolist(), ends.tolist())]])


def _removed(schema: T.StructType, k: int, text_at: int):
    """The input columns but the last (all parts of starts) and the three results."""
    from pyspark.sql.pandas.types import to_arrow_schema

    out_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, gone, kept = [], [], []
            for text, parts in zip(b.column(text_at), b.column(b.num_columns - 1)):
                words = (text.as_py() or "").encode().split()
                cover = np.zeros(len(words) + 1, np.int32)
                for part in parts.as_py() or ():
                    s = np.frombuffer(part, "<u4").astype(np.int64)
                    np.add.at(cover, s, 1)
                    np.add.at(cover, s + k, -1)
                drop = np.cumsum(cover)[:-1] > 0
                total.append(len(words))
                gone.append(int(drop.sum()))
                if gone[-1]:
                    words = [words[i] for i in np.flatnonzero(~drop).tolist()]
                kept.append(b" ".join(words).decode())
            cols = [b.column(j).cast(f.type) for j, f in zip(range(b.num_columns - 1), out_schema)]
            yield batch_of(out_schema, [*cols, total, gone, kept])

    return run


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 35) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` (long) and ``kept_text`` (the kept words joined by one space).

    Words are ``[^\\x20\\x09-\\x0D]+``.  A word goes if a window of k consecutive words of its document covers
    it whose word sequence also starts anywhere else, in the same document or another; windows are judged on
    the input.

    Nulls and edges: a null or empty text has no words; texts of fewer than k words keep all; rows with a null
    id count like others; repeated rows are places of their own, so each loses the windows it shares with its
    like; other columns pass through, those named like the new ones are replaced; an empty table gives an empty
    result.  A text is held whole in a task, in both passes.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_words", "n_removed", "kept_text")
    # no id and the smallest long are told apart by the text's hash alone
    slim = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"),
                       F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, int(size // 8).bit_length()))
    sketch = spark.sparkContext.broadcast(repeat_sketch(slim, k, bits))
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = max(n_parts, -(-size // (6 * GROUPED)))
    found, found_path = write_table(slim.mapInArrow(_candidates(k, bits, slices, sketch),
                                           "slice int, doc long, th long, n int, part binary"), "repeatfound")
    exact = (found.filter("slice >= 0").select("n", "part", "slice").repartitionById(slices, "slice")
             .select("n", "part").mapInArrow(_grouped(slices), "slice int, doc long, th long, n int, part binary")
             .repartitionById(slices, "slice").select("n", "part")
             .mapInArrow(_per_document, "slice int, doc long, th long, n int, part binary"))
    # repeated rows of one id give equal parts, which are merged before they meet
    starts = (found.filter("slice < 0").unionByName(exact).select("doc", "th", "part").distinct()
              .groupBy("doc", "th").agg(F.collect_list("part").alias("parts")))
    starts, _ = write_table(starts, "repeatstarts")
    drop_table(spark, found_path)
    starts = starts.withColumnsRenamed({"doc": "__doc", "th": "__th", "parts": "__parts"})
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    both = docs.alias("d").join(starts.alias("s"), (key == F.col("s.__doc")) & (F.xxhash64(F.col(f"d.{text_col}")) == F.col("s.__th")), "left")
    both = both.select("d.*", F.col("s.__parts"))
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    return both.mapInArrow(_removed(schema, k, docs.columns.index(text_col)), schema)


def op2_repeated_passages(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeated_windows(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i, ws FROM w WHERE len(ws) >= 35),
h AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM p),
again AS (SELECT h FROM h GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM h WHERE h IN (SELECT h FROM again)),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w),
marked AS (SELECT x.*, g.j IS NOT NULL AS out FROM words x LEFT JOIN gone g ON x.doc_id = g.doc_id AND x.j = g.j),
r AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE out) AS gone,
             string_agg(word, ' ' ORDER BY j) FILTER (WHERE NOT out) AS kept FROM marked GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN r ON w.doc_id = r.doc_id
"""
