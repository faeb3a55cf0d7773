"""Runs: stretches of words that repeat with a period, found by longest common extensions on a harmonic grid.

A stretch of period q and at least E * q words holds (E - 1) * q places in a row where the word q further on
is the same, so one of them is a multiple of (E - 1) * q.  Those grid points, n / q for each q and n log n in
all, are tested; where words agree at the next points of step q too, the extensions to both sides give the
whole stretch.  Extensions longer than a few words are asked of a difference-cover index (``lce``), one for
each direction, over the documents that have such stretches.  A stretch found under several periods keeps the
smallest: every other one is a multiple of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import SLICE_BYTES, WORD_RE, read_table
from tessera.llm.lce import CoverLCE

EXPONENT = 4
LEAST = 6
FEW = 32  # words compared one by one before the index is asked
PENDING = 1 << 17  # grid points that are resolved at once


def _extend(seq: np.ndarray, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
    """How many of the items at i, j and further on (step 1 or -1) are equal, up to ``FEW``."""
    out = np.zeros(len(i), np.int64)
    alive = np.arange(len(i))
    for t in range(FEW):
        alive = alive[seq[i[alive] + step * t] == seq[j[alive] + step * t]]
        if not len(alive):
            break
        out[alive] += 1
    return out


class _Stretches:
    """Maximal stretches (start, length, period) around grid points of one sequence with separators."""

    def __init__(self, seq: np.ndarray, heads: np.ndarray, sizes: np.ndarray, exponent: int, least: int):
        self.seq, self.heads, self.sizes = seq, heads, sizes  # heads: each document's first place, ascending
        self.exponent, self.least = exponent, least
        self.found = [np.zeros((3, 0), np.int64)]

    def known(self, i: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Points inside a stretch found before whose period divides q: theirs is the same stretch."""
        r = np.concatenate(self.found, axis=1)
        r = r[:, np.argsort(r[0], kind="stable")]
        at = np.searchsorted(r[0], i, side="right") - 1
        near = r[:, np.maximum(at, 0)] if r.shape[1] else np.ones((3, len(i)), np.int64)
        return (at >= 0) & (i + q < near[0] + near[1]) & (q % near[2] == 0)

    def resolve(self, i: np.ndarray, q: np.ndarray) -> None:
        new = ~self.known(i, q)
        i, q = i[new], q[new]
        ahead, back = _extend(self.seq, i, i + q, 1), _extend(self.seq, i - 1, i + q - 1, -1)
        long = np.flatnonzero((ahead == FEW) | (back == FEW))
        if len(long):
            doc = np.searchsorted(self.heads, i[long], side="right") - 1
            docs, doc = np.unique(doc, return_inverse=True)
            # these documents alone, each after a separator, and one at the end
            take = np.concatenate([np.arange(self.heads[d] - 1, self.heads[d] + self.sizes[d]) for d in docs])
            own = np.append(self.seq[take], self.seq.max() + 1)
            first = np.cumsum(np.append(0, self.sizes[docs[:-1]] + 1)) + 1
            p = i[long] - self.heads[docs[doc]] + first[doc]
            ahead[long] = CoverLCE(own).lcp(p, p + q[long])
            n = len(own)
            back[long] = CoverLCE(own[::-1]).lcp(n - p, n - p - q[long])
        length = ahead + back + q
        good = length >= np.maximum(self.least, self.exponent * q)
        self.found.append(_smallest(np.stack((i - back, length, q))[:, good]))
        if len(self.found) > 16:
            self.found = [_smallest(np.concatenate(self.found, axis=1))]

    def all(self) -> np.ndarray:
        return _smallest(np.concatenate(self.found, axis=1))


def _smallest(r: np.ndarray) -> np.ndarray:
    """One column per (start, length): the one of smallest period."""
    r = r[:, np.lexsort((r[2], r[1], r[0]))]
    head = np.ones(r.shape[1], bool)
    head[1:] = (r[:2, 1:] != r[:2, :-1]).any(axis=0)
    return r[:, head]


def runs_of(codes: np.ndarray, first: np.ndarray, exponent: int = EXPONENT, least: int = LEAST) -> np.ndarray:
    """Rows (document, start, length, period) of all runs, by document, start and period.

    ``codes[first[d]:first[d + 1]]`` are the words of document d as numbers >= 0.  A run has ``exponent`` (at
    least 3) times its period and ``least`` words.
    """
    sizes = np.diff(first)
    docs = np.flatnonzero(sizes >= max(least, exponent))
    if not len(docs):
        return np.zeros((0, 4), np.int64)
    docs = docs[np.argsort(-sizes[docs], kind="stable")]  # long ones first: a period concerns a prefix
    n = sizes[docs]
    heads = np.cumsum(np.append(0, n[:-1] + 1)) + 1
    seq = np.empty(int(n.sum()) + len(n) + 1, np.int64)
    top = int(codes.max()) + 1
    seq[heads - 1], seq[-1] = top + np.arange(len(n)), top + len(n)  # separators occur once
    for d, h in zip(docs, heads):
        seq[h:h + sizes[d]] = codes[first[d]:first[d + 1]]
    work = _Stretches(seq, heads, n, exponent, least)
    ends, wait, held = heads + n, [], 0
    need = np.searchsorted(-n, -np.maximum(least, exponent * np.arange(1, n[0] // exponent + 1)), side="right")
    for q, many in enumerate(need, 1):
        if not many:
            break
        end, step = ends[many - 1], (exponent - 1) * q
        i = np.flatnonzero(seq[:end - q:step] == seq[q:end:step]) * step
        if not len(i):
            continue
        # a chain of exponent - 1 points of step q, with i in it
        row = np.ones(len(i), np.int64)
        for way in (q, -q):
            alive, x = np.arange(len(i)), i
            for _ in range(exponent - 2):
                x = x + way
                ok = (x >= 0) & (x + q < end)
                ok[ok] = seq[x[ok]] == seq[x[ok] + q]
                alive, x = alive[ok], x[ok]
                row[alive] += 1
        i = i[row >= exponent - 1]
        if len(i):
            wait.append((i, np.full(len(i), q)))
            held += len(i)
        if held >= PENDING:
            work.resolve(*map(np.concatenate, zip(*wait)))
            wait, held = [], 0
    if wait:
        work.resolve(*map(np.concatenate, zip(*wait)))
    start, length, period = work.all()
    at = np.searchsorted(heads, start, side="right") - 1
    out = np.stack((docs[at], start - heads[at], length, period), axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(codes, distinct words, first): the words of text d are codes[first[d]:first[d + 1]]."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = parts.flatten()
    real = pc.not_equal(flat, "")
    seen = np.append(0, np.cumsum(real.to_numpy(zero_copy_only=False)))
    offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    words = flat.filter(real).dictionary_encode()
    return words.indices.to_numpy().astype(np.int64), words.dictionary, seen[offsets]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(row, rows) of consecutive slices of about ``SLICE_BYTES``, a document at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_BYTES)))
        yield at, end - at
        at = end


def _list(first: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), values)


def periodic_runs(docs: DataFrame, text_col: str = "text", exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """``docs`` with n_words, runs (array of start, length, period in words) and collapsed, one row per row.

    A run is a maximal stretch of words with smallest period q, of at least ``exponent`` * q and ``least``
    words; runs are listed by start, then period.  ``collapsed`` is the text's words joined by one space,
    without those that any run holds after its first q words.

    Nulls and edges: null, empty and white-space texts have no words, no runs and collapse to the empty
    text; rows are independent, so repeated rows and null ids change nothing; columns named n_words, runs or
    collapsed are replaced; an empty table gives an empty result.  A text is held whole in one task, with
    some 100 bytes a word of those with long repetitions.
    """
    keep = [c for c in docs.columns if c.lower() not in ("n_words", "runs", "collapsed")]
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    src = docs.select(*keep)
    schema = T.StructType([*src.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(keep.index(text_col))
            for at, many in _slices(texts):
                codes, words, first = _words(texts.slice(at, many))
                r = runs_of(codes, first, exponent, least)
                edge = np.zeros(len(codes) + 1, np.int64)
                np.add.at(edge, first[r[:, 0]] + r[:, 1] + r[:, 3], 1)
                np.add.at(edge, first[r[:, 0]] + r[:, 1] + r[:, 2], -1)
                stays = np.cumsum(edge[:-1]) == 0
                left = np.append(0, np.cumsum(stays))[first]
                text = pc.binary_join(_list(left, words.take(pa.array(codes[stays]))), " ")
                of = _list(np.searchsorted(r[:, 0], np.arange(many + 1)), pa.StructArray.from_arrays(
                    [pa.array(r[:, k]) for k in (1, 2, 3)], ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays([*(c.slice(at, many) for c in batch.columns),
                                                  pa.array(np.diff(first)), of, text], schema.names)

    return src.mapInArrow(rows, schema)


def repeat_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` where one id in ten has its words from some place on replaced by repetitions of the first of them."""
    h = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(1))
    return docs.withColumn(text_col, F.when(h % 10 != 0, F.col(text_col)).otherwise(F.array_join(F.expr(
        f"""transform(array(named_struct('w', regexp_extract_all(coalesce(`{text_col}`, ''), r'{WORD_RE}', 0),
                                         'g', crc32(cast(cast(`{id_col}` as string) as binary)) div 10)),
              x -> transform(array(named_struct('w', x.w, 'a', if(size(x.w) = 0, 0L, x.g % size(x.w)), 'g', x.g)),
                y -> transform(array(named_struct('w', y.w, 'a', y.a, 'p', 1 + (size(y.w) - y.a) div (3 + y.g % 8))),
                  z -> array_join(transform(z.w, (t, i) -> if(i < z.a, t, z.w[int(z.a + (i - z.a) % z.p)])), ' '))[0])[0])"""),
        " ")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    r = periodic_runs(repeat_tails(docs))
    best = F.expr("""aggregate(runs, runs[0], (b, r) -> if(r.length * b.period > b.length * r.period, r, b))""")
    lines = F.array_join(F.expr("transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n'))"), "")
    return r.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
