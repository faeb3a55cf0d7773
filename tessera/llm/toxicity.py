"""Toxicity by a linear-chain conditional random field over words.

The field has two labels per word, plain and toxic.  Its training words are
labelled from documents: in a document labelled toxic, the words that are far
more frequent in toxic documents than in others, by themselves or by their
beginnings (so inflected forms count together).  Forward and backward passes
give each word's marginal; a document's score is a logistic function of its
marginals, fitted on the document labels, and the words with a marginal over
one half are its offending spans.

The field is fitted on the driver from a bounded sample of labelled rows
(``SAMPLE_ROWS`` documents, their first ``SAMPLE_CHARS`` characters).  The
document weights are fitted on the whole texts of that sample: longer ones are
read in Spark tasks, which return what the score sees of them.  Scoring reads
every word of every text, in chains of one line, ``CHAIN`` words at most.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD_RE, batch_of, read_table, text_slices, trimmed

SAMPLE_ROWS, SAMPLE_CHARS = 4000, 6000
CHAIN = 128
PREFIXES = (4, 5, 6, 7, 8, 9)
THRESHOLD = 0.3
#: Words that a worker remembers; the memory is emptied when full.
CACHE_WORDS = 500_000
_EDGE = bytes(range(0x21, 0x30)) + b":;<=>?@[\\]^_`{|}~"
_WORD = re.compile(WORD_RE)


def chains(text: str | None) -> list[list[bytes]]:
    """The words of each line, in pieces of ``CHAIN`` at most."""
    out = []
    for line in (text or "").encode().split(b"\n"):
        w = line.split()
        out += [w[i:i + CHAIN] for i in range(0, len(w), CHAIN)]
    return out


def forms(word: bytes) -> list[str]:
    """The word in lower case without marks around it, and its beginnings of ``PREFIXES`` characters."""
    w = word.lower().strip(_EDGE).decode()
    return [w, *[f"{w[:n]}-" for n in PREFIXES if n <= len(w)]] if w else []


@dataclass
class Model:
    """``evidence``: form to (test strength, log odds) in toxic documents; ``own``: weights of forms that mark spans."""

    evidence: dict[str, tuple[float, float]] = field(default_factory=dict)
    own: dict[str, float] = field(default_factory=dict)
    emit: np.ndarray = field(default_factory=lambda: np.array([-6.0, 0.0, 0.0, 0.0]))  # bias, evidence, previous, next
    step: np.ndarray = field(default_factory=lambda: np.zeros(3))  # plain-toxic, toxic-plain, toxic-toxic
    doc: np.ndarray | None = None  # logistic weights of ``summary``; None: no labels were given

    def look(self, word: bytes) -> tuple[str, float]:
        """The form of the word with the strongest evidence, and its log odds ("" and 0 if none has any)."""
        best = max(((self.evidence[f][0], len(f), f) for f in forms(word) if f in self.evidence), default=None)
        return (best[2], self.evidence[best[2]][1]) if best else ("", 0.0)


def _padded(seqs: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indexes, steps by sequences matrix) of sequences of like length; padding is NaN."""
    order = np.argsort([len(s) for s in seqs], kind="stable")
    for at in range(0, len(order), 1024):
        idx = order[at:at + 1024]
        m = np.full((len(seqs[idx[-1]]), len(idx)), np.nan)
        for c, i in enumerate(idx):
            m[:len(seqs[i]), c] = seqs[i]
        yield idx, m


def odds(emission: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward odds, backward odds and exp(emission) of toxic against plain, steps by sequences.

    Both messages of a two-label chain are ratios, so no scaling is needed; at padding the emission is 1 and
    the backward ratio starts anew.
    """
    pt, tp, tt = np.exp(step)
    pad = np.isnan(emission)
    e = np.exp(np.clip(np.where(pad, 0, emission), -30, 30))
    fwd, bwd = np.empty_like(e), np.ones_like(e)
    fwd[0] = e[0]
    for t in range(1, len(e)):
        r = fwd[t - 1]
        fwd[t] = e[t] * (pt + r * tt) / (1 + r * tp)
    for t in range(len(e) - 2, -1, -1):
        x = e[t + 1] * bwd[t + 1]
        bwd[t] = np.where(pad[t + 1], 1, (tp + tt * x) / (1 + pt * x))
    return fwd, bwd, e


def marginals(emission: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Probability of toxic at each step (0 at padding)."""
    fwd, bwd, _ = odds(emission, step)
    x = fwd * bwd
    return np.where(np.isnan(emission), 0, x / (1 + x))


class Tagger:
    """Emissions and marginals of texts under a model, with a memory of words."""

    def __init__(self, model: Model):
        self.m = model
        self.known: dict[bytes, tuple[float, float]] = {}

    def _look(self, word: bytes) -> tuple[float, float]:
        got = self.known.get(word)
        if got is None:
            f, x = self.m.look(word)
            got = (float(self.m.emit[0] + self.m.emit[1] * x + self.m.own.get(f, 0.0)), x)
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = got
        return got

    def emission(self, words: list[bytes]) -> np.ndarray:
        known, look = self.known, self._look
        a = np.array([known.get(w) or look(w) for w in words])
        out = a[:, 0].copy()
        out[1:] += self.m.emit[2] * a[:-1, 1]
        out[:-1] += self.m.emit[3] * a[1:, 1]
        return out

    def tag(self, texts: list[str | None]) -> list[np.ndarray]:
        """The marginals of all words of each text, in order."""
        parts = [chains(t) for t in texts]
        seqs = [self.emission(c) for p in parts for c in p]
        p = [np.zeros(0)] * len(seqs)
        for idx, m in _padded(seqs):
            got = marginals(m, self.m.step)
            for c, i in enumerate(idx.tolist()):
                p[i] = got[:len(seqs[i]), c]
        out, at = [], 0
        for c in parts:
            out.append(np.concatenate(p[at:at + len(c)]) if c else np.zeros(0))
            at += len(c)
        return out


def summary(p: np.ndarray) -> np.ndarray:
    """What the document score sees of the marginals.

    The most and the sum of the marginals rise with the number of words, so their weights may depend on it.
    """
    if not len(p):
        return np.eye(8)[0]
    some = 1 - np.exp(np.log1p(-np.minimum(p, 1 - 1e-9)).sum())
    n, most, total = np.log1p(len(p)), p.max(), np.log1p(p.sum())
    return np.array([1.0, most, some, total, min(1.0, 20 * p.mean()), n, n * most, n * total])


def score(model: Model, p: np.ndarray) -> float:
    if model.doc is None:
        return 0.0
    return float(1 / (1 + np.exp(-np.clip(summary(p) @ model.doc, -30, 30))))


def _evidence(docs: Iterator[set[str]], y: np.ndarray) -> tuple[dict[str, tuple[float, float]], set[str]]:
    """Log odds of forms by document with a likelihood ratio test, and those that mark toxic documents beyond chance."""
    pos, neg = int(y.sum()), int((1 - y).sum())
    if not pos or not neg:
        return {}, set()
    n: dict[str, int] = {}  # toxic documents of a form in the upper half, others in the lower
    for words, label in zip(docs, y.tolist()):
        one = 1 << 32 * label
        for w in words:
            n[w] = n.get(w, 0) + one
    evidence, marks = {}, set()

    def entropy(k, m):
        return sum(v * np.log(v / m) for v in (k, m - k) if v)

    for w, both in n.items():
        a, b = both >> 32, both & 0xFFFFFFFF
        if a + b < 4:
            continue
        g = 2 * (entropy(a, pos) + entropy(b, neg) - entropy(a + b, pos + neg))
        x = np.log((a + 0.5) / (pos + 1)) - np.log((b + 0.5) / (neg + 1))
        if g >= 12:
            evidence[w] = (float(g), float(np.clip(x, -3, 5)))
        if g >= 26 and x >= 1.5:
            marks.add(w)
    return evidence, marks


def _fit_field(model: Model, seqs: list[list[bytes]], labels: list[np.ndarray], marks: list[str], rounds: int = 40) -> None:
    """Maximum conditional likelihood of the labels, by Adam with a small quadratic penalty."""
    place = {w: i for i, w in enumerate(marks)}
    known = {w: model.look(w) for w in {w for s in seqs for w in s}}
    ev = [np.array([known[w][1] for w in s]) for s in seqs]
    own = [np.array([place.get(known[w][0], -1) for w in s]) for s in seqs]
    theta = np.concatenate(([-4.0, 1.0, 0.0, 0.0], np.zeros(3), np.zeros(len(marks))))
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    batches = []
    for idx, shape in _padded(ev):
        def fill(rows, none):
            m = np.full(shape.shape, none)
            for c, i in enumerate(idx):
                m[:len(rows[i]), c] = rows[i]
            return m
        x = fill(ev, 0.0)
        prev, nxt = np.zeros_like(x), np.zeros_like(x)
        prev[1:], nxt[:-1] = x[:-1], x[1:]
        batches.append((x, prev, nxt, fill(own, -1).astype(int), fill(labels, 0).astype(float), np.isnan(shape)))
    total = sum(int((~b[5]).sum()) for b in batches) or 1
    for t in range(1, rounds + 1):
        grad = np.zeros_like(theta)
        for x, prev, nxt, mark, y, pad in batches:
            w = np.concatenate((theta[7:], [0.0]))
            em = theta[0] + theta[1] * x + theta[2] * prev + theta[3] * nxt + w[mark]
            fwd, bwd, e = odds(np.where(pad, np.nan, em), theta[4:7])
            p = fwd * bwd
            d = np.where(pad, 0, y - p / (1 + p))
            grad[:4] += [d.sum(), (d * x).sum(), (d * prev).sum(), (d * nxt).sum()]
            hit = mark >= 0
            grad[7:] += np.bincount(mark[hit], d[hit], len(marks))
            if len(x) > 1:
                inside = ~pad[1:]
                pt, tp, tt = np.exp(theta[4:7])
                r, b = fwd[:-1], e[1:] * bwd[1:]
                w01, w10, w11 = pt * b, r * tp, r * tt * b
                z = 1 + w01 + w10 + w11
                y0, y1 = y[:-1], y[1:]
                for j, (have, want) in enumerate((((1 - y0) * y1, w01), (y0 * (1 - y1), w10), (y0 * y1, w11))):
                    grad[4 + j] += ((have - want / z) * inside).sum()
        grad = grad / total * 50 - 1e-3 * theta
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        theta += 0.2 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-8)
    model.emit, model.step = theta[:4], theta[4:7]
    model.own = dict(zip(marks, theta[7:].tolist()))


def fit_words(texts: list[str | None], toxic: list[int]) -> Model:
    """The evidence and the field of some labelled texts, without document weights."""
    model, y = Model(), np.array(toxic, int)
    if not len(y):
        return model
    parts = [chains(t) for t in texts]
    words = ({f for w in {w for c in p for w in c} for f in forms(w)} for p in parts)
    model.evidence, marks = _evidence(words, y)
    if marks:
        seqs, labels = [], []
        for p, label in zip(parts, y.tolist()):
            for c in p:
                seqs.append(c)
                labels.append(np.array([int(label == 1 and model.look(w)[0] in marks) for w in c]))
        _fit_field(model, seqs, labels, sorted(marks))
    return model


def document_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps of a penalised logistic regression
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - q) - 0.05 * w)
    return w


def fit(texts: list[str | None], toxic: list[int]) -> Model:
    """The model of some labelled texts; without both labels among them the scores are constant."""
    model = fit_words(texts, toxic)
    if len(toxic):
        model.doc = document_weights(np.array([summary(p) for p in Tagger(model).tag(texts)]), np.array(toxic, int))
    return model


def _summaries(model):
    """Mapper of (text, toxic) to (summary, toxic) under a broadcast model."""
    schema = pa.schema([("x", pa.list_(pa.float64())), ("toxic", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model.value)
        for b in batches:
            for at, texts in text_slices(b.column(0)):
                yield batch_of(schema, [[summary(p).tolist() for p in tagger.tag(texts)], b.column(1).slice(at, len(texts))])

    return run


def fold(id_col):
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(4))


def fit_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model of a bounded sample of the labelled rows outside fold 2.

    Rows are chosen by a hash of the id, so that about ``SAMPLE_ROWS`` and never more than twice as many reach
    the driver, the first ``SAMPLE_CHARS`` characters of each and the summary of those that are longer.
    """
    own = (labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
           .filter(fold(F.col("doc_id")) != 2).select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("__toxic")))
    n = own.count()
    if n > SAMPLE_ROWS:
        own = own.filter(F.pmod(F.xxhash64("__id"), F.lit(1 << 20)) < int((1 << 20) * SAMPLE_ROWS / n))
    own = F.broadcast(own.limit(2 * SAMPLE_ROWS))  # two numbers a row
    rows = (docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("__text"))
            .filter(F.col("__text").isNotNull() & (fold(F.col("__doc")) != 2))
            .join(own, F.col("__doc") == F.col("__id")))
    longer = F.char_length("__text") > SAMPLE_CHARS
    heads = (rows.select("__doc", F.substring("__text", 1, SAMPLE_CHARS).alias("__head"), "__toxic", longer.alias("__longer"))
             .limit(2 * SAMPLE_ROWS).collect())
    heads.sort(key=tuple)  # the fit does not depend on how rows are partitioned
    model = fit_words([r[1] for r in heads], [r[2] for r in heads])
    if not heads:
        return model
    whole = [r for r in heads if not r[3]]
    x = [summary(p).tolist() for p in Tagger(model).tag([r[1] for r in whole])]
    y = [r[2] for r in whole]
    if len(whole) < len(heads):
        shared = docs.sparkSession.sparkContext.broadcast(model)
        got = (rows.filter(longer).select("__text", "__toxic").mapInArrow(trimmed(_summaries(shared)), "x array<double>, toxic int")
               .limit(2 * SAMPLE_ROWS).collect())
        got.sort(key=tuple)
        x += [r[0] for r in got]
        y += [r[1] for r in got]
    model.doc = document_weights(np.array(x), np.array(y, int))
    return model


_OUT = pa.schema([("score", pa.float64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])


def toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and the offending spans ``starts``, ``ends`` (code points, ends exclusive).

    The score sees the text alone.  A null or empty text has the score of a text without words and no spans;
    nulls elsewhere, repeated rows and other columns pass through (those named like the new ones are replaced).
    """
    docs = docs.drop("score", "starts", "ends")
    at_text = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        for b in batches:
            for at, texts in text_slices(b.column(at_text)):
                scores, starts, ends = [], [], []
                for text, p in zip(texts, tagger.tag(texts)):
                    scores.append(score(tagger.m, p))
                    spans: list[tuple[int, int]] = []
                    if len(p) and p.max() > 0.5:
                        for m, x in zip(_WORD.finditer(text), p):
                            if x > 0.5:
                                spans.append(m.span())
                    starts.append([s for s, _ in spans])
                    ends.append([e for _, e in spans])
                new = batch_of(_OUT, [scores, starts, ends])
                yield pa.RecordBatch.from_arrays([*b.slice(at, len(texts)).columns, *new.columns],
                                                 names=[*b.schema.names, *_OUT.names])

    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType()))])
    return docs.mapInArrow(trimmed(run), schema)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_on(docs, read_table(spark, sf_dir, "labels"))
    out = toxicity(docs, model)
    return out.select("doc_id", (F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False))).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                      F.size("starts").cast("long").alias("n_spans"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the model predicts toxic; same columns.

    Each row goes to its task once and comes back whole or not at all.  A null or empty text has the score of
    a text without words; nulls elsewhere, repeated rows and other columns pass through; an empty table stays
    empty.  A text is held whole in its task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit_on(docs, labels, id_col, text_col))
    at_text = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        for b in batches:
            for at, texts in text_slices(b.column(at_text)):
                good = [score(tagger.m, p) < THRESHOLD for p in tagger.tag(texts)]
                yield b.slice(at, len(texts)).filter(pa.array(good))

    return docs.mapInArrow(trimmed(run), docs.schema)
