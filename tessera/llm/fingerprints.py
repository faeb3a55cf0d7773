"""Document fingerprints by content-defined chunking with a gear hash.

A text's UTF-8 bytes are cut where the gear hash of the last 32 bytes is small
(normalised chunking: a harder test before the usual chunk length, an easier
one after it), so an insertion moves only the cuts near it.  The fingerprint is
the set of chunk digests, each with its chunk's length; containment of one
fingerprint in another is the share of the length that is in both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import batch_of, mix64, read_table, span_hash

MIN_CHUNK, USUAL_CHUNK, MAX_CHUNK = 8, 32, 120
HARD_BITS, EASY_BITS = 6, 4
BLOCK = 1 << 20
_GEAR = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(a: np.ndarray) -> np.ndarray:
    """At each byte the sum of gear[byte k places back] << k over the last 32 bytes, by doubling."""
    h = _GEAR[a]
    for s in (1, 2, 4, 8, 16):
        h[s:] = h[s:] + (h[:-s] << np.uint32(s))
    return h


def cut_points(a: np.ndarray) -> list[int]:
    """Ends of the chunks of ``a``."""
    at, hard = [], []
    for s in range(0, len(a), BLOCK):
        lead = min(s, 31)
        h = gear_hashes(a[s - lead:s + BLOCK])[lead:]
        easy = np.flatnonzero(h >> np.uint32(32 - EASY_BITS) == 0)
        at += (easy + s + 1).tolist()
        hard += (h[easy] >> np.uint32(32 - HARD_BITS) == 0).tolist()
    cuts, start, n = [], 0, len(a)
    for p, strong in zip(at, hard):
        while p - start > MAX_CHUNK:
            start += MAX_CHUNK
            cuts.append(start)
        size = p - start
        if size >= USUAL_CHUNK or strong and size >= MIN_CHUNK:
            cuts.append(p)
            start = p
    while n - start > MAX_CHUNK:
        start += MAX_CHUNK
        cuts.append(start)
    if start < n:
        cuts.append(n)
    return cuts


def fingerprint(text: str | None) -> np.ndarray:
    """Sorted distinct chunks: 56 bits of digest, then 8 bits of length.  Empty for a null or empty text."""
    a = np.frombuffer((text or "").encode(), np.uint8)
    ends = np.array(cut_points(a), np.int64)
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(ends) else ends
    out, k = [], 0
    while k < len(ends):  # whole chunks, a block of text at a time
        j = max(k + 1, int(np.searchsorted(ends, starts[k] + BLOCK, "right")))
        s = starts[k]
        d = span_hash(a[s:ends[j - 1]], starts[k:j] - s, ends[k:j] - s)
        out.append(d & ~np.uint64(0xFF) | (ends[k:j] - starts[k:j]).astype(np.uint64))
        k = j
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the chunk length of ``a`` that ``b`` has too; 1 if ``a`` is empty and ``b`` also, else 0."""
    if not len(a):
        return float(not len(b))
    w = (a & np.uint64(0xFF)).astype(np.int64)
    return float(w[np.isin(a, b, assume_unique=True)].sum() / w.sum())


def as_text(fp: np.ndarray) -> str:
    return fp.astype(">u8").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by as much of the beginning of the following one."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k] if k else text


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                  ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                  ("near_next", pa.float64())])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order within each part; the one marked as a copy only ends its part."""
    last = None  # part, id, text, fingerprint
    for b in batches:
        rows: list[tuple] = []
        for part, copy, doc, text in zip(*[b.column(j) for j in range(4)]):
            part, copy, doc, text = part.as_py(), copy.as_py(), doc.as_py(), text.as_py() or ""
            if last is None and copy:
                continue
            fp = fingerprint(text)
            if last is not None and last[0] == part:
                _, d, t, f = last
                e = edited(t, text)
                g = fingerprint(e) if e != t else f
                rows.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), as_text(f), as_text(g),
                             containment(f, g), containment(f, fp)))
            last = None if copy else (part, doc, text, fp)
            if len(rows) >= 500:
                yield batch_of(_OUT, [list(c) for c in zip(*rows)])
                rows = []
        if rows:
            yield batch_of(_OUT, [list(c) for c in zip(*rows)])


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (part, copy, doc, text) dealt by ranges of descending id and sorted within each part.

    Each part ends with a copy of the row that follows its last one, in the next part (the first row of all
    after the last).  The driver sees one key per part.  Rows with the same id follow each other by a hash of
    their text; null ids come last.
    """
    spark: SparkSession = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    cuts = d.select("doc").approxQuantile("doc", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    cuts = sorted(set(cuts))
    part = F.lit(0)
    if cuts:
        over = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c > F.col("doc").cast("double")))
        part = F.when(F.col("doc").isNull(), F.lit(len(cuts))).otherwise(over)
    d = d.withColumn("part", part.cast("int")).withColumn("th", F.xxhash64("text"))
    firsts = sorted(d.groupBy("part").agg(F.max(F.struct("doc", "th")).alias("f")).collect())
    if not firsts:
        return d.select("part", F.lit(False).alias("copy"), "doc", "text")
    before = [(r["part"], r["f"]["doc"], r["f"]["th"], firsts[i - 1]["part"]) for i, r in enumerate(firsts)]
    small = F.broadcast(spark.createDataFrame(before, "part int, doc1 long, th1 long, before int"))  # a row per part
    d = d.join(small, "part")
    first = F.col("doc").eqNullSafe(F.col("doc1")) & (F.col("th") == F.col("th1"))
    own = F.struct(F.col("part"), F.lit(False).alias("copy"))
    to = F.when(first, F.array(own, F.struct(F.col("before").alias("part"), F.lit(True).alias("copy")))).otherwise(F.array(own))
    d = d.select(F.explode(to).alias("to"), "doc", "text", "th")
    d = d.select(F.col("to.part").alias("part"), F.col("to.copy").alias("copy"), "doc", "text", "th")
    return (d.repartitionById(len(cuts) + 1, "part")
            .sortWithinPartitions("part", "copy", F.col("doc").desc_nulls_last(), F.col("th").desc())
            .select("part", "copy", "doc", "text"))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its fingerprint, that of its edited text, and how much of it those and the next row's hold.

    The next row is that of the next smaller id (after the smallest: the largest); a null text is empty; a
    single row is its own next; repeated rows follow each other; an empty table gives an empty result.
    """
    return with_next(docs, id_col, text_col).mapInArrow(
        _pairs, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                "near_edited double, near_next double")


def op8_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compare_with_next(read_table(spark, sf_dir, "documents"))
