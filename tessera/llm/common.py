"""Word scanning, vectorised hashing and small helpers shared by the text operators.

Everything here works on one bounded slice of an Arrow batch at a time; no
function holds more than ``SLICE_BYTES`` of text plus one document.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
#: Rows that a job under ``small_batches`` sends to a Python worker at once: some 2 MB of texts of 2 KB.
BATCH_ROWS = 1000
WORD_RE = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_B1 = 0x9E3779B97F4A7C15  # odd bases of the polynomial hashes
_B2 = 0xD1342543DE82EF95
_M64 = (1 << 64) - 1


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tmp_col(df: DataFrame, base: str) -> str:
    """A column name derived from ``base`` that ``df`` does not have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in have:
        name += "_"
    return name


def ascii_lower(col):
    """A-Z to lower case, every other character unchanged."""
    plain = F.octet_length(col) == F.char_length(col)  # lower() is much faster, and the same for ASCII alone
    return F.when(plain, F.lower(col)).otherwise(
        F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inv = base, pow(base, -1, 1 << 64)
        self.clear()

    def clear(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            def grow(b):
                out = np.full(n, b, np.uint64)
                out[0] = 1
                return np.multiply.accumulate(out)
            n = max(n, len(self.up) + len(self.up) // 4)
            self.up, self.down = grow(self.base), grow(self.inv)
        return self.up, self.down


_POW = {b: _Powers(b) for b in (_B1, _B2)}


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _B1) -> np.ndarray:
    """Hash of values[s:e] for each (s, e): a polynomial over prefix sums, equal for equal spans."""
    n = len(values)
    up, down = _POW[base].upto(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:n], out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * down[starts]
    return mix64(h ^ (ends - starts).astype(np.uint64) * np.uint64(_B2))


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of some texts: one byte buffer with start and end offsets.

    ``first[i]:first[i + 1]`` are the words of text i; a null text has none.
    """

    def __init__(self, texts: list[str | None], lower: bool = False):
        enc = [(t or "").encode() for t in texts]
        self.buf = b"\n".join(enc) + b"\n"
        if lower:
            self.buf = self.buf.lower()  # bytes.lower changes A-Z only
        a = self.bytes = np.frombuffer(self.buf, np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate(([1], _SPACE[a].view(np.int8)))))
        self.starts, self.ends = edge[0::2], edge[1::2]  # the buffer ends in white space
        offs = np.zeros(len(enc) + 1, np.int64)
        np.cumsum([len(e) + 1 for e in enc], out=offs[1:])
        self.first = np.searchsorted(self.starts, offs)

    def hashes(self, base: int = _B1) -> np.ndarray:
        return span_hash(self.bytes, self.starts, self.ends, base)

    def word(self, k: int) -> bytes:
        return self.buf[self.starts[k]:self.ends[k]]


def window_hashes(word_hash: np.ndarray, k: int, base: int = _B2) -> np.ndarray:
    """Hashes of all runs of k consecutive entries (len - k + 1 of them, none if shorter)."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if k <= 8:
        mul = [pow(base, i + 1, 1 << 64) for i in range(k)]
        acc = word_hash[:n] * np.uint64(mul[0])
        for i in range(1, k):
            acc = acc + word_hash[i:i + n] * np.uint64(mul[i])
        return mix64(acc)
    s = np.arange(n)
    return span_hash(word_hash, s, s + k, base)


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of consecutive slices of about ``limit`` characters, one document at least."""
    at, out, size = 0, [], 0
    for i, t in enumerate(texts):
        s = t.as_py()
        out.append(s)
        size += len(s or "")
        if size >= limit:
            yield at, out
            at, out, size = i + 1, [], 0
    if out:
        yield at, out


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema)


def as_signed(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as the longs that Spark has."""
    return np.ascontiguousarray(x).view(np.int64)


#: What this worker keeps from task to task, and how to free it.
KEPT: dict[str, Callable[[], None]] = {}


def free_kept(but: str | None) -> None:
    for name, free in KEPT.items():
        if name != but:
            free()


def free_unused() -> None:
    for powers in _POW.values():
        powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim:
        trim(0)


def trimmed(fn: Callable, keeps: str | None = None) -> Callable:
    """``fn`` for mapInArrow; a task frees what others keep in its worker, but for what it ``keeps`` itself, and at its
    end the worker, which waits for the next one, gives back the memory it has free.

    The helpers are functions of this module, as those reach a worker by name; a table named in ``run`` would come as a copy.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_kept(keeps)
        free_unused()
        try:
            yield from fn(batches)
        finally:
            free_unused()

    return run


@contextmanager
def small_batches(spark: SparkSession):
    """Jobs started inside send ``BATCH_ROWS`` rows at once to a worker, if the session does not ask for fewer.

    Whole texts by the session's default of 10,000 rows take tens of MB a task, both in the JVM's buffers, which
    double as they grow, and in the worker.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    if not 0 < int(old) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, old)
