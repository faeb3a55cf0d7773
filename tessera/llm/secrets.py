"""Secret scans: an Aho-Corasick prefilter over keywords, anchored patterns at the hits, checksums last.

One automaton pass over each text finds the keywords in either case.  A pattern
is tried only at a hit, anchored there, so text without keywords costs the
automaton alone.  Kinds with a checksum in the token are then validated by it.
Hex strings have no keyword: their prefilter is the run of hex digits itself.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batch_of, read_table, text_slices

# The patterns of the kinds, as the contract and the public token formats state them.
ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
CHECKED = re.compile(rb"(gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "api_key": "assign",
            "apikey": "assign", "akia": "access", "ghp_": "checked", "gho_": "checked", "ghu_": "checked",
            "ghs_": "checked", "ghr_": "checked", "npm_": "checked"}
KINDS = ("assign", "access", "hex", "github", "npm")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32
_DIGITS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True

Span = tuple[str, int, int]


def checksum62(body: bytes) -> bytes:
    """CRC32 of the body in six base-62 digits, as such tokens carry it at their end."""
    n, out = zlib.crc32(body), []
    for _ in range(6):
        n, d = divmod(n, 62)
        out.append(_DIGITS[d])
    return bytes(reversed(out))


class Scanner:
    """Spans of one text at a time; positions are code points, ends exclusive."""

    def __init__(self):
        import ahocorasick

        self.auto = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            self.auto.add_word(word, (len(word), kind))
        self.auto.make_automaton()

    def spans(self, text: str | None) -> list[Span]:
        # one byte per code point: every character of the patterns is ASCII, others become a byte that is in none
        raw = (text or "").encode("latin-1", "replace")
        out: list[Span] = []
        after = {"assign": 0, "access": 0, "checked": 0}
        hits = [(end + 1 - n, kind) for end, (n, kind) in self.auto.iter(raw.lower().decode("latin-1"))]
        for at, kind in sorted(hits):
            if at < after[kind]:
                continue  # inside the previous match of this kind
            if kind == "assign" and (m := ASSIGN.match(raw, at)):
                after[kind] = m.end()
                if len(m[2]) >= MIN_VALUE:
                    out.append(("assign", at, m.end()))
            elif kind == "access" and (m := ACCESS.match(raw, at)):
                after[kind] = m.end()
                if len(m[0]) >= MIN_ACCESS:
                    out.append(("access", at, m.end()))
            elif kind == "checked" and (m := CHECKED.match(raw, at)):
                if checksum62(m[2]) == m[3]:
                    after[kind] = m.end()
                    out.append(("npm" if m[1] == b"npm" else "github", at, m.end()))
        is_hex = _HEX[np.frombuffer(raw, np.uint8)]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], is_hex, [False])).view(np.int8)))
        long = edge[1::2] - edge[0::2] >= MIN_HEX
        out += [("hex", int(s), int(e)) for s, e in zip(edge[0::2][long], edge[1::2][long])]
        return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


_SCHEMA = pa.schema([("doc", pa.int64()), ("kind", pa.list_(pa.string())), ("start", pa.list_(pa.int64())),
                     ("stop", pa.list_(pa.int64())), ("spans", pa.string()), ("base", pa.string())])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, kind, start, stop, spans, base) per row of ``docs``: the spans as arrays and as a joined string.

    ``base`` joins those of assign, access and hex; github and npm tokens count only if their checksum
    holds.  A null or empty text has no spans; null ids and repeated rows pass through.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for b in batches:
            for at, texts in text_slices(b.column(1), 8 << 20):
                found = [scanner.spans(t) for t in texts]
                yield batch_of(_SCHEMA, [
                    b.column(0).slice(at, len(texts)), *[[[s[j] for s in f] for f in found] for j in range(3)],
                    [joined(f) for f in found], [joined([s for s in f if s[0] in KINDS[:3]]) for f in found]])

    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc long, kind array<string>, start array<long>, stop array<long>, spans string, base string")


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(read_table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("kind", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("doc").alias("doc_id"), count("assign"), count("access"), count("hex"),
                        F.sha2(F.col("base"), 256).alias("base_sha256"), "spans")


def base_spans_brute(text: str | None) -> list[Span]:
    """The base spans by plain regular expressions over the whole text (for tests)."""
    t, out = text or "", []
    for m in re.finditer(ASSIGN.pattern.decode(), t, re.I | re.A):
        if len(m[2]) >= MIN_VALUE:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= MIN_ACCESS]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= MIN_HEX]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
