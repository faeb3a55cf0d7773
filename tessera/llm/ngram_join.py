"""N-gram Jaccard join by a prefix tree over globally ordered shingle sets.

1. One pass counts shingles in a small sketch (``CELLS`` counters, whatever the corpus), which gives shingles
   their global order: rarer first, ties by hash.
2. Documents with equal sets form classes.  Two classes that link differ in a bounded number d of shingles, so
   of more than d parts, into which a hash deals all shingles, some hold the same shingles in both.  Each class
   sends one key per part.  As at most d parts of a class differ from those of a partner, a class of which more
   are found nowhere else links with nothing; chance sharing of a few shingles, which grows with the corpus,
   keeps no class.  A map task sends one class per key and counts the others itself, so a part that very many
   documents share stays small.
3. Only classes with enough shared parts ship their whole set, once; a bitmap of ``1 << ID_BITS`` hashed ids keeps
   most other texts out of the exchange that finds theirs.  Among these classes alone, equal keys form coarse
   groups (a map task links the others to the class that it sends), dealt to blocks of about
   ``BLOCK`` sets; each block is a trie of the ordered sets, and each set walks it, sharing the overlap
   counted on common paths and leaving subtrees whose remaining length cannot reach the threshold, or
   whose sets are in its component already.
4. Groups of many blocks go on with one set per component and block until these fit a few blocks, and
   then compare the blocks that still hold different components, so every link between components is
   found, while a large group of alike texts costs no more than its own size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Words, as_signed, batch_of, mix64, read_table, text_slices, tmp_col, trimmed, window_hashes
from tessera.llm.graph import UnionFind, connected_components, star_edges
from tessera.session import drop_table, write_table

CELLS = 1 << 20
BLOCK = 256
#: Characters hashed at once: a worker takes some 50 bytes for each.
SLICE = 1 << 18
#: Bits of the hash of an id in the bitmap of documents to read again: 8 MB on the driver and in each task, at any size.
ID_BITS = 26
_SLICES = 64


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Distinct hashes of k-word shingles of each text (of the whole word sequence, if shorter)."""
    w = Words(texts, lower=True)
    wh = w.hashes()
    win = window_hashes(wh, k)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(win[a:b - k + 1]))
        elif b > a:
            out.append(window_hashes(wh[a:b], b - a, 0xC2B2AE3D27D4EB4F))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _cells(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(20)) & np.uint64(CELLS - 1)


def shingle_sketch(docs: DataFrame, k: int) -> np.ndarray:
    """Documents per cell of shingle hashes, over all documents: ``CELLS`` saturating counters."""
    size = CELLS // _SLICES
    schema = pa.schema([("slice", pa.int32()), ("part", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.uint32)
        for b in batches:
            for _, texts in text_slices(b.column(0), SLICE):
                sets = shingle_sets(texts, k)
                if sets:
                    total += np.bincount(_cells(np.concatenate(sets)).astype(np.int64), minlength=CELLS).astype(np.uint32)
        yield batch_of(schema, [list(range(_SLICES)), [total[i * size:(i + 1) * size].tobytes() for i in range(_SLICES)]])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for s, part in zip(b.column(0).to_pylist(), b.column(1)):
                x = sums.setdefault(s, np.zeros(size, np.uint64))
                x += np.frombuffer(part.as_py(), np.uint32)
        yield batch_of(schema, [list(sums), [np.minimum(x, 0xFFFFFFFF).astype(np.uint32).tobytes() for x in sums.values()]])

    parts = (docs.select("text").mapInArrow(trimmed(count), "slice int, part binary")
             .repartitionById(_SLICES, "slice").mapInArrow(merge, "slice int, part binary"))
    out = np.zeros(CELLS, np.uint32)
    for r in parts.collect():  # _SLICES rows of CELLS / _SLICES counters
        out[r["slice"] * size:(r["slice"] + 1) * size] = np.frombuffer(r["part"], np.uint32)
    return out


def ordered_tokens(h: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The set as sorted numbers: 8 bits of frequency level, then 56 bits of hash."""
    return np.sort(levels[_cells(h)].astype(np.uint64) << np.uint64(56) | h >> np.uint64(8))


def least_overlap(a, b, num: int, den: int):
    """Smallest intersection of sets of sizes a and b with den * |a & b| >= num * |a | b|."""
    return -(-num * (a + b) // (num + den))


def _class_id(h: np.ndarray) -> int:
    """A number for the set, whatever its order."""
    return int(np.array([mix64(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)], np.uint64).view(np.int64)[0])


@lru_cache
def part_plan(num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(least size, parts, spare parts, size of a small part) of each band of set sizes.

    A pair is dealt by the band of its smaller set, of at most m shingles; then it differs in at most
    d = (den - num) m / num of them.  Of d + 1 + spare parts at least 1 + spare are equal, so small parts, which
    chance may share, are left out; ``spare`` lies three deviations above the number of them to expect, where
    the threshold leaves room for that.  Sets with more of them send a prefix, too.  Sets of a band without
    parts link with equal ones only.
    """
    least, parts, spares, small = [1], [], [], []
    while least[-1] < 1 << 31:
        least.append(max(least[-1] + 1, least[-1] * 5 // 4))
        d, spare, last, tiny = (den - num) * (least[-1] - 1) // num, 1, 0, 0
        while last < spare <= d + 1:
            last, fill = spare, least[-2] / (d + 1 + spare)
            tiny = int(fill >= 5)
            few = (d + 1 + spare) * np.exp(-fill) * (1 + fill * tiny)
            spare = max(spare, int(np.ceil(few + 3 * np.sqrt(few))))
        if spare > d + 1:
            spare, tiny = 1, 0
        parts.append(d + 1 + spare if d else 0)
        spares.append(spare)
        small.append(tiny)
    return tuple(np.array(x, np.int64) for x in (least[:-1], parts, spares, small))


def part_keys(sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, position of the set) of the parts of each set, for every band that a smaller partner may have.

    If one set of a pair has no more than ``spare`` small parts, an equal part is not small; if both have more,
    their prefixes, the n - ceil(t n) + 1 first shingles by hash, share one.
    """
    return banded_keys(sets, num, den)[:2]


def banded_keys(sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``part_keys`` with the slot of each key, and the least shared keys of each set by slot (0: it has no keys there).

    A slot is a band, counted down from the set's own; the last holds all further ones.  Sets of a and b shingles
    that link differ in at most (a + b) (den - num) / (num + den), where b is at most den a / num, and at most the
    band's top if the band lies below a's.  Each spoils one part, and the others are equal, so of a set's parts
    that are not small all but so many have their equals in a partner, and one key has in any case.
    """
    least, parts, spares, small = part_plan(num, den)
    sizes = np.array([len(h) for h in sets], np.int64)
    need = np.zeros((len(sets), SLOTS), np.int64)
    if not sizes.sum():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64), need
    h, ends = np.concatenate(sets), np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sets)), sizes)
    place = mix64(h ^ np.uint64(0x5851F42D4C957F2D))
    value = mix64(h ^ np.uint64(0x2545F4914F6CDD1D))
    own = np.searchsorted(least, sizes, "right") - 1
    lowest = np.searchsorted(least, -(-num * sizes // den), "right") - 1
    keys, whose, slots = [], [], []
    for back in range(int((own - lowest).max()) + 1):
        band = np.maximum(own - back, 0)
        m = np.where((own - back >= lowest) & (sizes > 0), parts[band], 0)
        start = np.cumsum(m) - m
        use = m[owner] > 0
        o, total = owner[use], int(m.sum())
        if not total:
            continue
        cell = start[o] + (place[use] % m[o].astype(np.uint64)).astype(np.int64)
        held = np.bincount(cell, minlength=total)
        halves = [np.bincount(cell, x.astype(float), total).astype(np.uint64)  # exact: sums of 32-bit numbers
                  for x in (value[use] & np.uint64(0xFFFFFFFF), value[use] >> np.uint64(32))]
        who = np.repeat(np.arange(len(sets)), m)
        part = (np.arange(total) - start[who]).astype(np.uint64) | (band[who] + 1).astype(np.uint64) << np.uint64(40)
        tiny = held <= small[band[who]]
        keys.append(mix64(halves[0] + (halves[1] << np.uint64(32)) + mix64(part))[~tiny])
        whose.append(who[~tiny])
        full = np.bincount(whose[-1], minlength=len(sets))
        apart = (sizes + least[band + 1] - 1) * (den - num) // (num + den) if back else (den - num) * sizes // num
        slot = min(back, SLOTS - 1)
        slots.append(np.full(len(whose[-1]), slot, np.uint64))
        now = np.where(m > 0, np.maximum(1, full - apart), 0)
        need[:, slot] = np.where(need[:, slot] * now > 0, np.minimum(need[:, slot], now), need[:, slot] + now)
        for i in np.flatnonzero(np.bincount(who, tiny, len(sets)) > spares[band]).tolist():
            prefix = np.sort(place[ends[i] - sizes[i]:ends[i]])[:sizes[i] + num * -sizes[i] // den + 1]
            keys.append(mix64(prefix + np.uint64(band[i])))
            whose.append(np.full(len(prefix), i))
            slots.append(np.full(len(prefix), slot, np.uint64))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64), need
    return np.concatenate(keys), np.concatenate(whose), np.concatenate(slots), need


_ROWS = pa.schema([("kind", pa.int8()), ("deal", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()),
                   ("keys", pa.binary())])
_ROWS_SQL = "kind byte, deal int, a long, b long, n long, keys binary"
DOCUMENT, KEY, LINK, NEED, SHARED = range(5)
KEY_BYTES = 6  # of a key that are sent, besides its partition: chance equals only join coarse groups
SLOTS = 8
_SLOT, _COUNTED, _LOW = np.uint64(7), np.uint64(8), np.uint64(15)  # of the low bits of a key that is sent to be counted
KEYS_A_PART, KEYS_A_FLUSH = 200_000, 500_000  # held in a task at once, about


def _typed(kind: int, deal, a, b, n=None) -> pa.RecordBatch:
    zero = np.zeros(len(deal), np.int64)
    return batch_of(_ROWS, [np.full(len(deal), kind, np.int8), np.asarray(deal).astype(np.int32), a, b, zero if n is None else n,
                            pa.nulls(len(deal), pa.binary())])


def packed_keys(keys: np.ndarray, classes: np.ndarray, parts: int) -> pa.RecordBatch:
    """A KEY row for each partition that a key goes to: ``KEY_BYTES`` of its keys, one after another, then their classes."""
    part = ((keys.view(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    low = np.ascontiguousarray(keys[order]).view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
    whose = classes[order]
    to, first = np.unique(part[order], return_index=True)
    ends = [*first[1:].tolist(), len(order)]
    zero = np.zeros(len(to), np.int64)
    return batch_of(_ROWS, [np.full(len(to), KEY, np.int8), to.astype(np.int32), zero, zero, zero,
                            [low[s:e].tobytes() + whose[s:e].tobytes() for s, e in zip(first.tolist(), ends)]])


def unpacked_keys(cell: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(cell) // (KEY_BYTES + 8)
    key = np.zeros((n, 8), np.uint8)
    key[:, :KEY_BYTES] = np.frombuffer(cell, np.uint8, n * KEY_BYTES).reshape(n, KEY_BYTES)
    return key.view(np.int64).ravel(), np.frombuffer(cell, np.int64, n, n * KEY_BYTES)


def _shared(key: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position of one row per key, whether its key has several classes, positions of the classes of such keys)."""
    order = np.lexsort((cls, key))
    k, c = key[order], cls[order]
    head = np.ones(len(k), bool)
    head[1:] = k[1:] != k[:-1]
    pair = head.copy()
    pair[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(head)
    many = np.add.reduceat(pair.astype(np.int64), at) > 1 if len(k) else head
    return order[at], many, order[pair & many[np.cumsum(head) - 1]]


def _counts(cls: np.ndarray, slot: np.ndarray, parts: int) -> pa.RecordBatch:
    """A SHARED row per class and slot: so many rows."""
    order = np.lexsort((slot, cls))
    c, s = cls[order], slot[order]
    head = np.ones(len(c), bool)
    head[1:] = (c[1:] != c[:-1]) | (s[1:] != s[:-1])
    at = np.flatnonzero(head)
    return _typed(SHARED, c[at].view(np.uint64) % np.uint64(parts), c[at], s[at].astype(np.int64), np.diff([*at, len(c)]))


def _class_rows(k: int, num: int, den: int, parts: int):
    """DOCUMENT: document a of class b with n shingles; KEY: classes and the keys of their parts; NEED and SHARED: class a
    needs n shared keys in slot b, and has n.

    Rows are dealt to ``parts`` partitions by ``deal``: keys by their value, packed, documents in turns, as ids may
    be null or repeated.  A class comes once per task, seldom more; a task sends one class per key and flush, and
    counts the key for all of its classes if they are several.  A key may be counted twice for a class, never less
    than once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        row = 0

        def flush():
            key, cls = (np.concatenate(x) for x in zip(*held))
            held.clear()
            first, many, both = _shared(key & ~_LOW, cls)
            yield packed_keys(as_signed(key[first] | np.where(many, _COUNTED, np.uint64(0))), cls[first], parts)
            yield _counts(cls[both], key[both] & _SLOT, parts)

        for b in batches:
            for at, texts in text_slices(b.column(1), SLICE):
                sets = shingle_sets(texts, k)
                ids = [_class_id(h) if len(h) else None for h in sets]
                docs = b.column(0).slice(at, len(texts))
                yield _typed(DOCUMENT, np.arange(row, row + len(texts)) % parts, docs, ids, [len(h) for h in sets])
                row += len(texts)
                new = {c: h for c, h, d in zip(ids, sets, docs.to_pylist())
                       if c is not None and d is not None and c not in seen}
                seen |= new.keys()
                key, whose, slot, need = banded_keys(list(new.values()), num, den)
                if len(key):
                    cls = np.array(list(new), np.int64)
                    held.append((key & ~_LOW | slot, cls[whose]))
                    who, at_slot = np.nonzero(need)
                    yield _typed(NEED, cls[who].view(np.uint64) % np.uint64(parts), cls[who], at_slot, need[who, at_slot])
            if sum(len(x) for x, _ in held) > KEYS_A_FLUSH:
                yield from flush()
            if len(seen) > 1_000_000:
                seen.clear()
        if held:
            yield from flush()

    return trimmed(run)


def _count_keys(parts: int):
    """All rows but the KEY rows as they are, and for those the SHARED rows of keys that several classes have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = []
        for b in batches:
            kind = b.column(0).to_numpy(zero_copy_only=False)
            if (kind != KEY).any():
                yield b.filter(pa.array(kind != KEY))
            keys += [unpacked_keys(x) for x in b.column(5).filter(pa.array(kind == KEY)).to_pylist()]
        if keys:
            key, cls = (np.concatenate(x) for x in zip(*keys))
            key = key.view(np.uint64)
            both = _shared(key & ~_LOW, cls)[2]
            both = both[key[both] & _COUNTED == 0]
            yield _counts(cls[both], key[both] & _SLOT, parts)

    return run


def _link_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition's classes, by KEY and LINK rows, as a forest."""
    keys, links = [], []
    for b in batches:
        kind = b.column(0).to_numpy(zero_copy_only=False)
        keys += [unpacked_keys(x) for x in b.column(5).filter(pa.array(kind == KEY)).to_pylist()]
        if (kind == LINK).any():
            rest = b.filter(pa.array(kind == LINK))
            links.append([rest.column(j).to_numpy(zero_copy_only=False).copy() for j in (2, 3)])
    if keys:
        links.append(star_edges(*[np.concatenate(x) for x in zip(*keys)])[2:])
    uf = UnionFind()
    for u, v in links:
        for x, y in zip(u.tolist(), v.tolist()):
            uf.union(x, y)
    nodes = list(uf.up)
    if nodes:
        yield _typed(LINK, np.zeros(len(nodes)), nodes, [uf.find(x) for x in nodes])


def _partitions(spark, shingles: int) -> int:
    """A set sends about as many keys as it has shingles."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shingles // KEYS_A_PART))


def class_rows(docs: DataFrame, k: int, num: int, den: int, shingles: int = 0) -> DataFrame:
    """DOCUMENT, NEED and SHARED rows of all of ``docs`` (doc, text), which have about so many ``shingles``."""
    n = _partitions(docs.sparkSession, shingles)
    return (docs.select("doc", "text").mapInArrow(_class_rows(k, num, den, n), _ROWS_SQL)
            .repartitionById(n, "deal").mapInArrow(trimmed(_count_keys(n)), _ROWS_SQL).drop("keys"))


def alike_classes(rows: DataFrame) -> DataFrame:
    """(cls) of the classes with as many shared keys as a partner asks for, in the band of one."""
    def total(kind):
        return F.sum(F.when(F.col("kind") == kind, F.col("n")))

    return (rows.filter(F.col("kind").isin(NEED, SHARED)).groupBy("a", "b")
            .agg(F.max(F.when(F.col("kind") == NEED, F.col("n"))).alias("need"), total(SHARED).alias("shared"))
            .filter("shared >= need").select(F.col("a").alias("cls")).distinct())


def class_links(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(u, v): links that join the classes of ``sets`` (cls, n, tokens) with an equal part."""
    spark = sets.sparkSession
    n = _partitions(spark, int(sets.agg(F.sum("n")).first()[0] or 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            key, cls, u, v = star_edges(*[np.concatenate(x) for x in zip(*held)])
            held.clear()
            yield packed_keys(key, cls, n)
            yield _typed(LINK, u.view(np.uint64) % np.uint64(n), u, v)

        for b in batches:
            cls, size = (b.column(j).to_numpy() for j in (0, 1))
            cut = np.flatnonzero(np.diff(np.cumsum(size) // (SLICE // 4), prepend=0)) if len(size) else []
            for lo, hi in zip([0, *cut], [*cut, len(size)]):
                key, whose = part_keys([np.frombuffer(x.as_py(), np.uint64) for x in b.column(2)[lo:hi]], num, den)
                if len(key):
                    held.append((as_signed(key), cls[lo:hi][whose]))
                if sum(len(x) for x, _ in held) > KEYS_A_FLUSH:
                    yield from flush()
        if held:
            yield from flush()

    return (sets.select("cls", "n", "tokens").mapInArrow(trimmed(run), _ROWS_SQL)
            .repartitionById(n, "deal").mapInArrow(trimmed(_link_classes), _ROWS_SQL)
            .select(F.col("a").alias("u"), F.col("b").alias("v")))


class Trie:
    """A radix tree of ordered sets: nodes in depth-first order, each with its own run of tokens."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">i4").tobytes())
        seqs = [sets[i] for i in self.order]
        self.leaf = list(range(len(seqs)))  # position in ``order`` of the set that ends at a leaf
        self.segment: list[np.ndarray] = []
        self.low: list[int] = []   # of the positions below a node
        self.high: list[int] = []
        self.after: list[int] = []  # the node that follows the subtree
        self.depth: list[int] = []  # tokens before the node's own
        self._build(seqs)
        sizes = np.array([len(s) for s in seqs])
        self.least = [int(sizes[a:b].min()) for a, b in zip(self.low, self.high)]
        self.most = [int(sizes[a:b].max()) for a, b in zip(self.low, self.high)]

    def _build(self, seqs):
        def common(a, b):
            m = min(len(a), len(b))
            d = np.flatnonzero(a[:m] != b[:m])
            return int(d[0]) if len(d) else m

        lcp = [common(a, b) for a, b in zip(seqs, seqs[1:])]
        work = [(0, len(seqs), 0, None)]
        while work:
            lo, hi, depth, done = work.pop()
            if done is not None:
                self.after[done] = len(self.segment)
                continue
            end = len(seqs[lo]) if hi - lo == 1 else min(lcp[lo:hi - 1])
            node = len(self.segment)
            self.segment.append(seqs[lo][depth:end])
            self.low.append(lo)
            self.high.append(hi)
            self.after.append(-1)
            self.depth.append(depth)
            work.append((0, 0, 0, node))
            if hi - lo > 1:
                cuts = [lo, *[i + 1 for i in range(lo, hi - 1) if lcp[i] == end], hi]
                work += [(a, b, end, None) for a, b in reversed(list(zip(cuts, cuts[1:])))]


def trie_links(own: list[np.ndarray], own_ids: list, sets: list[np.ndarray], ids: list, uf: UnionFind,
               num: int, den: int) -> list[tuple]:
    """Links found between ``own`` and ``sets`` that join two components of ``uf``.

    A set walks the tree with a mask of its tokens; a node adds the tokens of its run that the set has.
    ``ids`` are the classes; those of ``sets`` and ``own`` may be the same lists.
    """
    vocab, flat = np.unique(np.concatenate([*sets, *own]), return_inverse=True)
    cut = np.cumsum([len(s) for s in [*sets, *own]])[:-1]
    dense = [x.astype(np.int32) for x in np.split(flat, cut)]
    trie = Trie(dense[:len(sets)])
    names = [ids[i] for i in trie.order]
    mask = np.zeros(len(vocab), bool)
    links = []
    for x, me in zip(dense[len(sets):], own_ids):
        n = len(x)
        mask[x] = True
        node, total = 0, len(trie.segment)
        lo_n, hi_n = -(-num * n // den), den * n // num
        path: list[tuple[int, int, int]] = []  # (end of subtree, overlap at its root, own tokens after it)
        root = uf.find(me)
        while node < total:
            while path and node >= path[-1][0]:
                path.pop()
            shared = path[-1][1] if path else 0
            a, b = trie.low[node], trie.high[node]
            least, most = max(trie.least[node], lo_n), min(trie.most[node], hi_n)
            seg = trie.segment[node]
            if least > most or (uf.find(names[a]) == root and (b - a == 1 or all(uf.find(y) == root for y in names[a:b]))):
                node = trie.after[node]
                continue
            shared += int(np.count_nonzero(mask[seg]))
            seen = trie.depth[node] + len(seg)
            # a set below has ``seen`` of its tokens behind it; of this one's, those after the path are left
            left = n - int(np.searchsorted(x, seg[-1], "right")) if len(seg) else path[-1][2] if path else n
            best = min(max(seen + left, least), most)  # the size with which most can be reached
            if shared + min(left, best - seen) < least_overlap(n, best, num, den):
                node = trie.after[node]
                continue
            if b - a == 1:
                if den * shared >= num * (n + seen - shared) and uf.union(me, names[a]):
                    links.append((me, names[a]))
                    root = uf.find(me)
                node = trie.after[node]
                continue
            path.append((trie.after[node], shared, left))
            node += 1
        mask[x] = False
    return links


def _id_cell(doc: str):
    return F.pmod(F.xxhash64(doc), F.lit(1 << ID_BITS))


def some_docs(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc, text) whose id is one of ``ids`` (least), and a few others with an id of equal hash."""
    cell = _id_cell("least") + 1  # the bitmap functions count from 1
    slices = (ids.filter("least is not null").groupBy(F.bitmap_bucket_number(cell).alias("at"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("bits")))
    bitmap = np.zeros((max(1, 1 << ID_BITS >> 15), 1 << 12), np.uint8)
    for r in slices.collect():  # at most 2^11 rows of 4096 bytes
        bitmap[r["at"] - 1] = np.frombuffer(r["bits"], np.uint8)
    held = docs.sparkSession.sparkContext.broadcast(bitmap.ravel())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column(2).to_numpy(zero_copy_only=False)
            yield b.select([0, 1]).filter(pa.array((held.value[at >> 3] >> (at & 7) & 1).astype(bool)))

    return (docs.filter("doc is not null").select("doc", "text", _id_cell("doc").alias("cell"))
            .mapInArrow(trimmed(run), "doc long, text string"))


def set_rows(docs: DataFrame, members: DataFrame, k: int, levels) -> DataFrame:
    """(cls, n, tokens) of the classes in ``members`` (cls, least): each read from one document.

    Repeated rows of an id give a class once per task, seldom more; readers take equal rows as one.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("cls", "n")] + [("tokens", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lv = levels.value
        seen: set[int] = set()
        for b in batches:
            for at, texts in text_slices(b.column(1), SLICE):
                rows = []
                for h, c in zip(shingle_sets(texts, k), b.column(0).slice(at, len(texts)).to_pylist()):
                    if len(h) and c not in seen and _class_id(h) == c:  # an id may have several texts
                        seen.add(c)
                        rows.append((c, len(h), ordered_tokens(h, lv).tobytes()))
                if rows:
                    yield batch_of(schema, [list(x) for x in zip(*rows)])
                if len(seen) > 1_000_000:
                    seen.clear()

    docs = some_docs(docs, members)
    both = docs.join(members, docs["doc"] == members["least"]).select("cls", "text")
    return both.mapInArrow(trimmed(run), "cls long, n long, tokens binary")


def _block_links(num: int, den: int):
    """Per unit of the rows (unit, side, label, cls, tokens): the links that join components.

    Side 0 alone: the sets of one block among themselves; sides 0 and 1: those of one block with another's.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(sides):
            uf = UnionFind()
            for s in sides.values():
                for c, (label, _) in s.items():
                    if label is not None:
                        uf.union(c, label)
            a = sides.get(0, {})
            b = sides.get(1, a)
            if not a or not b or b is a and len(a) < 2:
                return []
            arr = {c: np.frombuffer(t, np.uint64) for s in (a, b) for c, (_, t) in s.items()}
            return trie_links([arr[c] for c in a], list(a), [arr[c] for c in b], list(b), uf, num, den)

        out: list[tuple] = []
        unit, sides = None, {}
        for batch in batches:
            for u, side, label, cls, tokens in zip(*[batch.column(j).to_pylist() for j in range(5)]):
                if u != unit:
                    if sides:
                        out += solve(sides)
                    unit, sides = u, {}
                sides.setdefault(side, {})[cls] = (label, tokens)
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        if sides:
            out += solve(sides)
        yield _edges(out)

    return run


def _edges(pairs: list[tuple]) -> pa.RecordBatch:
    u, v = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _solve(units: DataFrame, num: int, den: int) -> DataFrame:
    """``units``: unit, side, label, cls, tokens; whole units come to one task, one after another."""
    n = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = units.select("unit", "side", "label", "cls", "tokens")
    return (cols.repartition(n, "unit").sortWithinPartitions("unit")
            .mapInArrow(trimmed(_block_links(num, den)), "u long, v long"))


def _blocks(sets: DataFrame, members: DataFrame) -> DataFrame:
    """Units of the sets of ``members`` (comp, cls, blk): one block each, compared within itself."""
    m = members.select(F.col("cls").alias("c2"), F.concat_ws(":", "comp", "blk").alias("unit"))
    return (sets.join(m, F.col("cls") == F.col("c2"))
            .select("unit", F.lit(0).alias("side"), F.lit(None).cast("long").alias("label"), "cls", "tokens"))


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` (comp, cls, n) with the label of their component so far."""
    roots = connected_components(links)
    return write_table(members.join(roots, members["cls"] == roots["node"], "left")
                       .select("comp", "cls", "n", F.coalesce("root", "cls").alias("label")), "ngramlabels")[0]


def _open(labelled: DataFrame) -> DataFrame:
    """(comp, cls, parts): one set per label of the coarse groups that still hold several."""
    reps = labelled.groupBy("comp", "label").agg(F.min("cls").alias("cls"))
    parts = reps.groupBy("comp").agg(F.count("*").alias("parts")).filter("parts > 1")
    return write_table(reps.join(parts, "comp").select("comp", "cls", "parts"), "ngramopen")[0]


def _block_of(per: str):
    return F.pmod(F.xxhash64("cls"), F.ceil(F.col(per) / F.lit(BLOCK)))


def _cross_units(sets: DataFrame, labelled: DataFrame, still: DataFrame, num: int, den: int) -> DataFrame:
    """Units of two blocks of one coarse group, but for blocks of one label and lengths too far apart."""
    step = float(np.log(den / num) * 1.001) if den > num else 1e-9
    m = (labelled.join(still.select("comp").distinct(), "comp", "left_semi")
         .withColumn("band", F.floor(F.log("n") / F.lit(step))))
    per = m.groupBy("comp", "band", "label").agg(F.count("*").alias("own"))
    per = per.withColumn("large", F.col("own") >= BLOCK // 2)
    small = per.filter("not large").groupBy("comp", "band").agg(F.sum("own").alias("total"))
    per = per.join(small, ["comp", "band"], "left").withColumn(
        "fold", F.when(F.col("large"), F.ceil(F.col("own") / BLOCK)).otherwise(F.ceil(F.col("total") / BLOCK)))
    m = m.join(per, ["comp", "band", "label"]).select(
        "comp", "cls", "label", "band", F.when(F.col("large"), F.col("label")).alias("one"),
        F.when(F.col("large"), F.concat_ws(":", F.col("band"), F.col("label"), F.pmod(F.xxhash64("cls"), "fold")))
        .otherwise(F.concat_ws(":", F.col("band"), F.pmod(F.xxhash64("label"), "fold"))).alias("blk"))
    m, _ = write_table(m, "ngramcross")
    blocks = m.select("comp", "band", "blk", "one").distinct()
    other = (blocks.select("comp", F.explode(F.array("band", F.col("band") - 1)).alias("band"),
                           F.col("band").alias("band2"), F.col("blk").alias("blk2"), F.col("one").alias("one2")))
    pairs = (blocks.join(other, ["comp", "band"])
             .filter("(band2 > band or blk2 >= blk) and not (one is not null and one2 is not null and one = one2)"))
    unit = F.concat_ws("|", "comp", "blk", "blk2").alias("unit")
    sides = (pairs.select("comp", unit, F.lit(0).alias("side"), F.col("blk").alias("b"))
             .unionByName(pairs.filter("blk <> blk2").select("comp", unit, F.lit(1).alias("side"), F.col("blk2").alias("b"))))
    rows = (m.join(sides, (m["comp"] == sides["comp"]) & (m["blk"] == sides["b"]))
            .select("unit", "side", "label", F.col("cls").alias("c2")))
    return sets.join(rows, F.col("cls") == F.col("c2")).select("unit", "side", "label", "cls", "tokens")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, num: int = 90,
                       den: int = 100) -> DataFrame:
    """(doc, n_shingles, component): the components of documents under den * |A & B| >= num * |A | B|.

    A and B are the sets of k-word shingles (A-Z lower-cased; a shorter text is one shingle, whole);
    ``component`` is the smallest id that links reach.

    Nulls and edges: a text that is null or without words has an empty set and links with nothing, not even
    with its like; a row with a null id is counted and gets a null component unless its text's class has an
    id; repeated rows are one class; one result row per input row; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    sketch = shingle_sketch(docs, k).astype(np.float64)
    levels = spark.sparkContext.broadcast(np.minimum(255, 8 * np.log2(1 + sketch)).astype(np.uint8))
    rows, rows_at = write_table(class_rows(docs, k, num, den, int(sketch.sum())), "ngramrows")
    owners = rows.filter(F.col("kind") == DOCUMENT).select(F.col("a").alias("doc"), F.col("b").alias("cls"), "n")
    alike, alike_at = write_table(alike_classes(rows), "ngramalike")
    least = owners.filter("cls is not null").join(alike, "cls", "left_semi").groupBy("cls").agg(F.min("doc").alias("least"))
    members, members_at = write_table(least, "ngrammembers")
    alone, alone_at = write_table(set_rows(docs, members, k, levels), "ngramalone")
    coarse = connected_components(class_links(alone, num, den))
    coarse, coarse_at = write_table(coarse.select(F.col("node").alias("cls"), F.col("root").alias("comp")), "ngramcoarse")
    sizes = coarse.groupBy("comp").agg(F.count("*").alias("many"))
    sets, sets_at = write_table(alone.join(coarse.join(sizes, "comp"), "cls").select("comp", "many", "cls", "n", "tokens"),
                                "ngramsets")
    for path in (alike_at, members_at, alone_at, coarse_at):
        drop_table(spark, path)
    first_units = sets.select(F.concat_ws(":", "comp", _block_of("many")).alias("unit"), F.lit(0).alias("side"),
                              F.lit(None).cast("long").alias("label"), "cls", "tokens")
    links, _ = write_table(_solve(first_units, num, den), "ngramlinks")

    sets = sets.filter(F.col("many") > BLOCK)  # the others are done
    wide = sets.select("comp", "cls", "n").distinct()
    if not wide.isEmpty():
        wide = write_table(wide, "ngramwide")[0]
        before = None
        while True:
            labelled = _labelled(wide, links)
            still = _open(labelled)
            now = still.count()
            if now == 0 or before is not None and now > before // 2:
                break
            before = now
            units = _blocks(sets, still.select("comp", "cls", _block_of("parts").alias("blk")))
            links = write_table(links.unionByName(_solve(units, num, den)), "ngramlinks")[0]
        if now:
            more = _solve(_cross_units(sets, labelled, still, num, den), num, den)
            links = write_table(links.unionByName(more), "ngramlinks")[0]

    roots, _ = write_table(connected_components(links), "ngramroots")
    drop_table(spark, sets_at)
    out, _ = write_table(owners.join(roots, owners["cls"] == roots["node"], "left")
                         .select("doc", "n", F.coalesce("root", "cls").alias("key")), "ngramdocs")
    drop_table(spark, rows_at)
    first, _ = write_table(out.filter("key is not null").groupBy("key").agg(F.min("doc").alias("first")), "ngramfirst")
    first = first.withColumnRenamed("key", "key1")
    return (out.join(first, F.col("key") == F.col("key1"), "left")
            .select("doc", F.col("n").alias("n_shingles"), F.coalesce("first", "doc").alias("component")))


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    out = jaccard_components(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 4,
                     den: int = 5) -> DataFrame:
    """One row of ``docs`` of each component: that of the smallest id, of several texts of that id any one.

    Rows are told apart by id and text (64 bits of hash), so an id with several texts keeps those that link with
    nothing of a smaller id, and of repeated rows one stays.

    Nulls and edges: rows without an id, and rows whose text is null or without words, link with nothing here and
    all stay; of repeated rows that differ in other columns one stays; other columns pass through; an empty table
    gives an empty result.  A text is held whole in the task that reads its shingles.
    """
    row, own = tmp_col(docs, "row"), F.col(id_col).cast("long")
    keyed = docs.withColumn(row, F.when(own.isNotNull(), F.xxhash64(own, F.col(text_col))))
    c = jaccard_components(keyed.select(row, text_col), row, text_col, k, num, den)
    nodes = (c.filter("doc is not null and n_shingles > 0").groupBy("doc")
             .agg(F.min("component").alias("comp"), F.count("*").alias("many")))
    ids = keyed.groupBy(F.col(row).alias("key")).agg(F.min(own).alias("id"))
    nodes, _ = write_table(nodes.join(ids, F.col("doc") == F.col("key")).select("doc", "comp", "many", "id"), "ngramnodes")
    first = nodes.groupBy("comp").agg(F.min(F.struct("id", "doc")).alias("first")).withColumnRenamed("comp", "comp1")
    fate = (nodes.join(first, F.col("comp") == F.col("comp1"))
            .select(F.col("doc").alias("key"), (F.col("doc") != F.col("first.doc")).alias("goes"), "many"))
    fate, _ = write_table(fate.filter("goes or many > 1"), "ngramfate")
    plain = keyed.join(fate.select("key"), keyed[row] == F.col("key"), "left_anti")
    again = keyed.join(fate.filter("not goes").select("key"), keyed[row] == F.col("key"), "left_semi")
    return plain.unionByName(again.dropDuplicates([row])).drop(row)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g
  FROM w),
d AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n, g FROM s),
c AS (SELECT min(doc_id) AS cls, n, list_sort(g) AS g FROM d WHERE n > 0 GROUP BY n, list_sort(g)),
x AS (SELECT cls, n, unnest(g) AS t FROM c),
p AS (
  SELECT a.cls AS u, b.cls AS v FROM x a JOIN x b ON a.t = b.t AND a.cls < b.cls
  WHERE 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.cls, b.cls, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT u, v FROM p UNION ALL SELECT v, u FROM p),
r AS (SELECT cls AS node, cls AS root FROM c UNION SELECT e.v, r.root FROM r JOIN e ON r.node = e.u),
f AS (SELECT node, min(root) AS root FROM r GROUP BY node)
SELECT d.doc_id, d.n AS n_shingles, coalesce(f.root, d.doc_id) AS component_id
FROM d LEFT JOIN c ON d.n > 0 AND list_sort(d.g) = c.g LEFT JOIN f ON c.cls = f.node
"""
