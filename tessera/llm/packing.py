"""Packing tokenised documents into fixed-length sequences: best fit, then a swap-based local search.

Documents become token pieces in one pass over the text.  Pieces of full length
are sequences of their own.  The others are dealt at random to groups of about
``GROUP_PIECES`` pieces; each group is packed by best-fit decreasing and
improved by moves and exchanges between underfull bins that raise the sum of
squared fills, until bins are empty.  A group costs at most about one
sequence over packing all pieces together, so the loss stays near
1 / GROUP_PIECES at any corpus size, and no task ever sees more than a group.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import KEPT, batch_of, read_table, small_batches, trimmed
from tessera.session import write_table

MAX_TOKENS = 2048
GROUP_PIECES = 4000
#: Words whose ids a worker remembers; the older half, as far as it was not met again, goes when the memory is full.
CACHE_WORDS = 500_000
#: Text that is split at once.
SLICE_BYTES = 1 << 20
#: Texts of words that the tokenizer gets at once, as its answer holds far more than ids.
RUNS_AT_ONCE = 8
#: Signs that may be parted from the letters before them.
SIGNS = ".,;:!?"

PIECE = pa.schema([("doc", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                   ("ids_crc32", pa.int64()), ("ids", pa.binary())])


class WordEncoder:
    """Ids of texts by a tokenizer that never merges across ASCII white space, word by word with a memory.

    Each slice of texts is split and its words are numbered in Arrow, so only its distinct words reach Python.
    If the tokenizer parts letters from the signs ``.,;:!?`` after them (asked of it when it is loaded), those
    are encoded apart, as the same letters come with several signs.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a word
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        probes = [w + t for w in ("the", "\u00e9t\u00e9", "\u0434\u0430") for t in (*SIGNS, SIGNS, "...")]
        pre = self.tok.pre_tokenizer
        self.parts_signs = pre is not None and all(len(pre.pre_tokenize_str(w)) == 2 for w in probes)
        self.known: dict[str, bytes] = {}  # words of late
        self.before: dict[str, bytes] = {}  # those remembered before them

    def _learn(self, words: list[str]) -> None:
        """Words of letters are encoded many to a text and told apart by the ids that end a word; if their number
        is not that of the words (a letter may become several characters), and for all others, one by one."""
        known = self.known
        single: list[str] = []
        letters: list[str] = []
        for w in words:
            (letters if w.isalpha() else single).append(w)
        runs = [letters[i:i + 500] for i in range(0, len(letters), 500)]
        for k in range(0, len(runs), RUNS_AT_ONCE):
            some = runs[k:k + RUNS_AT_ONCE]
            for run, e in zip(some, self.tok.encode_batch_fast([" ".join(r) for r in some], add_special_tokens=False)):
                ids = np.array(e.ids, "<u4")
                cut = np.flatnonzero(self.ends[ids]) + 1
                if len(cut) != len(run) or len(ids) != cut[-1]:
                    single += run
                    continue
                raw, at = ids.tobytes(), 0
                for w, c in zip(run, (4 * cut).tolist()):
                    known[w] = raw[at:c]
                    at = c
        for i in range(0, len(single), 5000):
            some = single[i:i + 5000]
            lists = [e.ids for e in self.tok.encode_batch_fast(some, add_special_tokens=False)]
            raw, at = np.array(list(chain.from_iterable(lists)), "<u4").tobytes(), 0
            for w, ids in zip(some, lists):
                known[w] = raw[at:at + 4 * len(ids)]
                at += 4 * len(ids)

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        if len(self.known) > CACHE_WORDS // 2:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        out = list(map(known.get, words))
        missing = [i for i, ids in enumerate(out) if ids is None]
        new: list[str] = []
        joined: list[str] = []
        cores: list[str] = []
        for i in missing:
            w = words[i]
            ids = before.get(w)
            if ids is not None:
                known[w] = ids
            elif self.parts_signs and (core := w.rstrip(SIGNS)) != w and core.isalpha():
                joined.append(w)
                cores.append(core)
            else:
                new.append(w)
        parts = {*cores, *[w[len(core):] for w, core in zip(joined, cores)]}
        self._learn(list(parts.difference(known).union(new)))
        for w, core in zip(joined, cores):
            known[w] = known[core] + known[w[len(core):]]
        for i in missing:
            out[i] = known[words[i]]
        return out

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, place where each text ends)."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = split.flatten().dictionary_encode()
        raw = self._ids(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(size))).astype(np.int32),
                                         pa.array(np.frombuffer(b"".join(raw), "<u4")))
        upto = np.concatenate(([0], np.cumsum(size[words.indices.to_numpy()])))
        ends = np.cumsum(pc.list_value_length(split).to_numpy())
        return lists.take(words.indices).flatten().to_numpy(zero_copy_only=False), upto[ends]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        ids, ends = self.flat(pa.array(texts, pa.string()))
        return np.split(ids, ends[:-1]) if len(texts) else []


def _slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of consecutive slices of about ``SLICE_BYTES`` of text, one document at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = upto[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(upto, done + SLICE_BYTES, "right")))
        yield at, texts.slice(at, to - at)
        at = to


_ENCODERS: dict[str, WordEncoder] = {}
KEPT["encoder"] = _ENCODERS.clear


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 max_tokens: int = MAX_TOKENS, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """(doc, piece, start, length, ids_crc32, ids): the token pieces of every row of ``docs``.

    A document's ids are the tokenizer's, without special tokens added, then ``end_id``; only documents of
    more than ``max_tokens`` ids are cut.  ``ids`` holds little-endian unsigned 32-bit ids if ``keep_ids``,
    else null.  A null or empty text is the single id ``end_id``; null ids and repeated rows pass through.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer_path)
        for b in batches:
            for at, texts in _slices(b.column(1)):
                ids, ends = enc.flat(texts)
                ids = np.insert(ids, ends, end_id).astype("<u4", copy=False)
                ends = ends + np.arange(1, len(ends) + 1)
                rows: list[tuple] = []
                start = 0
                for doc, end in zip(b.column(0).slice(at, len(texts)).to_pylist(), ends.tolist()):
                    for p, s in enumerate(range(start, end, max_tokens)):
                        cut = ids[s:min(end, s + max_tokens)]
                        rows.append((doc, p, s - start, len(cut), zlib.crc32(cut), cut.tobytes() if keep_ids else None))
                    start = end
                yield batch_of(PIECE, [list(c) for c in zip(*rows)])

    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        trimmed(run, "encoder"), "doc long, piece int, start long, length long, ids_crc32 long, ids binary")


def lower_bound(lengths: np.ndarray, cap: int) -> int:
    """Bins that any packing needs: by volume, or counting pieces too long to share (Martello and Toth's L2)."""
    x = np.sort(lengths)
    total = np.concatenate(([0], np.cumsum(x)))
    best = -(-int(total[-1]) // cap)
    half = np.searchsorted(x, cap // 2, "right")
    for k in np.unique(x[:half]):  # pieces over cap - k share with none of those of k or more
        big = np.searchsorted(x, cap - k, "right")
        lo = np.searchsorted(x, k, "left")
        need = int(total[half] - total[lo]) - ((big - half) * cap - int(total[big] - total[half]))
        best = max(best, len(x) - half + max(0, -(-need // cap)))
    return max(best, len(x) - int(half))


def best_fit(lengths: np.ndarray, cap: int) -> list[list[int]]:
    """Bins of piece indexes: longest first, each into the fullest bin that holds it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(cap + 1)]
    rooms = 0  # bit r: some bin has r tokens of room
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = rooms >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                rooms &= ~(1 << r)
        else:
            r, b = cap, len(bins)
            bins.append([])
        bins[b].append(i)
        if r > n:
            by_room[r - n].append(b)
            rooms |= 1 << (r - n)
    return bins


def _options(items: list[int], lengths: list[int]) -> tuple[dict[int, tuple], dict[int, tuple]]:
    """Pieces of a bin by their length, one piece and two pieces, one entry for each different length."""
    one: dict[int, tuple] = {}
    twice: dict[int, int] = {}
    for i in items:
        if lengths[i] in one:
            twice[lengths[i]] = i
        else:
            one[lengths[i]] = (i,)
    two = {2 * n: (*one[n], i) for n, i in twice.items()}
    ns = list(one)
    for a, n in enumerate(ns):
        for m in ns[a + 1:]:
            two.setdefault(n + m, (*one[n], *one[m]))
    return one, two


class Underfull:
    """Fills and returns of the bins that have room: the index of the local search.

    Row b of ``back[w]`` holds for each length x the least length of x or more that bin b can give back with
    at most w pieces (none: 0), so that the best step from a donor to every bin is one lookup per option.
    """

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, cap: int):
        self.bins, self.lengths, self.cap = bins, lengths.tolist(), cap
        self.fill = np.array([sum(self.lengths[i] for i in items) for items in bins], np.int64)
        self.open = (self.fill > 0) & (self.fill < cap)
        self.slot = np.zeros(len(bins), np.int64)  # full bins have no row
        under = np.flatnonzero(self.open)
        self.slot[under] = np.arange(len(under))
        self.back = {w: np.full((len(under), cap + 1), cap + 1, np.int32) for w in (1, 2)}
        self.give: dict[int, tuple] = {}
        for b in under.tolist():
            self._index(b)

    def _index(self, b: int) -> None:
        one, two = self.give[b] = _options(self.bins[b], self.lengths)
        row = np.full(self.cap + 1, self.cap + 1, np.int32)
        for w, sizes in ((1, one), (2, two)):
            at = np.fromiter((n for n in (0, *sizes) if n <= self.cap), np.int64)
            row[at] = at
            self.back[w][self.slot[b]] = np.minimum.accumulate(row[::-1])[::-1]

    def best(self, donor: int, among: np.ndarray) -> tuple | None:
        """(bin, pieces given, length returned, gain) of the step that raises the sum of squares most."""
        among = among[(among != donor) & (self.fill[among] >= self.fill[donor])]
        if not len(among):
            return None
        room = self.cap - self.fill[among]
        ahead = self.fill[among] - self.fill[donor]
        top, found = 0, None
        for w, options in ((2, self.give[donor][0]), (1, self.give[donor][1])):  # not two for two
            if not options:
                continue
            n = np.fromiter(options, np.int64)
            for part in np.array_split(n, -(-len(n) * len(among) // 1_000_000)):  # 8 MB at a time
                m = self.back[w][self.slot[among][:, None], np.maximum(0, part - room[:, None])]
                gain = part - m
                score = np.where(gain > 0, gain * (ahead[:, None] + gain), 0)
                i = int(score.argmax())
                if score.flat[i] > top:
                    top, (r, c) = score.flat[i], divmod(i, len(part))
                    found = int(among[r]), options[int(part[c])], int(m[r, c]), int(gain[r, c])
        return found

    def step(self, donor: int, b: int, give: tuple, back: int, gain: int) -> None:
        one, two = self.give[b]
        single = len(give) == 2 or back in one
        returned = () if back == 0 else one[back] if single and back in one else two[back]
        self.bins[donor] = [i for i in self.bins[donor] if i not in give] + list(returned)
        self.bins[b] = [i for i in self.bins[b] if i not in returned] + list(give)
        self.fill[b] += gain
        self.fill[donor] -= gain
        for x in (b, donor):
            self.open[x] = 0 < self.fill[x] < self.cap
            if self.open[x]:
                self._index(x)


def improve(bins: list[list[int]], lengths: np.ndarray, cap: int) -> list[list[int]]:
    """Local search over underfull bins, emptiest donor first.

    A step moves one or two pieces to a bin that is as full or fuller, for none, one or two pieces in return
    (not two for two): of all such steps of the donor, the one that raises the sum of squared fills most.  It
    ends when a round over all donors finds no step, or when the bins reach the lower bound.  A donor without a step is asked
    again only about bins that changed since.
    """
    least = lower_bound(lengths, cap)
    n_bins = len(bins)
    if n_bins <= least:
        return bins
    state = Underfull(bins, lengths, cap)
    changed = np.zeros(len(bins), np.int64)
    asked = np.full(len(bins), -1, np.int64)
    latest, before = 0, -1
    while latest != before and n_bins > least:  # a round: every donor, the emptiest first, until it has no step
        before = latest
        under = np.flatnonzero(state.open)
        for donor in under[np.argsort(state.fill[under], kind="stable")].tolist():
            while state.open[donor] and n_bins > least:
                found = state.best(donor, np.flatnonzero(state.open & (changed > asked[donor])))
                asked[donor] = latest
                if found is None:
                    break
                state.step(donor, *found)
                latest += 1
                for x in (donor, found[0]):
                    changed[x], asked[x] = latest, -1
                n_bins -= state.fill[donor] == 0
    return [items for items in state.bins if items]


def pack_group(lengths: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece."""
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for b, items in enumerate(improve(best_fit(lengths, cap), lengths, cap)):
        bin_of[items] = b
        offset[items] = np.cumsum(lengths[items]) - lengths[items]
    return bin_of, offset


def pack_pieces(pieces: DataFrame, max_tokens: int = MAX_TOKENS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (with a column ``length`` of 1 to ``max_tokens``) plus ``sequence_id`` and ``offset`` (long).

    Sequences are gapless from offset 0.  The pieces are written once, so that their row numbers, which deal
    them to the groups, are fixed; repeated rows therefore spread like any others.  Other columns pass through;
    those named ``sequence_id`` or ``offset`` are replaced.  An empty table gives an empty result; rows whose
    length is null or out of range raise an error in the group that meets them.
    """
    with small_batches(pieces.sparkSession):  # the pieces are cut from whole texts here
        p, _ = write_table(pieces.drop("sequence_id", "offset"), "pieces")
    p = p.withColumn("__row", F.monotonically_increasing_id())
    p, _ = write_table(p, "numbered")
    short = F.col("length") < max_tokens
    n = p.filter(short).count()
    groups = max(1, round(n / group_pieces))
    cols = [c for c in p.columns if c != "__row"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in p.schema if f.name != "__row")
    schema += ", sequence_id long, offset long"

    def run(key, pdf):  # without types, as workers that encode have no use for pandas
        lengths = pdf["length"].to_numpy(np.int64)
        if len(lengths) and (lengths.min() < 1 or lengths.max() > max_tokens):
            raise ValueError(f"piece lengths must be 1 to {max_tokens}")
        bin_of, offset = pack_group(lengths, max_tokens)
        return pdf[cols].assign(sequence_id=(np.int64(key[0]) << 32) + bin_of, offset=offset)

    packed = (p.filter(~short | F.col("length").isNull()).filter(F.col("length") == max_tokens)
              .select(*cols, (-1 - F.col("__row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    rest = p.filter(F.col("length").isNull() | (F.col("length") != max_tokens))
    rest = (rest.withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups)))
            .groupBy("__group").applyInPandas(run, schema))
    return packed.unionByName(rest)


def op9_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The pieces of all documents with their places, under the column names of the query.

    Nulls and edges: a null or empty text is one piece of the end id alone; null ids stay null; repeated rows
    are packed each; other columns do not matter; an empty table gives an empty result.  A text is held whole
    in the task that encodes it.
    """
    pieces = token_pieces(docs, tokenizer_path).drop("ids").withColumnRenamed("doc", "doc_id")
    return pack_pieces(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
