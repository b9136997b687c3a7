"""Removal of long repeats across documents by recompression.

Each round replaces runs and pairs of neighbouring symbols by a new symbol whose name follows from their names alone
(a 64-bit hash, so that all tasks agree on it without talking).  Whether two neighbours pair depends on a bit of
either name: a left one followed by a right one.  So equal passages get equal symbols except at their borders, where
a symbol hangs on what stands outside.  For each symbol the words that it hangs on are tracked (its context), and a
window of words may use the symbols whose context lies inside it.  Its anchor is one of the highest of these: the
one whose hash over the context's words is least.  Equal windows thus have equal anchors, and neighbouring windows
mostly share theirs, so a document has one anchor for some five words.

1. Equal texts are one text from here on, that of the least doc_id: whole copies need no windows.
2. All documents' anchors are counted by name: a name in one document only rules all its windows out.
3. The windows of the other anchors are named by 128 bits of hash over all their words; the least doc_id of each
   name decides.  What a document loses is put together from its windows, by document.

Names that very many documents share are folded to a minimum in each task before they are shuffled, and what joins
back to them is an ordinary join, whose heavy keys adaptive execution splits.  A window without any symbol that is
sure (long runs) is its own anchor.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, stored, word_blocks

#: Words that a task names together.
GATHER = 100_000
NO_ID = (1 << 63) - 1

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Sums:
    """Hashes of all stretches of a word sequence from one pass of prefix sums."""

    def __init__(self, word: np.ndarray, base: int):
        n = len(word)
        power = np.multiply.accumulate(np.concatenate([[_U(1)], np.full(n, _U(base))]))
        self.back = np.multiply.accumulate(np.concatenate([[_U(1)], np.full(n, _U(pow(base, -1, 1 << 64)))]))
        self.sums = np.concatenate([[_U(0)], np.cumsum(word * power[:n])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start])


def pair_rounds(window: int) -> int:
    """Rounds of pairs whose symbols' contexts still fit a window of so many words: a round about doubles them."""
    return max(1, window.bit_length() - 2)


def _rounds(word: np.ndarray, many: int):
    """Yield, for each round, the symbols' (name, context start, context end); -1 or n + 1 where the context leaves
    the sequence.  Both bounds ascend."""
    n = len(word)
    name, low, high = word, np.arange(n), np.arange(1, n + 1)
    # runs: their names hold the length, and hang on the neighbours that end them
    first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
    last = np.concatenate([first[1:] - 1, [n - 1]])
    size = (last - first + 1).astype(_U)
    low, high = np.where(first > 0, low[first - 1], -1), np.where(last < n - 1, high[np.minimum(last + 1, n - 1)], n + 1)
    name = np.where(size > 1, _mix(name[first] + size * _U(0xD6E8FEB86659FD93)), name[first])
    for r in range(many):
        m = len(name)
        left = (_mix(name ^ _U(r + 1)) >> _U(63)).astype(bool)
        pair = np.zeros(m, bool)
        pair[:-1] = left[:-1] & ~left[1:]
        own = np.flatnonzero(~np.concatenate([[False], pair[:-1]]))  # all but the right halves
        after, before = np.minimum(own + 1, m - 1), np.maximum(own - 1, 0)
        new = np.where(pair[own], _mix(name[own] * _U(0xC2B2AE3D27D4EB4F) + name[after] + _U(1)), name[own])
        # a pair hangs on its halves only; a single one on the neighbour that might have joined it
        low2 = np.where(left[own], low[own], np.where(own > 0, low[before], -1))
        high2 = np.where(left[own], np.where(own < m - 1, high[after], n + 1), high[own])
        name, low, high = new, low2, high2
        yield name, low, high


def anchors(word: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, hash, second hash) of every window of ``window`` consecutive words, from the words' hashes."""
    n, many = len(word), len(word) - window + 1
    sums, sums2 = _Sums(word, _BASES[0]), _Sums(_mix(word ^ _U(_BASES[1])), _BASES[1])
    start = np.arange(many)
    full, full2 = sums.of(start, start + window), sums2.of(start, start + window)
    anchor, open_ = full.copy(), np.ones(many, bool)
    for name, low, high in reversed(list(_rounds(word, pair_rounds(window)))):
        inside = (low >= 0) & (high <= n)
        weight = _mix(sums.of(np.where(inside, low, 0), np.where(inside, high, 0)) + name)
        # window i has the symbols first[i] .. last[i]: context from i on, and up to i + window
        first = np.cumsum(np.bincount(np.clip(low + 1, 0, n), minlength=n + 1))[:many]
        last = np.cumsum(np.bincount(high, minlength=n + 2))[window:window + many] - 1
        at = np.flatnonzero(open_ & (first <= last))
        if not len(at):
            continue
        a, b = first[at], last[at]
        # the least weight of a stretch, from the least of stretches of 1, 2, 4 and 8 symbols
        log, least, k = np.frexp(b - a + 1)[1] - 1, weight, 0
        best = np.empty(len(at), _U)
        while True:
            here = log == k
            best[here] = np.minimum(least[a[here]], least[b[here] - (1 << k) + 1])
            k += 1
            if k > log.max():
                break
            least = np.minimum(least[:-(1 << (k - 1))], least[(1 << (k - 1)):])
        anchor[at] = best
        open_[at] = False
    return anchor, full, full2


def _gathered(rows, window: int):
    """Yield lists of (row, first word, hashes of the words), some GATHER words a list, from (row, text) pairs.
    A long text comes in blocks that overlap by a window less a word, so that each window is in one block."""
    held, n = [], 0
    for row, text in rows:
        at = 0
        for block in word_blocks(text or b"", window - 1):
            if len(block) >= window:
                held.append((row, at, np.fromiter(map(xxhash.xxh64_intdigest, block), _U, len(block))))
                n += len(block)
            at += max(0, len(block) - (window - 1))  # what the next block does not repeat
            if n >= GATHER:
                yield held
                held, n = [], 0
    if held:
        yield held


def _windows(rows, window: int):
    """Yield (row, first window, anchors, hashes, second hashes) for each block of each text of ``rows``."""
    for held in _gathered(rows, window):
        # a separator between blocks; no window with it is used, and no symbol that hangs on it
        word = np.concatenate([x for _, _, own in held for x in (own, np.array([0x5EED], _U))])
        found = anchors(word, window)
        at = 0
        for row, first, own in held:
            many = len(own) - window + 1
            yield row, first, *(x[at:at + many] for x in found)
            at += len(own) + 1


def _lists(arrays: list, kind) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays], dtype=np.int64)]).astype(np.int32)
    flat = np.concatenate([*arrays, np.zeros(0, kind)]).astype(kind, copy=False)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _name_anchors(window: int):
    """mapInArrow (id, key, copy_key, text): the distinct anchors of each text that has any."""
    def run(frames):
        for b in batches_of(frames):
            own: dict[int, list] = {}
            for row, _, anchor, _, _ in _windows(enumerate(b.column(3).cast(pa.binary()).to_pylist()), window):
                change = np.concatenate([[True], anchor[1:] != anchor[:-1]])
                own.setdefault(row, []).append(anchor[change])
            rows = pa.array(list(own), pa.int64())
            names = _lists([np.unique(np.concatenate(x)).view(np.int64) for x in own.values()], np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(rows) for k in range(3)), names],
                                             names=["id", "key", "copy_key", "names"])

    return run


def _name_windows(window: int):
    """mapInArrow (id, key, names, text): the places and hashes of the windows whose anchor is among the names."""
    def run(frames):
        for b in batches_of(frames):
            names = b.column(2)
            values, ends = names.values.to_numpy(zero_copy_only=False), names.offsets.to_numpy()
            out: dict[int, list] = {}
            for row, first, anchor, h, h2 in _windows(enumerate(b.column(3).cast(pa.binary()).to_pylist()), window):
                at = np.flatnonzero(np.isin(anchor.view(np.int64), values[ends[row]:ends[row + 1]]))
                if len(at):
                    out.setdefault(row, []).append((at + first, h[at].view(np.int64), h2[at].view(np.int64)))
            rows = pa.array(list(out), pa.int64())
            cols = [[np.concatenate(x) for x in zip(*parts)] for parts in out.values()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(rows), b.column(1).take(rows), _lists([c[0] for c in cols], np.int32),
                 _lists([c[1] for c in cols], np.int64), _lists([c[2] for c in cols], np.int64)],
                names=["id", "key", "at", "h", "h2"])

    return run


def _keep_words(window: int):
    """mapInArrow (doc_id, whole, starts, text): the words that no window of ``starts`` covers (``whole``: none)."""
    def cut(text: bytes, whole: bool, starts):
        kept, n, left, cover = [], 0, 0, None
        if not whole and starts is not None and len(starts):
            cover = np.sort(starts)
        for block in word_blocks(text, 0):
            size = len(block)
            if cover is None:
                kept.append(block)
                left += size
            else:
                # +1 where a window begins, -1 where it ends; windows that began before the block count from its start
                change = np.zeros(size + 1, np.int64)
                lo, hi = np.searchsorted(cover, [n - window + 1, n + size])
                np.add.at(change, np.maximum(cover[lo:hi] - n, 0), 1)
                np.add.at(change, np.minimum(cover[lo:hi] + window - n, size), -1)
                free = np.cumsum(change)[:size] == 0
                kept.append([block[k] for k in np.flatnonzero(free).tolist()])
                left += len(kept[-1])
            n += size
        if whole and n >= window:
            return n, n, b""
        return n, n - left, b" ".join(w for block in kept for w in block)

    def run(frames):
        for b in batches_of(frames):
            starts = b.column(2)
            values, ends = starts.values.to_numpy(zero_copy_only=False), starts.offsets.to_numpy()
            rows = [cut(t or b"", w, values[a:z]) for t, w, a, z in
                    zip(b.column(3).cast(pa.binary()).to_pylist(), b.column(1).to_pylist(), ends[:-1], ends[1:])]
            n, removed, text = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(text, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_text"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for each row of ``docs``.

    A word goes when a window of ``window`` consecutive words covers it whose word sequence also starts in a document
    with a smaller doc_id; windows are those of the input.  The kept words are joined by one space.  Null texts have
    no words; texts of fewer words than a window lose none.  Rows of one doc_id are no smaller than each other, and a
    null id is larger than any other.  An empty table gives an empty result; other columns are not read."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")) \
        .withColumn("id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("key", F.xxhash64("text"))

    named = stored(d.select("id", "key", F.md5("text").alias("copy_key"), "text")
                   .mapInArrow(_name_anchors(window), "id long, key long, copy_key string, names array<long>"), "anchors")
    least = named.groupBy("copy_key").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    least = stored(least.where("first_id < last_id").select("copy_key", "first_id"), "least")
    classed = named.select("id", "key", "copy_key").join(least, "copy_key")
    copies = stored(classed.where("id > first_id").select("id", "key").distinct(), "copies")
    firsts = named.join(copies, ["id", "key"], "left_anti").select("id", "key", F.explode("names").alias("name"))

    count = firsts.groupBy("name").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("name")
    common = stored(count, "common")
    told = stored(firsts.join(common, "name").groupBy("id", "key").agg(F.collect_set("name").alias("names")), "told")

    places = stored(d.select("id", "key", "text").join(told, ["id", "key"]).select("id", "key", "names", "text")
                    .mapInArrow(_name_windows(window), "id long, key long, at array<int>, h array<long>, h2 array<long>"),
                    "windows")
    each = places.select("id", "key", F.explode(F.arrays_zip("at", "h", "h2")).alias("w")) \
        .select("id", "key", "w.at", "w.h", "w.h2")
    # stored, so that the join below has plain shuffles on both sides, of which adaptive execution splits the heavy keys
    first = stored(each.groupBy("h", "h2").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b")
                   .select("h", "h2", "a"), "first")
    lost = each.join(first, ["h", "h2"]).where("id > a").groupBy("id", "key").agg(F.collect_set("at").alias("starts"))
    fate = lost.select("id", "key", F.lit(False).alias("whole"), "starts") \
        .unionByName(copies.select("id", "key", F.lit(True).alias("whole"), F.lit(None).cast("array<int>").alias("starts")))
    fate = stored(fate, "fate")

    out = d.join(fate, ["id", "key"], "left")
    return out.select("doc_id", F.coalesce("whole", F.lit(False)).alias("whole"),
                      F.coalesce("starts", F.array().cast("array<int>")).alias("starts"), "text") \
        .mapInArrow(_keep_words(window), "doc_id long, n_words long, n_removed long, kept_text string")
