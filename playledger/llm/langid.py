"""Language identification with a bit-sliced Bloom filter of n-grams.

One filter serves all languages: a cell is a bitmask with a bit for each language, and the AND of an n-gram's cells
is the set of languages that have it.  The set bits of a text's n-grams, counted per language and corrected by that
language's share of false positives, decide.

N-grams are runs of ``N`` bytes of the lower-cased text in UTF-8 in which everything but letters is a single space.
A language has the n-grams that occur in at least ``MIN_SHARE`` of its training documents; their number is thus
bounded (a document's mean number of n-grams over MIN_SHARE) however many documents there are.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, fold

N, MIN_SHARE, HASHES, CELLS_PER_GRAM = 4, 0.01, 3, 8
#: Training documents of a language, about: those of least hash.
SAMPLE_DOCS = 3000
UNKNOWN = "und"

_U = np.uint64
_SPREAD = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0xD6E8FEB86659FD93)]
#: Bytes that belong to no ASCII letter become spaces; bytes beyond ASCII stay, as most are parts of letters.
_FOLD = np.array([b | 0x20 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


#: Bytes of a text that are folded at once.
_BLOCK = 1 << 20


def grams(text: bytes):
    """Yield arrays of the n-grams of a text, as numbers.  A long text comes in blocks; what a block hands on to the next are
    its last folded bytes, so a border changes nothing, be it inside a run of gaps or not."""
    raw = np.frombuffer(b" " + text + b" ", np.uint8)
    held = np.zeros(0, np.uint8)
    for at in range(0, len(raw), _BLOCK):
        part = _FOLD[raw[at:at + _BLOCK]]
        gap = part == 32
        part = part[~(gap & np.concatenate([held[-1:] == 32 if len(held) else [False], gap[:-1]]))]
        part = np.concatenate([held, part])
        held = part[-(N - 1):]
        if len(part) < N:
            continue
        wide = part.astype(np.uint32)
        out = np.zeros(len(part) - N + 1, np.uint32)
        for k in range(N):
            out |= wide[k:len(part) - N + 1 + k] << np.uint32(8 * k)
        yield out


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    raw = np.frombuffer(text, np.uint8)
    low = raw | 0x20
    if ((low >= 97) & (low <= 122)).any():
        return True
    return bool((raw >= 128).any()) and any(c.isalpha() for c in text.decode(errors="replace"))


@dataclass
class Filter:
    """``cells[s]``: the masks of the languages 64 s .. 64 s + 63, or a narrower type if they are few."""
    languages: list[str]
    cells: np.ndarray
    false_share: np.ndarray

    @staticmethod
    def of(sets: dict[str, np.ndarray]) -> Filter:
        names = sorted(sets)
        bits = max(10, int(np.ceil(np.log2(max(CELLS_PER_GRAM * max([1, *map(len, sets.values())]), 2)))))
        kind = next(t for t, most in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 1 << 60)) if len(names) <= most)
        cells = np.zeros((max(1, -(-len(names) // 64)), 1 << bits), kind)
        for k, name in enumerate(names):
            for place in Filter._places(sets[name].astype(np.uint32), bits):
                cells[k // 64, place] |= kind(1 << (k % 64))
        filled = [((cells[k // 64] >> kind(k % 64)) & kind(1)).mean() for k in range(len(names))]
        return Filter(names, cells, np.minimum(np.array(filled) ** HASHES, 0.99))

    @staticmethod
    def _places(gram: np.ndarray, bits: int):
        wide = gram.astype(_U)
        return [((wide + _U(1)) * s) >> _U(64 - bits) for s in _SPREAD[:HASHES]]

    def counts(self, text: bytes) -> tuple[np.ndarray, int]:
        """(n-grams of the text that each language has, corrected for false positives; n-grams)."""
        hits, n = np.zeros(len(self.languages)), 0
        bits = self.cells.shape[1].bit_length() - 1
        for gram in grams(text):
            n += len(gram)
            places = self._places(gram, bits)
            for s in range(len(self.cells)):
                mask = self.cells[s][places[0]]
                for p in places[1:]:
                    mask &= self.cells[s][p]
                kind = mask.dtype.type
                own = range(64 * s, min(64 * s + 64, len(self.languages)))
                if len(own) <= 8:
                    tally = np.bincount(mask, minlength=1 << len(own))
                    sets = np.arange(len(tally))
                    for k in own:
                        hits[k] += tally[(sets >> (k % 64)) & 1 == 1].sum()
                else:
                    for k in own:
                        hits[k] += np.count_nonzero(mask & kind(1 << (k % 64)))
        return np.maximum((hits - n * self.false_share) / (1 - self.false_share), 0), n

    def predict(self, text: bytes | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        count, _ = self.counts(text)
        best = int(count.argmax())  # of equal counts the first by name
        total = count.sum()
        return self.languages[best], float(count[best] / total) if total > 0 else 0.0


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: int = 1,
        folds: int = 3, sample_docs: int = SAMPLE_DOCS) -> Filter:
    """Learn from the whole texts of about ``sample_docs`` documents of each language outside the held-out fold.

    Null languages, ids and texts teach nothing; an empty table gives a filter that knows no language."""
    own = docs.where(~fold(docs, held_out, folds, id_col) & F.col(id_col).isNotNull()) \
        .select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang"),
                F.col(text_col).cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    share = {r.lang: sample_docs / r.n for r in own.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not share:
        return Filter.of({})
    keep = F.element_at(F.create_map(*[F.lit(x) for kv in share.items() for x in kv]), F.col("lang"))
    drawn = own.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < keep * float(1 << 30)).select("lang", "text")

    def run(frames):
        for b in batches_of(frames):
            langs, texts = b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()
            for lang in sorted(set(langs)):
                sets = [np.unique(np.concatenate([*grams(t), np.zeros(0, np.uint32)]))
                        for own_lang, t in zip(langs, texts) if own_lang == lang]
                gram, df = np.unique(np.concatenate(sets), return_counts=True)
                gram, df = np.append(gram.astype(np.int64), -1), np.append(df.astype(np.int64), len(sets))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram), pa.array(df)],
                                                 names=["lang", "gram", "df"])

    counted = drawn.mapInArrow(run, "lang string, gram long, df long").groupBy("lang", "gram").agg(F.sum("df").alias("df"))
    # the row of gram -1 holds the number of documents
    total = counted.where("gram = -1").select("lang", F.col("df").alias("n"))
    common = counted.where("gram >= 0").join(F.broadcast(total), "lang").where((F.col("df") >= MIN_SHARE * F.col("n")))
    rows = common.select("lang", "gram").toArrow()
    langs, gram = np.array(rows.column(0).to_pylist(), object), rows.column(1).to_numpy()
    return Filter.of({lang: np.sort(gram[langs == lang]) for lang in share})


def identify(docs: DataFrame, model: Filter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for each row of ``docs``, from the whole text alone.

    ``score``: the predicted language's part of all corrected counts.  A text that is null or has no letter is
    ``und`` with score 0; one with letters but no known n-gram gets the first language by name and score 0."""
    def run(frames):
        for b in batches_of(frames):
            found = [model.predict(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f[0] for f in found], pa.string()),
                                              pa.array([f[1] for f in found], pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
