"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are computed for every whole text where it lies.  The trees are fitted on a bounded sample of
labelled documents (``sample_rows``, the least hashes of their ids): the sample's statistics, a matrix of fixed
size, are binned and boosted with numpy.  The model is a few arrays; scoring walks all rows and trees of a batch
together, one level at a time.
"""
from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, fold, line_blocks, word_blocks

THRESHOLD = 0.7
SAMPLE_ROWS = 20_000
BINS, TREES, DEPTH, RATE, L2, LEAST_HESSIAN = 64, 60, 4, 0.2, 1.0, 5.0

PUNCTUATION = np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8)
FEATURES = ["bytes_log", "words_log", "lines_log", "word_mean", "word_sd", "word_max_log", "distinct_words",
            "top_word", "distinct_lines", "words_per_line", "upper", "lower", "digit", "space", "beyond_ascii",
            "control", "punctuation", "top_punctuation", "punctuation_kinds", "entropy", "capital_words",
            "one_letter_words"] + [f"punct_{b}" for b in PUNCTUATION.tolist()]


def statistics(text: bytes | None) -> np.ndarray:
    """The features of a text in UTF-8; null counts as empty.  A very long text is read block by block; its words and lines
    (these by a 64-bit hash) are counted over all blocks, so the features mean the same at every length."""
    text = text or b""
    out = np.zeros(len(FEATURES), np.float32)
    raw = np.frombuffer(text, np.uint8)
    n = len(raw)
    if not n:
        return out
    hist = np.zeros(256, np.int64)
    for at in range(0, n, 1 << 20):
        hist += np.bincount(raw[at:at + (1 << 20)], minlength=256)
    words = chars = squares = longest = lines = capital = single = 0
    kinds: Counter = Counter()
    for block in word_blocks(text, 0):
        size = np.fromiter(map(len, block), np.int64, len(block))
        words += len(block)
        chars += int(size.sum())
        squares += int((size * size).sum())
        longest = max(longest, int(size.max()))
        single += int((size == 1).sum())
        kinds.update(block)
        capital += sum(1 for w in block if 65 <= w[0] <= 90)
    own_lines = set()
    for part in line_blocks(text):
        part = [x for x in part if x]
        lines += len(part)
        own_lines.update(map(xxhash.xxh3_64_intdigest, part))
    punct = hist[PUNCTUATION]
    p = hist[hist > 0] / n
    mean = chars / max(words, 1)
    out[:22] = (np.log1p(n), np.log1p(words), np.log1p(lines), mean, np.sqrt(max(squares / max(words, 1) - mean * mean, 0)),
                np.log1p(longest), len(kinds) / max(words, 1), max(kinds.values(), default=0) / max(words, 1), len(own_lines) / max(lines, 1),
                words / max(lines, 1), hist[65:91].sum() / n, hist[97:123].sum() / n, hist[48:58].sum() / n, hist[32] / n,
                hist[128:].sum() / n, hist[:32].sum() / n, punct.sum() / n, punct.max() / n, (punct > 0).sum(),
                -(p * np.log2(p)).sum(), capital / max(words, 1), single / max(words, 1))
    out[22:] = punct / n
    return out


@dataclass
class Model:
    """Complete trees of one depth, flattened: node k of a tree has the children 2k + 1 and 2k + 2; rows go to the
    right where the feature is above the cut.  ``leaf``: log-odds of the leaves.  ``base``: log-odds of the sample."""
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for a matrix of statistics."""
        raw = np.full(len(x), self.base)
        if len(self.feature):
            trees = np.arange(len(self.feature))[None, :]
            rows = np.arange(len(x))[:, None]
            node = np.zeros((len(x), len(self.feature)), np.int64)
            for _ in range(DEPTH):
                right = x[rows, self.feature[trees, node]] > self.cut[trees, node]
                node = 2 * node + 1 + right
            raw = raw + self.leaf[trees, node - (2 ** DEPTH - 1)].sum(1)
        return 1 / (1 + np.exp(-raw))


def boost(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit the trees.  Without rows every score is 0.5; with labels of one kind only it is the smoothed share."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])).astype(np.float32) if len(x) else
            np.zeros(0, np.float32) for f in range(x.shape[1])]
    if len(np.unique(y)) < 2:
        return Model(np.zeros((0, 0), np.int64), np.zeros((0, 0), np.float32), np.zeros((0, 0)), base)
    # a value equal to a cut lies below it, as in Model.score
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    raw, inner = np.full(len(y), base), 2 ** DEPTH - 1
    feature = np.zeros((TREES, inner), np.int64)
    cut = np.full((TREES, inner), np.inf, np.float32)
    leaf = np.zeros((TREES, inner + 1))
    for t in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, many = 2 ** level - 1, 2 ** level
            best = np.zeros(many)
            at = np.zeros(len(y), bool)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                slot = (node - first) * BINS + binned[:, f]
                gs = np.bincount(slot, g, many * BINS).reshape(many, BINS).cumsum(1)
                hs = np.bincount(slot, h, many * BINS).reshape(many, BINS).cumsum(1)
                gl, hl, ga, ha = gs[:, :len(c)], hs[:, :len(c)], gs[:, -1:], hs[:, -1:]
                gain = gl ** 2 / (hl + L2) + (ga - gl) ** 2 / (ha - hl + L2) - ga ** 2 / (ha + L2)
                gain[(hl < LEAST_HESSIAN) | (ha - hl < LEAST_HESSIAN)] = 0
                k = gain.argmax(1)
                for m in np.flatnonzero(gain[np.arange(many), k] > best + 1e-9):
                    best[m] = gain[m, k[m]]
                    feature[t, first + m], cut[t, first + m] = f, c[k[m]]
            at = x[np.arange(len(y)), feature[t, node]] > cut[t, node]
            node = 2 * node + 1 + at
        node -= inner
        gs, hs = np.bincount(node, g, inner + 1), np.bincount(node, h, inner + 1)
        leaf[t] = RATE * gs / (hs + L2)
        raw += leaf[t, node]
    return Model(feature, cut, leaf, base)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        held_out: int = 2, folds: int = 4, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled documents outside the held-out fold.

    Null labels and null ids teach nothing; of several labels of one id the mean counts (half is label 1); of several
    rows of one id one row's statistics count.  Texts are read whole."""
    own = labels.where(~fold(labels, held_out, folds, id_col) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    sample = own.groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("_label")) \
        .orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")) \
        .join(F.broadcast(sample), "_id")  # bounded by sample_rows

    def run(frames):
        for b in batches_of(frames):
            feats = [statistics(t).tolist() for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(feats, pa.list_(pa.float32()))],
                                             names=["_id", "_label", "_x"])

    kind = texts.schema["_id"].dataType.simpleString()
    rows = texts.mapInArrow(run, f"_id {kind}, _label int, _x array<float>") \
        .groupBy("_id").agg(F.max(F.struct("_label", "_x")).alias("r")).select("r._label", "r._x").toArrow()
    x = np.array(rows.column(1).to_pylist(), np.float32).reshape(-1, len(FEATURES))
    y = rows.column(0).to_numpy().astype(np.float64)
    order = np.lexsort((*x.T, y))  # the same trees whatever the order in which the rows arrive
    return boost(x[order], y[order])


def _scorer(model: Model, text_at: int):
    """A mapInArrow function that appends a score to each row; column ``text_at`` is the text."""
    def run(frames):
        for b in batches_of(frames):
            texts = b.column(text_at).cast(pa.binary()).to_pylist()
            if not texts:
                continue
            score = model.score(np.stack([statistics(t) for t in texts]))
            yield pa.RecordBatch.from_arrays([*b.columns[:text_at], *b.columns[text_at + 1:], pa.array(score)],
                                             names=[*(n for k, n in enumerate(b.schema.names) if k != text_at), "_score"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) for each row of ``docs``; null and empty texts are scored by their (zero) statistics."""
    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(_scorer(model, 1), f"doc_id {kind}, _score double")
    return out.select("doc_id", F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))


def select_documents(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``."""
    kept = [f"_c{k}" for k in range(len(docs.columns))]
    named = docs.toDF(*kept)
    text = kept[docs.columns.index(text_col)]

    def run(frames):
        for b in batches_of(frames):
            texts = b.column(b.schema.names.index(text)).cast(pa.binary()).to_pylist()
            if texts:
                good = model.score(np.stack([statistics(t) for t in texts])) >= threshold
                yield b.filter(pa.array(good))

    return named.mapInArrow(run, named.schema).toDF(*docs.columns)
