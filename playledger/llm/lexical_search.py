"""Ranked lexical search with hashed max-sketches.

A term occurring tf times in a document of length norm m has the impact  (10^9 tf) div (1000 tf + 8 m),  and a document
scores the sum of weight times impact over the query's terms.  The index is one row for each document: its text, its
number of terms and its sketch, ``WIDTH`` coordinates among which the terms are hashed; a coordinate keeps the maximum
over its terms.  As the impact of a document's terms grows with tf alone, the maximum of tf is that of the impacts; it
is kept in a byte (counts above 128 rounded up), so the index needs no statistics of the collection.  Weights being
non-negative, a query's weights folded onto the coordinates times the sketch bound the score from above: one matrix
product for a batch of documents and a block of queries.

1. The index, and in the same pass the document counts of all terms and the two sums that make the norm.
2. From the sketches alone, the ``k`` documents of highest bound of each query; their exact scores give a threshold.
3. In each task, batch by batch, the documents whose bound reaches the threshold, by descending bound, are scored
   exactly from their whole text until the next bound lies below the k-th best score.  A task returns at most k rows a
   query; a window makes the final ranks.

Queries are taken in blocks of ``block_terms`` terms, so neither a task nor the driver holds all of a large query set.
"""
from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, stored

WIDTH, BATCH = 1024, 512
#: Terms of the queries that are looked up together; a longer query is a block of its own.
BLOCK_TERMS = 100_000
#: Distinct terms that a task counts before it sends its counts on.
HELD_TERMS = 200_000

#: Letters of ASCII in lower case, digits and all bytes beyond ASCII stay; the rest separates.
_FOLD = bytes(b | 0x20 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))
#: What a byte of a sketch stands for: itself up to 128, then steps of 15 % to above 5 * 10^9, more than a text can hold.
_LEVEL = np.array([*range(129), *(math.ceil(128 * 1.15 ** k) for k in range(1, 127))], np.int64)


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8; null has none."""
    return (text or b"").translate(_FOLD).split()


def sketch(counts: Counter) -> np.ndarray:
    out = np.zeros(WIDTH, np.uint8)
    if counts:
        at = np.fromiter(map(zlib.crc32, counts), np.int64, len(counts)) % WIDTH
        np.maximum.at(out, at, np.searchsorted(_LEVEL, np.fromiter(counts.values(), np.int64, len(counts))).astype(np.uint8))
    return out


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(df: int, n: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def norm(n_terms: np.ndarray, many: int, total: int) -> np.ndarray:
    return 25 + (75 * n_terms * many) // max(total, 1)


@dataclass
class Index:
    """``rows``: (row, doc_id, n_terms, sketch, text) of the documents that have terms; ``df``: (term, df) of all terms;
    ``many`` documents with ``total`` terms."""
    rows: DataFrame
    df: DataFrame
    many: int
    total: int


def _read(frames):
    """mapInArrow (doc_id, text): a row for each document that has terms, and rows (term, df) of the task's counts."""
    held: Counter = Counter()
    schema = None

    def told():
        none = [pa.nulls(len(held), t) for t in schema]
        return pa.RecordBatch.from_arrays([*none, pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                                          names=["doc_id", "text", "n_terms", "sketch", "term", "df"])

    for b in batches_of(frames, BATCH):
        schema = [b.schema[0].type, b.schema[1].type, pa.int64(), pa.binary()]
        keep, n, made = [], [], []
        for row, text in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
            found = terms(text)
            if found:
                counts = Counter(found)
                held.update(dict.fromkeys(counts, 1))
                keep.append(row)
                n.append(len(found))
                made.append(sketch(counts).tobytes())
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(n, pa.int64()), pa.array(made, pa.binary()),
                                          pa.nulls(len(keep), pa.binary()), pa.nulls(len(keep), pa.int64())],
                                         names=["doc_id", "text", "n_terms", "sketch", "term", "df"])
        if len(held) >= HELD_TERMS:
            yield told()
            held.clear()
    if held:
        yield told()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    kind = docs.schema[id_col].dataType.simpleString()
    both = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                  .mapInArrow(_read, f"doc_id {kind}, text string, n_terms long, sketch binary, term binary, df long")
                  .withColumn("row", F.monotonically_increasing_id()), "index")
    rows = both.where("n_terms IS NOT NULL").select("row", "doc_id", "n_terms", "sketch", "text")
    df = both.where("df IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df"))
    many, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    return Index(rows, df, many, total)


@dataclass
class Queries:
    """A block of queries: distinct terms with their weights, and for each query its terms' places and counts."""
    vocabulary: dict[bytes, int]
    weights: np.ndarray
    places: list[np.ndarray]
    times: list[np.ndarray]
    many: int
    total: int

    def folded(self) -> np.ndarray:
        """The queries' weights by coordinate of a sketch, a column for each query."""
        at = np.fromiter(map(zlib.crc32, self.vocabulary), np.int64, len(self.vocabulary)) % WIDTH
        out = np.zeros((WIDTH, len(self.places)))
        for q, (p, t) in enumerate(zip(self.places, self.times)):
            np.add.at(out[:, q], at[p], (self.weights[p] * t).astype(float))
        return out

    def bounds(self, folded: np.ndarray, n_terms: np.ndarray, sketches: list[bytes]) -> np.ndarray:
        """Upper bounds of the scores, documents by queries."""
        level = _LEVEL[np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), WIDTH)]
        top = impact(level, norm(n_terms, self.many, self.total)[:, None])
        # sums of whole numbers below 2^53 are exact; beyond, the allowance covers the rounding
        return np.ceil((top.astype(float) @ folded) * (1 + 1e-9))

    def scores(self, text: bytes, asked) -> list[int]:
        """Exact scores of one document for the queries ``asked``."""
        counts = Counter(terms(text))
        m = norm(np.int64(sum(counts.values())), self.many, self.total)
        tf = np.fromiter(map(counts.__getitem__, self.vocabulary), np.int64, len(self.vocabulary))
        worth = self.weights * impact(tf, m)
        return [int((worth[self.places[q]] * self.times[q]).sum()) for q in asked]


def _best_bounds(block: Queries, k: int):
    """mapInArrow (row, n_terms, sketch): (query, row, bound) of a task's ``k`` highest bounds of each query."""
    def run(frames):
        folded, many = block.folded(), len(block.places)
        bound, at = np.full((k, many), -1.0), np.zeros((k, many), np.int64)
        for b in batches_of(frames, BATCH):
            if not b.num_rows:
                continue
            new = block.bounds(folded, b.column(1).to_numpy(), b.column(2).to_pylist())
            row = np.broadcast_to(b.column(0).to_numpy()[:, None], new.shape)
            bound, at = np.concatenate([bound, new]), np.concatenate([at, row])
            best = np.argsort(-bound, axis=0, kind="stable")[:k]
            bound, at = np.take_along_axis(bound, best, 0), np.take_along_axis(at, best, 0)
        _, q = np.nonzero(bound > 0)
        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(at[bound > 0]), pa.array(bound[bound > 0])],
                                         names=["query", "row", "bound"])

    return run


def _score_given(block: Queries):
    """mapInArrow (queries, text): (query, score) for each of a document's queries."""
    def run(frames):
        for b in batches_of(frames, BATCH):
            rows = [(q, s) for asked, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist())
                    for q, s in zip(asked, block.scores(text, asked))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64())],
                                             names=["query", "score"])

    return run


def _rescore(block: Queries, least: np.ndarray, k: int):
    """mapInArrow (doc_id, n_terms, sketch, text): (query, doc_id, score) of a task's ``k`` best documents of each query
    that reach the query's ``least`` score."""
    def run(frames):
        folded = block.folded()
        # (score, order of the id, doc_id) of the best so far, best first; of equal scores the least id, null last
        best: list[list] = [[] for _ in block.places]
        limit = np.maximum(least, 1)
        id_type = None
        for b in batches_of(frames, BATCH):
            id_type = b.schema[0].type
            if not b.num_rows:
                continue
            bound = block.bounds(folded, b.column(1).to_numpy(), b.column(2).to_pylist())
            open_ = bound >= limit
            asked_rows = np.flatnonzero(open_.any(1))
            # rows by their highest bound over its query's limit, so that limits rise early
            texts, ids = b.column(3).cast(pa.binary()), b.column(0)
            for row in asked_rows[np.argsort(-(bound[asked_rows] / limit).max(1), kind="stable")].tolist():
                asked = np.flatnonzero(bound[row] >= limit)
                if not len(asked):
                    continue
                doc = ids[row].as_py()
                for q, s in zip(asked.tolist(), block.scores(texts[row].as_py(), asked)):
                    if s >= limit[q]:
                        mine = best[q]
                        mine.append((-s, doc is None, doc))
                        mine.sort(key=lambda r: (r[0], r[1], r[2] if r[2] is not None else 0))
                        del mine[k:]
                        if len(mine) == k:
                            limit[q] = max(limit[q], -mine[-1][0])
        rows = [(q, doc, -s) for q, mine in enumerate(best) for s, _, doc in mine]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], id_type),
                                              pa.array([r[2] for r in rows], pa.int64())], names=["query", "doc_id", "score"])

    return run


def _blocks(items: DataFrame, block_terms: int):
    """Lists of (place, text) of the queries, each list of some ``block_terms`` terms."""
    held, n = [], 0
    for r in items.select("place", "text").toLocalIterator():
        held.append((r.place, terms((r.text or "").encode())))
        n += len(held[-1][1])
        if n >= block_terms:
            yield held
            held, n = [], 0
    if held:
        yield held


def _block(index: Index, held: list) -> Queries:
    spark = index.df.sparkSession
    words = sorted({t for _, found in held for t in found})
    vocabulary = {t: j for j, t in enumerate(words)}
    asked = spark.createDataFrame([(t,) for t in map(bytearray, words)], "term binary")
    known = {bytes(r.term): r.df for r in index.df.join(F.broadcast(asked), "term", "left_semi").collect()}  # at most the block's terms
    weights = np.array([weight(known[t], index.many) if t in known else 0 for t in words], np.int64)
    places, times = [], []
    for _, found in held:
        counts = Counter(found)
        places.append(np.array([vocabulary[t] for t in counts], np.int64))
        times.append(np.array(list(counts.values()), np.int64))
    return Queries(vocabulary, weights, places, times, index.many, index.total)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` highest-scoring documents with a score above 0.

    Terms are runs of letters, digits and characters beyond ASCII in the whole text, A-Z lower-cased; null has none.
    Weights and norms count all documents with a term.  Equal scores go by ascending doc_id, null last; ranks run from 1
    without ties.  Rows of ``docs`` that repeat an id are documents of their own.  Items are told apart by id and text:
    one that repeats in both is one item, one id with two texts has two lists.  Empty tables give an empty result;
    other columns are not read."""
    index = build_index(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    asked = stored(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).distinct()
                   .withColumn("place", F.monotonically_increasing_id()), "queries")
    out = None
    for held in _blocks(asked, block_terms) if index.many else ():
        found = _search_block(index, _block(index, held), k, kind)
        place = F.element_at(F.array(*[F.lit(p) for p, _ in held]), F.col("query") + 1)
        found = stored(found.select(place.alias("place"), "rank", "doc_id", "score"), "found")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], f"place long, rank int, doc_id {kind}, score long")
    return out.join(asked, "place").select("item_id", "rank", "doc_id", "score")


def _search_block(index: Index, block: Queries, k: int, kind: str) -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.col("bound").desc(), "row")
    first = index.rows.select("row", "n_terms", "sketch").mapInArrow(_best_bounds(block, k), "query int, row long, bound double") \
        .withColumn("n", F.row_number().over(w)).where(F.col("n") <= k).groupBy("row").agg(F.collect_list("query").alias("queries"))
    # at most k rows for each query of the block
    given = index.rows.select("row", "text").join(F.broadcast(stored(first, "first")), "row").select("queries", "text")
    w = Window.partitionBy("query").orderBy(F.col("score").desc())
    least = given.mapInArrow(_score_given(block), "query int, score long").withColumn("n", F.row_number().over(w)).where(F.col("n") == k)
    limit = np.zeros(len(block.places), np.int64)
    for r in least.collect():  # at most one row for each query of the block
        limit[r.query] = r.score
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = index.rows.select("doc_id", "n_terms", "sketch", "text") \
        .mapInArrow(_rescore(block, limit, k), f"query int, doc_id {kind}, score long")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
