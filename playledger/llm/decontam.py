"""Benchmark decontamination: containment search with size-partitioned MinHash sketches, exactly verified.

A test item of n word shingles lies in a document at containment t when at least ceil(t n) of them occur there, so
at most n - ceil(t n) are missing, and of any n - ceil(t n) + 1 of them one must occur.  The sketch of an item is
its bottom-k MinHash (the k shingles of least hash); k belongs to the item's size partition (powers of two) and is
the bound above for the partition's largest size.  Looking the sketches up among all shingles of a document thus
misses no document, however long it is; a MinHash of the document itself could not see an item of 30 shingles
among 20,000.  The candidates are then verified by counting the item's distinct shingles, as text, in the document.

DataFrame operations only.  The document side is one pass without a shuffle as long as the sketches are few enough
to be sent to all tasks (counted first); beyond that bound they join by hash.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sent, stored, words

#: Rows and bytes up to which sketches or item shingles are sent to every task, and rows of plain hashes.
SEND_ROWS, SEND_BYTES, SEND_HASHES = 200_000, 32 << 20, 2_000_000


def _sent(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it is small, by rows and by the length of its texts."""
    texts = [F.octet_length(F.col(f.name)) for f in df.schema.fields if f.dataType.typeName() == "string"]
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(sum(texts, F.lit(0))), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if size.n <= SEND_ROWS and size.b <= SEND_BYTES else df


def _shingles(df: DataFrame, keep: list[str], k: int) -> tuple[DataFrame, list[str]]:
    """A row for each shingle of the word array ``w``, repeats included: the columns ``keep`` and the shingle's words."""
    cols = [f"_w{j}" for j in range(k)]
    runs = [F.slice("w", F.lit(j + 1), F.size("w") - (k - 1)).alias(c) for j, c in enumerate(cols)]
    return df.where(F.size("w") >= k).select(*keep, F.inline(F.arrays_zip(*runs))), cols


def _all_shingles(df: DataFrame, keep: list[str], sizes: list[int], value) -> DataFrame:
    """The shingles of each of the ``sizes``: the columns ``keep``, ``k`` and what ``value`` makes of their words."""
    parts = []
    for k in sizes:
        rows, cols = _shingles(df, keep, k)
        parts.append(rows.select(*keep, F.lit(k).alias("k"), *value(cols)))
    return reduce(DataFrame.unionByName, parts)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", shingle: int = 5,
               threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment): the items that lie in a document at ``threshold`` or more.

    Words are runs of non-space characters of the lower-cased text; shingles count once per text.  An item of fewer
    words than a shingle is one shingle, its whole word sequence, and lies in the documents that have these words in a
    row.  Null and wordless texts have no shingle.  Rows that repeat a doc_id (or item_id) are one text with their
    shingles pooled; null ids are ids like any other.  Empty tables give an empty result; other columns are not read."""
    w = lambda c: words(F.lower(F.col(c).cast("string")))
    text = lambda cols: [F.concat_ws(" ", *cols).alias("s")]
    hashed = lambda cols: [F.xxhash64(F.lit(len(cols)), *cols).alias("h")]
    d = docs.select(F.col(id_col).alias("doc_id"), w(text_col).alias("w"))
    b = items.select(F.col(item_col).alias("item_id"), w(item_text_col).alias("w"))
    sizes = range(1, shingle + 1)
    # an item is cut by its own size: only whole items have fewer words than a shingle
    own = reduce(DataFrame.unionByName, [_all_shingles(b.where(F.size("w") == k) if k < shingle else b, ["item_id"], [k],
                                                       lambda c: text(c) + hashed(c)) for k in sizes])
    whole = stored(own.distinct(), "items")
    used = sorted(r.k for r in whole.select("k").distinct().collect()) or [shingle]  # at most ``shingle`` numbers
    sketch = stored(_sketches(whole, threshold), "sketches")

    rows = _all_shingles(d, ["doc_id"], used, hashed)
    small = sketch.select("h").distinct()
    if sketch.count() > SEND_ROWS and small.count() <= SEND_HASHES:
        rows = rows.join(F.broadcast(small), "h", "left_semi")  # 8 bytes a row; only what can match is shuffled then
    found = stored(rows.select("doc_id", "h").join(_sent(sketch), "h").select("doc_id", "item_id").distinct(), "candidates")

    # only the candidates' texts are cut again; few ids are sent to the texts, which then stay where they are
    ids = sent(stored(found.select(F.col("doc_id").alias("cand_id")).distinct(), "ids"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")) \
        .join(ids, F.col("doc_id").eqNullSafe(F.col("cand_id")), "left_semi")
    have = _all_shingles(texts.select("doc_id", w("_text").alias("w")), ["doc_id"], used, text)
    shared = have.join(_sent(whole.select("item_id", "k", "s")), ["k", "s"]).distinct() \
        .groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_shared"))
    n_item = whole.groupBy(F.col("item_id").alias("of")).agg(F.count(F.lit(1)).alias("n_item"))
    out = shared.join(_sent(stored(n_item, "sizes")), F.col("item_id").eqNullSafe(F.col("of"))) \
        .withColumn("containment", F.col("n_shared") / F.col("n_item")).where(F.col("containment") >= threshold)
    cand = found.select(F.col("doc_id").alias("cd"), F.col("item_id").alias("ci"))
    out = out.join(cand, F.col("doc_id").eqNullSafe(F.col("cd")) & F.col("item_id").eqNullSafe(F.col("ci")), "left_semi")
    return out.select("doc_id", "item_id", "n_shared", "n_item", "containment")


def _sketches(whole: DataFrame, threshold: float) -> DataFrame:
    """(h, item_id): each item's bottom-k MinHash, k by its size partition."""
    sets = whole.groupBy("item_id").agg(F.sort_array(F.collect_set("h")).alias("hs"), F.count(F.lit(1)).alias("n"))
    high = F.pow(F.lit(2.0), F.floor(F.log2("n") + 1e-9)).cast("long") * 2 - 1
    k = F.greatest(F.lit(1), high - F.ceil(high * F.lit(threshold) - 1e-9) + 1).cast("int")
    return sets.select(F.explode(F.slice("hs", F.lit(1), k)).alias("h"), "item_id")
