"""Exact duplicates: group by a 128-bit content hash, then compare the bytes inside each group."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import rows_in, stored


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     normalise: Callable[[Column], Column] = lambda t: t, keep: str = "min",
                     content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row of ``docs``.

    Texts are equal when they are identical after ``normalise``; null counts as empty.  Of equal texts the ``keep``
    ("min" or "max") doc_id stays.  Rows that share id and text are one document twice: both have ``kept``.  A null
    id stays only where all ids of its group are null.  An empty table gives an empty result.

    The byte comparison is a grouping by (hash, text): copies fold into one row per task before the shuffle, so a
    group that holds a third of all rows sends its text once per task.  Rows are then linked to their group by the
    hash alone; only hashes that turn out to hold different texts link by the text as well."""
    text = normalise(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")) \
        .withColumn("h", content_hash(F.col("text")).cast("string"))
    best = {"min": F.min, "max": F.max}[keep]
    classes = rows.groupBy("h", "text").agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    classes = classes.withColumn("text_sha256", F.sha2("text", 256))
    # sha256 tells the texts of one hash apart in what is stored; the collided texts themselves follow below
    groups = stored(classes.select("h", "keep_id", "group_size", "text_sha256"), "classes")
    collided = stored(groups.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("h"), "collided")
    ids = rows.select("doc_id", "h")
    if collided.isEmpty():
        linked = ids.join(groups, "h")
    else:
        alone = groups.join(collided, "h", "left_anti")
        mixed = classes.join(collided, "h", "left_semi")
        linked = ids.join(alone, "h").unionByName(rows.join(mixed, ["h", "text"]).drop("text"))
    return linked.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         "text_sha256")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`exact_duplicates` keeps; one row where id and text repeat."""
    found = stored(exact_duplicates(docs, id_col, text_col, keep=keep).select("doc_id", "text_sha256", "kept"), "found")
    made = {"doc_id": lambda c: c(id_col),
            "text_sha256": lambda c: F.sha2(F.coalesce(c(text_col).cast("string"), F.lit("")), 256)}
    own = found.where("kept")
    if own.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        # whether a row stays follows from its id and text, so those to drop say it as well, and they are fewer
        return rows_in(docs, stored(found.where("NOT kept").select("doc_id", "text_sha256").distinct(), "dropped"), made, "left_anti")
    return rows_in(docs, own, made, once=True)
