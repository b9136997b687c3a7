"""The corpus pipeline: each stage works on all that the stage before it kept, written as Parquet and read again.

Quality classifier, exact duplicates, SimHash near-duplicates, benchmark decontamination, byte-level BPE.  All
stages but the last return the columns of ``documents``.  Rows that repeat another row's doc_id and text are one
document.  ``ORACLE_SQL`` is None: SQL can express neither the classifier nor SimHash nor BPE; the tests hold
``run`` against a brute-force version.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playledger.llm import bpe, decontam, exact_dedup, quality, simhash
from playledger.llm.common import rows_in, stored
from playledger.session import path_of, scratch_path, scratch_scope

ORACLE_SQL = None


def _sha(text):
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


BY_TEXT = {"doc_id": lambda c: c("doc_id"), "text_sha256": lambda c: _sha(c("text"))}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the classifier's threshold stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels)
    return quality.select_documents(docs, model)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the least doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of SimHash links the document with the least doc_id stays, null last, then the least sha256."""
    found = stored(simhash.near_duplicates(docs, shingle=3, max_bits=3, text_key=True), "near")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_sha256")
    kept = found.groupBy("component").agg(F.min(order).alias("d"))
    gone = found.join(kept, "component").where("NOT (doc_id <=> d.doc_id AND text_sha256 = d.text_sha256)")
    return rows_in(docs, stored(gone.select("doc_id", "text_sha256").distinct(), "dropped"), BY_TEXT, "left_anti")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    keyed = docs.select(F.struct("doc_id", _sha(F.col("text")).alias("text_sha256")).alias("key"), "text")
    leaks = decontam.find_leaks(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="key")
    return rows_in(docs, stored(leaks.select("doc_id.*").distinct(), "leaks"), BY_TEXT, "left_anti")


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (the tokens of the whole text), n_tokens."""
    out = bpe.encode(docs)
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [("quality", quality_stage), ("exact_dedup", exact_dedup_stage), ("near_dedup", near_dedup_stage),
          ("decontamination", decontamination_stage), ("encode", encode_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage.  When a stage's result is written, its own steps and the stage before go."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"llm-{name}")
        with scratch_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            fs, at = path_of(spark, before)
            fs.delete(at, True)
        before = path
    return docs
