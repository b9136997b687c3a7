"""Readers (S1-S17): layer tables, raw play-log TSV, resource dictionaries, dated archives, CSV bootstrap,
paged JSON envelopes, run logs.

All of them are ``spark.read`` scans split across executors by the file source (gzip is decoded by the
Hadoop codec, one split per .gz file); nothing is read on the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as K
from ..functions.jsonfn import unwrap
from ..functions.names import file_date, json_text_field
from ..functions.semantics import to_double, to_long, to_ts
from ..operators.rollup import latest_by
from ..session import store

def read_layer(spark: SparkSession, root: str, name: str, schema: T.StructType | str | None = None,
               columns: list[str] | None = None) -> DataFrame:
    """``<root>/<name>`` Parquet table; a missing table raises.  A declared schema avoids footer
    inference; ``columns`` prunes (Catalyst pushes the projection into the scan either way)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(f"{root.rstrip('/')}/{name}")
    return df.select(*columns) if columns else df


def parse_play_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """S3: parse raw play-log lines (batch or streaming DataFrame).  Lines with more than 13 fields and blank
    lines are skipped, short lines are padded with NULLs, unparsable numbers/timestamps become NULL,
    ``contract_id`` is captured from the JSON text of field 12.  Other input columns are kept."""
    parts = F.split(F.col(value_col), "\t")
    rows = lines.where((F.trim(F.col(value_col)) != "") & (F.size(parts) <= K.PLAY_LOG_WIDTH)).withColumn("__p", parts)
    p = F.col("__p")
    cols = []
    for i, name in K.PLAY_LOG_FIELDS.items():
        v = F.try_element_at(p, F.lit(i + 1))
        if name == "DateEndTime":
            cols.append(to_ts(v).alias(name))
        elif name == "Duration":
            cols.append(to_double(v).alias(name))
        else:
            cols.append(to_long(v).alias(name))
    cols.append(json_text_field(F.try_element_at(p, F.lit(K.PLAY_LOG_JSON_FIELD + 1)), "contract_id").alias("contract_id"))
    keep = [F.col(c) for c in lines.columns if c != value_col]
    return rows.select(*cols, *keep)


def read_play_log(spark: SparkSession, path: str, with_file: bool = True) -> DataFrame:
    """Headerless TSV play log files (plain or .gz) under ``path``, parsed by :func:`parse_play_log`;
    ``source_file`` and ``file_date`` (the date in the file's path) are kept."""
    raw = spark.read.text(path)
    if with_file:
        raw = raw.select("value", F.col("_metadata.file_path").alias("source_file"))
        raw = raw.withColumn("file_date", file_date(F.regexp_extract("source_file", r".*(\d{4}-\d{2}-\d{2})", 1)))
    return parse_play_log(raw)


def read_dictionary(spark: SparkSession, path: str, known_types=K.KNOWN_RESOURCE_TYPES) -> tuple[DataFrame, DataFrame]:
    """``id, name, flag, type`` TSV.  Returns (ok, rejects): blank lines are ignored, lines with fewer
    than 4 fields or a non-digit id are rejects (with a reason), unknown types are dropped from ``ok``."""
    raw = spark.read.text(path).select(F.col("value"), F.col("_metadata.file_name").alias("source_file"))
    line = F.regexp_replace(F.col("value"), r"[\r\n]+$", "")
    parts = F.split(line, "\t")
    lines = raw.where(F.trim(line) != "").select("value", "source_file", parts.alias("p"))
    ident = F.trim(F.col("p")[0])
    reason = (F.when(F.size("p") < 4, F.lit("fields")).when(~ident.rlike(r"^\d+$"), F.lit("id")))
    tagged = lines.withColumn("reason", reason)
    rejects = tagged.where(F.col("reason").isNotNull()).select("value", "source_file", "reason")
    ok = (tagged.where(F.col("reason").isNull())
                .select(ident.alias("id"), F.trim(F.col("p")[1]).alias("name"), F.trim(F.col("p")[3]).alias("type"),
                        "source_file")
                .where(F.col("type").isin(list(known_types))))
    return ok, rejects


def read_two_columns(spark: SparkSession, path: str) -> DataFrame:
    """The first two columns of headed TSV files, whatever their header calls them: (id, val, src_file, file_date)."""
    csv = spark.read.option("header", True).option("sep", "\t").csv(path)
    a, b = csv.columns[:2]
    return csv.select(F.col(f"`{a}`").alias("id"), F.col(f"`{b}`").alias("val"), F.col("_metadata.file_path").alias("src_file"),
                      file_date(F.regexp_extract(F.col("_metadata.file_path"), r".*(\d{4}-\d{2}-\d{2})", 1)).alias("file_date"))


ARCHIVE_NAME = r"resources-\d{4}-\d{2}-\d{2}\.txt(\.gz)?"


def read_dictionary_files(spark: SparkSession, directory: str, name_pattern: str = ARCHIVE_NAME) -> DataFrame:
    """The valid rows of every dated dictionary file under a directory (flat ``resources-YYYY-MM-DD.txt(.gz)``
    files, or folders of that name holding part files), with ``source_file`` and ``file_date``.  Paths without
    such a name are ignored."""
    raw = (spark.read.option("recursiveFileLookup", True).text(directory)
                .select("value", F.col("_metadata.file_path").alias("source_file")))
    raw = raw.where(F.col("source_file").rlike(name_pattern))
    last_date = F.regexp_extract(F.col("source_file"), r".*(\d{4}-\d{2}-\d{2})", 1)
    parts = F.split(F.regexp_replace("value", r"[\r\n]+$", ""), "\t")
    rows = raw.select(parts.alias("p"), F.regexp_extract("source_file", ".*/(" + name_pattern + ")", 1).alias("source_file"),
                      F.try_to_timestamp(F.nullif(last_date, F.lit("")), F.lit("yyyy-MM-dd")).cast("date").alias("file_date"))
    ok = (rows.where((F.size("p") >= 4) & F.trim(F.col("p")[0]).rlike(r"^\d+$") & F.col("file_date").isNotNull())
              .select(F.trim(F.col("p")[0]).alias("id"), F.trim(F.col("p")[1]).alias("name"),
                      F.trim(F.col("p")[3]).alias("type"), "source_file", "file_date")
              .where(F.col("type").isin(list(K.KNOWN_RESOURCE_TYPES))))
    return ok


def read_dictionary_archive(spark: SparkSession, directory: str, name_pattern: str = ARCHIVE_NAME) -> DataFrame:
    """The archive merged newest-wins per id, independent of read order (grouped ``max_by``)."""
    ok = read_dictionary_files(spark, directory, name_pattern)
    return latest_by(ok, ["id"], "file_date", ["name", "type", "source_file"])


def latest_file_rows(df: DataFrame, date_col: str = "file_date") -> DataFrame:
    """Rows of the newest file only (max date as a scalar subquery)."""
    newest = df.select(F.max(date_col)).scalar()
    return df.where(F.col(date_col) == newest)


def read_csv_bootstrap(spark: SparkSession, path: str) -> DataFrame:
    """Historical CSV with a header; missing columns are added as NULL, the projection is fixed."""
    df = spark.read.option("header", True).csv(path)
    cols = []
    text_cols = ("DateEnd", "timeslot_label", "contract_id")
    for c in K.PLAY_LOG_CSV_COLUMNS:
        if c not in df.columns:
            t = "string" if c in text_cols else "double" if c == "Duration" else "bigint"
            cols.append(F.lit(None).cast(t).alias(c))
        elif c in text_cols:
            cols.append(F.col(c))
        elif c == "Duration":
            cols.append(to_double(c).alias(c))
        else:
            cols.append(to_long(c).alias(c))
    return df.select(*cols)


ENVELOPE_PATHS = ["$.data", "$.proposal_items", "$.data.proposal_items", "$.d.results", "$.items", "$.list",
                  "$.contents", "$.reservation"]

# FIXED VALUES: keys tried, in order, by the screen-management API reader (S12), and the keys tried inside an
# object found under one of them.
POLY_KEYS = ["items", "list", "contents", "deviceListBaseBean", "data"]
POLY_SUBKEYS = ["items", "list", "contents"]
# A top-level array first; then, per key, the array under it or under one of its sub-keys.
POLYMORPHIC_PATHS = ["$"] + [p for k in POLY_KEYS for p in [f"$.{k}"] + [f"$.{k}.{sk}" for sk in POLY_SUBKEYS]]


def read_paged_json(spark: SparkSession, path: str, item_schema: str, paths: list[str] = ENVELOPE_PATHS,
                    per_file: bool = False) -> DataFrame:
    """API pages saved as JSON (one envelope per line, or per file with ``per_file``); the record
    array is taken from whichever envelope path is present and each record is typed by ``item_schema``."""
    raw = spark.read.text(path, wholetext=per_file).select("value", F.col("_metadata.file_name").alias("page_file"))
    items = unwrap(raw, "value", paths)
    typed = items.select("page_file", F.from_json(F.to_json(F.col("item")), item_schema).alias("r"))
    return typed.select("r.*", "page_file")


def read_run_log(spark: SparkSession, path: str, tagged: bool = False) -> DataFrame:
    """The lines of run logs that are not empty, with the log's name and the line's number in it (from 0).

    A log may be of any length: it is read in splits like any text, and numbered in two passes.  A split's lines come in
    order, so their ids ascend without gaps; a line's number is its place in its split plus the lines of the splits
    before it in the file (prefix sums over one row for each split).  The lines are stored once, with their ids, so
    that both passes see the same splits.

    ``tagged``: a file holds many logs, and each line begins with its log's name and a tab; the numbers, which count the
    file's lines, then ascend within each log.  Files are as many as the data needs, however many logs there are."""
    raw = spark.read.option("lineSep", "\n").text(path)
    own = [c for c in raw.columns if c != "value"]  # folder columns
    lines = store(raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                             F.monotonically_increasing_id().alias("id"), F.col("_metadata.file_name").alias("log"), *own, "value"),
                  "run-log")
    split = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    split = split.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).drop("first", "n")
    # few rows, one for each split: nothing of the lines is shuffled for them while they are few
    numbered = lines.join(store(split, "run-log-splits"), ["file", "block"])
    log, value = F.col("log"), F.col("value")
    if tagged:
        log, value = F.substring_index(value, "\t", 1), F.regexp_replace(value, r"^[^\t]*\t", "")
    return numbered.select(log.alias("log"), (F.col("id") + F.col("base")).alias("line_no"), *own,
                           F.regexp_replace(value, r"\r$", "").alias("value")).where("value <> ''")


def index_files(pages: DataFrame, html_col: str = "html", prefix: str = "playlog-",
                suffixes: tuple[str, ...] = (".txt", ".txt.gz")) -> DataFrame:
    """Data files linked from HTML index pages.  Every ``href`` is extracted (one row per link),
    kept when its file name starts with ``prefix`` and ends with a listed suffix, dated from its name, and per
    date the plain file is preferred over the ``.gz`` copy."""
    from ..operators.rollup import dedup
    links = pages.select(F.explode(F.regexp_extract_all(F.col(html_col), F.lit(r'href="([^"]+)"'), 1)).alias("href"))
    name = F.regexp_extract(F.col("href"), r"([^/]+)$", 1)
    ok = F.lit(False)
    for sfx in suffixes:
        ok = ok | name.endswith(sfx)
    files = (links.select(name.alias("file")).where(F.col("file").startswith(prefix) & ok).distinct()
                  .withColumn("file_date", file_date(F.col("file")))
                  .where(F.col("file_date").isNotNull())
                  .withColumn("is_gz", F.col("file").endswith(".gz")))
    return dedup(files, ["file_date"], order=["is_gz", "file"]).drop("is_gz")
