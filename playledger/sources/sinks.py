"""Writers for the refresh strategies (M1-M4, M10-M12): thin persistence around the pure merges.

A batch is computed once: it is cut from its lineage with a reliable checkpoint in the shared ``spark.checkpoint.dir``
(survives executor loss), or staged.  Reading and overwriting the same table is never done in one plan.  A whole table
is replaced by writing the new copy beside it and swapping the two by name; parts of one by dynamic partition
overwrite, which stages the new files and moves them when the job commits.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge as M
from ..session import cut_lineage, path_of


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there; any other trouble with it (access, damaged files) is an error where it is read."""
    fs, at = path_of(spark, path)
    return fs.exists(at)


def _layout(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Rows of a partition value together, large values in several even parts: few files for each."""
    return df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by]) if partition_by else df


def _stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    staged = f"{path.rstrip('/')}__staged_{uuid.uuid4().hex[:12]}"
    w = _layout(df, partition_by).write.mode("errorifexists")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(staged)
    return staged


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    """Put the staged copy in the table's place.  The old copy goes last: a failure in between leaves both on disk."""
    fs, new = path_of(spark, staged)
    _, at = path_of(spark, path)
    _, old = path_of(spark, staged.replace("__staged_", "__old_"))
    had = fs.exists(at)
    if had and not fs.rename(at, old):
        raise OSError(f"cannot move the old table {path}")
    if not fs.rename(new, at):
        if had:
            fs.rename(old, at)
        raise OSError(f"cannot move {staged} to {path}")
    if had:
        fs.delete(old, True)


def write_guarded(df: DataFrame, path: str, partition_by: list[str] | None = None) -> bool:
    """Replace the whole table unless the batch is empty (an empty refetch never replaces data).  Returns
    whether it wrote.  The batch is computed once, into the staged copy; days that it lacks are gone afterwards."""
    spark = df.sparkSession
    staged = _stage(df, path, partition_by)
    if spark.read.schema(df.schema).parquet(staged).isEmpty():
        fs, at = path_of(spark, staged)
        fs.delete(at, True)
        return False
    _swap(spark, staged, path)
    return True


def _note_file(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/_{name}"  # a leading underscore keeps it out of the data


def _write_note(spark: SparkSession, path: str, name: str, text: str) -> None:
    fs, at = path_of(spark, _note_file(path, name))
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_note(spark: SparkSession, path: str, name: str) -> str | None:
    fs, at = path_of(spark, _note_file(path, name))
    if not fs.exists(at):
        return None
    held = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
    finally:
        held.close()


def _note_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keep a table's schema beside its files: the columns known so far and, at the end, new ones.  Written before the data
    that has them: a column without data reads as NULL."""
    known = _read_note(spark, path, "schema")
    old = T.StructType.fromJson(json.loads(known)) if known else T.StructType([])
    more = [f for f in schema.fields if f.name not in old.names]
    if more:
        _write_note(spark, path, "schema", T.StructType(old.fields + more).json())


def stored_table(spark: SparkSession, path: str, typed: T.StructType | None = None) -> DataFrame:
    """The table at ``path`` with its own columns, whichever of its files have them, by the schema kept beside it; without
    one, all files are asked.  Columns of ``typed`` that make up the folder names keep their declared type."""
    known = _read_note(spark, path, "schema")
    if known:
        return spark.read.schema(T.StructType.fromJson(json.loads(known))).parquet(path)
    schema = spark.read.option("mergeSchema", "true").parquet(path).schema
    declared = {f.name: f.dataType for f in typed.fields} if typed else {}
    fields = [T.StructField(f.name, declared.get(f.name, f.dataType)) for f in schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _replace_parts(rows: DataFrame, path: str, part: str) -> None:
    """Replace the partitions that ``rows`` has; all others stay as they are."""
    (_layout(rows, [part]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(part).parquet(path))


def write_new(rows: DataFrame, path: str, part: str) -> None:
    """Create a table partitioned by ``part``, whole or not at all."""
    staged = _stage(rows, path, [part])
    _note_schema(rows.sparkSession, staged, rows.schema)
    _swap(rows.sparkSession, staged, path)


def replace_partitions(rows: DataFrame, path: str, part: str, touched: DataFrame) -> None:
    """Replace the partitions listed in ``touched`` (one column, ``part``) by what ``rows`` has for them, which may be
    nothing; ``rows`` is a stored frame and has no other partitions.  All other partitions keep their files."""
    _replace_parts(rows, path, part)
    spark = rows.sparkSession
    for r in M.match_keys(touched.select(part).distinct(), rows.select(part).distinct(), part, "left_anti").toLocalIterator():
        fs, at = path_of(spark, f"{path.rstrip('/')}/{part}={'__HIVE_DEFAULT_PARTITION__' if r[0] is None else r[0]}")
        fs.delete(at, True)


BUCKET_COL = "__bucket"
#: Rows that a bucket should hold; twice as many make the table grow.
ROWS_PER_BUCKET = 1_000_000
#: Blocks of neighbouring whole-number keys in a bucket.
BLOCKS_PER_BUCKET = 8


def _buckets(spark: SparkSession, path: str) -> dict:
    return json.loads(_read_note(spark, path, "buckets"))


def bucket_count(spark: SparkSession, path: str) -> int:
    """The present bucket count of a table of :func:`write_upsert`."""
    return _buckets(spark, path)["n"]


def _bucket_of(keys: list[str], spec: dict):
    """The bucket of a key.  Where the first key is a whole number it counts by blocks of neighbours, so that a batch of
    neighbouring ids lies in few buckets."""
    head = F.col(f"`{keys[0]}`")
    parts = [F.floor(head / spec["block"])] if spec["block"] else [F.col(f"`{k}`") for k in keys]
    return F.pmod(F.xxhash64(*parts), F.lit(spec["n"])).cast("int")


def _new_buckets(rows: DataFrame, keys: list[str], n: int | None, fixed: bool) -> dict:
    """The bucket count and, for whole-number keys, the width of a block of neighbours: about an eighth of a bucket's rows."""
    whole = isinstance(rows.schema[keys[0]].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    key = F.col(f"`{keys[0]}`") if whole else F.lit(None).cast("bigint")
    many, lo, hi = rows.agg(F.count(F.lit(1)), F.min(key), F.max(key)).first()
    n = n or max(1, -(-many // ROWS_PER_BUCKET))
    if lo is None:
        return {"n": n, "block": 0, "fixed": fixed, "rows": many}
    share = n if fixed else max(1, many / ROWS_PER_BUCKET)
    return {"n": n, "block": max(1, int((hi - lo + 1) / share / BLOCKS_PER_BUCKET)), "fixed": fixed, "rows": many}


def write_upsert(spark: SparkSession, new: DataFrame, path: str, keys: list[str], order: list | None = None,
                 buckets: int | None = None, expected_rows: int | None = None) -> None:
    """M2/M5: key upsert into a Parquet table (created by the first batch).

    The table is partitioned by a bucket of the key; a batch reads and replaces only the buckets it touches: of whole-number
    keys those of the keys' neighbourhoods, of others, by hash, as many as it has keys.  ``buckets`` fixes their number for
    good (another one is refused later).  Otherwise there is one for each million of ``expected_rows``, or of the first
    batch's rows, and when they hold more than two million rows on average, the table is dealt into eight times as many,
    as a staged copy that takes its place.  NULL keys are keys like any other, and columns that the batch lacks are
    kept (NULL in its rows)."""
    batch = cut_lineage(new)
    if batch.isEmpty():
        return
    if not table_exists(spark, path):
        spec = _new_buckets(batch, keys, buckets or (expected_rows and -(-expected_rows // ROWS_PER_BUCKET)), buckets is not None)
        once = M.upsert(batch.limit(0), batch, keys, order=order).withColumn(BUCKET_COL, _bucket_of(keys, spec))
        _put_buckets(spark, once, path, spec)
        return
    spec = _buckets(spark, path)
    if buckets not in (None, spec["n"]):
        raise ValueError(f"{path} has {spec['n']} buckets, not {buckets}")
    batch = batch.withColumn(BUCKET_COL, _bucket_of(keys, spec))
    _note_schema(spark, path, batch.schema)
    touched = cut_lineage(batch.select(BUCKET_COL).distinct())
    old = stored_table(spark, path).join(touched, BUCKET_COL, "left_semi")
    merged = cut_lineage(M.upsert(old, batch, keys, order=order))
    spec["rows"] += merged.count() - old.count()
    _replace_parts(merged, path, BUCKET_COL)
    if spec["fixed"] or spec["rows"] <= 2 * ROWS_PER_BUCKET * spec["n"]:
        _write_note(spark, path, "buckets", json.dumps(spec))
        return
    table = stored_table(spark, path)
    spec = _new_buckets(table, keys, 4 * -(-spec["rows"] // ROWS_PER_BUCKET), False)
    _put_buckets(spark, table.withColumn(BUCKET_COL, _bucket_of(keys, spec)), path, spec)


def _put_buckets(spark: SparkSession, rows: DataFrame, path: str, spec: dict) -> None:
    """Put ``rows`` (with their bucket) in the table's place, whole or not at all."""
    staged = _stage(rows, path, [BUCKET_COL])
    _write_note(spark, staged, "buckets", json.dumps(spec))
    _note_schema(spark, staged, rows.schema)
    _swap(spark, staged, path)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """A table written by :func:`write_upsert`, without its bucket column."""
    return stored_table(spark, path).drop(BUCKET_COL)


def write_replace_days(spark: SparkSession, new: DataFrame, path: str, date_col: str,
                       dates: list | DataFrame | None = None) -> None:
    """Date-partitioned table; the batch's dates (or ``dates``) are replaced and every other partition stays
    untouched.  Rows the batch carries for other dates are appended to those dates' existing rows.  Rows without a
    date are kept and added to (see :func:`~playledger.operators.merge.replace_dates`)."""
    batch = cut_lineage(new)
    if not table_exists(spark, path):
        write_new(batch, path, date_col)
        return
    touched = batch.select(date_col).distinct()
    _note_schema(spark, path, batch.schema)
    old = M.match_keys(stored_table(spark, path, batch.schema), touched, date_col, "left_semi")
    _replace_parts(cut_lineage(M.replace_dates(old, batch, date_col, dates)), path, date_col)


def export_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    """Delimited text export (one file per task; no single-file funnel)."""
    df.write.mode("overwrite").option("sep", sep).option("header", header).csv(path)


def export_text(df: DataFrame, path: str, compression: str | None = None) -> None:
    w = df.write.mode("append")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def stamp_now(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def import_historical(spark: SparkSession, csv_path: str, table_path: str) -> bool:
    """Bootstrap a play-log table from a historical CSV, only when the table is missing or empty (a
    second call never overwrites loaded data).  Returns whether it imported."""
    from .readers import read_csv_bootstrap
    if table_exists(spark, table_path) and not spark.read.parquet(table_path).isEmpty():
        return False
    _swap(spark, _stage(read_csv_bootstrap(spark, csv_path), table_path), table_path)
    return True


def replace_with_guard(spark: SparkSession, new: DataFrame, path: str, ratio: float = 0.9, force: bool = False,
                       snapshot_date: str | None = None) -> bool:
    """Replace the table at ``path`` only if the new copy has at least ``ratio`` x its rows (or ``force``);
    with ``snapshot_date`` the new copy is also kept as ``<path>_snapshots/snapshot_date=<date>``.  Returns
    whether it replaced."""
    staged = _stage(new, path)
    copy = spark.read.schema(new.schema).parquet(staged)
    if table_exists(spark, path) and not M.shrink_check(spark.read.parquet(path), copy, ratio, force).first()["ok"]:
        fs, at = path_of(spark, staged)
        fs.delete(at, True)
        return False
    if snapshot_date:
        copy.write.mode("overwrite").parquet(f"{path.rstrip('/')}_snapshots/snapshot_date={snapshot_date}")
    _swap(spark, staged, path)
    return True
