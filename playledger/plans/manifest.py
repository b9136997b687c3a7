"""Loading the files of a landing folder that are new or have changed, by a stored manifest.

The manifest holds one row for each file loaded: its name, size, and the days that its rows fell on.  A run lists the
folder, takes the files whose size differs from the manifest's, rolls them up and writes, in this order,

1. the data: the rows of those files, by file, in place of what the same files brought before,
2. the manifest.

A run that dies in between leaves data that the next run replaces by the same rows, since the manifest still shows the
files as changed.  Files already in the manifest are not read again, so an interrupted first load resumes where it was.
Rows keep the name of their file; :func:`read_loaded` sums them over the files (M9), as several files may bring rows of
one day.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import changed_files, match_keys
from ..operators.rollup import hourly_rollup
from ..session import store
from ..sources import sinks as SK
from ..sources.readers import parse_play_log

MANIFEST = "file string, size bigint, days array<string>"
#: Rows that carry no day of their own lie in the folder of this day.
NO_DAY = "undated"


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(file, path, size) of the files in ``folder``: the binary-file source with everything but their bytes."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return found.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "path", F.col("length").alias("size"))


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    if SK.table_exists(spark, manifest_path):
        return spark.read.schema(MANIFEST).parquet(manifest_path)
    return spark.createDataFrame([], MANIFEST)


def roll_up_lines(lines: DataFrame) -> DataFrame:
    """The raw lines (value, file) of play-log files: plays by hour, keys and file."""
    keys = ["PlayerID", "AdCopyId", "CampID", "FrameID", "DisplayUnitID", "contract_id"]
    out = hourly_rollup(parse_play_log(lines), [*keys, "file"], ts="DateEndTime",
                        sums={"Duration": "Duration", "Impresje": "Impresje"}, scale=None)
    return out.drop("timeslot_label")


def load_changed_files(spark: SparkSession, folder: str, table_path: str, manifest_path: str, pattern: str = "playlog-*",
                       roll_up: Callable[[DataFrame], DataFrame] = roll_up_lines, day_col: str = "DateEnd",
                       before_manifest: Callable[[], None] | None = None) -> DataFrame:
    """One run; returns (file, size, status) of all files listed, status being new, update or skip.

    The table is partitioned by ``day_col``.  A changed file's old rows lie in the days that the manifest has for it, its
    new ones in the days it has now: only these partitions are rewritten, whatever the table's size.  ``before_manifest``
    runs between the two commits (tests stop a run there)."""
    seen = read_manifest(spark, manifest_path)
    listed = store(changed_files(list_files(spark, folder, pattern), seen), "listing")
    todo = listed.where("status <> 'skip'")
    # names only: the reader's own file index is on the driver as well
    paths = [r.path for r in todo.select("path").toLocalIterator()]
    if not paths:
        return listed.select("file", "size", "status")
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("file"))
    rows = store(roll_up(lines).withColumn(day_col, F.coalesce(F.col(day_col), F.lit(NO_DAY))), "rolled")
    if SK.table_exists(spark, table_path):
        gone = seen.join(todo.select("file"), "file", "left_semi").select(F.explode("days").alias(day_col))
        touched = gone.union(rows.select(day_col)).distinct()
        old = match_keys(SK.stored_table(spark, table_path, rows.schema), touched, day_col, "left_semi")
        kept = match_keys(old, todo.select("file"), "file", "left_anti")
        SK.replace_partitions(store(kept.unionByName(rows, allowMissingColumns=True), "merged"), table_path, day_col, store(touched, "touched"))
    else:
        SK.write_new(rows, table_path, day_col)
    if before_manifest:
        before_manifest()
    days = rows.groupBy("file").agg(F.sort_array(F.collect_set(day_col)).alias("days"))  # a file holds a day, and spills into few
    done = todo.select("file", "size").join(days, "file", "left").withColumn("days", F.coalesce("days", F.array().cast("array<string>")))
    SK.write_guarded(match_keys(seen, todo.select("file"), "file", "left_anti").unionByName(done), manifest_path)
    return listed.select("file", "size", "status")


def read_loaded(spark: SparkSession, table_path: str, sums: tuple[str, ...] = ("Duration", "Impresje", "emisje"),
                day_col: str = "DateEnd") -> DataFrame:
    """M9: the table's rows summed over the files."""
    df = SK.stored_table(spark, table_path)
    df = df.withColumn(day_col, F.nullif(F.col(day_col).cast("string"), F.lit(NO_DAY)))
    keys = [c for c in df.columns if c not in (*sums, "file")]
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums if c in df.columns])
