"""Structured Streaming forms of the incremental loads.

* T1 file discovery: a file-source stream over the landing folder; the checkpoint remembers which files
  were processed, ``Trigger.AvailableNow`` drains what is there and stops (the daily batch run).
* T2 hourly roll-up: event-time ``window(ts, '1 hour')`` with a watermark bounding the state.
* T3 late data / re-delivered day: ``foreachBatch`` -> replace the batch's days (idempotent per batch).
* T4 shrinking source window: ``foreachBatch`` -> key upsert.

Checkpoints live under the shared ``spark.checkpoint.dir`` so a restarted driver resumes exactly.
"""
from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import match_keys
from ..operators.rollup import hourly_rollup
from ..session import cut_lineage, scratch_path
from ..sources import sinks


def landing_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                   max_files: int | None = None) -> DataFrame:
    """Stream of the rows of new files in ``path`` (schema declared, no inference)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def hourly_window_counts(stream: DataFrame, ts: str, keys: list[str], value: str, watermark: str = "2 hours") -> DataFrame:
    """Per (hour window, keys): plays and summed value; state older than the watermark is dropped.

    Plays behind the watermark are not in the counts.  :func:`run_available_now` reports how many (window, key) groups
    of them there were; :func:`hourly_day_batches` counts them, too."""
    return (stream.withWatermark(ts, watermark)
                  .groupBy(F.window(ts, "1 hour").alias("w"), *keys)
                  .agg(F.count(F.lit(1)).alias("emisje"), F.sum(value).alias("Duration"))
                  .select(F.col("w.start").alias("window_start"), *keys, "emisje", "Duration"))


def run_available_now(df: DataFrame, batch_fn, name: str, checkpoint: str | None = None,
                      output_mode: str = "update", timeout_s: int | None = None, late: list | None = None) -> str:
    """Drain a stream with ``Trigger.AvailableNow`` through ``batch_fn(batch_df, epoch_id)``; returns the
    checkpoint path (reuse it to resume).  It ends when everything is drained, unless ``timeout_s`` sets a limit.
    ``late`` gets the number of groups of rows that the watermark has dropped in this call, also when it fails."""
    spark = df.sparkSession
    checkpoint = checkpoint or scratch_path(spark, f"ckpt-{name}")
    dropped, query, started = {}, [], threading.Event()

    def note(progress) -> None:
        if progress:
            n = sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])
            dropped[progress["batchId"]] = max(n, dropped.get(progress["batchId"], 0))

    def counted(batch: DataFrame, epoch_id: int) -> None:
        # a query keeps its last progress reports only, so the one of the batch before is read here
        started.wait()
        note(query[0].lastProgress)
        batch_fn(batch, epoch_id)

    q = (df.writeStream.outputMode(output_mode).foreachBatch(batch_fn if late is None else counted)
           .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.append(q)
    started.set()
    try:
        finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination() is None
        if not finished:
            q.stop()
            raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
        if q.exception():
            raise q.exception()
    finally:
        if late is not None:
            for progress in q.recentProgress:
                note(progress)
            late.append(sum(dropped.values()))
    return checkpoint


EPOCH = "__epoch"


def hourly_day_batches(table_path: str, ts: str, keys: list[str], value: str, watermark: str = "2 hours"):
    """T2/T3 without loss: foreachBatch function over raw rows that keeps hourly counts by day and counts late rows as well.

    Each batch is rolled up by (hour, keys) and replaces its own part of the days that it has rows for; the counts of the
    batches before it in those days are folded into one row for each key.  Rows in time touch the last day or two; rows
    behind the high-water mark of the earlier batches (the greatest event time less ``watermark``) rewrite their own days,
    and how many (hour, key) groups they make is kept with the mark.  A batch that is run again after a failure finds its
    earlier rows by its number and replaces them.  No row is read twice from the landing folder.  :func:`read_hourly` gives
    the counts, :func:`late_groups` the late ones.  The table belongs to one checkpoint: a new one would number its batches
    from 0 again, which is refused."""
    marks_path = f"{table_path.rstrip('/')}__marks"

    def fn(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        marks = spark.read.schema(f"mark timestamp, late bigint, {EPOCH} bigint").parquet(marks_path) \
            if sinks.table_exists(spark, marks_path) else None
        before, last = (None, -1) if marks is None else \
            marks.agg(F.max(F.when(F.col(EPOCH) < epoch_id, F.col("mark"))), F.max(EPOCH)).first()
        if last > epoch_id:
            raise ValueError(f"{table_path} holds batch {last} of another checkpoint; this one is at {epoch_id}")
        rows = batch.withColumn("window_start", F.date_trunc("hour", F.col(ts)))
        part = cut_lineage(rows.groupBy("window_start", *keys).agg(F.count(F.lit(1)).alias("emisje"), F.sum(value).alias("Duration"),
                                                                   F.max(F.col(ts).cast("timestamp")).alias("newest"))
                           .withColumn("day", F.date_format("window_start", "yyyy-MM-dd")))
        if part.isEmpty():
            return
        behind = F.col("window_start") + F.expr("INTERVAL 1 HOUR") <= F.lit(before) - F.expr(f"INTERVAL {watermark}")
        newest, late = part.agg(F.max("newest"), F.count_if(behind) if before else F.lit(0).cast("bigint")).first()
        own = part.drop("newest").withColumn(EPOCH, F.lit(epoch_id).cast("bigint"))
        if sinks.table_exists(spark, table_path):
            old = match_keys(sinks.stored_table(spark, table_path).where(F.col(EPOCH) < epoch_id), own.select("day"), "day", "left_semi")
            folded = old.groupBy("day", "window_start", *keys).agg(F.sum("emisje").alias("emisje"), F.sum("Duration").alias("Duration"),
                                                                   F.max(EPOCH).alias(EPOCH))
            sinks._replace_parts(cut_lineage(own.unionByName(folded)), table_path, "day")
        else:
            sinks.write_new(own, table_path, "day")
        mark = max(m for m in (before, newest) if m is not None) if before or newest else None
        noted = spark.createDataFrame([(mark, late, epoch_id)], f"mark timestamp, late bigint, {EPOCH} bigint").coalesce(1)
        noted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(EPOCH).parquet(marks_path)
    return fn


def read_hourly(spark: SparkSession, table_path: str) -> DataFrame:
    """The counts that :func:`hourly_day_batches` keeps: one row for each hour and key."""
    df = sinks.stored_table(spark, table_path)
    keys = [c for c in df.columns if c not in ("day", "emisje", "Duration", EPOCH)]
    return df.groupBy(*keys).agg(F.sum("emisje").alias("emisje"), F.sum("Duration").alias("Duration"))


def late_groups(spark: SparkSession, table_path: str) -> int:
    """How many (hour, key) groups came behind the mark, over all batches."""
    marks = spark.read.schema(f"late bigint, {EPOCH} bigint").parquet(f"{table_path.rstrip('/')}__marks")
    return marks.agg(F.coalesce(F.sum("late"), F.lit(0))).first()[0]


def upsert_batches(table_path: str, keys: list[str], buckets: int | None = None):
    """T4: foreachBatch function that upserts each micro-batch into ``table_path`` by ``keys`` (``buckets``: see
    :func:`~playledger.sources.sinks.write_upsert`; a micro-batch rewrites only the buckets it touches)."""
    def fn(batch: DataFrame, epoch_id: int) -> None:
        sinks.write_upsert(batch.sparkSession, batch, table_path, keys, buckets=buckets)
    return fn


def replace_day_batches(table_path: str, date_col: str):
    """foreachBatch function replacing the days present in each micro-batch."""
    def fn(batch: DataFrame, epoch_id: int) -> None:
        sinks.write_replace_days(batch.sparkSession, batch, table_path, date_col)
    return fn


def play_log_file_stream(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Raw TSV play-log files arriving in ``landing`` (plain or .gz), parsed line by line; every row keeps
    the date of the file it came from (``file_date``, from the file path)."""
    from ..functions.names import file_date
    from ..sources.readers import parse_play_log
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    raw = r.load(landing).select("value", F.col("_metadata.file_path").alias("source_file"))
    raw = raw.withColumn("file_date", F.date_format(file_date(F.regexp_extract("source_file", r".*(\d{4}-\d{2}-\d{2})", 1)),
                                                   "yyyy-MM-dd"))
    return parse_play_log(raw)


def ingest_play_log_batches(table_path: str, keys: list[str], sums: dict):
    """C1 per micro-batch: hourly roll-up by file, then the files' days.

    A day's rows are those of the day's own file.  Rows that another file carries for the day (plays that end past
    midnight) count only as long as the day's own file has not been loaded, so the result does not depend on which
    files share a batch.  A file delivered again replaces all its rows.  The table is partitioned by day and keeps
    ``file_date``; only the files' days and the days beside them are rewritten."""
    def fn(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        agg = cut_lineage(hourly_rollup(batch, [*keys, "file_date"], ts="DateEndTime", sums=sums, scale=None)
                          .drop("timeslot_label"))
        files = cut_lineage(batch.select("file_date").distinct())
        first = not sinks.table_exists(spark, table_path)
        rows = agg
        if not first:
            stored = sinks.stored_table(spark, table_path, agg.schema)
            beside = files.select(F.explode(F.array(*[F.date_format(F.date_add(F.to_date("file_date"), d), "yyyy-MM-dd")
                                                      for d in (-1, 0, 1)])).alias("DateEnd"))
            touched = beside.union(agg.select("DateEnd")).distinct()
            old = match_keys(match_keys(stored, touched, "DateEnd", "left_semi"), files, "file_date", "left_anti")
            rows = old.unionByName(agg, allowMissingColumns=True)
        own = rows.where("file_date = DateEnd").select("DateEnd").union(files).distinct()
        spill = rows.where(~F.col("file_date").eqNullSafe(F.col("DateEnd")))
        kept = rows.where("file_date = DateEnd").unionByName(match_keys(spill, own, "DateEnd", "left_anti"))
        if first:
            sinks.write_new(kept, table_path, "DateEnd")
        else:
            sinks._replace_parts(cut_lineage(kept), table_path, "DateEnd")
    return fn
