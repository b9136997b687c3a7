"""Structured Streaming semantics: hourly windows with a watermark across AvailableNow runs sharing a checkpoint."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from playledger.plans import q_io
from playledger.session import scratch_path
from playledger.sources import sinks as SK
from playledger.streaming import stream as ST

SCHEMA = "ts timestamp, kind string, value double"


def test_watermark_drops_late_plays(spark):
    land, table, ckpt = scratch_path(spark, "wm-land"), scratch_path(spark, "wm-tbl"), scratch_path(spark, "wm-ckpt")
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    first = [(t(10, 5), "a", 1.0), (t(11, 10), "a", 2.0), (t(12, 40), "a", 3.0)]
    spark.createDataFrame(first, SCHEMA).write.mode("append").parquet(land)

    late = []

    def run():
        counts = ST.hourly_window_counts(ST.landing_stream(spark, land, SCHEMA), "ts", ["kind"], "value", watermark="1 hour")
        ST.run_available_now(counts, ST.upsert_batches(table, ["window_start", "kind"]), "wm", ckpt, late=late)

    run()
    # the next delivery: one play far behind the watermark (12:40 - 1 h), one on time
    spark.createDataFrame([(t(8, 30), "a", 9.0), (t(12, 50), "a", 4.0)], SCHEMA).write.mode("append").parquet(land)
    run()
    got = {r.window_start.hour: (r.emisje, r.Duration) for r in SK.read_upserted(spark, table).collect()}
    assert 8 not in got and late[0] == 0 and late[1] >= 1  # late play dropped by the watermark, and reported
    assert got[12] == (2, 7.0) and got[10] == (1, 1.0) and got[11] == (1, 2.0)


def test_replace_day_stream_is_idempotent(spark):
    land, table, ckpt = scratch_path(spark, "rd-land"), scratch_path(spark, "rd-tbl"), scratch_path(spark, "rd-ckpt")
    schema = "id long, day string, v double"
    spark.createDataFrame([(1, "2024-01-01", 1.0), (2, "2024-01-02", 2.0)], schema).write.mode("append").parquet(land)
    ST.run_available_now(ST.landing_stream(spark, land, schema), ST.replace_day_batches(table, "day"), "rd", ckpt)
    spark.createDataFrame([(3, "2024-01-02", 5.0)], schema).write.mode("append").parquet(land)   # day 2 redelivered
    ST.run_available_now(ST.landing_stream(spark, land, schema), ST.replace_day_batches(table, "day"), "rd", ckpt)
    ST.run_available_now(ST.landing_stream(spark, land, schema), ST.replace_day_batches(table, "day"), "rd", ckpt)  # nothing new
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(table).select("id", "day", "v").collect())
    assert got == [(1, "2024-01-01", 1.0), (3, "2024-01-02", 5.0)]


def test_late_groups_of_many_batches(spark):
    land = scratch_path(spark, "many-land")
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    # Spark lets a row pass that only the watermark of its own batch excludes, so the third file is the first to be late
    for row in [(t(12, 40), "a", 1.0), (t(12, 45), "a", 1.0), (t(8, 30), "late", 1.0)]:
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(land)
    more = spark.range(0, 104, 1, 104).select(F.lit(t(12, 50)).alias("ts"), F.lit("a").alias("kind"), F.lit(1.0).alias("value"))
    more.write.mode("append").parquet(land)
    late, epochs = [], []
    counts = ST.hourly_window_counts(ST.landing_stream(spark, land, SCHEMA, max_files=1), "ts", ["kind"], "value", watermark="1 hour")
    ST.run_available_now(counts, lambda batch, epoch: epochs.append(epoch) or batch.write.format("noop").mode("append").save(), "many", late=late)
    assert len(epochs) > 100 and late == [1]   # dropped long before the query's last 100 progress reports


def test_late_groups_of_a_failed_run(spark):
    land, late = scratch_path(spark, "fail-land"), []
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    for row in [(t(12, 40), "a", 1.0), (t(12, 45), "a", 1.0), (t(8, 30), "late", 1.0), (t(12, 50), "a", 1.0)]:
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(land)

    def fn(batch, epoch):
        batch.write.format("noop").mode("append").save()
        if epoch == 3:
            raise ValueError("stop here")

    counts = ST.hourly_window_counts(ST.landing_stream(spark, land, SCHEMA, max_files=1), "ts", ["kind"], "value", watermark="1 hour")
    with pytest.raises(Exception, match="stop here"):
        ST.run_available_now(counts, fn, "fail", late=late)
    assert late == [1]


def test_stream_hourly_counts_late_plays(spark, tmp_path):
    """A week in several files of mixed hours, read two files at a time."""
    rows = [(f * 2 + k, dt.datetime(2024, 1, 1 + 5 * k, 0, 30), f, "view", 1.0, None) for f in range(16) for k in (0, 1)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    events = spark.createDataFrame(rows, schema)
    for f in range(16):
        events.where(F.col("user_id") == f).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")   # each file is a partition, so each week lands in 16 files
    try:
        got = sorted((r.window_start, r.emisje, r.Duration) for r in q_io.q_stream_hourly(spark, str(tmp_path)).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [("2024-01-01 00:00:00", 16, 16.0), ("2024-01-06 00:00:00", 16, 16.0)]
