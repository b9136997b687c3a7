"""Changed files by a manifest, facts brought up to changed days, control tables of one run, late rows of a stream."""
import datetime as dt
import glob
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from playledger.plans import manifest as MF
from playledger.plans import refresh as RF
from playledger.plans.ingest import read_cursors, sync_control_tables
from playledger.plans.q_jobs import REFRESH_CFG, monthly_bronze
from playledger.session import scratch_path, scratch_scope, store
from playledger.sources import readers as RD
from playledger.sources import sinks as SK
from playledger.streaming import stream as ST
from tests.conftest import SF_SMALL


def line(player, when, camp, seconds="10"):
    return "\t".join([str(player), when, seconds, "1", "i", str(camp), "2", "3", "4", "a", "b", "c", '{"contract_id": "C1"}'])


def put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def files_of(path, part="*"):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path.removeprefix('file:')}/{part}/*.parquet")}


def test_changed_files(spark):
    folder = tempfile.mkdtemp(prefix="landing-")
    table, manifest = scratch_path(spark, "mf-table"), scratch_path(spark, "mf-manifest")

    def run(**kw):
        out = MF.load_changed_files(spark, folder, table, manifest, **kw)
        return {r.file: r.status for r in out.collect()}

    def plays():
        return sorted((r.DateEnd or "", r.CampID, r.emisje) for r in MF.read_loaded(spark, table).groupBy("DateEnd", "CampID").agg(F.sum("emisje").alias("emisje")).collect())

    one, two, three = (f"playlog-2024-01-0{d}.txt" for d in (1, 2, 3))
    put(folder, one, line(1, "2024-01-01 10:00:00", 7), line(1, "2024-01-02 00:10:00", 7), line(2, "no time", 8))
    put(folder, two, line(1, "2024-01-02 10:00:00", 7))
    put(folder, "other.txt", line(1, "2024-01-02 10:00:00", 99))
    assert run() == {one: "new", two: "new"}
    assert plays() == [("", 8, 1), ("2024-01-01", 7, 1), ("2024-01-02", 7, 2)]
    assert run() == {one: "skip", two: "skip"}
    # the first file comes again without its spill and its undated play, a third one is new; the run dies before the manifest
    put(folder, one, line(1, "2024-01-01 10:00:00", 7), line(1, "2024-01-01 11:00:00", 7), line(1, "2024-01-01 12:00:00", 7), line(3, "2024-01-01 12:00:00", 9))
    put(folder, three, line(1, "2024-01-03 10:00:00", 7))

    def die():
        raise InterruptedError

    with pytest.raises(InterruptedError):
        run(before_manifest=die)
    want = [("2024-01-01", 7, 3), ("2024-01-01", 9, 1), ("2024-01-02", 7, 1), ("2024-01-03", 7, 1)]
    assert plays() == want
    assert run() == {one: "update", two: "skip", three: "new"} and plays() == want
    # a file that brings one day touches that day's partition and no other
    before = files_of(table)
    put(folder, three, line(1, "2024-01-03 10:00:00", 7), line(1, "2024-01-03 11:00:00", 7))
    assert run()[three] == "update" and plays() == want[:3] + [("2024-01-03", 7, 2)]
    assert {p for p in before if "2024-01-03" not in p} == {p for p in files_of(table) if "2024-01-03" not in p}
    assert not glob.glob(f"{table.removeprefix('file:')}/DateEnd={MF.NO_DAY}")


def test_refresh_equals_full_build(spark):
    """The last day of the log among the changed ones, so the trim window moves."""
    cfg = {**REFRESH_CFG, "calendar_start": dt.date(2001, 9, 20), "calendar_end": dt.date(2001, 11, 5)}
    bronze = monthly_bronze(spark, SF_SMALL)
    bronze["play_logs"] = logs = store(bronze["play_logs"])
    days = ["2001-11-01", "2001-10-01", None]
    first = logs.where((F.col("DateEnd") != "2001-11-01") & ((F.col("DateEnd") != "2001-10-01") | (F.col("PlayerID") < 5)))
    first = first.unionByName(logs.limit(3).withColumn("DateEnd", F.lit(None).cast("string")))
    a, b = scratch_path(spark, "gold-a"), scratch_path(spark, "gold-b")
    RF.build_all(spark, {**bronze, "play_logs": first}, a, cfg)
    before = files_of(f"{a}/fact_play_logs")
    old_days = RF._day_list(RF.read_fact(spark, f"{a}/fact_health"))
    replaced = RF.refresh_days(spark, bronze, days, a, cfg)
    RF.build_all(spark, bronze, b, cfg)
    for name in ("fact_play_logs", "fact_campaign_budget", "fact_health"):
        got, want = (RF.read_fact(spark, f"{r}/{name}").drop("_gold_at") for r in (a, b))
        want = want.select(*got.columns)
        assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), name
    assert set(RF._day_list(RF.read_fact(spark, f"{a}/fact_health"))) != set(old_days)
    kept = {p for p in before if not any(f"date_key={d or '__HIVE'}" in p for d in replaced["fact_play_logs"])}
    assert len(kept) > 50 and kept <= set(files_of(f"{a}/fact_play_logs"))
    # a second time with the same days changes nothing
    held = {n: RF.read_fact(spark, f"{a}/{n}").drop("_gold_at").count() for n in replaced}
    RF.refresh_days(spark, bronze, days, a, cfg)
    assert {n: RF.read_fact(spark, f"{a}/{n}").count() for n in replaced} == held


CONTROL = "id bigint, name string, modified timestamp"


def pages(*records, resource):
    d = tempfile.mkdtemp(prefix="ctl-")
    put(d, "p.json", json.dumps({resource: [dict(zip(("id", "name", "modified"), r)) for r in records]}))
    return d, CONTROL


def test_control_rows_without_a_time_and_of_the_cursor(spark):
    root, cursors = scratch_path(spark, "ctl"), scratch_path(spark, "cur")

    def run(**landed):
        return {r.table_name: (r.ok, r.strategy, r.n_rows) for r in sync_control_tables(spark, landed, root, cursors).collect()}

    t = "2024-01-0{} 00:00:00".format
    got = run(reservations=pages((1, "a", t(1)), (2, "b", None), resource="reservation"), players=pages((1, "p", t(1)), resource="client_registration"))
    assert got == {"reservations": (True, "incremental", 2), "players": (True, "overwrite", 1)}
    assert read_cursors(spark, cursors) == {"reservations": dt.datetime(2024, 1, 1)}
    got = run(reservations=pages((3, "c", t(1)), (4, "d", t(2)), (5, "old", "2023-01-01 00:00:00"), resource="reservation"),
              players=pages(resource="client_registration"), content=("/nowhere/at/all", CONTROL), users=pages((9, "u", None), resource="user"))
    assert got["reservations"] == (True, "incremental", 3) and got["players"] == (True, "overwrite/empty", 0)
    assert got["content"][0] is False and got["users"] == (True, "overwrite", 1)  # one source's trouble is not the others'
    assert sorted(r.id for r in SK.read_upserted(spark, f"{root}/ctrl_reservations").collect()) == [1, 2, 3, 4]
    assert [r.id for r in spark.read.parquet(f"{root}/ctrl_players").collect()] == [1]
    assert read_cursors(spark, cursors) == {"reservations": dt.datetime(2024, 1, 2)}
    assert run(reservations=pages(resource="reservation")) == {"reservations": (True, "incremental/no-change", 0)}


EVENTS = "ts timestamp, kind string, value double"


def test_late_rows_of_a_long_drain(spark):
    land, table, ckpt = (scratch_path(spark, n) for n in ("late-land", "late-table", "late-ckpt"))
    r = random.Random(1)
    t0 = dt.datetime(2024, 1, 3)
    rows = []
    for f in range(104):  # one file a batch; each tenth brings a row of some days before
        when = t0 + dt.timedelta(minutes=20 * f)
        own = [(when, r.choice("ab"), 1.0)] + ([(when - dt.timedelta(days=r.randrange(1, 3)), "late", 2.0)] if f % 10 == 9 else [])
        spark.createDataFrame(own, EVENTS).coalesce(1).write.mode("append").parquet(land)
        rows += own
    seen = []
    count = ST.hourly_day_batches(table, "ts", ["kind"], "value", watermark="2 hours")

    def fn(batch, epoch):
        count(batch, epoch)
        seen.append(epoch)
        if epoch in (0, 5) and seen.count(epoch) == 1:
            count(batch, epoch)  # the batch again, as after a lost commit

    ST.run_available_now(ST.landing_stream(spark, land, EVENTS, max_files=1), fn, "late", ckpt, output_mode="append")
    want = {}
    for ts, kind, value in rows:
        k = (ts.replace(minute=0), kind)
        want[k] = (want.get(k, (0, 0))[0] + 1, want.get(k, (0, 0))[1] + value)
    got = {(x.window_start, x.kind): (x.emisje, x.Duration) for x in ST.read_hourly(spark, table).collect()}
    assert len(seen) > 100 and got == want and ST.late_groups(spark, table) == 10
    with pytest.raises(ValueError, match="another checkpoint"):
        count(spark.createDataFrame(rows[:1], EVENTS), 3)


def test_run_log_in_many_splits(spark):
    folder = tempfile.mkdtemp(prefix="log-")
    r = random.Random(2)
    logs = {f"l{k}.log": [("x" * r.randrange(0, 30)) if r.random() < 0.9 else "" for _ in range(400)] for k in range(3)}
    for name, lines in logs.items():
        with open(f"{folder}/{name}", "w", newline="") as f:
            f.write("".join(x + r.choice(["\n", "\r\n"]) for x in lines) + "the end")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = RD.read_run_log(spark, folder).collect()
        assert spark.read.text(folder).rdd.getNumPartitions() > 20
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, lines in logs.items():
        assert sorted((x.line_no, x.value) for x in got if x.log == name) == [(n, v) for n, v in enumerate([*lines, "the end"]) if v]


def test_stored_steps(spark):
    df = spark.range(5).select("id", F.lit(None).alias("nothing"), F.lit("x").alias("a.b"))
    with scratch_scope(spark):
        out = store(df)
        assert out.columns == df.columns and out.count() == 5 and out.schema["nothing"].dataType == df.schema["nothing"].dataType
        path = "/" + out.inputFiles()[0].removeprefix("file:").lstrip("/")
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_upserted_table_grows_and_keeps_to_neighbours(spark, monkeypatch):
    monkeypatch.setattr(SK, "ROWS_PER_BUCKET", 500)
    path = scratch_path(spark, "grow")
    for k in range(6):
        SK.write_upsert(spark, spark.range(k * 2000, (k + 1) * 2000).selectExpr("id", f"{k} AS v"), path, ["id"])
    n = SK.bucket_count(spark, path)
    assert n > 8 and SK.read_upserted(spark, path).count() == 12_000   # began with the first batch's four
    before = files_of(path)
    SK.write_upsert(spark, spark.range(3000, 3120).selectExpr("id", "99 AS v", "'x' AS more"), path, ["id"])   # 1 % of the keys
    after = files_of(path)
    assert len(set(before) - set(after)) <= max(2, len(before) // 10)
    got = SK.read_upserted(spark, path)
    assert got.columns == ["id", "v", "more"] and got.where("v = 99").count() == 120 and got.count() == 12_000
    with pytest.raises(ValueError):
        SK.write_upsert(spark, spark.range(3), path, ["id"], buckets=n + 1)
