"""Sources, sinks and streams end to end: driver data is written as the raw formats the jobs ingest (TSV
play logs with bad lines and gzip, dictionary TSV, a dated archive, CSV, paged JSON, run-log text, landing
files for streams) into a fresh folder under the shared checkpoint dir, then read back by the library.
The oracle computes the same result directly from the table."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from .. import config as K
from ..functions.semantics import round_half_up
from ..operators.rollup import hourly_rollup
from ..session import path_of, scratch_path
from ..sources import readers as RD
from ..sources import sinks as SK
from ..streaming import stream as ST
from . import analogs as A
from .catalog import register
from .runlog import parse_run_log, run_log_facts

T = A.table
_K = r'"k"\s*:\s*(\d+)'
_K_SQL = '"k"\\s*:\\s*(\\d+)'


# ---- S3 / S4 / S5 / C1: raw play-log TSV ---------------------------------------------------------------------------
def _tsv_lines(ev, *keep):
    k = F.regexp_extract("props", _K, 1)
    f = [F.when(F.col("user_id") % 7 == 0, F.lit("")).otherwise(F.col("user_id").cast("string")),
         F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
         F.when(F.col("event_id") % 83 == 0, F.lit("x")).otherwise(F.col("value").cast("string")),
         (F.col("event_id") % 60).cast("string"), F.lit("i"), k,
         (F.col("user_id") % 40).cast("string"), (F.col("user_id") % 25).cast("string"),
         F.floor("value").cast("string"), F.lit("a"), F.lit("b"), F.lit("c"),
         F.when(k.cast("int") % 3 == 0, F.concat(F.lit('{"contract_id": "C'), k, F.lit('"}'))).otherwise(F.lit('{"x": 1}'))]
    full = F.concat_ws("\t", *f)
    line = (F.when(F.col("event_id") % 97 == 0, F.concat(full, F.lit("\textra")))
             .when(F.col("event_id") % 89 == 0, F.concat_ws("\t", *f[:9]))
             .otherwise(full))
    return ev.select(line.alias("value"), "event_id", F.dayofmonth("ts").alias("dom"), F.date_format("ts", "yyyy-MM-dd").alias("day"), *keep)


def land_play_log(spark, d) -> str:
    land = scratch_path(spark, "playlog")
    lines = _tsv_lines(T(spark, d, "events"))
    SK.export_text(lines.where(F.col("dom") < 16).select("value"), land)
    SK.export_text(lines.where(F.col("dom") >= 16).select("value"), land, compression="gzip")
    return land


_TSV_KEYS = ["PlayerID", "AdCopyId", "CampID", "FrameID", "DisplayUnitID", "contract_id"]


@register("play_log_tsv", f"""
WITH p AS (
  SELECT CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END AS PlayerID, date_trunc('second', ts) AS t,
         CASE WHEN event_id % 83 = 0 THEN NULL ELSE value END AS Duration, event_id % 60 AS AdCopyId,
         CAST(regexp_extract(props, '{_K_SQL}', 1) AS BIGINT) AS CampID, user_id % 40 AS FrameID, user_id % 25 AS DisplayUnitID,
         CAST(floor(value) AS BIGINT) AS Impresje,
         CASE WHEN event_id % 89 = 0 THEN NULL
              WHEN CAST(regexp_extract(props, '{_K_SQL}', 1) AS INTEGER) % 3 = 0 THEN 'C' || regexp_extract(props, '{_K_SQL}', 1) END
           AS contract_id
  FROM events WHERE event_id % 97 <> 0)
SELECT strftime(t, '%Y-%m-%d') AS DateEnd, CAST(hour(t) AS INTEGER) AS timeslot, PlayerID, AdCopyId, CampID, FrameID,
       DisplayUnitID, contract_id, round(CAST(coalesce(sum(Duration), 0) AS DECIMAL(38,10)), 2)::DOUBLE AS Duration,
       CAST(coalesce(sum(Impresje), 0) AS BIGINT) AS Impresje, count(*) AS emisje
FROM p GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""")
def q_play_log_tsv(spark, d):
    logs = RD.read_play_log(spark, land_play_log(spark, d))
    agg = hourly_rollup(logs, _TSV_KEYS, sums={"Duration": "Duration", "Impresje": "Impresje"}, scale=None)
    return agg.select("DateEnd", "timeslot", *_TSV_KEYS, round_half_up(F.col("Duration"), 2).alias("Duration"),
                      "Impresje", "emisje")


# ---- S6 / S7 / M6 / C2: dictionary TSV ------------------------------------------------------------------------------
_TYPES = ["display_unit", "reservation", "content", "host", "skin"]


def _dict_lines(p):
    m = F.col("p_partkey") % 10
    typ = F.get(F.array(*[F.lit(t) for t in _TYPES]), (F.col("p_partkey") % 5).cast("int"))
    full = F.concat_ws("\t", F.concat(F.lit(" "), F.col("p_partkey").cast("string")), F.concat(F.col("p_name"), F.lit(" ")),
                       F.lit("1"), F.concat(typ, F.lit(" ")))
    return p.select((F.when(m == 0, F.concat_ws("\t", F.col("p_partkey").cast("string"), F.col("p_name"), F.lit("1")))
                      .when(m == 1, F.concat_ws("\t", F.concat(F.lit("x"), F.col("p_partkey").cast("string")), F.col("p_name"),
                                                F.lit("1"), F.lit("content")))
                      .when(m == 2, F.concat_ws("\t", F.col("p_partkey").cast("string"), F.col("p_name"), F.lit("1"), F.lit("banner")))
                      .when(m == 3, F.lit(""))
                      .otherwise(full)).alias("value"))


_DICT_TYPE_SQL = "['display_unit', 'reservation', 'content', 'host', 'skin'][p_partkey % 5 + 1]"


def _dict_read(spark, d):
    land = scratch_path(spark, "dict")
    SK.export_text(_dict_lines(T(spark, d, "part")), land)
    return RD.read_dictionary(spark, land)


@register("dictionary_tsv", f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, {_DICT_TYPE_SQL} AS type FROM part WHERE p_partkey % 10 > 3""")
def q_dictionary_tsv(spark, d):
    ok, _ = _dict_read(spark, d)
    return ok.select("id", "name", "type")


@register("dictionary_rejects", """
SELECT CASE WHEN p_partkey % 10 = 0 THEN 'fields' ELSE 'id' END AS reason, count(*) AS n FROM part
WHERE p_partkey % 10 IN (0, 1) GROUP BY 1""")
def q_dictionary_rejects(spark, d):
    _, rej = _dict_read(spark, d)
    return rej.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---- S8 / M8 / S13: dated archive, newest wins ------------------------------------------------------------------------
def _land_archive(spark, d):
    p = T(spark, d, "part")
    root = scratch_path(spark, "archive")
    typ = F.get(F.array(*[F.lit(t) for t in _TYPES]), (F.col("p_partkey") % 5).cast("int"))

    def lines(df, name_col):
        return df.select(F.concat_ws("\t", F.col("p_partkey").cast("string"), name_col, F.lit("1"), typ).alias("value"))

    SK.export_text(lines(p, F.col("p_name")), f"{root}/resources-2024-01-01.txt")
    SK.export_text(lines(p.where(F.col("p_partkey") % 3 == 0), F.upper("p_name")), f"{root}/resources-2024-01-03.txt")
    SK.export_text(lines(p.where(F.col("p_partkey") % 5 == 0), F.col("p_brand")), f"{root}/resources-2024-01-02.txt.gz",
                   compression="gzip")
    SK.export_text(lines(p, F.lit("ignored")), f"{root}/notes-2024-01-09.txt")
    return root


@register("dictionary_archive", f"""
WITH a AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, 'resources-2024-01-01.txt' AS source_file, DATE '2024-01-01' AS file_date, p_partkey
  FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), upper(p_name), 'resources-2024-01-03.txt', DATE '2024-01-03', p_partkey FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_brand, 'resources-2024-01-02.txt.gz', DATE '2024-01-02', p_partkey FROM part WHERE p_partkey % 5 = 0)
SELECT id, name, {_DICT_TYPE_SQL} AS type, source_file, strftime(file_date, '%Y-%m-%d') AS file_date FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY file_date DESC, name DESC) AS rn FROM a) WHERE rn = 1""")
def q_dictionary_archive(spark, d):
    res = RD.read_dictionary_archive(spark, _land_archive(spark, d))
    return res.select("id", "name", "type", "source_file", F.date_format("file_date", "yyyy-MM-dd").alias("file_date"))


@register("dictionary_latest_file", f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, upper(p_name) AS name, {_DICT_TYPE_SQL} AS type FROM part WHERE p_partkey % 3 = 0""")
def q_dictionary_latest_file(spark, d):
    rows = RD.read_dictionary_files(spark, _land_archive(spark, d))
    return RD.latest_file_rows(rows).select("id", "name", "type")


# ---- S9 / S10 / M12: CSV bootstrap -----------------------------------------------------------------------------------
@register("csv_bootstrap", f"""
WITH {A.PLAY_LOG_SQL}
SELECT PlayerID, strftime(DateEndTime, '%Y-%m-%d') AS DateEnd, CAST(hour(DateEndTime) AS BIGINT) AS timeslot, NULL::BIGINT AS AdCopyId,
       CampID, NULL::BIGINT AS FrameID, NULL::BIGINT AS DisplayUnitID, NULL::VARCHAR AS contract_id,
       round(CAST(coalesce(sum(Duration), 0) AS DECIMAL(38,10)), 2)::DOUBLE AS Duration, NULL::BIGINT AS Impresje,
       count(*) AS emisje, NULL::VARCHAR AS timeslot_label
FROM play_log GROUP BY 1, 2, 3, 5""")
def q_csv_bootstrap(spark, d):
    hist = hourly_rollup(A.play_log(spark, d), ["PlayerID", "CampID"], sums={"Duration": "Duration"})
    path = scratch_path(spark, "csv")
    SK.export_csv(hist.select("PlayerID", "DateEnd", "timeslot", "CampID", "Duration", "emisje"), path)
    return RD.read_csv_bootstrap(spark, path)


@register("csv_bootstrap_guarded", f"""
WITH {A.PLAY_LOG_SQL}
SELECT PlayerID, strftime(DateEndTime, '%Y-%m-%d') AS DateEnd, CAST(hour(DateEndTime) AS BIGINT) AS timeslot, CampID,
       round(CAST(coalesce(sum(Duration), 0) AS DECIMAL(38,10)), 2)::DOUBLE AS Duration, count(*) AS emisje
FROM play_log GROUP BY 1, 2, 3, 4""")
def q_csv_bootstrap_guarded(spark, d):
    hist = hourly_rollup(A.play_log(spark, d), ["PlayerID", "CampID"], sums={"Duration": "Duration"})
    first, second, table = scratch_path(spark, "csv-a"), scratch_path(spark, "csv-b"), scratch_path(spark, "tbl-hist")
    SK.export_csv(hist.select("PlayerID", "DateEnd", "timeslot", "CampID", "Duration", "emisje"), first)
    SK.export_csv(hist.select("PlayerID", "DateEnd", "timeslot", "CampID", (F.col("Duration") * 2).alias("Duration"),
                              "emisje"), second)
    SK.import_historical(spark, first, table)      # empty target: imported
    SK.import_historical(spark, second, table)     # target has data: skipped
    return spark.read.parquet(table).select("PlayerID", "DateEnd", "timeslot", "CampID", "Duration", "emisje")


# ---- S11 / S12: paged JSON envelopes ---------------------------------------------------------------------------------
@register("json_pages", "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_custkey // 100 AS page FROM customer")
def q_json_pages(spark, d):
    c = T(spark, d, "customer").withColumn("page", (F.col("c_custkey") / 100).cast("bigint"))
    recs = F.collect_list(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                   F.col("c_acctbal").alias("balance"), F.col("page")))
    pages = c.groupBy("page").agg(recs.alias("recs"), F.count(F.lit(1)).alias("n"))   # one API page = at most 100 records
    env = (F.when(F.col("page") % 3 == 0, F.to_json(F.struct(F.col("n").alias("total"), F.col("recs").alias("data"))))
            .when(F.col("page") % 3 == 1, F.to_json(F.struct(F.col("n").alias("total_rows"), F.col("recs").alias("proposal_items"))))
            .otherwise(F.to_json(F.struct(F.struct(F.col("n").alias("__count"), F.col("recs").alias("results")).alias("d")))))
    path = scratch_path(spark, "pages")
    SK.export_text(pages.select(env.alias("value")), path)
    return RD.read_paged_json(spark, path, "id bigint, name string, balance double, page bigint").drop("page_file")


# ---- S17 / C19 / F20: run-log text ------------------------------------------------------------------------------------
_RUN_SQL = """
WITH ev AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS line_no FROM events),
marks AS (SELECT user_id, count(*) AS run_no, max(line_no) AS st FROM ev WHERE event_type = 'signup' GROUP BY 1),
good AS (SELECT user_id, arg_max(ts, line_no) AS last_good FROM ev WHERE event_type = 'purchase' GROUP BY 1),
run AS (SELECT ev.*, m.run_no FROM ev JOIN marks m ON m.user_id = ev.user_id WHERE ev.line_no >= m.st)
SELECT r.user_id, max(run_no) AS run_no,
       strftime(arg_max(ts, line_no) FILTER (WHERE event_type = 'signup'), '%Y-%m-%d %H:%M:%S') AS started,
       strftime(arg_min(ts, line_no) FILTER (WHERE event_type = 'purchase'), '%Y-%m-%d %H:%M:%S') AS done_at,
       CAST(count(*) FILTER (WHERE event_type = 'view' AND event_id % 10 <> 0) AS BIGINT) AS n_ok,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS n_fail,
       arg_min(event_id * 1000, line_no) FILTER (WHERE event_type = 'click') AS rows_added,
       arg_min(event_id * 1000 + r.user_id, line_no) FILTER (WHERE event_type = 'click') AS rows_total,
       arg_min(event_id % 500, line_no) FILTER (WHERE event_type = 'view' AND event_id % 10 = 0) AS campaigns,
       strftime(max(g.last_good), '%Y-%m-%d %H:%M:%S') AS last_good
FROM run r LEFT JOIN good g ON g.user_id = r.user_id
GROUP BY r.user_id"""


def _grouped(x):
    """Thousands separated by spaces, as the run log prints them."""
    return F.regexp_replace(F.format_number(x, 0), ",", " ")


@register("run_log_text", _RUN_SQL)
def q_run_log_text(spark, d):
    ev = T(spark, d, "events")
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    line = (F.when(F.col("event_type") == "signup", F.concat(F.lit("==== "), ts, F.lit(" START ====")))
             .when(F.col("event_type") == "purchase", F.concat(F.lit("==== "), ts, F.lit(" DONE ====")))
             .when(F.col("event_type") == "error", F.concat(F.lit("  FAIL step_"), F.col("event_id").cast("string"), F.lit(": boom")))
             .when(F.col("event_type") == "click",
                   F.concat(F.lit("[upsert_date] "), F.date_format("ts", "yyyy-MM-dd"), F.lit(": "), _grouped(F.col("event_id") * 1000),
                            F.lit(" wierszy -> lacznie "), _grouped(F.col("event_id") * 1000 + F.col("user_id")), F.lit(" w play_logs")))
             .when(F.col("event_id") % 10 == 0, F.concat(F.lit("  Kampanie: "), (F.col("event_id") % 500).cast("string")))
             .otherwise(F.concat(F.lit("  OK   step_"), F.col("event_type"))))
    path = scratch_path(spark, "runlog")
    # as a log collector writes them: many logs to a file, each line with its log's name, a log's lines in order.  (A file
    # for each log made as many files as users, which the driver lists, commits and deals out one by one.)
    named = F.concat(F.col("user_id").cast("string"), F.lit("\t"), F.coalesce(line, F.lit(""))).alias("value")
    (ev.where(F.col("user_id").isNotNull()).select("user_id", "ts", "event_id", named).repartition("user_id")
       .sortWithinPartitions("user_id", "ts", "event_id").select("value").write.text(path))
    lines = RD.read_run_log(spark, path, tagged=True).withColumn("user_id", F.col("log").try_cast("bigint"))
    facts = run_log_facts(parse_run_log(lines), "user_id", "line_no")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return facts.select("user_id", "run_no", F.date_format("started", fmt).alias("started"),
                        F.date_format("done_at", fmt).alias("done_at"), "n_ok", "n_fail", "rows_added", "rows_total",
                        "campaigns", F.date_format("last_good", fmt).alias("last_good"))


# ---- T1 / T2: hourly windows from a landing folder ----------------------------------------------------------------------
_EV_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@register("stream_hourly", """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS emisje,
       round(CAST(sum(value) AS DECIMAL(38,10)), 2)::DOUBLE AS Duration FROM events GROUP BY 1, 2""")
def q_stream_hourly(spark, d):
    ev = T(spark, d, "events")
    land, table = scratch_path(spark, "land-ev"), scratch_path(spark, "tbl-hourly")
    wk = F.floor((F.dayofmonth("ts") - 1) / 7)
    for w in range(5):   # weekly files, oldest first (arrival order)
        ev.where(wk == w).write.mode("append").parquet(land)
    # a week in several files: rows of a later batch fall behind the mark and are counted by the stream itself
    stream = ST.landing_stream(spark, land, _EV_SCHEMA, max_files=2).withColumn("ts", F.col("ts").cast("timestamp"))
    ST.run_available_now(stream, ST.hourly_day_batches(table, "ts", ["event_type"], "value"), "hourly", output_mode="append")
    out = ST.read_hourly(spark, table)
    return out.select(F.date_format(F.col("window_start").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      "event_type", "emisje",
                      round_half_up(F.col("Duration"), 2).alias("Duration"))


# ---- T3: a re-delivered day replaces the old one ---------------------------------------------------------------------------
@register("stream_replace_day", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN day(ts) IN (5, 6) THEN value * 2 ELSE value END AS value FROM events
WHERE NOT (day(ts) IN (5, 6) AND event_type = 'error')""")
def q_stream_replace_day(spark, d):
    ev = T(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "value", "event_type")
    land, table = scratch_path(spark, "land-days"), scratch_path(spark, "tbl-days")
    ckpt = scratch_path(spark, "ckpt-days")
    schema = "event_id bigint, day string, value double"
    ev.drop("event_type").write.mode("append").parquet(land)       # day 1: the original files
    ST.run_available_now(ST.landing_stream(spark, land, schema), ST.replace_day_batches(table, "day"), "days", ckpt)
    fix = ev.where(F.dayofmonth(F.to_date("day")).isin(5, 6) & (F.col("event_type") != "error")) \
            .withColumn("value", F.col("value") * 2).drop("event_type")
    fix.write.mode("append").parquet(land)                         # day 2: corrected re-delivery of two days
    ST.run_available_now(ST.landing_stream(spark, land, schema), ST.replace_day_batches(table, "day"), "days", ckpt)
    return spark.read.schema(schema).parquet(table).select("event_id", "day", "value")


# ---- T4 / M5: shrinking source window, merged by key ------------------------------------------------------------------------
@register("stream_upsert", """
WITH m AS (SELECT l_returnflag AS format, l_partkey % 100 AS content_id, strftime(l_shipdate, '%Y-%m-%d') AS play_date,
                  count(*) AS play_count FROM lineitem GROUP BY 1, 2, 3),
cur AS (SELECT max(substr(play_date, 1, 7)) AS ym FROM m)
SELECT format, content_id, play_date, CASE WHEN substr(play_date, 1, 7) = (SELECT ym FROM cur) THEN play_count * 2 ELSE play_count END
       AS play_count FROM m""")
def q_stream_upsert(spark, d):
    li = T(spark, d, "lineitem")
    m = li.groupBy(F.col("l_returnflag").alias("format"), (F.col("l_partkey") % 100).alias("content_id"),
                   F.date_format("l_shipdate", "yyyy-MM-dd").alias("play_date")).agg(F.count(F.lit(1)).alias("play_count"))
    land, table, ckpt = scratch_path(spark, "land-pop"), scratch_path(spark, "tbl-pop"), scratch_path(spark, "ckpt-pop")
    schema = "format string, content_id bigint, play_date string, play_count bigint"
    m.write.mode("append").parquet(land)
    keys = ["format", "content_id", "play_date"]
    ST.run_available_now(ST.landing_stream(spark, land, schema), ST.upsert_batches(table, keys), "pop", ckpt)
    cur = m.select(F.max(F.substring("play_date", 1, 7))).scalar()
    m.where(F.substring("play_date", 1, 7) == cur).withColumn("play_count", F.col("play_count") * 2) \
     .write.mode("append").parquet(land)                          # the current month, refetched
    ST.run_available_now(ST.landing_stream(spark, land, schema), ST.upsert_batches(table, keys), "pop", ckpt)
    return spark.read.parquet(table).select(*keys, "play_count")


# ---- C1: daily ingest = T1 stream over TSV files + hourly roll-up + day replace --------------------------------------------
@register("job_ingest_play_logs", f"""
WITH p AS (
  SELECT CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END AS PlayerID, date_trunc('second', ts) AS t,
         CASE WHEN event_id % 83 = 0 THEN NULL ELSE value END AS Duration, event_id % 60 AS AdCopyId,
         CAST(regexp_extract(props, '{_K_SQL}', 1) AS BIGINT) AS CampID, CAST(floor(value) AS BIGINT) AS Impresje
  FROM events WHERE event_id % 97 <> 0)
SELECT strftime(t, '%Y-%m-%d') AS DateEnd, CAST(hour(t) AS INTEGER) AS timeslot, PlayerID, AdCopyId, CampID,
       round(CAST(coalesce(sum(Duration), 0) AS DECIMAL(38,10)), 2)::DOUBLE AS Duration,
       CAST(coalesce(sum(Impresje), 0) AS BIGINT) AS Impresje, count(*) AS emisje
FROM p GROUP BY 1, 2, 3, 4, 5""")
def q_job_ingest(spark, d):
    land = scratch_path(spark, "land-tsv")
    lines = _tsv_lines(T(spark, d, "events"))
    # one folder per delivered day file: <landing>/file=playlog-YYYY-MM-DD.txt/part-*
    lines.select("value", F.concat(F.lit("playlog-"), F.col("day"), F.lit(".txt")).alias("file")) \
         .write.partitionBy("file").text(land)
    table = scratch_path(spark, "tbl-playlogs")
    stream = ST.play_log_file_stream(spark, land)
    ST.run_available_now(stream, ST.ingest_play_log_batches(table, ["PlayerID", "AdCopyId", "CampID"],
                                                            {"Duration": "Duration", "Impresje": "Impresje"}), "ingest")
    out = spark.read.parquet(table)
    return out.select(F.date_format("DateEnd", "yyyy-MM-dd").alias("DateEnd"), "timeslot", "PlayerID", "AdCopyId", "CampID",
                      round_half_up(F.col("Duration"), 2).alias("Duration"), F.col("Impresje").cast("bigint").alias("Impresje"),
                      F.col("emisje").cast("bigint").alias("emisje"))


# ---- I3 / I7 / M9: files that are new or have changed, by a stored manifest ---------------------------------------------
def land_day_files(spark, lines, folder: str) -> str:
    """The lines (value, day) as one file for each day, named playlog-<day>.txt, replacing what is there."""
    staged = scratch_path(spark, "days")
    lines.select("value", "day").repartition("day").write.partitionBy("day").text(staged)
    fs, at = path_of(spark, staged)
    _, out = path_of(spark, folder)
    fs.mkdirs(out)
    for one in fs.listStatus(at):
        name = one.getPath().getName()
        if name.startswith("day="):
            _, to = path_of(spark, f"{folder}/playlog-{name[4:]}.txt")
            fs.delete(to, False)
            for part in fs.listStatus(one.getPath()):
                fs.rename(part.getPath(), to)
    return folder


_CHANGED_DAY, _FIRST_DAYS = "2024-01-05", "2024-01-20"


def file_lines(spark, d):
    """Raw lines by the day of their file: plays of a day's first hour are in the file of the day before."""
    ev = T(spark, d, "events")
    own = F.date_format(F.col("ts") - F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd")
    return _tsv_lines(ev.withColumn("own", own), "own").select("value", "event_id", F.col("own").alias("day"))


@register("job_changed_files", f"""
WITH p AS (
  SELECT CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END AS PlayerID, date_trunc('second', ts) AS t,
         CASE WHEN event_id % 83 = 0 THEN NULL ELSE value END AS Duration, event_id % 60 AS AdCopyId,
         CAST(regexp_extract(props, '{_K_SQL}', 1) AS BIGINT) AS CampID, user_id % 40 AS FrameID, user_id % 25 AS DisplayUnitID,
         CAST(floor(value) AS BIGINT) AS Impresje,
         CASE WHEN event_id % 89 = 0 THEN NULL
              WHEN CAST(regexp_extract(props, '{_K_SQL}', 1) AS INTEGER) % 3 = 0 THEN 'C' || regexp_extract(props, '{_K_SQL}', 1) END
           AS contract_id
  FROM events WHERE event_id % 97 <> 0
    AND (strftime(ts - INTERVAL 1 HOUR, '%Y-%m-%d') <> '{_CHANGED_DAY}' OR event_id % 2 = 0))
SELECT strftime(t, '%Y-%m-%d') AS DateEnd, CAST(hour(t) AS INTEGER) AS timeslot, PlayerID, AdCopyId, CampID, FrameID,
       DisplayUnitID, contract_id, round(CAST(coalesce(sum(Duration), 0) AS DECIMAL(38,10)), 2)::DOUBLE AS Duration,
       CAST(coalesce(sum(Impresje), 0) AS BIGINT) AS Impresje, count(*) AS emisje
FROM p GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""")
def q_job_changed_files(spark, d):
    from .manifest import load_changed_files, read_loaded
    lines = file_lines(spark, d)
    folder, table, manifest = (scratch_path(spark, n) for n in ("landing", "play-logs", "manifest"))
    land_day_files(spark, lines.where(F.col("day") <= _FIRST_DAYS), folder)
    load_changed_files(spark, folder, table, manifest)
    # one file comes again and smaller, the other days' files arrive; the run dies before its manifest and is repeated
    land_day_files(spark, lines.where((F.col("day") > _FIRST_DAYS) | (F.col("day") == _CHANGED_DAY))
                   .where((F.col("day") != _CHANGED_DAY) | (F.col("event_id") % 2 == 0)), folder)

    def die():
        raise InterruptedError("stopped between data and manifest")

    try:
        load_changed_files(spark, folder, table, manifest, before_manifest=die)
    except InterruptedError:
        load_changed_files(spark, folder, table, manifest)
    return read_loaded(spark, table).select("DateEnd", "timeslot", *_TSV_KEYS, round_half_up(F.col("Duration"), 2).alias("Duration"),
                                            "Impresje", "emisje")


# ---- C3 / I1 / S11 / M1 / M2: control-table sync with a high-water cursor ---------------------------------------------
_RES_ITEM = "id bigint, cust bigint, price double, modified timestamp"


def _api_pages(df, key):
    recs = F.collect_list(F.struct(F.col("id"), F.col("cust"), F.col("price"), F.date_format("modified", "yyyy-MM-dd HH:mm:ss").alias("modified")))
    pages = df.withColumn("page", (F.col("id") / 100).cast("bigint")).groupBy("page").agg(recs.alias("recs"))
    return pages.select(F.to_json(F.struct(F.col("recs").alias(key))).alias("value"))


@register("job_control_sync", """
SELECT o_orderkey AS id, o_custkey AS cust, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 10 ELSE o_totalprice END AS price
FROM orders""")
def q_job_control_sync(spark, d):
    from .ingest import sync_control_table
    o = T(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"),
                                     F.col("o_totalprice").alias("price"), F.col("o_orderdate").cast("timestamp").alias("modified"))
    table, ctrl = scratch_path(spark, "tbl-reservations"), scratch_path(spark, "ctrl-cursor")
    land1 = scratch_path(spark, "api-1")
    SK.export_text(_api_pages(o, "reservation"), land1)
    sync_control_table(spark, "reservations", land1, _RES_ITEM, table, ctrl)        # first run: everything
    later = o.select(F.max("modified")).scalar()
    upd = o.join(T(spark, d, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "O").alias("changed")), "id")
    upd = upd.select("id", "cust", F.when(F.col("changed"), F.col("price") + 10).otherwise(F.col("price")).alias("price"),
                     F.when(F.col("changed"), F.date_add(later, 1).cast("timestamp")).otherwise(F.col("modified")).alias("modified"))
    land2 = scratch_path(spark, "api-2")
    SK.export_text(_api_pages(upd, "reservation"), land2)
    sync_control_table(spark, "reservations", land2, _RES_ITEM, table, ctrl)        # next run: only the changed rows
    return SK.read_upserted(spark, table).select("id", "cust", "price")


# The nine tables of a run stand on slices of orders by o_orderkey % 9; the second landing adds 10 to the prices of one
# status (incremental tables: those rows with a later time, among them rows without a time; replaced tables: whole
# slices without status P, and one refetch that comes back empty).
@register("job_control_all", f"""
WITH t AS (SELECT * FROM (VALUES {', '.join(
    f"({k}, '{t}', {str(t in K.CONTROL_INCREMENTAL).lower()})" for k, t in enumerate(K.CONTROL_ENDPOINTS))}) v(k, table_name, incremental)),
 o AS (SELECT table_name, incremental, o_orderkey AS id, o_custkey AS cust, o_orderstatus AS st, o_totalprice AS price
       FROM orders JOIN t ON o_orderkey % 9 = k)
SELECT table_name, id, cust, CASE WHEN incremental AND st = 'O' THEN price + 10 ELSE price END AS price FROM o
WHERE incremental OR table_name = 'customers' OR st <> 'P'""")
def q_job_control_all(spark, d):
    from .ingest import sync_control_tables
    o = T(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"), F.col("o_totalprice").alias("price"), "o_orderstatus",
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate").cast("timestamp")).alias("modified"))
    later = F.date_add(o.select(F.max("modified")).scalar(), 1).cast("timestamp")
    again = o.withColumn("changed", F.col("o_orderstatus") == "O") \
        .withColumn("price", F.when(F.col("changed"), F.col("price") + 10).otherwise(F.col("price"))) \
        .withColumn("modified", F.when(F.col("changed") & F.col("modified").isNotNull(), later).otherwise(F.col("modified")))
    root, ctrl = scratch_path(spark, "control"), scratch_path(spark, "cursors")

    def land(run: str, rows) -> dict:
        out = {}
        for k, (table, (resource, _)) in enumerate(K.CONTROL_ENDPOINTS.items()):
            out[table] = (scratch_path(spark, f"api-{run}-{table}"), _RES_ITEM)
            SK.export_text(_api_pages(rows(table).where(F.col("id") % 9 == k), resource), out[table][0])
        return out

    def second(table):
        if table in K.CONTROL_INCREMENTAL:
            return again.where("changed")
        return o.where(F.lit(False) if table == "customers" else F.col("o_orderstatus") != "P")

    sync_control_tables(spark, land("1", lambda t: o), root, ctrl)
    report = sync_control_tables(spark, land("2", second), root, ctrl)
    parts = [(SK.read_upserted(spark, f"{root}/ctrl_{t}") if t in K.CONTROL_INCREMENTAL else spark.read.parquet(f"{root}/ctrl_{t}"))
             .select(F.lit(t).alias("table_name"), "id", "cust", "price") for t in K.CONTROL_ENDPOINTS]
    if report.where("NOT ok").count():
        raise RuntimeError("a control table failed")
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---- S16 / F6: content metadata pages ------------------------------------------------------------------------------------
@register("content_meta", """
SELECT p_partkey AS content_id, p_name AS content_name,
       CASE p_size % 4 WHEN 0 THEN '1920 x 540' WHEN 1 THEN '1920 x 1080' WHEN 2 THEN '3840 x 2160' ELSE '800 x 600' END AS content_res,
       CASE p_size % 4 WHEN 0 THEN 'liveline' WHEN 1 THEN 'stroertv' WHEN 2 THEN 'triplay' ELSE 'other' END AS format
FROM part""")
def q_content_meta(spark, d):
    from .gold import content_format
    p = T(spark, d, "part")
    res = (F.when(F.col("p_size") % 4 == 0, "1920 x 540").when(F.col("p_size") % 4 == 1, "1920 x 1080")
            .when(F.col("p_size") % 4 == 2, "3840 x 2160").otherwise("800 x 600"))
    recs = F.collect_list(F.struct(F.col("p_partkey").alias("contentId"), F.col("p_name").alias("contentName"),
                                   res.alias("resolution")))
    pages = p.withColumn("page", (F.col("p_partkey") / 50).cast("bigint")).groupBy("page").agg(recs.alias("r"))
    env = (F.when(F.col("page") % 4 == 0, F.to_json(F.struct(F.col("r").alias("items"))))
            .when(F.col("page") % 4 == 1, F.to_json(F.struct(F.struct(F.col("r").alias("contents")).alias("deviceListBaseBean"))))
            .when(F.col("page") % 4 == 2, F.to_json(F.col("r")))
            .otherwise(F.to_json(F.struct(F.lit("x").alias("items"), F.struct(F.col("r").alias("list")).alias("data")))))
    land = scratch_path(spark, "content-meta")
    SK.export_text(pages.select(env.alias("value")), land)
    meta = RD.read_paged_json(spark, land, "contentId bigint, contentName string, resolution string",
                              paths=RD.POLYMORPHIC_PATHS)
    return meta.select(F.col("contentId").alias("content_id"), F.col("contentName").alias("content_name"),
                       F.col("resolution").alias("content_res"), content_format(F.col("resolution")).alias("format"))


# ---- C2: resources_latest = newest delivered file upserted by id, then the archive added for ids still missing --------------
@register("job_resources_latest", f"""
WITH a AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, 'resources-2024-01-01.txt' AS source_file, DATE '2024-01-01' AS file_date, p_partkey
  FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), upper(p_name), 'resources-2024-01-03.txt', DATE '2024-01-03', p_partkey FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_brand, 'resources-2024-01-02.txt.gz', DATE '2024-01-02', p_partkey FROM part WHERE p_partkey % 5 = 0
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), lower(p_name) || ' (today)', 'resources-2024-01-05.txt', DATE '2024-01-05', p_partkey FROM part WHERE p_size > 40)
SELECT id, name, {_DICT_TYPE_SQL} AS type, source_file FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY file_date DESC, name DESC) AS rn FROM a) WHERE rn = 1""")
def q_job_resources_latest(spark, d):
    root = _land_archive(spark, d)
    p = T(spark, d, "part")
    typ = F.get(F.array(*[F.lit(t) for t in _TYPES]), (F.col("p_partkey") % 5).cast("int"))
    today = p.where(F.col("p_size") > 40).select(
        F.concat_ws("\t", F.col("p_partkey").cast("string"), F.concat(F.lower("p_name"), F.lit(" (today)")), F.lit("1"), typ).alias("value"))
    SK.export_text(today, f"{root}/resources-2024-01-05.txt")
    table = scratch_path(spark, "tbl-resources")
    cols = ["id", "name", "type", "source_file"]
    latest = RD.latest_file_rows(RD.read_dictionary_files(spark, root)).select(*cols)
    SK.write_upsert(spark, latest, table, ["id"])                        # M2: the newest file, by id
    current = SK.read_upserted(spark, table).select(*cols)
    archive = RD.read_dictionary_archive(spark, root).select(*cols)      # M8: newest wins across the archive
    from ..operators.merge import add_only
    return add_only(current, archive, "id")                             # M6: only ids the table lacks
