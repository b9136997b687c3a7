"""Refresh strategies, incremental selection and quality audits on splits of the driver tables.

The "current table" and the "new batch" are two overlapping key-hash splits of the same driver table, so
every strategy sees inserts, updates and untouched rows.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.semantics import round_half_up
from ..operators import merge as M
from ..operators import quality as Q
from ..operators.lookup import two_sided_diff, unknown_keys
from ..operators.rollup import dedup, hourly_rollup
from . import analogs as A
from .catalog import register

T = A.table


def _orders_old(spark, d):
    return T(spark, d, "orders").where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"), F.col("o_totalprice").alias("price"))


def _orders_batch(spark, d):
    o = T(spark, d, "orders")
    a = o.where(F.col("o_orderstatus") != "F").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"),
                                                    (F.col("o_totalprice") + 1).alias("price"), F.lit(1).alias("seq"))
    b = o.where(F.col("o_orderstatus") == "O").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"),
                                                    (F.col("o_totalprice") + 2).alias("price"), F.lit(2).alias("seq"))
    return a.unionByName(b)


_OLD_SQL = "old AS (SELECT o_orderkey AS id, o_custkey AS cust, o_totalprice AS price FROM orders WHERE o_orderstatus <> 'P')"
_BATCH_SQL = """new0 AS (SELECT o_orderkey AS id, o_custkey AS cust, o_totalprice + 1 AS price, 1 AS seq FROM orders WHERE o_orderstatus <> 'F'
         UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 2, 2 FROM orders WHERE o_orderstatus = 'O')"""


@register("upsert_by_key", f"""
WITH {_OLD_SQL}, {_BATCH_SQL},
new AS (SELECT id, cust, price FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM new0) WHERE rn = 1)
SELECT id, cust, price FROM old WHERE id NOT IN (SELECT id FROM new) UNION ALL SELECT id, cust, price FROM new""")
def q_upsert(spark, d):
    return M.upsert(_orders_old(spark, d), _orders_batch(spark, d), "id", order=["seq"]).select("id", "cust", "price")


def _ev_keyed(spark, d, cond, factor=1):
    ev = T(spark, d, "events").where(cond)
    return ev.groupBy(F.col("event_type").alias("format"), F.col("user_id").alias("content_id"),
                      F.to_date("ts").alias("play_date")).agg((F.count(F.lit(1)) * factor).alias("play_count"))


@register("upsert_composite", """
WITH old AS (SELECT event_type AS format, user_id AS content_id, CAST(ts AS DATE) AS play_date, count(*) AS play_count
             FROM events WHERE event_type <> 'view' GROUP BY 1, 2, 3),
new AS (SELECT event_type AS format, user_id AS content_id, CAST(ts AS DATE) AS play_date, count(*) * 2 AS play_count
        FROM events WHERE event_type <> 'click' GROUP BY 1, 2, 3)
SELECT format, content_id, strftime(play_date, '%Y-%m-%d') AS play_date, play_count FROM (
  SELECT * FROM old WHERE (format, content_id, play_date) NOT IN (SELECT (format, content_id, play_date) FROM new)
  UNION ALL SELECT * FROM new)""")
def q_upsert_composite(spark, d):
    old = _ev_keyed(spark, d, F.col("event_type") != "view")
    new = _ev_keyed(spark, d, F.col("event_type") != "click", factor=2)     # the refetch of four formats
    r = M.upsert(old, new, ["format", "content_id", "play_date"])
    return r.select("format", "content_id", F.date_format("play_date", "yyyy-MM-dd").alias("play_date"), "play_count")


@register("append_new_dates", """
WITH old AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE ts < TIMESTAMP '2024-01-21'),
new AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE ts >= TIMESTAMP '2024-01-15')
SELECT * FROM old UNION ALL SELECT * FROM new WHERE day NOT IN (SELECT day FROM old)""")
def q_append_new(spark, d):
    ev = T(spark, d, "events").select("event_id", "ts", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    old = ev.where(F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz")).drop("ts")
    new = ev.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")).drop("ts")   # overlaps six loaded days
    return M.append_new(old, new, "day")


@register("replace_day", """
WITH old AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, value FROM events),
new AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, value * 2 AS value FROM events
        WHERE strftime(ts, '%Y-%m-%d') = '2024-01-15' OR (strftime(ts, '%Y-%m-%d') = '2024-01-16' AND event_type = 'signup'))
SELECT * FROM old WHERE day <> '2024-01-15' UNION ALL SELECT * FROM new""")
def q_replace_day(spark, d):
    ev = T(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "value", "event_type")
    old = ev.drop("event_type")
    new = ev.where((F.col("day") == "2024-01-15") | ((F.col("day") == "2024-01-16") & (F.col("event_type") == "signup"))) \
            .withColumn("value", F.col("value") * 2).drop("event_type")
    # the batch is the file of 2024-01-15, which spilled rows into the next day
    return M.replace_dates(old, new, "day", dates=["2024-01-15"])


@register("add_only", """
WITH old AS (SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_mktsegment <> 'BUILDING'),
new AS (SELECT c_custkey AS id, upper(c_name) || '_v2' AS name FROM customer WHERE c_mktsegment <> 'MACHINERY')
SELECT * FROM old UNION ALL SELECT * FROM new WHERE id NOT IN (SELECT id FROM old)""")
def q_add_only(spark, d):
    c = T(spark, d, "customer")
    old = c.where(F.col("c_mktsegment") != "BUILDING").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    new = c.where(F.col("c_mktsegment") != "MACHINERY").select(F.col("c_custkey").alias("id"),
                                                     F.concat(F.upper("c_name"), F.lit("_v2")).alias("name"))
    return M.add_only(old, new, "id")


def _res_rows(spark, d):
    p = T(spark, d, "part")
    # a value read with each row, as a file's name is, not a constant of the plan
    file = lambda name: F.concat(F.lit(name), F.substring("p_name", 1, 0)).alias("source_file")
    key = F.col("p_partkey").alias("id")
    f1 = p.select(key, F.col("p_name").alias("name"), file("resources-2024-01-01.txt"))
    f2 = p.where(F.col("p_size") > 25).select(key, F.col("p_brand").alias("name"), file("resources-2024-01-02.txt"))
    new = p.where(F.col("p_type") == "SMALL").select(key, F.upper("p_name").alias("name"), file("resources-2024-01-02.txt"))
    fd = lambda df: df.withColumn("file_date", F.regexp_extract("source_file", r"(\d{4}-\d{2}-\d{2})", 1))
    return fd(f1.unionByName(f2)), fd(new)


@register("latest_per_key", """
WITH old AS (SELECT p_partkey AS id, p_name AS name, 'resources-2024-01-01.txt' AS source_file FROM part
             UNION ALL SELECT p_partkey, p_brand, 'resources-2024-01-02.txt' FROM part WHERE p_size > 25),
new AS (SELECT p_partkey AS id, upper(p_name) AS name, 'resources-2024-01-02.txt' AS source_file FROM part WHERE p_type = 'SMALL'),
u AS (SELECT * FROM old WHERE source_file NOT IN (SELECT source_file FROM new) UNION ALL SELECT * FROM new),
v AS (SELECT *, regexp_extract(source_file, '(\\d{4}-\\d{2}-\\d{2})', 1) AS file_date FROM u)
SELECT id, name, source_file, file_date FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY file_date DESC NULLS LAST, name ASC NULLS LAST, source_file ASC NULLS LAST) AS rn FROM v)
WHERE rn = 1""")
def q_latest(spark, d):
    old, new = _res_rows(spark, d)
    return M.latest_per_key(old, new, "id", "file_date", source_col="source_file").select("id", "name", "source_file", "file_date")


@register("reaggregate_union", f"""
WITH {A.PLAY_LOG_SQL},
old AS (SELECT strftime(DateEndTime, '%Y-%m-%d') AS DateEnd, CAST(hour(DateEndTime) AS INTEGER) AS timeslot, AdCopyId,
               coalesce(sum(Duration), 0) AS Duration, count(*) AS emisje
        FROM play_log GROUP BY 1, 2, 3),
new AS (SELECT strftime(DateEndTime, '%Y-%m-%d') AS DateEnd, CAST(hour(DateEndTime) AS INTEGER) AS timeslot, AdCopyId,
               coalesce(sum(Duration), 0) AS Duration, count(*) AS emisje
        FROM play_log WHERE AdCopyId <> 'error' AND DateEndTime >= TIMESTAMP '2024-01-10' AND DateEndTime < TIMESTAMP '2024-01-13'
        GROUP BY 1, 2, 3),
u AS (SELECT * FROM old WHERE DateEnd NOT IN (SELECT DateEnd FROM new) UNION ALL SELECT * FROM new)
SELECT DateEnd, timeslot, AdCopyId, round(CAST(sum(Duration) AS DECIMAL(38,10)), 2)::DOUBLE AS Duration,
       CAST(sum(emisje) AS BIGINT) AS emisje
FROM u GROUP BY 1, 2, 3""")
def q_reaggregate(spark, d):
    pl = A.play_log(spark, d)
    keys = ["AdCopyId"]
    old = hourly_rollup(pl, keys, sums={"Duration": "Duration"}, scale=None)
    # a redelivery of three days without the error plays
    new = hourly_rollup(pl.where((F.col("AdCopyId") != "error") & (F.col("DateEndTime") >= F.lit("2024-01-10").cast("timestamp_ntz"))
                                 & (F.col("DateEndTime") < F.lit("2024-01-13").cast("timestamp_ntz"))),
                        keys, sums={"Duration": "Duration"}, scale=None)
    r = M.reaggregate_union(old.drop("timeslot_label"), new.drop("timeslot_label"),
                            ["DateEnd", "timeslot", "AdCopyId"], ["Duration", "emisje"], "DateEnd")
    return r.select("DateEnd", "timeslot", "AdCopyId", round_half_up(F.col("Duration"), 2).alias("Duration"),
                    F.col("emisje").cast("bigint").alias("emisje"))


@register("overwrite_guarded", """
SELECT o_orderkey AS id, o_custkey AS cust, o_totalprice AS price FROM orders""")
def q_overwrite_guarded(spark, d):
    current = T(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"),
                                           F.col("o_totalprice").alias("price"))
    empty_batch = current.where(F.col("price") < 0)   # a refetch that returned nothing
    return M.overwrite_guarded(current, empty_batch)


@register("shrink_guard", """
SELECT (SELECT count(*) FROM orders) AS old_rows, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS new_rows,
       (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') >= (SELECT count(*) FROM orders) * 0.9 AS ok""")
def q_shrink(spark, d):
    o = T(spark, d, "orders")
    return M.shrink_check(o, o.where(F.col("o_orderstatus") != "P"), 0.9)   # a refetch missing one status


@register("since_cursor", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN date_trunc('hour', ts) END AS changed FROM events)
SELECT event_id, strftime(changed, '%Y-%m-%d %H:%M:%S') AS changed,
       strftime((SELECT max(changed) FROM e), '%Y-%m-%d %H:%M:%S') AS cursor
FROM e WHERE changed >= TIMESTAMP '2024-01-25 12:00:00' OR changed IS NULL""")
def q_since_cursor(spark, d):
    # whole hours, so that many rows are of the cursor's own instant; some without a time
    ev = T(spark, d, "events").select("event_id", F.when(F.col("event_id") % 50 != 0, F.date_trunc("hour", "ts")).alias("changed"))
    rows, nxt = M.since_cursor(ev, "changed", "2024-01-25 12:00:00")
    text = "yyyy-MM-dd HH:mm:ss"
    return rows.select("event_id", F.date_format("changed", text).alias("changed"),
                       F.date_format(nxt.scalar(), text).alias("cursor"))


@register("rolling_window", """
WITH b AS (SELECT CAST(max(ts) AS DATE) AS e FROM events)
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS n FROM events, b
WHERE CAST(ts AS DATE) BETWEEN e - 28 AND e - 1 GROUP BY 1""")
def q_rolling(spark, d):
    ev = T(spark, d, "events")
    end = ev.select(F.to_date(F.max("ts"))).scalar()
    day = F.to_date("ts")
    return (ev.where((day >= F.date_sub(end, 28)) & (day <= F.date_sub(end, 1)))
              .groupBy(F.date_format(day, "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n")))


def _listing(spark, d):
    ev = T(spark, d, "events")
    days = ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date")).agg(F.count(F.lit(1)).alias("size"))
    plain = days.select("date", F.concat(F.lit("playlog-"), F.col("date"), F.lit(".txt")).alias("file"), "size")
    gz = days.where(F.dayofmonth(F.to_date("date")) % 2 == 0).select(
        "date", F.concat(F.lit("playlog-"), F.col("date"), F.lit(".txt.gz")).alias("file"), F.floor(F.col("size") / 3).cast("bigint").alias("size"))
    return plain.unionByName(gz)


_LISTING_SQL = """days AS (SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS size FROM events GROUP BY 1),
listing AS (SELECT date, 'playlog-' || date || '.txt' AS file, size FROM days
            UNION ALL SELECT date, 'playlog-' || date || '.txt.gz', size // 3 FROM days WHERE day(CAST(date AS DATE)) % 2 = 0)"""


@register("new_files", f"""
WITH {_LISTING_SQL},
pref AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY ends_with(file, '.gz'), file) AS rn FROM listing) WHERE rn = 1),
loaded AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date FROM events WHERE ts < TIMESTAMP '2024-01-21')
SELECT date, file, size FROM pref WHERE date NOT IN (SELECT date FROM loaded)""")
def q_new_files(spark, d):
    lst = _listing(spark, d)
    pref = dedup(lst.withColumn("is_gz", F.col("file").endswith(".gz")), ["date"], order=["is_gz", "file"]).drop("is_gz")
    ev = T(spark, d, "events")
    loaded = ev.where(F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz")) \
               .select(F.date_format("ts", "yyyy-MM-dd").alias("date"))
    return M.unseen_dates(pref, loaded, "date").select("date", "file", "size")


@register("changed_files", f"""
WITH {_LISTING_SQL},
manifest AS (SELECT 'playlog-' || date || '.txt' AS file, CASE WHEN date <= '2024-01-10' THEN size ELSE size + 1 END AS size
             FROM days WHERE date <= '2024-01-20')
SELECT l.date, l.file, l.size, CASE WHEN m.size IS NULL THEN 'new' WHEN m.size <> l.size THEN 'update' ELSE 'skip' END AS status
FROM listing l LEFT JOIN manifest m ON m.file = l.file""")
def q_changed_files(spark, d):
    lst = _listing(spark, d)
    man = lst.where(~F.col("file").endswith(".gz") & (F.col("date") <= "2024-01-20")).select(
        "file", F.when(F.col("date") <= "2024-01-10", F.col("size")).otherwise(F.col("size") + 1).alias("size"))
    return M.changed_files(lst, man).select("date", "file", "size", "status")


@register("months_to_fetch", """
WITH avail AS (SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS ym FROM lineitem),
seen AS (SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS ym FROM lineitem WHERE l_linestatus = 'F'),
cur AS (SELECT max(ym) AS ym FROM avail)
SELECT ym FROM avail WHERE ym NOT IN (SELECT ym FROM seen) UNION SELECT ym FROM cur""")
def q_months(spark, d):
    li = T(spark, d, "lineitem")
    avail = li.select(F.date_format("l_shipdate", "yyyy-MM").alias("ym")).distinct()
    seen = li.where(F.col("l_linestatus") == "F").select(F.date_format("l_shipdate", "yyyy-MM").alias("ym"))
    cur = avail.select(F.max("ym")).scalar()
    return M.months_to_fetch(avail, seen, "ym", cur)


def _orders_known(spark, d):
    return T(spark, d, "orders").where(F.col("o_orderstatus") != "P")


@register("orphans", """
SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def q_orphans(spark, d):
    ids = T(spark, d, "lineitem").select("l_orderkey").distinct()
    return unknown_keys(ids, _orders_known(spark, d).select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")


@register("recover_orphans", """
WITH orph AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'))
SELECT o.o_orderkey AS id, o.o_custkey AS cust, o.o_totalprice AS price FROM orph JOIN orders o ON o.o_orderkey = orph.l_orderkey""")
def q_recover(spark, d):
    cols = [F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"), F.col("o_totalprice").alias("price")]
    known = _orders_known(spark, d).select(*cols)
    source = T(spark, d, "orders").select(*cols)                    # the recovery source (an API refetch)
    _, recovered, _ = M.reconcile_orphans(T(spark, d, "lineitem"), known, source, "id", fact_key="l_orderkey")
    return recovered


@register("two_sided_diff", """
WITH a AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'F'), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT k, 'missing' AS side FROM a WHERE k NOT IN (SELECT k FROM b)
UNION ALL SELECT k, 'surplus' FROM b WHERE k NOT IN (SELECT k FROM a)""")
def q_two_sided(spark, d):
    a = T(spark, d, "orders").where(F.col("o_orderstatus") != "F").select(F.col("o_orderkey").alias("k"))
    b = T(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"))
    return two_sided_diff(a, b, "k")


def _cov_sql(label, left, lk, right, rk):
    return f"""SELECT '{label}' AS label, count(*) AS left_rows, count(r.k) AS matched, count(*) - count(r.k) AS unmatched,
  CASE WHEN count(*) > 0 THEN count(r.k) * 100.0 / count(*) ELSE 0.0 END AS coverage_pct,
  CASE WHEN count(*) > 0 AND count(r.k) * 100.0 / count(*) = 100 THEN 'OK'
       WHEN count(*) > 0 AND count(r.k) * 100.0 / count(*) >= 95 THEN 'WARN' ELSE 'FAIL' END AS status
FROM (SELECT {lk} AS k FROM {left} WHERE {lk} IS NOT NULL) l
LEFT JOIN (SELECT DISTINCT {rk} AS k FROM {right} WHERE {rk} IS NOT NULL) r ON r.k = l.k"""


@register("coverage", _cov_sql("lineitem->orders", "lineitem", "l_orderkey", "(SELECT * FROM orders WHERE o_orderstatus <> 'P')", "o_orderkey"))
def q_coverage(spark, d):
    return Q.coverage(T(spark, d, "lineitem"), _orders_known(spark, d), "l_orderkey", "o_orderkey", "lineitem->orders")


@register("coverage_report", "\nUNION ALL\n".join([
    _cov_sql("lineitem->orders", "lineitem", "l_orderkey", "(SELECT * FROM orders WHERE o_orderstatus <> 'P')", "o_orderkey"),
    _cov_sql("lineitem->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    _cov_sql("orders->customer", "orders", "o_custkey", "(SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING')", "c_custkey")]))
def q_coverage_report(spark, d):
    li, o = T(spark, d, "lineitem"), T(spark, d, "orders")
    c = T(spark, d, "customer").where(F.col("c_mktsegment") != "BUILDING")
    return Q.coverage_report([("lineitem->orders", li, _orders_known(spark, d), "l_orderkey", "o_orderkey"),
                              ("lineitem->supplier", li, T(spark, d, "supplier"), "l_suppkey", "s_suppkey"),
                              ("orders->customer", o, c, "o_custkey", "c_custkey")])


@register("top_unmatched", """
SELECT l_orderkey AS id, count(*) AS n FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
GROUP BY 1 ORDER BY n DESC, id ASC LIMIT 10""")
def q_top_unmatched(spark, d):
    return Q.top_unmatched(T(spark, d, "lineitem"), _orders_known(spark, d), "l_orderkey", "o_orderkey", 10)


@register("fill_rates", f"""
WITH {A.PLAY_LOG_SQL}
SELECT 'PlayerID' AS "column", count(PlayerID) AS filled, count(*) AS rows, count(PlayerID) * 100.0 / count(*) AS fill_pct FROM play_log
UNION ALL SELECT 'CampID', count(CampID), count(*), count(CampID) * 100.0 / count(*) FROM play_log
UNION ALL SELECT 'AdCopyId', count(AdCopyId), count(*), count(AdCopyId) * 100.0 / count(*) FROM play_log""")
def q_fill_rates(spark, d):
    return Q.fill_rates(A.play_log(spark, d), ["PlayerID", "CampID", "AdCopyId"])


@register("dup_counts", """
SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem""")
def q_dup_counts(spark, d):
    return Q.dup_counts(T(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("assert_unique", """
SELECT 'orders' AS tbl, count(*) AS rows, count(DISTINCT o_orderkey) AS distinct_keys, count(*) = count(DISTINCT o_orderkey) AS "unique" FROM orders
UNION ALL SELECT 'lineitem', count(*), count(DISTINCT (l_orderkey, l_linenumber)),
                 count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem""")
def q_assert_unique(spark, d):
    a = Q.assert_unique(T(spark, d, "orders"), "o_orderkey").withColumn("tbl", F.lit("orders"))
    b = Q.assert_unique(T(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]).withColumn("tbl", F.lit("lineitem"))
    return a.unionByName(b).select("tbl", "rows", "distinct_keys", "unique")


@register("missing_by_status", """
SELECT o_orderstatus, count(*) AS n FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_mktsegment <> 'BUILDING')
GROUP BY 1""")
def q_missing_by_status(spark, d):
    from ..operators.lookup import lookup_join
    c = T(spark, d, "customer").where(F.col("c_mktsegment") != "BUILDING")
    j = lookup_join(T(spark, d, "orders"), c, {"o_custkey": "c_custkey"}, {"c_custkey": "cust_found"})
    return Q.missing_by(j, "cust_found", "o_orderstatus")


@register("orphans_unrecovered", """
WITH orph AS (SELECT DISTINCT l_orderkey AS id FROM lineitem
              WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'))
SELECT id FROM orph WHERE id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT')""")
def q_orphans_unrecovered(spark, d):
    cols = [F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust")]
    known = _orders_known(spark, d).select(*cols)
    # the refetch returns every campaign except the urgent ones: those orphans stay unrecovered and are reported
    source = T(spark, d, "orders").where(F.col("o_orderpriority") != "1-URGENT").select(*cols)
    _, _, unrecovered = M.reconcile_orphans(T(spark, d, "lineitem"), known, source, "id", fact_key="l_orderkey")
    return unrecovered
