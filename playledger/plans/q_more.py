"""Remaining operator queries: run log, JSON, HTML links, conformance and unions, lookups, dedup, ranges,
previews, overrides, sampling and ordering."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.jsonfn import unpack_json
from ..functions.names import file_date
from ..functions.semantics import blank_to_null, round_half_up
from ..operators import conform as C
from ..operators import lookup as L
from ..operators import rollup as R
from ..operators.filters import order_nulls_last, stable_sample, top_k
from ..operators.expand import synthetic_rows
from . import analogs as A
from .catalog import register
from .runlog import last_run

T = A.table


# ---- C19 / S17 / F20 -------------------------------------------------------------------------------------------
@register("log_last_run", """
WITH marks AS (SELECT user_id, count(*) AS run_no, max({'ts': ts, 'id': event_id}) AS st FROM events WHERE event_type = 'signup' GROUP BY 1),
run AS (SELECT e.*, m.run_no FROM events e JOIN marks m ON m.user_id = e.user_id WHERE {'ts': e.ts, 'id': e.event_id} >= m.st)
SELECT user_id, max(run_no) AS run_no, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS started, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS finished,
       CAST(count_if(event_type IN ('view', 'click', 'purchase')) AS BIGINT) AS n_ok, CAST(count_if(event_type = 'error') AS BIGINT) AS n_fail,
       count(*) AS n_lines, round(CAST(coalesce(sum(value), 0) AS DECIMAL(38,10)), 2)::DOUBLE AS counter
FROM run GROUP BY user_id""")
def q_log_last_run(spark, d):
    ev = T(spark, d, "events")
    r = last_run(ev, "user_id", ["ts", "event_id"], F.col("event_type") == "signup",
                 F.col("event_type").isin("view", "click", "purchase"), F.col("event_type") == "error", F.col("value"))
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return (r.withColumn("counter", round_half_up(F.col("counter"), 2))
             .withColumn("started", F.date_format("started", fmt)).withColumn("finished", F.date_format("finished", fmt)))


# ---- F7 / S12 / M14 -------------------------------------------------------------------------------------------
def _nested_json():
    return (F.when(F.col("event_id") % 50 == 0, F.lit("not json"))
             .otherwise(F.concat(F.lit('{"perf": {"goal": '), F.regexp_extract("props", r'"k"\s*:\s*(\d+)', 1),
                                 F.lit(', "unit": "'), F.col("event_type"), F.lit('"}, "k": '),
                                 F.regexp_extract("props", r'"k"\s*:\s*(\d+)', 1), F.lit("}"))))


@register("json_unpack", """
WITH j AS (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'not json'
                                 ELSE '{"perf": {"goal": ' || regexp_extract(props, '"k"\\s*:\\s*(\\d+)', 1) || ', "unit": "' || event_type
                                      || '"}, "k": ' || regexp_extract(props, '"k"\\s*:\\s*(\\d+)', 1) || '}' END AS doc FROM events)
SELECT event_id,
       CASE WHEN json_valid(doc) THEN CAST(json_extract(doc, '$.k') AS BIGINT) END AS "doc_k",
       CASE WHEN json_valid(doc) THEN CAST(json_extract(doc, '$.perf.goal') AS BIGINT) END AS "doc_perf.goal",
       CASE WHEN json_valid(doc) THEN json_extract_string(doc, '$.perf.unit') END AS "doc_perf.unit"
FROM j""")
def q_json_unpack(spark, d):
    ev = T(spark, d, "events").select("event_id", _nested_json().alias("doc"))
    return unpack_json(ev, "doc", "k bigint, perf struct<goal: bigint, unit: string>", prefix="doc_")


@register("nested_to_json", """
SELECT c_custkey, '{"name":"' || c_name || '","seg":{"code":"' || c_mktsegment || '","nation":' || CAST(c_nationkey AS VARCHAR) || '}}' AS doc,
       '[' || CAST(c_nationkey AS VARCHAR) || ',' || CAST(c_custkey % 3 AS VARCHAR) || ']' AS tags
FROM customer""")
def q_nested_to_json(spark, d):
    from ..functions.jsonfn import nested_to_json
    c = T(spark, d, "customer").select(
        "c_custkey", F.struct(F.col("c_name").alias("name"),
                              F.struct(F.col("c_mktsegment").alias("code"), F.col("c_nationkey").alias("nation")).alias("seg")).alias("doc"),
        F.array(F.col("c_nationkey").cast("bigint"), F.col("c_custkey") % 3).alias("tags"))
    return nested_to_json(c)


# ---- S14 / S15 / F16: links in HTML pages ---------------------------------------------------------------------------
@register("href_files", """
SELECT page_id, CAST(h.pos AS INTEGER) AS pos, h.href AS href
FROM pages, LATERAL (SELECT unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href,
                            unnest(range(len(regexp_extract_all(html, 'href="([^"]+)"', 1)))) AS pos) h""")
def q_href_files(spark, d):
    p = T(spark, d, "pages")
    return p.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r'href="([^"]+)"'), 1)).alias("pos", "href"))


@register("page_dates", """
SELECT page_id, url, strftime(CAST(NULLIF(regexp_extract(url || ' ' || CAST(page_id % 28 + 1 AS VARCHAR), '(\\d{4}-\\d{2}-\\d{2})', 1), '') AS DATE), '%Y-%m-%d') AS d,
       regexp_extract('playlog-2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || CASE WHEN page_id % 2 = 0 THEN '.txt.gz' ELSE '.txt' END,
                      '(\\d{4}-\\d{2}-\\d{2})', 1) AS file_day
FROM pages""")
def q_page_dates(spark, d):
    p = T(spark, d, "pages")
    name = F.concat(F.lit("playlog-2024-01-"), F.lpad(((F.col("page_id") % 28) + 1).cast("string"), 2, "0"),
                    F.when(F.col("page_id") % 2 == 0, ".txt.gz").otherwise(".txt"))
    return p.select("page_id", "url",
                    F.date_format(file_date(F.concat(F.col("url"), F.lit(" "), ((F.col("page_id") % 28) + 1).cast("string"))), "yyyy-MM-dd").alias("d"),
                    F.date_format(file_date(name), "yyyy-MM-dd").alias("file_day"))


# ---- P1 / P2 / P3 / P16 / U1 / M15 -----------------------------------------------------------------------------------
_SCHEMA = "customer_id bigint, customer_name string, nation_id int, balance double, segment string, region_id bigint, source string"


@register("conform_columns", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id, c_acctbal AS balance,
       c_mktsegment AS segment, NULL::BIGINT AS region_id, 'direct' AS source
FROM customer""")
def q_conform(spark, d):
    c = T(spark, d, "customer").withColumn("_fetched_at", F.current_timestamp())
    c = C.drop_audit(c, "_fetched_at")
    out = C.conform(c, _SCHEMA, rename={"c_custkey": "customer_id", "c_name": "customer_name", "c_nationkey": "nation_id",
                                        "c_acctbal": "balance", "c_mktsegment": "segment"}, strict_names=True)
    return out.withColumn("source", F.coalesce(F.col("source"), F.lit("direct")))


@register("prefixed_columns", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem""")
def q_prefixed(spark, d):
    li = T(spark, d, "lineitem")
    keep = ["l_orderkey", "l_linenumber"] + [c for c in C.prefixed(li, "l_q", "l_e", "l_d", "l_t", "l_r", "l_l")
                                             if c not in ("l_linenumber",)]
    return li.select(*keep)


@register("union_missing_columns", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::VARCHAR AS segment, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, 'supplier', 'supplier' FROM supplier""")
def q_union_missing(spark, d):
    c = T(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                       F.col("c_acctbal").alias("balance"))
    s = T(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                       F.lit("supplier").alias("segment"))
    return C.union_by_name(c, s, tag="kind", tags=["customer", "supplier"])


@register("union_mixed_types", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 1""")
def q_union_mixed(spark, d):
    o = T(spark, d, "orders")
    a = o.where(F.col("o_orderkey") % 2 == 0).select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("price"))
    b = o.where(F.col("o_orderkey") % 2 == 1).select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    return C.union_by_name(a, b, types={"price": "double"})


# ---- J1 / J6 / J7 / J8 / J13 / J14 / J17 -----------------------------------------------------------------------------
@register("left_lookup_one", """
SELECT o.o_orderkey, NULLIF(o.o_custkey, 0) AS cust, coalesce(c.c_name, 'unknown') AS customer_name
FROM orders o LEFT JOIN customer c ON c.c_custkey = NULLIF(o.o_custkey, 0)""")
def q_left_lookup_one(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", blank_to_null(F.col("o_custkey")).alias("cust"))
    j = L.lookup_join(o, T(spark, d, "customer"), {"cust": "c_custkey"}, {"c_name": "customer_name"})
    return j.withColumn("customer_name", F.coalesce("customer_name", F.lit("unknown")))


@register("left_lookup_two_key", """
WITH plan AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, l_suppkey, sum(l_quantity) AS planned FROM lineitem GROUP BY 1, 2),
act AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, l_suppkey, sum(l_quantity) AS actual FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2)
SELECT p.day, p.l_suppkey, p.planned, coalesce(a.actual, 0.0) AS actual
FROM plan p LEFT JOIN act a ON a.day = p.day AND a.l_suppkey = p.l_suppkey""")
def q_left_lookup_two(spark, d):
    li = T(spark, d, "lineitem").withColumn("day", F.date_format("l_shipdate", "yyyy-MM-dd"))
    plan = li.groupBy("day", "l_suppkey").agg(F.sum("l_quantity").alias("planned"))
    act = li.where(F.col("l_linestatus") == "F").groupBy("day", "l_suppkey").agg(F.sum("l_quantity").alias("actual"))
    j = L.lookup_join(plan, act, ["day", "l_suppkey"], ["actual"])
    return j.withColumn("actual", F.coalesce("actual", F.lit(0.0)))


@register("anti_three_keys", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem a
WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_returnflag = 'R' AND b.l_orderkey = a.l_orderkey
                  AND b.l_partkey = a.l_partkey AND b.l_suppkey = a.l_suppkey)""")
def q_anti_three(spark, d):
    li = T(spark, d, "lineitem")
    seen = li.where(F.col("l_returnflag") == "R")
    return L.unknown_keys(li, seen, ["l_orderkey", "l_partkey", "l_suppkey"]).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@register("two_hop_reservation_map", """
SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, c.c_nationkey
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey""")
def q_two_hop(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = T(spark, d, "customer").select("c_custkey", "c_nationkey")
    m = L.lookup_join(o, c, {"o_custkey": "c_custkey"}, ["c_nationkey"])
    m = R.dedup(m, ["o_orderkey"], order=["o_custkey"])
    return L.lookup_join(T(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), m, {"l_orderkey": "o_orderkey"},
                         ["o_custkey", "c_nationkey"])


# ---- D3 / D5 / A12 / W3 -------------------------------------------------------------------------------------------------
@register("distinct_pairs", "SELECT DISTINCT l_suppkey, l_partkey % 50 AS grp FROM lineitem")
def q_distinct_pairs(spark, d):
    return T(spark, d, "lineitem").select("l_suppkey", (F.col("l_partkey") % 50).alias("grp")).distinct()


@register("override_dedup", """
SELECT o_custkey AS cust, o_orderkey AS last_order, o_totalprice AS price FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def q_override_dedup(spark, d):
    o = T(spark, d, "orders").select(F.col("o_custkey").alias("cust"), F.col("o_orderkey").alias("last_order"),
                                     F.col("o_totalprice").alias("price"))
    return R.dedup(o, ["cust"], order=["last_order"], keep="last")


@register("global_range", """
SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_ts, count(*) AS n, count(DISTINCT user_id) AS users,
       round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6) AS error_share FROM events""")
def q_global_range(spark, d):
    ev = T(spark, d, "events")
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return ev.agg(F.date_format(F.min("ts"), fmt).alias("first_ts"), F.date_format(F.max("ts"), fmt).alias("last_ts"),
                  F.count(F.lit(1)).alias("n"),
                  F.countDistinct("user_id").alias("users"),
                  F.round(F.avg(F.when(F.col("event_type") == "error", 1.0).otherwise(0.0)), 6).alias("error_share"))


@register("preview_top", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type FROM events ORDER BY events.ts, event_id LIMIT 5")
def q_preview(spark, d):
    top = top_k(T(spark, d, "events").select("event_id", "ts", "event_type"), [F.col("ts"), F.col("event_id")], 5)
    return top.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "event_type")


# ---- P12 / J18 / G6 -----------------------------------------------------------------------------------------------------
_OVR = [{"o_orderkey": 9, "cust": 1, "prio": "1-URGENT"}, {"o_orderkey": 18, "cust": 2, "prio": None},
        {"o_orderkey": 27, "cust": 3, "prio": "2-HIGH"}, {"o_orderkey": 27, "cust": 4, "prio": "2-HIGH"}]


@register("override_where_null", """
WITH ov AS (SELECT * FROM (VALUES (9, 1, '1-URGENT'), (18, 2, NULL), (27, 4, '2-HIGH')) t(k, cust, prio)),
o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey END AS cust,
             CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS prio FROM orders)
SELECT o.o_orderkey, CASE WHEN o.cust IS NULL THEN ov.cust ELSE o.cust END AS cust,
       CASE WHEN o.prio IS NULL THEN ov.prio ELSE o.prio END AS prio
FROM o LEFT JOIN ov ON ov.k = o.o_orderkey""")
def q_override(spark, d):
    o = T(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")).alias("cust"),
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")).alias("prio"))
    ov = synthetic_rows(spark, _OVR, "o_orderkey bigint, cust bigint, prio string")
    return L.override_where_null(o, "o_orderkey", ov, ["cust", "prio"])   # of two overrides of a key the last wins


# ---- P15 / W1 -------------------------------------------------------------------------------------------------------------
@register("stable_sample", """
SELECT c_custkey, c_name FROM customer ORDER BY md5('42:' || CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 100""")
def q_stable_sample(spark, d):
    return stable_sample(T(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", 100, seed=42)


@register("sort_nulls_last", f"""
WITH {A.PLAY_LOG_SQL}
SELECT event_id, PlayerID FROM play_log ORDER BY PlayerID DESC NULLS LAST, event_id""")
def q_sort_nulls_last(spark, d):
    pl = A.play_log(spark, d).select("event_id", "PlayerID")
    return order_nulls_last(pl, ["PlayerID", "event_id"], [True, False])


# ---- S14 / S15 / F16: a file index scraped from pages -------------------------------------------------------------------
def _index_html():
    day = F.lpad(((F.col("page_id") % 28) + 1).cast("string"), 2, "0")
    links = F.concat(F.lit('<a href="/logs/playlog-2024-01-'), day, F.lit('.txt.gz">gz</a>'),
                     F.when(F.col("page_id") % 3 != 0,
                            F.concat(F.lit('<a href="playlog-2024-01-'), day, F.lit('.txt">txt</a>'))).otherwise(F.lit("")),
                     F.lit('<a href="readme-2024-01-'), day, F.lit('.txt">x</a>'))
    return F.concat(F.col("html"), links)


@register("index_files", """
WITH l AS (SELECT unnest(regexp_extract_all(html || '<a href="/logs/playlog-2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0')
                    || '.txt.gz">gz</a>' || CASE WHEN page_id % 3 <> 0 THEN '<a href="playlog-2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0')
                    || '.txt">txt</a>' ELSE '' END || '<a href="readme-2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || '.txt">x</a>',
                    'href="([^"]+)"', 1)) AS href FROM pages),
f AS (SELECT DISTINCT regexp_extract(href, '([^/]+)$', 1) AS file FROM l),
g AS (SELECT file, CAST(NULLIF(regexp_extract(file, '(\\d{4}-\\d{2}-\\d{2})', 1), '') AS DATE) AS d, ends_with(file, '.gz') AS gz
      FROM f WHERE starts_with(file, 'playlog-') AND (ends_with(file, '.txt') OR ends_with(file, '.txt.gz')))
SELECT file, strftime(d, '%Y-%m-%d') AS file_date FROM (
  SELECT *, row_number() OVER (PARTITION BY d ORDER BY gz, file) AS rn FROM g WHERE d IS NOT NULL) WHERE rn = 1""")
def q_index_files(spark, d):
    from ..sources.readers import index_files
    pages = T(spark, d, "pages").select(_index_html().alias("html"))
    return index_files(pages).select("file", F.date_format("file_date", "yyyy-MM-dd").alias("file_date"))
