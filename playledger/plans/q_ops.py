"""Operator-level queries (filters, null rules, lookups, expansion, aggregates, names, calendar, sets)."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as K
from ..functions import names as N
from ..functions.calendar import calendar_columns, iso_week_label
from ..functions.semantics import is_in, keep_not_in, not_null_and_not_zero, not_zero, round_half_up, sum_round
from ..operators import expand as X
from ..operators import lookup as L
from ..operators import rollup as R
from ..operators.filters import active_status
from . import analogs as A
from .catalog import register
from .gold import period_bridge

T = A.table
LO, HI = A.BUDGET_WINDOW


def _label_sql(h):
    return (f"CASE WHEN {h} IS NOT NULL THEN lpad(CAST({h} AS VARCHAR), 2, '0') || ':00-' || "
            f"lpad(CAST(({h} + 1) % 24 AS VARCHAR), 2, '0') || ':00' END")


# ---- F4 ------------------------------------------------------------------------------------------
@register("timeslot_label", f"""
SELECT DISTINCT CAST(hour(ts) AS INTEGER) AS timeslot, {_label_sql('hour(ts)')} AS timeslot_label FROM events""")
def q_timeslot_label(spark, d):
    h = F.hour("ts")
    return T(spark, d, "events").select(h.alias("timeslot"), N.slot_label(h).alias("timeslot_label")).distinct()


# ---- P4 / P14: zero filter with NULL kept ----------------------------------------------------------
_XK_SQL = "CASE WHEN user_id % 7 = 0 THEN NULL ELSE CAST(regexp_extract(props, '\"k\"\\s*:\\s*(\\d+)', 1) AS BIGINT) END"


def _xk():
    return F.when(F.col("user_id") % 7 != 0, N.json_number_field(F.col("props"), "k"))


@register("zero_filter_nullsafe", f"""
SELECT event_id, x FROM (SELECT event_id, {_XK_SQL} AS x FROM events) WHERE coalesce(x <> 0, true)""")
def q_zero_filter(spark, d):
    return T(spark, d, "events").select("event_id", _xk().alias("x")).where(not_zero("x"))


@register("pair_filter", f"""
WITH {A.PLAY_LOG_SQL}
SELECT event_id, NULLIF(PlayerID % 10, 0) AS frame_id, NULLIF(CampID % 10, 0) AS group_id FROM play_log
WHERE NULLIF(PlayerID % 10, 0) IS NOT NULL AND NULLIF(CampID % 10, 0) IS NOT NULL""")
def q_pair_filter(spark, d):
    pl = A.play_log(spark, d).select("event_id", N.F.nullif(F.col("PlayerID") % 10, F.lit(0)).alias("frame_id"),
                                     F.nullif(F.col("CampID") % 10, F.lit(0)).alias("group_id"))
    return pl.where(not_null_and_not_zero("frame_id", "group_id"))


# ---- P6 / P13 ----------------------------------------------------------------------------------------
_EXCL = list(range(1, 11))


@register("not_in_keeps_null", f"""
SELECT event_id, x FROM (SELECT event_id, {_XK_SQL} AS x FROM events)
WHERE coalesce(NOT x IN ({', '.join(map(str, _EXCL))}), true)""")
def q_not_in(spark, d):
    return T(spark, d, "events").select("event_id", _xk().alias("x")).where(keep_not_in("x", _EXCL))


_S1 = [3, 14, 15, 92, 65]
_S2 = [1, 2, 3, 4, 5, 6, 7, 8, 9]


@register("flag_precedence", f"""
WITH {A.PLAY_LOG_SQL}
SELECT event_id, CAST(CASE WHEN coalesce(CampID IN ({', '.join(map(str, _S1))}), false) THEN 1
                        WHEN coalesce(PlayerID IN ({', '.join(map(str, _S2))}), false) THEN 2 ELSE 0 END AS TINYINT) AS flag
FROM play_log""")
def q_flag_precedence(spark, d):
    pl = A.play_log(spark, d)
    return pl.select("event_id", L.service_flag([is_in(F.col("CampID"), _S1)], [is_in(F.col("PlayerID"), _S2)]).alias("flag"))


# ---- P7 / P8 / P9 ---------------------------------------------------------------------------------
@register("positive_only", """
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount > 0""")
def q_positive(spark, d):
    return T(spark, d, "lineitem").where(F.col("l_discount") > 0).select("l_orderkey", "l_linenumber", "l_discount")


@register("drop_null_keys", f"""
WITH {A.PLAY_LOG_SQL}
SELECT event_id, PlayerID, CampID FROM play_log WHERE PlayerID IS NOT NULL AND CampID IS NOT NULL""")
def q_drop_null(spark, d):
    return R.drop_null_keys(A.play_log(spark, d), ["PlayerID", "CampID"]).select("event_id", "PlayerID", "CampID")


_STATUS_SQL = "CASE o_orderstatus WHEN 'O' THEN 'Live' WHEN 'F' THEN 'ENDED' ELSE 'draft' END"


def _status():
    return F.when(F.col("o_orderstatus") == "O", "Live").when(F.col("o_orderstatus") == "F", "ENDED").otherwise("draft")


@register("status_whitelist", f"""
SELECT o_orderkey, {_STATUS_SQL} AS status_name FROM orders
WHERE coalesce(lower({_STATUS_SQL}) IN ('live', 'ended', 'submitted', 'booked'), false)""")
def q_status(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", _status().alias("status_name"))
    return o.where(active_status("status_name"))


# ---- F6 / F19 ----------------------------------------------------------------------------------------
_RES_SQL = "CASE p_size % 4 WHEN 0 THEN '1920 x 540' WHEN 1 THEN ' 1920 x 1080 ' WHEN 2 THEN '3840 x 2160' ELSE p_type END"


@register("classify_map", f"""
SELECT p_partkey, CASE lower(trim({_RES_SQL})) WHEN '1920 x 540' THEN 'liveline' WHEN '1920 x 1080' THEN 'stroertv'
                       WHEN '3840 x 2160' THEN 'triplay' ELSE 'other' END AS content_format
FROM part""")
def q_classify(spark, d):
    p = T(spark, d, "part")
    res = (F.when(F.col("p_size") % 4 == 0, "1920 x 540").when(F.col("p_size") % 4 == 1, " 1920 x 1080 ")
            .when(F.col("p_size") % 4 == 2, "3840 x 2160").otherwise(F.col("p_type")))
    return p.select("p_partkey", N.classify(res, K.RESOLUTION_FORMAT, K.DEFAULT_FORMAT, normalize=True).alias("content_format"))


# ---- F9: location ------------------------------------------------------------------------------------
def _loc_name():
    k = F.col("p_partkey") % 8
    nm = F.regexp_replace(F.col("p_name"), " ", "_")
    return (F.when(k == 0, F.concat(F.lit("A"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("_"), nm, F.lit("_TP05_południe")))
             .when(k == 1, F.concat(F.col("p_brand"), F.lit(" | "), F.col("p_name"), F.lit(" | "), F.col("p_partkey").cast("string")))
             .when(k == 2, F.concat(F.lit("Panel "), F.col("p_name")))
             .when(k == 3, F.concat(F.lit("C1"), (F.col("p_size") % 9).cast("string"), F.lit("_DMB_"), nm, F.lit("_cała_stacja")))
             .when(k == 4, F.concat(F.col("p_type"), F.lit(" Kraków")))
             .when(k == 5, F.concat(F.lit("B18D | "), F.col("p_name"), F.lit(" | 1")))
             .when(k == 6, F.concat(F.lit("X"), (F.col("p_size") % 9).cast("string"), F.lit("_TP"), F.lit("_CA_"), nm))
             .otherwise(F.col("p_brand")))


_LOC_NAME_SQL = """CASE p_partkey % 8
  WHEN 0 THEN 'A' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '_' || replace(p_name, ' ', '_') || '_TP05_południe'
  WHEN 1 THEN p_brand || ' | ' || p_name || ' | ' || CAST(p_partkey AS VARCHAR)
  WHEN 2 THEN 'Panel ' || p_name
  WHEN 3 THEN 'C1' || CAST(p_size % 9 AS VARCHAR) || '_DMB_' || replace(p_name, ' ', '_') || '_cała_stacja'
  WHEN 4 THEN p_type || ' Kraków'
  WHEN 5 THEN 'B18D | ' || p_name || ' | 1'
  WHEN 6 THEN 'X' || CAST(p_size % 9 AS VARCHAR) || '_TP' || '_CA_' || replace(p_name, ' ', '_')
  ELSE p_brand END"""

_STOPS = ", ".join(f"'{w}'" for w in K.LOCATION_STOP_WORDS)
_CODE = K.LOCATION_CODE_PATTERN


def _location_sql(v):
    pri = "\n".join(
        f"    WHEN regexp_matches({v}, '{pat}'{', ' + repr('i') if ic else ''}) THEN '{label}'"
        for label, pat, ic in K.LOCATION_PRIORITY)
    parts = f"list_filter(string_split({v}, '_')[2:], lambda x: x <> '')"
    return f"""CASE WHEN {v} IS NULL THEN NULL
{pri}
    WHEN contains({v}, ' | ') THEN trim(string_split({v}, ' | ')[2])
    WHEN contains({v}, '_') THEN (
      SELECT CASE WHEN fn > 0 AND (fs = 0 OR fn < fs)
                  THEN array_to_string(parts[fn:fn + (CASE WHEN te = 0 THEN len(parts) - fn + 1 ELSE te END) - 1], ' ') END
      FROM (SELECT parts, fn, fs,
                   coalesce(list_position(list_transform(parts[fn + 1:], lambda x: lower(x) IN ({_STOPS}) OR regexp_matches(x, '{_CODE}')), true), 0) AS te
            FROM (SELECT parts,
                         coalesce(list_position(list_transform(parts, lambda x: NOT (lower(x) IN ({_STOPS})) AND NOT regexp_matches(x, '{_CODE}')), true), 0) AS fn,
                         coalesce(list_position(list_transform(parts, lambda x: lower(x) IN ({_STOPS})), true), 0) AS fs
                  FROM (SELECT {parts} AS parts))))
    WHEN len(string_split({v}, ' ')) >= 2 THEN string_split({v}, ' ')[2]
  END"""


@register("name_location", f"""
SELECT p_partkey, name, {_location_sql('name')} AS location FROM (SELECT p_partkey, {_LOC_NAME_SQL} AS name FROM part)""")
def q_location(spark, d):
    p = T(spark, d, "part").select("p_partkey", _loc_name().alias("name"))
    return p.select("p_partkey", "name", N.location("name").alias("location"))


# ---- F12 / F13 ----------------------------------------------------------------------------------------
def _tok_sql(n, w):
    return f"regexp_matches(lower({n}), '(^|[_ /]){w}([_ /]|$)')"


@register("name_tokens", f"""
WITH {A.LINE_ITEMS_SQL},
t AS (SELECT line_item_id, line_item_name AS n,
             contains(lower(line_item_name), 'liveline') OR {_tok_sql('line_item_name', 'll')} AS ll,
             contains(lower(line_item_name), 'stroertv') OR {_tok_sql('line_item_name', 'stv')} AS stv,
             contains(lower(line_item_name), 'metromax') AS mm,
             {_tok_sql('line_item_name', 'dmb')} AS dmb, {_tok_sql('line_item_name', 'tp')} AS tp FROM li)
SELECT line_item_id,
       concat_ws(',', CASE WHEN ll THEN 'LL' END, CASE WHEN stv THEN 'STV' END, CASE WHEN mm THEN 'MM' END,
                 CASE WHEN dmb THEN 'DMB' END, CASE WHEN tp THEN 'TP' END) AS tokens,
       CASE WHEN NOT (ll OR stv OR mm) THEN NULL
            WHEN mm OR (ll::INT + stv::INT + mm::INT + dmb::INT + tp::INT) > 1 THEN 'BUNDLE'
            WHEN ll THEN 'liveline' WHEN stv THEN 'stroertv' END AS name_format
FROM t""")
def q_name_tokens(spark, d):
    li = A.line_items(spark, d)
    t = N.name_tokens("line_item_name")
    return li.select("line_item_id", F.array_join(t, ",").alias("tokens"), N.name_format(t).alias("name_format"))


# ---- F10 ------------------------------------------------------------------------------------------------
@register("test_flag", """
SELECT c_custkey,
       coalesce(regexp_matches(CASE c_custkey % 5 WHEN 0 THEN 'Biuro ' || c_name WHEN 1 THEN c_name || '_TEST' ELSE c_name END,
                               'biuro|test|teltronic', 'i'), false)
       OR coalesce(regexp_matches(CASE WHEN c_nationkey % 4 = 0 THEN 'TELTRONIC_VPN_3' END, 'biuro|test|teltronic', 'i'), false)
       AS is_test
FROM customer""")
def q_test_flag(spark, d):
    c = T(spark, d, "customer")
    n1 = (F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("Biuro "), F.col("c_name")))
           .when(F.col("c_custkey") % 5 == 1, F.concat(F.col("c_name"), F.lit("_TEST"))).otherwise(F.col("c_name")))
    n2 = F.when(F.col("c_nationkey") % 4 == 0, F.lit("TELTRONIC_VPN_3"))
    return c.select("c_custkey", N.is_test(n1, n2).alias("is_test"))


# ---- F14 --------------------------------------------------------------------------------------------------
@register("exp_factor", f"""
WITH {A.LINE_ITEMS_SQL}
SELECT line_item_id,
       CAST(('0x' || substr(md5(CAST(line_item_id AS VARCHAR)), 1, 8)) AS BIGINT) AS hash32,
       {K.EXP_FACTOR_LOW!r} + (CAST(('0x' || substr(md5(CAST(line_item_id AS VARCHAR)), 1, 8)) AS BIGINT)::DOUBLE / 4294967295.0)
         * {K.EXP_FACTOR_HIGH - K.EXP_FACTOR_LOW!r} AS factor
FROM li""")
def q_exp_factor(spark, d):
    li = A.line_items(spark, d)
    h = F.conv(F.substring(F.md5(F.col("line_item_id").cast("string")), 1, 8), 16, 10).cast("bigint")
    return li.select("line_item_id", h.alias("hash32"), N.stable_factor("line_item_id").alias("factor"))


# ---- G1 / F15: calendar over the data's own date span --------------------------------------------------
_PL = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"


@register("calendar", f"""
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
days AS (SELECT CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT strftime(d, '%Y-%m-%d') AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_number,
       {_PL(K.MONTH_FULL)}[month(d)] AS month_name, {_PL(K.MONTH_SHORT)}[month(d)] AS short_month,
       'Q' || CAST(quarter(d) AS VARCHAR) AS quarter, strftime(d, '%Y-%m') AS year_month,
       {_PL(K.WEEKDAY_FULL)}[isodow(d)] AS weekday_name, {_PL(K.WEEKDAY_SHORT)}[isodow(d)] AS short_weekday,
       CAST(isodow(d) AS INTEGER) AS weekday_number, CAST(isoyear(d) AS INTEGER) AS iso_year,
       CAST(weekofyear(d) AS INTEGER) AS iso_week,
       '{K.WEEK_LABEL_PL}' || CAST(weekofyear(d) AS VARCHAR) AS iso_week2, '{K.WEEK_LABEL_EN}' || CAST(weekofyear(d) AS VARCHAR) AS iso_week3,
       CAST(isoyear(d) * 100 + weekofyear(d) AS INTEGER) AS year_week_index, isodow(d) IN (6, 7) AS is_weekend,
       strftime(d, '%Y-%m-%d') AS date
FROM days""")
def q_calendar(spark, d):
    o = T(spark, d, "orders")
    days = o.agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi")) \
            .select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return days.select(*calendar_columns("d"))


# ---- G2 / F8: flight days -------------------------------------------------------------------------------
@register("flight_days", f"""
WITH {A.LINE_ITEMS_SQL}
SELECT line_item_id, line_days,
       strftime(unnest(generate_series(greatest(line_start, DATE '{LO}')::TIMESTAMP, least(line_end, DATE '{HI}')::TIMESTAMP,
                                       INTERVAL 1 DAY)), '%Y-%m-%d') AS day
FROM li WHERE line_start IS NOT NULL AND line_end IS NOT NULL AND greatest(line_start, DATE '{LO}') <= least(line_end, DATE '{HI}')""")
def q_flight_days(spark, d):
    li = A.line_items(spark, d)
    return X.flight_days(li, "line_start", "line_end", LO, HI).select(
        "line_item_id", "line_days", F.date_format("day", "yyyy-MM-dd").alias("day"))


# ---- G3 / G4 / C15: campaign period bridge ------------------------------------------------------------------
_BRIDGE_SQL = f"""
WITH {A.LINE_ITEMS_SQL},
a AS (SELECT * FROM li WHERE coalesce(lower(status_name) IN ('live', 'ended', 'submitted', 'booked'), false)
        AND campaign_id IS NOT NULL AND line_start IS NOT NULL AND line_end IS NOT NULL),
m AS (SELECT DISTINCT campaign_id, CAST(unnest(generate_series(date_trunc('month', line_start)::TIMESTAMP,
                                   date_trunc('month', line_end)::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS m FROM a),
w AS (SELECT DISTINCT campaign_id, CAST(unnest(generate_series(date_trunc('week', line_start)::TIMESTAMP,
                                   date_trunc('week', line_end)::TIMESTAMP, INTERVAL 7 DAY)) AS DATE) AS w FROM a)
SELECT campaign_id, 'M' AS grain, strftime(m, '%Y-%m') AS year_month, strftime(m, '%Y-%m-%d') AS year_month_dt,
       NULL::VARCHAR AS year_week, NULL::VARCHAR AS year_week_dt, NULL::VARCHAR AS week_parent_month_dt FROM m
UNION ALL
SELECT campaign_id, 'W', NULL, NULL, CAST(isoyear(w) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(w) AS VARCHAR), 2, '0'),
       strftime(w, '%Y-%m-%d'), strftime(date_trunc('month', w), '%Y-%m-%d') FROM w"""


@register("period_bridge", _BRIDGE_SQL)
def q_period_bridge(spark, d):
    return period_bridge(A.line_items(spark, d))


@register("flight_months", f"""
WITH {A.LINE_ITEMS_SQL}
SELECT line_item_id, strftime(unnest(generate_series(date_trunc('month', line_start)::TIMESTAMP,
       date_trunc('month', line_end)::TIMESTAMP, INTERVAL 1 MONTH)), '%Y-%m') AS year_month FROM li""")
def q_flight_months(spark, d):
    li = A.line_items(spark, d)
    return X.flight_months(li, "line_start", "line_end", "m").select("line_item_id", F.date_format("m", "yyyy-MM").alias("year_month"))


@register("flight_weeks", f"""
WITH {A.LINE_ITEMS_SQL}
SELECT line_item_id, strftime(w, '%Y-%m-%d') AS week_monday, CAST(isoyear(w) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(w) AS VARCHAR), 2, '0') AS year_week
FROM (SELECT line_item_id, CAST(unnest(generate_series(date_trunc('week', line_start)::TIMESTAMP,
       date_trunc('week', line_end)::TIMESTAMP, INTERVAL 7 DAY)) AS DATE) AS w FROM li)""")
def q_flight_weeks(spark, d):
    li = A.line_items(spark, d)
    return X.flight_weeks(li, "line_start", "line_end", "w").select(
        "line_item_id", F.date_format("w", "yyyy-MM-dd").alias("week_monday"), iso_week_label("w").alias("year_week"))


# ---- G5 ---------------------------------------------------------------------------------------------------
@register("virtual_slots", f"""
WITH {A.LINE_ITEMS_SQL}
SELECT line_item_id, NULL::BIGINT AS player_id, unnest(range(greatest(coalesce(CAST(screen_count AS INTEGER), 1), 1))) * 0 AS z
FROM li WHERE reservation_id IS NULL""")
def q_virtual_slots(spark, d):
    li = A.line_items(spark, d).where(F.col("reservation_id").isNull())
    return X.virtual_slots(li, "screen_count").select("line_item_id", "player_id", F.lit(0).cast("bigint").alias("z"))


# ---- J2 / J3 / J9 / J10: lookup chain with fallback ------------------------------------------------------
@register("lookup_chain_fallback", """
WITH s AS (SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 6 <> 0 THEN s_nationkey END AS nk FROM supplier)
SELECT s.s_suppkey, n.n_name, r.r_name, coalesce(n.n_name, s.s_name) AS location_name
FROM s LEFT JOIN nation n ON n.n_nationkey = s.nk LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def q_lookup_chain(spark, d):
    s = T(spark, d, "supplier").select("s_suppkey", "s_name",
                                      F.when(F.col("s_suppkey") % 6 != 0, F.col("s_nationkey")).alias("nk"))
    j = L.lookup_join(s, T(spark, d, "nation"), {"nk": "n_nationkey"}, ["n_name", "n_regionkey"], bounded=True)
    j = L.lookup_join(j, T(spark, d, "region"), {"n_regionkey": "r_regionkey"}, ["r_name"], bounded=True)
    return j.select("s_suppkey", "n_name", "r_name", F.coalesce("n_name", "s_name").alias("location_name"))


# ---- J4 / D1: duplicate dimension keys ------------------------------------------------------------------
@register("lookup_multi_fanout", """
SELECT s.s_suppkey, n.n_nationkey AS region_nation
FROM supplier s JOIN nation n0 ON n0.n_nationkey = s.s_nationkey LEFT JOIN nation n ON n.n_regionkey = n0.n_regionkey""")
def q_multi_fanout(spark, d):
    nat = T(spark, d, "nation")
    s = L.lookup_join(T(spark, d, "supplier"), nat, {"s_nationkey": "n_nationkey"}, {"n_regionkey": "rk"}, bounded=True)
    j = L.lookup_join(s, nat, {"rk": "n_regionkey"}, {"n_nationkey": "region_nation"}, on_multi="fanout", bounded=True)
    return j.select("s_suppkey", "region_nation")


@register("lookup_multi_first", """
SELECT s.s_suppkey, (SELECT min(n.n_nationkey) FROM nation n WHERE n.n_regionkey = n0.n_regionkey) AS region_nation
FROM supplier s JOIN nation n0 ON n0.n_nationkey = s.s_nationkey""")
def q_multi_first(spark, d):
    nat = T(spark, d, "nation")
    s = L.lookup_join(T(spark, d, "supplier"), nat, {"s_nationkey": "n_nationkey"}, {"n_regionkey": "rk"}, bounded=True)
    j = L.lookup_join(s, nat, {"rk": "n_regionkey"}, {"n_nationkey": "region_nation"}, on_multi="first",
                      order=["region_nation"], bounded=True)
    return j.select("s_suppkey", "region_nation")


# ---- J5 / P11: overlapping columns, campaign preferred -----------------------------------------------------
@register("overlap_join_prefer_right", f"""
WITH {A.LINE_ITEMS_SQL},
c AS (SELECT o_orderkey AS campaign_id, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price,
             CASE WHEN o_orderkey % 3 <> 0 THEN {_STATUS_SQL} END AS status_name FROM orders)
SELECT li.line_item_id, coalesce(c.price, li.line_price) AS price, coalesce(c.status_name, li.status_name) AS status_name
FROM li LEFT JOIN c ON c.campaign_id = li.campaign_id""")
def q_overlap(spark, d):
    li = A.line_items(spark, d).select("line_item_id", "campaign_id", F.col("line_price").alias("price"), "status_name")
    o = T(spark, d, "orders")
    c = o.select(F.col("o_orderkey").alias("campaign_id"),
                 F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("price"),
                 F.when(F.col("o_orderkey") % 3 != 0, _status()).alias("status_name"))
    return L.overlap_join(li, c, "campaign_id", prefer="right").select("line_item_id", "price", "status_name")


# ---- A3 / A4 / W4 --------------------------------------------------------------------------------------------
@register("bridge_pairs", """
SELECT l_suppkey, count(*) AS n_pairs, array_to_string(list_sort(list_distinct(list(l_partkey % 50))), ',') AS groups
FROM lineitem GROUP BY l_suppkey""")
def q_bridge_pairs(spark, d):
    li = T(spark, d, "lineitem").select("l_suppkey", (F.col("l_partkey") % 50).alias("g"))
    return li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_pairs"), R.sorted_distinct("g", ",").alias("groups"))


# ---- A5 / C20 / U3 / U4: single-panel campaigns ---------------------------------------------------------------
@register("single_panel", """
WITH one AS (SELECT l_orderkey FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) = 1),
flagged AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'),
ids AS (SELECT l_orderkey AS campaign_id FROM one UNION SELECT o_orderkey FROM orders WHERE o_totalprice >= 450000)
SELECT campaign_id FROM ids WHERE campaign_id NOT IN (SELECT o_orderkey FROM flagged)""")
def q_single_panel(spark, d):
    li = T(spark, d, "lineitem").dropna(subset=["l_suppkey"])
    one = li.groupBy("l_orderkey").agg(F.countDistinct("l_suppkey").alias("n")).where("n = 1").select(F.col("l_orderkey").alias("campaign_id"))
    o = T(spark, d, "orders")
    forced = o.where(F.col("o_totalprice") >= 450000).select(F.col("o_orderkey").alias("campaign_id"))
    flagged = o.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")).select(F.col("o_orderkey").alias("campaign_id"))
    ids = one.union(forced).distinct()
    return L.unknown_keys(ids, flagged, "campaign_id")


# ---- A8 / G7 / A9 / Q7: campaign totals and control totals --------------------------------------------------
def _camp_lines(spark, d):
    li = T(spark, d, "lineitem").select(F.col("l_orderkey").alias("campaign_id"), "l_linenumber",
                                       F.col("l_extendedprice").alias("line_price"))
    o = T(spark, d, "orders").select(F.col("o_orderkey").alias("campaign_id"),
                                     round_half_up(F.col("o_totalprice") * 1.02, 2).alias("campaign_price"),
                                     F.col("o_custkey").alias("client_id"))
    return li.join(o, "campaign_id", "left")


@register("campaign_totals", """
SELECT l_orderkey AS campaign_id, round(CAST(sum(l_extendedprice) AS DECIMAL(38,10)), 2)::DOUBLE AS sum_line_prices,
       count(*) AS n_lines, strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S.%f') AS first_ship
FROM lineitem GROUP BY l_orderkey""")
def q_campaign_totals(spark, d):
    li = T(spark, d, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("campaign_id")).agg(
        sum_round("l_extendedprice", 2).alias("sum_line_prices"), F.count(F.lit(1)).alias("n_lines"),
        F.date_format(F.min("l_shipdate"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("first_ship"))


@register("balancing_rows", """
WITH t AS (SELECT l_orderkey AS campaign_id, coalesce(sum(l_extendedprice), 0.0) AS s FROM lineitem GROUP BY 1)
SELECT o_orderkey AS campaign_id, round(CAST(round(CAST(o_totalprice * 1.02 AS DECIMAL(38,10)), 2)::DOUBLE - s AS DECIMAL(38,10)), 2)::DOUBLE AS line_price,
       true AS is_adjustment, o_custkey AS client_id
FROM t JOIN orders ON o_orderkey = t.campaign_id WHERE abs(round(CAST(o_totalprice * 1.02 AS DECIMAL(38,10)), 2)::DOUBLE - s) > 1""")
def q_balancing(spark, d):
    b = X.balancing_rows(_camp_lines(spark, d), "campaign_id", "line_price", "campaign_price", carry=["client_id"])
    return b.select("campaign_id", round_half_up(F.col("line_price"), 2).alias("line_price"), "is_adjustment", "client_id")


@register("control_totals", """
WITH t AS (SELECT l_orderkey AS campaign_id, coalesce(sum(l_extendedprice), 0.0) AS s FROM lineitem GROUP BY 1),
per AS (SELECT t.campaign_id, coalesce(abs(round(CAST(o_totalprice * 1.02 AS DECIMAL(38,10)), 2)::DOUBLE - s) < 1, false) AS ok
        FROM t LEFT JOIN orders ON o_orderkey = t.campaign_id)
SELECT count(*) AS keys, CAST(sum(ok::INT) AS BIGINT) AS ok_keys, round(avg(ok::INT::DOUBLE), 6) AS ok_share FROM per""")
def q_control_totals(spark, d):
    from ..operators.quality import control_totals
    _, share = control_totals(_camp_lines(spark, d), "campaign_id", "line_price", "campaign_price")
    return share.select("keys", "ok_keys", F.round("ok_share", 6).alias("ok_share"))
