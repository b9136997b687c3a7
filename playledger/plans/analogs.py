"""How the driver tables stand in for the domain inputs.

* play log (events): ``user_id`` = player (NULL when ``user_id % 7 = 0``, so NULL keys exist), ``props.k``
  = reservation (0 = filler), ``event_type`` = content, ``value`` = duration, ``ts`` = play end time.
* line items (lineitem grouped by ``(l_orderkey, l_linenumber)``, the smallest unique key):
  ``l_orderkey`` = campaign and reservation (none when ``l_orderkey % 7 = 0``), flight = first ship date
  for ``max(l_quantity)`` days, price = sum of extended prices, screen count = line number.
* play facts for the budget (lineitem rows with ``l_linestatus = 'F'``): reservation = ``l_orderkey``,
  player = ``l_suppkey``, day = ship date, impressions = quantity.
* players (supplier): name prefixed by a metro format chosen from ``s_nationkey % 3``.

Each analog is defined twice - as a DataFrame (what the library runs) and as DuckDB SQL (the oracle) -
and both read the whole tables.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import json_number_field
from ..functions.semantics import inclusive_days, round_half_up

# The ship dates of the driver tables lie in 1995-2001; the budget window is a parameter of the job.
BUDGET_WINDOW = (dt.date(1996, 1, 1), dt.date(2000, 12, 31))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (a missing table raises)."""
    from ..sources.readers import read_layer
    return read_layer(spark, sf_dir, f"{name}.parquet")


# --- play log from events -------------------------------------------------------------------------

def play_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("PlayerID"),
        F.col("ts").alias("DateEndTime"),
        F.col("value").alias("Duration"),
        F.col("event_type").alias("AdCopyId"),
        json_number_field(F.col("props"), "k").alias("CampID"),
        F.col("event_id"),
    )


PLAY_LOG_SQL = """play_log AS (
  SELECT CASE WHEN user_id % 7 <> 0 THEN user_id END AS PlayerID, ts AS DateEndTime, value AS Duration,
         event_type AS AdCopyId,
         CAST(NULLIF(regexp_extract(props, '"k"\\s*:\\s*"?(-?\\d+)', 1), '') AS BIGINT) AS CampID, event_id
  FROM events)"""


# --- line items from lineitem ---------------------------------------------------------------------

def _line_name(orderkey, linenumber):
    k = orderkey.cast("string")
    return (F.when(linenumber == 1, F.concat(F.lit("LL_"), k))
             .when(linenumber == 2, F.concat(F.lit("STV_"), k))
             .when(linenumber == 3, F.concat(F.lit("MetroMax "), k))
             .when(linenumber == 4, F.concat(F.lit("StroerTV & LL "), k))
             .when(linenumber == 5, F.concat(F.lit("DMB_"), k))
             .when(linenumber == 6, F.concat(F.lit("21/07 DMB/STV/LL "), k))
             .otherwise(F.concat(F.lit("Kampania "), k)))


LINE_NAME_SQL = """CASE l_linenumber WHEN 1 THEN 'LL_' || l_orderkey WHEN 2 THEN 'STV_' || l_orderkey
    WHEN 3 THEN 'MetroMax ' || l_orderkey WHEN 4 THEN 'StroerTV & LL ' || l_orderkey
    WHEN 5 THEN 'DMB_' || l_orderkey WHEN 6 THEN '21/07 DMB/STV/LL ' || l_orderkey
    ELSE 'Kampania ' || l_orderkey END"""


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_orderkey", "l_linenumber").agg(
        round_half_up(F.sum("l_extendedprice"), 2).alias("line_price"),
        (F.sum("l_quantity") * 24).alias("perf_expected_repetitions"),
        round_half_up(F.sum(F.col("l_quantity") * (1 - F.col("l_discount"))) * 24, 2).alias("perf_actual_repetitions"),
        F.to_date(F.min("l_shipdate")).alias("line_start"),
        F.max("l_quantity").cast("int").alias("q"),
    )
    return g.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_item_id"),
        F.col("l_orderkey").alias("campaign_id"),
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_orderkey")).alias("reservation_id"),
        _line_name(F.col("l_orderkey"), F.col("l_linenumber")).alias("line_item_name"),
        "line_price", "perf_expected_repetitions", "perf_actual_repetitions",
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linenumber") + 10).cast("double").alias("slot_duration"),
        "line_start",
        F.date_add("line_start", F.col("q") - 1).alias("line_end"),
        inclusive_days(F.col("line_start"), F.date_add("line_start", F.col("q") - 1)).cast("bigint").alias("line_days"),
        F.col("l_linenumber").cast("bigint").alias("screen_count"),
        F.when(F.col("l_linenumber") % 4 == 0, F.lit("Cancelled")).otherwise(F.lit("Live")).alias("status_name"),
    )


LINE_ITEMS_SQL = f"""li AS (
  SELECT l_orderkey * 10 + l_linenumber AS line_item_id, l_orderkey AS campaign_id,
         CASE WHEN l_orderkey % 7 <> 0 THEN l_orderkey END AS reservation_id,
         {LINE_NAME_SQL} AS line_item_name,
         round(CAST(sum(l_extendedprice) AS DECIMAL(38,10)), 2)::DOUBLE AS line_price,
         sum(l_quantity) * 24 AS perf_expected_repetitions,
         round(CAST(sum(l_quantity * (1 - l_discount)) * 24 AS DECIMAL(38,10)), 2)::DOUBLE AS perf_actual_repetitions,
         CAST(CASE WHEN l_linenumber % 3 <> 0 THEN l_linenumber + 10 END AS DOUBLE) AS slot_duration,
         CAST(min(l_shipdate) AS DATE) AS line_start,
         CAST(min(l_shipdate) AS DATE) + CAST(max(l_quantity) AS INTEGER) - 1 AS line_end,
         CAST(greatest(CAST(max(l_quantity) AS INTEGER), 1) AS BIGINT) AS line_days,
         CAST(l_linenumber AS BIGINT) AS screen_count,
         CASE WHEN l_linenumber % 4 = 0 THEN 'Cancelled' ELSE 'Live' END AS status_name
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""


def budget_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("CampID"), F.col("l_suppkey").alias("PlayerID"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date_key"),
        F.col("l_quantity").alias("Impresje"))


BUDGET_LOGS_SQL = """blogs AS (
  SELECT l_orderkey AS CampID, l_suppkey AS PlayerID, strftime(l_shipdate, '%Y-%m-%d') AS date_key,
         l_quantity AS Impresje
  FROM lineitem)"""


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    name = (F.when(F.col("s_nationkey") % 3 == 0, F.concat(F.lit("LiveLine "), F.col("s_name")))
             .when(F.col("s_nationkey") % 3 == 1, F.concat(F.lit("StroerTV "), F.col("s_name")))
             .otherwise(F.col("s_name")))
    return s.select(F.col("s_suppkey").alias("play_log_player_id"), name.alias("player_name"),
                    F.col("s_nationkey").alias("display_unit_id"))


PLAYERS_SQL = """players AS (
  SELECT s_suppkey AS play_log_player_id,
         CASE s_nationkey % 3 WHEN 0 THEN 'LiveLine ' || s_name WHEN 1 THEN 'StroerTV ' || s_name ELSE s_name END
           AS player_name,
         s_nationkey AS display_unit_id
  FROM supplier)"""
