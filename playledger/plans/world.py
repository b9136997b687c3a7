"""Bronze-layer inputs of the silver/gold jobs, derived from the driver tables (DataFrame + DuckDB SQL).

* proposals (campaigns) = orders; proposal items (line items) = lineitem grouped by (order, line number);
* reservations: one per line item whose line number is not a multiple of 4 (id = line*10+1), and a second
  one for line number 1 (id = line*10+2, so one line item has two reservations);
* play log (hourly bronze) = lineitem rows: reservation of the row's line, player = supplier,
  frame = part % 40, display unit = supplier % 25 (0 = filler), content = part, plays at ship date + order % 24 h;
* players = supplier (claimed resource id = supplier key), display units = nation, screens = region,
  frame mapping = nation (frame n -> group region) plus region rows (frames 20-24 get a second group),
  users = customer, content dictionary = part.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.semantics import round_half_up
from ..session import cut_lineage
from . import analogs as A

T = A.table


def proposals(spark: SparkSession, d: str) -> DataFrame:
    o = T(spark, d, "orders")
    status = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", 2).otherwise(3).cast("bigint")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Kampania "), F.col("o_orderkey").cast("string")).alias("name"),
        status.alias("status"),
        F.col("o_custkey").alias("client_id"),
        F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("Klient "), F.col("o_custkey").cast("string"))).alias("client_name"),
        F.concat(F.lit("Adv "), (F.col("o_custkey") % 50).cast("string")).alias("advertiser"),
        F.col("o_orderkey").alias("contract_id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).alias("contract_number"),
        F.to_date("o_orderdate").alias("start_date"),
        F.date_add(F.to_date("o_orderdate"), 30).alias("end_date"),
        round_half_up(F.col("o_totalprice") * 1.02, 2).alias("price"),
        (F.col("o_custkey") % 20).alias("owner_user_id"),
        (F.col("o_orderkey") % 10).cast("double").alias("discount"),
        round_half_up(F.col("o_totalprice") * 1.1, 2).alias("suggested_price"),
        F.concat(F.lit("Owner "), (F.col("o_custkey") % 20).cast("string")).alias("owner_user_name"),
        F.to_json(F.struct((F.col("o_orderkey") % 7).alias("goal"), F.col("o_orderpriority").alias("tier"))).alias("performance"),
    )


PROPOSALS_SQL = """proposals AS (
  SELECT o_orderkey AS id, 'Kampania ' || CAST(o_orderkey AS VARCHAR) AS name,
         CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS BIGINT) AS status,
         o_custkey AS client_id, CASE WHEN o_custkey % 2 = 0 THEN 'Klient ' || CAST(o_custkey AS VARCHAR) END AS client_name,
         'Adv ' || CAST(o_custkey % 50 AS VARCHAR) AS advertiser, o_orderkey AS contract_id,
         CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS contract_number,
         CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate AS DATE) + 30 AS end_date,
         round(CAST(o_totalprice * 1.02 AS DECIMAL(38,10)), 2)::DOUBLE AS price, o_custkey % 20 AS owner_user_id,
         CAST(o_orderkey % 10 AS DOUBLE) AS discount, round(CAST(o_totalprice * 1.1 AS DECIMAL(38,10)), 2)::DOUBLE AS suggested_price,
         'Owner ' || CAST(o_custkey % 20 AS VARCHAR) AS owner_user_name,
         o_orderkey % 7 AS perf_goal, o_orderpriority AS perf_tier
  FROM orders)"""


def proposal_items(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    li = A.line_items(spark, d) if lines is None else lines
    line = F.col("line_item_id")
    buy = F.to_json(F.struct((F.col("screen_count") * 5).alias("saturation"), (F.col("screen_count") * 4).alias("bs_saturation"),
                             (F.col("screen_count") / 8.0).alias("sov"),
                             F.struct(line.alias("id"), (line % 3).alias("tier")).alias("budget")))
    perf = F.to_json(F.struct(F.col("perf_expected_repetitions").alias("expected_repetitions"),
                              F.col("perf_actual_repetitions").alias("actual_repetitions"),
                              (F.col("perf_expected_repetitions") * 3).alias("expected_impressions"),
                              (F.col("perf_actual_repetitions") * 3).alias("actual_impressions"),
                              F.when(line % 7 == 0, None).when(line % 2 == 0, "ON_TRACK").otherwise("UNDER_PERFORMING").alias("status")))
    delivery = F.to_json(F.struct(F.when(line % 3 == 0, "asap").otherwise("even").alias("mode"), F.struct((line % 50).alias("daily")).alias("cap")))
    priority = F.when(line % 13 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct((line % 4).alias("level"))))
    return li.select(
        F.col("line_item_id").alias("id"),
        F.when(F.col("line_item_id") % 5 != 0, F.col("campaign_id")).alias("campaign_id"),
        F.col("campaign_id").alias("proposal_id"),
        F.col("line_item_name").alias("name"),
        "status_name",
        F.col("line_start").alias("start_date"), F.col("line_end").alias("end_date"),
        F.col("line_price").alias("price"), "slot_duration", "screen_count",
        (F.col("campaign_id") % 20).alias("owner_user_id"),
        F.when(F.col("line_item_id") % 3 == 0, F.lit("Adv item")).alias("advertiser"),
        F.when(F.col("line_item_id") % 11 == 0, F.lit("not json")).otherwise(buy).alias("buy_details"),
        perf.alias("performance"), delivery.alias("delivery"), priority.alias("priority"),
        F.when(line % 2 == 0, "guaranteed").otherwise("open").alias("type_of_buy"), (line % 2 == 0).alias("is_preemptible"),
        (line % 6).alias("status_id"), (F.col("screen_count") % 3 + 1).alias("group_count"),
        round_half_up(F.col("line_price") * 1.25, 2).alias("suggested_price"),
    )


ITEMS_SQL = f"""{A.LINE_ITEMS_SQL},
items AS (
  SELECT line_item_id AS id, CASE WHEN line_item_id % 5 <> 0 THEN campaign_id END AS campaign_id, campaign_id AS proposal_id,
         line_item_name AS name, status_name, line_start AS start_date, line_end AS end_date, line_price AS price,
         slot_duration, screen_count, campaign_id % 20 AS owner_user_id,
         CASE WHEN line_item_id % 3 = 0 THEN 'Adv item' END AS advertiser,
         CASE WHEN line_item_id % 11 = 0 THEN NULL ELSE screen_count * 5 END AS buy_saturation,
         CASE WHEN line_item_id % 11 = 0 THEN NULL ELSE screen_count * 4 END AS buy_bs_saturation,
         CASE WHEN line_item_id % 11 = 0 THEN NULL ELSE screen_count / 8.0 END AS buy_sov,
         perf_expected_repetitions * 3 AS perf_expected_impressions, perf_actual_repetitions * 3 AS perf_actual_impressions,
         CASE WHEN line_item_id % 7 = 0 THEN NULL WHEN line_item_id % 2 = 0 THEN 'ON_TRACK' ELSE 'UNDER_PERFORMING' END AS perf_status,
         CASE WHEN line_item_id % 3 = 0 THEN 'asap' ELSE 'even' END AS del_mode, line_item_id % 50 AS "del_cap.daily",
         CASE WHEN line_item_id % 13 = 0 THEN NULL ELSE line_item_id % 4 END AS priority_level,
         CASE WHEN line_item_id % 2 = 0 THEN 'guaranteed' ELSE 'open' END AS type_of_buy, line_item_id % 2 = 0 AS is_preemptible,
         line_item_id % 6 AS status_id, screen_count % 3 + 1 AS group_count,
         round(CAST(line_price * 1.25 AS DECIMAL(38,10)), 2)::DOUBLE AS suggested_price,
         CASE WHEN line_item_id % 11 = 0 THEN NULL ELSE line_item_id END AS "buy_budget.id",
         CASE WHEN line_item_id % 11 = 0 THEN NULL ELSE line_item_id % 3 END AS "buy_budget.tier",
         perf_expected_repetitions AS perf_expected_repetitions, perf_actual_repetitions AS perf_actual_repetitions
  FROM li)"""

#: Declared keys of the JSON columns, by the prefix of their columns.
JSON_SCHEMAS = {
    "buy_": "saturation bigint, bs_saturation bigint, sov double, budget struct<id: bigint, tier: bigint>",
    "perf_": "expected_repetitions double, actual_repetitions double, expected_impressions double, actual_impressions double, status string",
    "del_": "mode string, cap struct<daily: bigint>",
    "priority_": "level bigint",
    "camp_perf_": "goal bigint, tier string",
}
#: Reservations that occur in the play log but were never booked (the manual overrides name two of them).
UNBOOKED = [311, 321, 331]


def users(spark: SparkSession, d: str) -> DataFrame:
    c = T(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("id"),
                    F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"))


USERS_SQL = """users AS (SELECT c_custkey AS id, lower(replace(c_name, '#', '.')) || '@example.com' AS email FROM customer)"""


def reservations_v22(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    li = (A.line_items(spark, d) if lines is None else lines).select("line_item_id", "screen_count")
    a = li.where(F.col("screen_count") % 4 != 0).select((F.col("line_item_id") * 10 + 1).alias("id"),
                                                        F.col("line_item_id").alias("proposal_line_item_id"),
                                                        F.lit("booked").alias("booking_state"))
    b = li.where(F.col("screen_count") == 1).select((F.col("line_item_id") * 10 + 2).alias("id"),
                                                    F.col("line_item_id").alias("proposal_line_item_id"),
                                                    F.lit("held").alias("booking_state"))
    return a.unionByName(b).where(~F.col("id").isin(UNBOOKED))


RES22_SQL = f"""res22 AS (
  SELECT line_item_id * 10 + 1 AS id, line_item_id AS proposal_line_item_id, 'booked' AS booking_state FROM li
  WHERE screen_count % 4 <> 0 AND NOT line_item_id * 10 + 1 IN ({', '.join(map(str, UNBOOKED))})
  UNION ALL SELECT line_item_id * 10 + 2, line_item_id, 'held' FROM li WHERE screen_count = 1)"""


def reservations(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    r = reservations_v22(spark, d, lines)
    li = (A.line_items(spark, d) if lines is None else lines).select(F.col("line_item_id").alias("proposal_line_item_id"), "line_start", "line_end")
    return r.join(li, "proposal_line_item_id").select(
        "id", F.concat(F.lit("Rez "), F.col("id").cast("string")).alias("name"),
        F.col("line_start").alias("start_date"), F.col("line_end").alias("end_date"),
        F.when(F.col("id") % 3 == 0, "paused").otherwise("active").alias("state"),
        (F.col("id") % 100).alias("saturation"), (F.col("id") % 10 * 1000).alias("duration_msec"),
        (F.col("id") % 3 != 0).alias("active"))


RES_SQL = """res AS (
  SELECT r.id, 'Rez ' || CAST(r.id AS VARCHAR) AS name, li.line_start AS start_date, li.line_end AS end_date,
         CASE WHEN r.id % 3 = 0 THEN 'paused' ELSE 'active' END AS state, r.id % 100 AS saturation,
         r.id % 10 * 1000 AS duration_msec, r.id % 3 <> 0 AS active
  FROM res22 r JOIN li ON li.line_item_id = r.proposal_line_item_id)"""


def play_logs_raw(spark: SparkSession, d: str) -> DataFrame:
    """Plays before the hourly roll-up (one lineitem row = one play)."""
    li = T(spark, d, "lineitem")
    res = F.when(F.col("l_linenumber") % 4 != 0, (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 10 + 1)
    return li.select(
        F.col("l_suppkey").alias("PlayerID"),
        (F.col("l_shipdate") + F.make_interval(hours=(F.col("l_orderkey") % 24).cast("int"))).alias("DateEndTime"),
        (F.col("l_quantity") * 15).alias("Duration"),
        F.col("l_partkey").alias("AdCopyId"),
        res.alias("CampID"),
        (F.col("l_partkey") % 40).alias("FrameID"),
        (F.col("l_suppkey") % 25).alias("DisplayUnitID"),
        F.when(F.col("l_orderkey") % 2 == 0, F.col("l_orderkey").cast("string")).alias("contract_id"),
        F.col("l_quantity").cast("bigint").alias("Impresje"),
    )


PLAYS_SQL = """plays AS (
  SELECT l_suppkey AS PlayerID, l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS DateEndTime,
         l_quantity * 15 AS Duration, l_partkey AS AdCopyId,
         CASE WHEN l_linenumber % 4 <> 0 THEN (l_orderkey * 10 + l_linenumber) * 10 + 1 END AS CampID,
         l_partkey % 40 AS FrameID, l_suppkey % 25 AS DisplayUnitID,
         CASE WHEN l_orderkey % 2 = 0 THEN CAST(l_orderkey AS VARCHAR) END AS contract_id,
         CAST(l_quantity AS BIGINT) AS Impresje
  FROM lineitem)"""


def frames_mapping(spark: SparkSession, d: str) -> DataFrame:
    n = T(spark, d, "nation").select(F.col("n_nationkey").alias("frame_id"), (F.col("n_nationkey") + 100).alias("screen_id"),
                                     F.col("n_regionkey").alias("group_id"))
    r = T(spark, d, "region").select((F.col("r_regionkey") + 20).alias("frame_id"), (F.col("r_regionkey") + 200).alias("screen_id"),
                                     F.col("r_regionkey").alias("group_id"))
    return n.unionByName(r)


MAPPING_SQL = """sfm AS (
  SELECT n_nationkey AS frame_id, n_nationkey + 100 AS screen_id, n_regionkey AS group_id FROM nation
  UNION ALL SELECT r_regionkey + 20, r_regionkey + 200, r_regionkey FROM region)"""


def screens(spark: SparkSession, d: str) -> DataFrame:
    r = T(spark, d, "region")
    return r.select(F.col("r_regionkey").alias("id"),
                    F.concat(F.lit("A0"), F.col("r_regionkey").cast("string"), F.lit("_"), F.col("r_name"), F.lit("_TP05_południe")).alias("name"),
                    F.concat(F.lit("ul. "), F.col("r_name")).alias("address"),
                    F.when(F.col("r_regionkey") % 2 == 0, "1920 x 1080").otherwise("1920 x 540").alias("resolution"),
                    F.lit("landscape").alias("orientation"))


SCREENS_SQL = """screens AS (
  SELECT r_regionkey AS id, 'A0' || CAST(r_regionkey AS VARCHAR) || '_' || r_name || '_TP05_południe' AS name,
         'ul. ' || r_name AS address, CASE WHEN r_regionkey % 2 = 0 THEN '1920 x 1080' ELSE '1920 x 540' END AS resolution,
         'landscape' AS orientation
  FROM region)"""


def display_units(spark: SparkSession, d: str) -> DataFrame:
    n = T(spark, d, "nation")
    name = (F.when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit("B18D | "), F.col("n_name"), F.lit(" | 1")))
             .when(F.col("n_nationkey") % 5 == 1, F.concat(F.lit("Biuro "), F.col("n_name")))
             .otherwise(F.concat(F.lit("DU "), F.col("n_name"))))
    return n.select(F.col("n_nationkey").alias("id"), name.alias("name"),
                    F.concat(F.lit("adres "), F.col("n_nationkey").cast("string")).alias("address"),
                    F.lit("Europe/Warsaw").alias("timezone"), F.lit(True).alias("active"))


DU_SQL = """du AS (
  SELECT n_nationkey AS id,
         CASE WHEN n_nationkey % 5 = 0 THEN 'B18D | ' || n_name || ' | 1' WHEN n_nationkey % 5 = 1 THEN 'Biuro ' || n_name
              ELSE 'DU ' || n_name END AS name,
         'adres ' || CAST(n_nationkey AS VARCHAR) AS address, 'Europe/Warsaw' AS timezone, true AS active
  FROM nation)"""


def ctrl_players(spark: SparkSession, d: str) -> DataFrame:
    p = A.players(spark, d)
    return p.select((F.col("play_log_player_id") + 100000).alias("id"), F.col("play_log_player_id").alias("claimed_resource_id"),
                    F.col("player_name").alias("name"), F.concat(F.lit("host-"), F.col("play_log_player_id").cast("string")).alias("hostname"),
                    F.lit(True).alias("active"), F.lit(True).alias("licensed"), F.lit(1).alias("nscreens"),
                    F.col("display_unit_id").alias("target_display_unit_id"))


CTRL_PLAYERS_SQL = f"""{A.PLAYERS_SQL},
ctrl_players AS (
  SELECT play_log_player_id + 100000 AS id, play_log_player_id AS claimed_resource_id, player_name AS name,
         'host-' || CAST(play_log_player_id AS VARCHAR) AS hostname, true AS active, true AS licensed, 1 AS nscreens,
         display_unit_id AS target_display_unit_id
  FROM players)"""


def ctrl_content(spark: SparkSession, d: str) -> DataFrame:
    p = T(spark, d, "part")
    return p.select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_name")).alias("name"),
                    (F.col("p_partkey") % 4).alias("domain_id"))


def resources(spark: SparkSession, d: str) -> DataFrame:
    p = T(spark, d, "part")
    return p.where(F.col("p_partkey") % 2 == 0).select(
        F.col("p_partkey").cast("string").alias("id"), F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name")).alias("name"),
        F.when(F.col("p_partkey") % 4 == 0, "content").otherwise("skin").alias("type"))


CONTENT_SQL = """content AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS name, p_partkey % 4 AS domain_id FROM part),
resources AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand || ' ' || p_name AS name,
                     CASE WHEN p_partkey % 4 = 0 THEN 'content' ELSE 'skin' END AS type FROM part WHERE p_partkey % 2 = 0)"""


def bronze_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """All bronze inputs of the daily run, by their source names.  The lines and their reservations, which most of the run's
    steps read, are derived from the driver tables once and stored, as bronze tables are."""
    from ..operators.rollup import hourly_rollup
    lines = cut_lineage(A.line_items(spark, d))
    plays = hourly_rollup(play_logs_raw(spark, d), ["PlayerID", "AdCopyId", "CampID", "FrameID", "DisplayUnitID", "contract_id"],
                          sums={"Duration": "Duration", "Impresje": "Impresje"}, scale=None)
    return {
        "play_logs": plays,
        "ctrl_reservations": cut_lineage(reservations(spark, d, lines)),
        "ctrl_reservations_v22": reservations_v22(spark, d, lines),
        "screens": screens(spark, d),
        "screens_frames_mapping": frames_mapping(spark, d),
        "ctrl_display_units": display_units(spark, d),
        "ctrl_players": ctrl_players(spark, d),
        "proposals": proposals(spark, d),
        "proposal_items": proposal_items(spark, d, lines),
        "users": users(spark, d),
        "ctrl_content": ctrl_content(spark, d),
        "resources_latest": resources(spark, d),
    }
