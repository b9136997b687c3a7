"""Silver and gold jobs (C4-C16, C19, C20) run on the world derived from the driver tables."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import config as K
from ..functions.semantics import round_half_up
from ..operators.conform import project_existing
from ..operators.rollup import hourly_rollup
from ..session import cut_lineage, scratch_path, store_alone
from . import analogs as A
from . import gold as G
from . import silver as S
from . import world as W
from .budget import budget_intervals, explode_days
from .catalog import register
from .oracle import with_ctes
from .q_ops import _location_sql

# Service/flag configuration for the world (the production lists hold production ids).
JOB_CFG = {
    "service_campaign_ids": [3, 30, 300, 3000],
    "service_reservation_ids": [11, 21, 31, 101],
    "service_line_item_ids": [12, 22, 32],
    "force_single_panel_campaign_ids": [5],
    "excluded_campaign_ids": [7, 70, 700],
    # the first two configured overrides, on two of the world's unbooked reservations
    "reservation_overrides": [(res, *row[1:]) for row, res in zip(K.RESERVATION_OVERRIDES, W.UNBOOKED[:2])],
}
OVERRIDES = JOB_CFG["reservation_overrides"]
OVERRIDES_SQL = "ov AS (SELECT * FROM (VALUES " + ", ".join(
    f"({r[0]}::BIGINT, {r[1]}::BIGINT, {r[2]}::BIGINT, '{r[3]}', '{r[4]}', '{r[5]}', '{r[6]}')" for r in OVERRIDES) + (
    ") t(res, camp, line, camp_name, line_name, adv, client))")


def _in(ids):
    return "(" + ", ".join(str(i) for i in ids) + ")"


def bronze_play_logs(spark, d):
    return hourly_rollup(W.play_logs_raw(spark, d),
                         ["PlayerID", "AdCopyId", "CampID", "FrameID", "DisplayUnitID", "contract_id"],
                         sums={"Duration": "Duration", "Impresje": "Impresje"}, scale=None)


BRONZE_SQL = f"""{W.PLAYS_SQL},
bronze AS (
  SELECT PlayerID, strftime(DateEndTime, '%Y-%m-%d') AS DateEnd, CAST(hour(DateEndTime) AS INTEGER) AS timeslot, AdCopyId, CampID,
         FrameID, DisplayUnitID, contract_id, coalesce(sum(Duration), 0) AS Duration,
         CAST(coalesce(sum(Impresje), 0) AS BIGINT) AS Impresje, count(*) AS emisje
  FROM plays GROUP BY 1, 2, 3, 4, 5, 6, 7, 8)"""


def campaigns(spark, d, lines=None):
    return S.build_campaigns(W.proposal_items(spark, d, lines), W.proposals(spark, d), W.users(spark, d))


def stored_lines(spark, d):
    """The lines, of which campaigns and reservations are made, and the reservations of them: each derived from the plays'
    table once and stored, as bronze tables are."""
    lines = cut_lineage(A.line_items(spark, d))
    return lines, cut_lineage(W.reservations(spark, d, lines)), W.reservations_v22(spark, d, lines)


# ---- C5 ------------------------------------------------------------------------------------------------
CAMPAIGNS_SQL = f"""{W.ITEMS_SQL}, {W.PROPOSALS_SQL}, {W.USERS_SQL},
campaigns AS (
  SELECT i.id AS line_item_id, coalesce(i.campaign_id, i.proposal_id) AS campaign_id, i.name AS line_item_name, i.type_of_buy,
         i.is_preemptible, i.status_id, i.status_name, i.price AS line_price, i.suggested_price AS line_suggested_price,
         i.start_date AS line_start, i.end_date AS line_end, i.slot_duration, i.screen_count, i.group_count,
         p.name AS campaign_name, p.status AS campaign_status, coalesce(p.advertiser, i.advertiser) AS advertiser,
         p.client_id, p.client_name, p.price AS campaign_price, p.suggested_price AS campaign_suggested_price,
         p.discount AS campaign_discount, p.owner_user_name AS campaign_owner_name, p.contract_id, p.contract_number,
         p.start_date AS campaign_start, p.end_date AS campaign_end, i.owner_user_id, u.email AS owner_email,
         i.buy_saturation, i.buy_bs_saturation, i.buy_sov, i."buy_budget.id", i."buy_budget.tier", i.perf_expected_repetitions,
         i.perf_actual_repetitions, i.perf_expected_impressions, i.perf_actual_impressions, i.perf_status, i.del_mode,
         i."del_cap.daily", i.priority_level, p.perf_goal AS camp_perf_goal, p.perf_tier AS camp_perf_tier
  FROM items i LEFT JOIN proposals p ON p.id = coalesce(i.campaign_id, i.proposal_id)
               LEFT JOIN users u ON u.id = i.owner_user_id)"""

_CAMP_DATES = ["line_start", "line_end", "campaign_start", "campaign_end"]
_CAMP_OUT = ["line_item_id", "campaign_id", "line_item_name", "type_of_buy", "is_preemptible", "status_id", "status_name", "line_price",
             "line_suggested_price", "slot_duration", "screen_count", "group_count", "campaign_name", "campaign_status", "advertiser",
             "client_id", "client_name", "campaign_price", "campaign_suggested_price", "campaign_discount", "campaign_owner_name",
             "contract_id", "contract_number", "owner_user_id", "owner_email", "buy_saturation", "buy_bs_saturation", "buy_sov",
             "buy_budget.id", "buy_budget.tier", "perf_expected_repetitions", "perf_actual_repetitions", "perf_expected_impressions",
             "perf_actual_impressions", "perf_status", "del_mode", "del_cap.daily", "priority_level"]


def _days(df, cols):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in cols})


def _days_sql(cols, table=""):
    return ", ".join(f"strftime({table}{c}, '%Y-%m-%d') AS {c}" for c in cols)


@register("job_campaigns", f"""
WITH {CAMPAIGNS_SQL}
SELECT {', '.join('"' + c + '"' for c in _CAMP_OUT)}, {_days_sql(_CAMP_DATES)} FROM campaigns""")
def q_job_campaigns(spark, d):
    return _days(campaigns(spark, d), _CAMP_DATES).select(*[F.col(f"`{x}`") for x in _CAMP_OUT + _CAMP_DATES])


# ---- C6 / C11 dim_screen -----------------------------------------------------------------------------------
SCREENS_FULL_SQL = f"""{W.MAPPING_SQL}, {W.SCREENS_SQL},
m AS (SELECT frame_id, screen_id AS panel_id, CAST(group_id AS BIGINT) AS screen_id
      FROM (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY screen_id, group_id) AS rn FROM sfm) WHERE rn = 1),
screens_full AS (SELECT m.frame_id, m.panel_id, m.screen_id, s.name AS screen_name, s.address AS screen_address,
                        s.resolution, s.orientation FROM m LEFT JOIN screens s ON s.id = m.screen_id)"""


def screens_full(spark, d):
    return S.build_screens(W.frames_mapping(spark, d), W.screens(spark, d))


@register("job_screens", f"WITH {SCREENS_FULL_SQL} SELECT * FROM screens_full")
def q_job_screens(spark, d):
    return screens_full(spark, d).select("frame_id", "panel_id", "screen_id", "screen_name", "screen_address",
                                         "resolution", "orientation")


@register("job_dim_screen", f"""
WITH {SCREENS_FULL_SQL}
SELECT frame_id, screen_id, screen_name, {_location_sql('screen_name')} AS Lokalizacja FROM screens_full""")
def q_job_dim_screen(spark, d):
    return G.build_dim_screen(screens_full(spark, d)).select("frame_id", "screen_id", "screen_name", "Lokalizacja")


# ---- C7 / C11 dim_player -----------------------------------------------------------------------------------
PLAYERS_FULL_SQL = f"""{W.CTRL_PLAYERS_SQL}, {W.DU_SQL},
players_full AS (
  SELECT p.id AS player_id, p.claimed_resource_id AS play_log_player_id, p.name AS player_name, p.hostname,
         CAST(NULLIF(p.target_display_unit_id, 0) AS BIGINT) AS display_unit_id, du.name AS display_unit_name, du.address AS du_address,
         du.timezone
  FROM ctrl_players p LEFT JOIN du ON du.id = NULLIF(p.target_display_unit_id, 0))"""


def players_full(spark, d):
    return S.build_players(W.ctrl_players(spark, d), W.display_units(spark, d))


@register("job_players", f"WITH {PLAYERS_FULL_SQL} SELECT * FROM players_full")
def q_job_players(spark, d):
    return players_full(spark, d).select("player_id", "play_log_player_id", "player_name", "hostname", "display_unit_id",
                                         "display_unit_name", "du_address", "timezone")


@register("job_dim_player", f"""
WITH {PLAYERS_FULL_SQL}
SELECT play_log_player_id, player_name, display_unit_name, {_location_sql('display_unit_name')} AS Lokalizacja,
       coalesce(regexp_matches(player_name, 'biuro|test|teltronic', 'i'), false)
       OR coalesce(regexp_matches(display_unit_name, 'biuro|test|teltronic', 'i'), false) AS is_test
FROM players_full""")
def q_job_dim_player(spark, d):
    return G.build_dim_player(players_full(spark, d)).select("play_log_player_id", "player_name", "display_unit_name",
                                                             "Lokalizacja", "is_test")


# ---- C8 ------------------------------------------------------------------------------------------------------
@register("job_bridge", f"""
WITH {BRONZE_SQL}, {W.MAPPING_SQL}, {W.SCREENS_SQL}, {W.DU_SQL},
pairs AS (SELECT FrameID, DisplayUnitID, PlayerID FROM bronze
          WHERE FrameID IS NOT NULL AND FrameID <> 0 AND DisplayUnitID IS NOT NULL AND DisplayUnitID <> 0),
b AS (SELECT FrameID, DisplayUnitID, count(PlayerID) AS play_count,
             array_to_string(list_sort(list_distinct(list(PlayerID))), ',') AS player_ids FROM pairs GROUP BY 1, 2),
m AS (SELECT DISTINCT frame_id, group_id FROM sfm)
SELECT b.FrameID, b.DisplayUnitID, b.play_count, b.player_ids, CAST(m.group_id AS BIGINT) AS screen_id, s.name AS screen_name,
       s.address AS screen_address, du.name AS display_unit_name, du.address AS du_address
FROM b LEFT JOIN m ON m.frame_id = b.FrameID LEFT JOIN screens s ON s.id = m.group_id LEFT JOIN du ON du.id = b.DisplayUnitID""")
def q_job_bridge(spark, d):
    b = S.build_screen_bridge(bronze_play_logs(spark, d), W.frames_mapping(spark, d), W.screens(spark, d),
                              W.display_units(spark, d))
    return b.select("FrameID", "DisplayUnitID", "play_count", "player_ids", "screen_id", "screen_name", "screen_address",
                    "display_unit_name", "du_address")


# ---- C9 ------------------------------------------------------------------------------------------------------
ENRICHED_SQL = f"""{BRONZE_SQL}, {A.LINE_ITEMS_SQL}, {W.RES22_SQL}, {W.RES_SQL}, {W.MAPPING_SQL}, {W.SCREENS_SQL}, {W.DU_SQL},
{W.PROPOSALS_SQL},
sfm_s AS (SELECT m.frame_id, CAST(m.group_id AS BIGINT) AS screen_id, s.name AS screen_name, s.address AS screen_address
          FROM (SELECT DISTINCT frame_id, group_id FROM sfm) m LEFT JOIN screens s ON s.id = m.group_id),
enriched AS (
  SELECT b.DateEnd, b.timeslot, b.PlayerID, b.FrameID, b.DisplayUnitID, b.AdCopyId, b.CampID, b.contract_id, b.emisje,
         b.Impresje, b.Duration, r.name AS reservation_name, r.state AS reservation_state, r.start_date AS reservation_start,
         r.end_date AS reservation_end, du.name AS display_unit_name, du.address AS du_address, f.screen_id,
         coalesce(f.screen_name, du.name) AS screen_name, f.screen_address, p.id AS proposal_id, p.name AS proposal_name,
         p.advertiser, p.client_name, p.start_date AS proposal_start, p.end_date AS proposal_end, p.status
  FROM bronze b
  LEFT JOIN res r ON r.id = b.CampID
  LEFT JOIN sfm_s f ON f.frame_id = b.FrameID
  LEFT JOIN du ON du.id = b.DisplayUnitID
  LEFT JOIN (SELECT * FROM proposals WHERE contract_number IS NOT NULL) p ON p.contract_number = b.contract_id
  WHERE coalesce(b.CampID <> 0, true) AND coalesce(b.DisplayUnitID <> 0, true))"""


def enriched(spark, d):
    return S.build_play_logs_enriched(bronze_play_logs(spark, d), W.reservations(spark, d), W.frames_mapping(spark, d),
                                      W.screens(spark, d), W.display_units(spark, d), W.proposals(spark, d))


_ENR_DATES = ["reservation_start", "reservation_end", "proposal_start", "proposal_end"]
_ENR_OUT = ["timeslot", "PlayerID", "FrameID", "DisplayUnitID", "AdCopyId", "CampID", "contract_id", "emisje", "Impresje",
            "Duration", "reservation_name", "reservation_state", "display_unit_name", "du_address", "screen_id", "screen_name",
            "screen_address", "proposal_id", "proposal_name", "advertiser", "client_name", "status"]


@register("job_logs_enriched", f"""
WITH {ENRICHED_SQL}
SELECT DateEnd, {', '.join(_ENR_OUT)}, {', '.join(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in _ENR_DATES)} FROM enriched""")
def q_job_enriched(spark, d):
    e = enriched(spark, d)
    return e.select(F.date_format("DateEnd", "yyyy-MM-dd").alias("DateEnd"), *_ENR_OUT,
                    *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in _ENR_DATES])


# ---- J11 / J12 / C20 / C16 ----------------------------------------------------------------------------------
RESMAP_SQL = f"""{CAMPAIGNS_SQL}, {W.RES22_SQL},
camps AS (SELECT line_item_id, campaign_id FROM (
            SELECT line_item_id, campaign_id, row_number() OVER (PARTITION BY line_item_id ORDER BY campaign_id) AS rn
            FROM campaigns WHERE line_item_id IS NOT NULL) WHERE rn = 1),
res_map AS (SELECT reservation_id, line_item_id, campaign_id FROM (
              SELECT r.id AS reservation_id, r.proposal_line_item_id AS line_item_id, c.campaign_id,
                     row_number() OVER (PARTITION BY r.id ORDER BY r.proposal_line_item_id, c.campaign_id) AS rn
              FROM res22 r LEFT JOIN camps c ON c.line_item_id = r.proposal_line_item_id
              WHERE r.id IS NOT NULL AND r.proposal_line_item_id IS NOT NULL) WHERE rn = 1)"""


def res_map(spark, d):
    return G.reservation_map(W.reservations_v22(spark, d), campaigns(spark, d))


@register("reservation_map", f"WITH {RESMAP_SQL} SELECT * FROM res_map")
def q_reservation_map(spark, d):
    return res_map(spark, d).select("reservation_id", "line_item_id", "campaign_id")


SINGLE_SQL = f"""single AS (
  SELECT campaign_id FROM (
    SELECT m.campaign_id, count(DISTINCT b.PlayerID) AS n FROM bronze b JOIN res22 r ON r.id = b.CampID JOIN camps m ON m.line_item_id = r.proposal_line_item_id
    WHERE b.CampID IS NOT NULL AND b.PlayerID IS NOT NULL AND m.campaign_id IS NOT NULL GROUP BY 1)
  WHERE n = 1 AND coalesce(NOT campaign_id IN {_in(JOB_CFG['service_campaign_ids'])}, true)
  UNION SELECT unnest({list(JOB_CFG['force_single_panel_campaign_ids'])}) AS campaign_id)"""


def single_panel(spark, d, lines=None):
    booked = G.reservation_lines(W.reservations_v22(spark, d, lines), campaigns(spark, d, lines))
    return G.single_panel_campaigns(bronze_play_logs(spark, d), booked, JOB_CFG)


@register("job_single_panel", f"{with_ctes(BRONZE_SQL, RESMAP_SQL, SINGLE_SQL)} SELECT campaign_id FROM single")
def q_job_single_panel(spark, d):
    return single_panel(spark, d)


# the reservation map with the overrides of what it leaves without a campaign
FACT_MAP_SQL = f"""{OVERRIDES_SQL},
fact_rows AS (SELECT e.*, CASE WHEN m.campaign_id IS NULL THEN coalesce(o.camp, m.campaign_id) ELSE m.campaign_id END AS campaign_id,
                     CASE WHEN m.campaign_id IS NULL AND o.res IS NOT NULL THEN o.line ELSE m.line_item_id END AS line_item_id
              FROM enriched e LEFT JOIN res_map m ON m.reservation_id = e.CampID LEFT JOIN ov o ON o.res = e.CampID)"""
_FLAG_SQL = f"""CAST(CASE WHEN coalesce(m.campaign_id IN {_in(JOB_CFG['service_campaign_ids'])}, false)
                   OR coalesce(m.CampID IN {_in(JOB_CFG['service_reservation_ids'])}, false)
                   OR coalesce(m.line_item_id IN {_in(JOB_CFG['service_line_item_ids'])}, false) THEN 1
              WHEN m.campaign_id IN (SELECT campaign_id FROM single) THEN 2 ELSE 0 END AS TINYINT)"""


@register("job_fact_play_logs", f"""
{with_ctes(ENRICHED_SQL, RESMAP_SQL, SINGLE_SQL, FACT_MAP_SQL)}
SELECT m.DateEnd AS date_key, m.PlayerID AS play_log_player_id, m.FrameID AS frame_id, m.DisplayUnitID AS display_unit_id,
       m.CampID AS reservation_id, m.AdCopyId AS content_id, CAST(m.timeslot AS BIGINT) AS timeslot, m.contract_id, m.emisje, m.Impresje, m.Duration,
       m.line_item_id, m.campaign_id, {_FLAG_SQL} AS is_serwisowy
FROM fact_rows m""")
def q_job_fact_play_logs(spark, d):
    # the three inputs share the raw log, the lines, the reservations and the campaigns: each of those is stored once, and
    # each join of the plays that deals them out anew is a step, so that the shuffle files of one at a time are on disk
    logs = cut_lineage(bronze_play_logs(spark, d))
    lines, res, res22 = stored_lines(spark, d)
    camps = cut_lineage(campaigns(spark, d, lines).select("line_item_id", "campaign_id"))
    booked = cut_lineage(G.reservation_lines(res22, camps))
    single, res_map = cut_lineage(G.single_panel_campaigns(logs, booked, JOB_CFG)), cut_lineage(G.reservation_map(res22, camps))
    e = S.build_play_logs_enriched(logs, res, W.frames_mapping(spark, d), W.screens(spark, d), W.display_units(spark, d), W.proposals(spark, d))
    e = cut_lineage(project_existing(e, G.PLAY_COLUMNS))
    f = G.build_fact_play_logs(e, res_map, single, JOB_CFG)
    return f.withColumn("date_key", F.date_format("date_key", "yyyy-MM-dd"))


# ---- C12 ---------------------------------------------------------------------------------------------------------
_DC_OUT = ["campaign_id", "campaign_name", "campaign_status", "advertiser", "client_id", "client_name", "campaign_price",
           "campaign_suggested_price", "campaign_discount", "campaign_owner_name", "owner_user_id", "owner_email", "contract_id",
           "contract_number", "campaign_start", "campaign_end"]


@register("job_dim_campaign", f"""
{with_ctes(BRONZE_SQL, RESMAP_SQL, SINGLE_SQL, OVERRIDES_SQL)},
firsts AS (SELECT * REPLACE (strftime(campaign_start, '%Y-%m-%d') AS campaign_start, strftime(campaign_end, '%Y-%m-%d') AS campaign_end)
           FROM (SELECT *, row_number() OVER (PARTITION BY campaign_id ORDER BY line_item_id) AS rn FROM campaigns) WHERE rn = 1),
dc AS (SELECT {', '.join(_DC_OUT)} FROM firsts WHERE coalesce(NOT campaign_id IN {_in(JOB_CFG['excluded_campaign_ids'])}, true)
       UNION ALL BY NAME SELECT DISTINCT camp AS campaign_id, camp_name AS campaign_name, adv AS advertiser, client AS client_name FROM ov)
SELECT dc.*, CAST(CASE WHEN coalesce(campaign_id IN {_in(JOB_CFG['service_campaign_ids'])}, false) THEN 1
                       WHEN campaign_id IN (SELECT campaign_id FROM single) THEN 2 ELSE 0 END AS TINYINT) AS is_serwisowy
FROM dc""")
def q_job_dim_campaign(spark, d):
    lines = cut_lineage(A.line_items(spark, d))
    dc = G.build_dim_campaign(spark, campaigns(spark, d, lines), cut_lineage(single_panel(spark, d, lines)), JOB_CFG)
    return _days(dc, ["campaign_start", "campaign_end"]).select(*_DC_OUT, "is_serwisowy")


# ---- C13 ---------------------------------------------------------------------------------------------------------
RESFULL_SQL = """resfull AS (
  SELECT r.id AS reservation_id, r.proposal_line_item_id AS line_item_id, r.booking_state, x.name AS reservation_name,
         x.start_date AS reservation_start, x.end_date AS reservation_end, x.state AS reservation_state, x.saturation,
         x.duration_msec, x.active
  FROM res22 r LEFT JOIN res x ON x.id = r.id WHERE r.proposal_line_item_id IS NOT NULL)"""

_RES_OUT = ["reservation_id", "booking_state", "reservation_name", "reservation_state", "saturation", "duration_msec", "active"]
_DLI_OUT = ["line_item_id", "campaign_id", "line_item_name", "type_of_buy", "slot_duration", "screen_count", "group_count", "status_id",
            "status_name", "is_preemptible", "line_price", "line_suggested_price", "buy_saturation", "buy_bs_saturation", "buy_sov",
            "buy_budget.id", "buy_budget.tier", "perf_expected_repetitions", "perf_actual_repetitions", "perf_expected_impressions",
            "perf_actual_impressions"]
_LINE_DAYS_SQL = """CASE WHEN c.line_start IS NOT NULL AND c.line_end IS NOT NULL
            THEN CAST(greatest(datediff('day', c.line_start, c.line_end) + 1, 1) AS BIGINT) END AS line_days"""


def _cols(names, table):
    return ", ".join(f'{table}."{c}"' for c in names)


@register("job_dim_line_item", f"""
{with_ctes(CAMPAIGNS_SQL, W.RES22_SQL, W.RES_SQL, RESFULL_SQL, OVERRIDES_SQL).replace("campaigns AS (", "campaigns AS MATERIALIZED (").replace("resfull AS (", "resfull AS MATERIALIZED (")}
SELECT {_cols(_DLI_OUT, 'c')}, coalesce(c.perf_status, '{K.NO_STATUS}') AS broadsign_status,
       {_days_sql(['line_start', 'line_end'], 'c.')}, {_LINE_DAYS_SQL}, {_cols(_RES_OUT, 'r')},
       {_days_sql(['reservation_start', 'reservation_end'], 'r.')}
FROM campaigns c LEFT JOIN resfull r ON r.line_item_id = c.line_item_id
WHERE coalesce(NOT c.campaign_id IN {_in(JOB_CFG['excluded_campaign_ids'])}, true)
UNION ALL BY NAME SELECT line AS line_item_id, camp AS campaign_id, line_name AS line_item_name, res AS reservation_id FROM ov""")
def q_job_dim_line_item(spark, d):
    lines, res, res22 = stored_lines(spark, d)
    full = cut_lineage(G.reservations_full(res22, res))
    camps = campaigns(spark, d, lines)
    camps = cut_lineage(camps.select(*[F.col(f"`{c}`") for c in camps.columns if c.split(".")[0] in K.LINE_ITEM_COLUMNS]))
    li = G.build_dim_line_item(spark, camps, res22, res, JOB_CFG, full=full)
    return _days(li, ["reservation_start", "reservation_end"]).select(
        *[F.col(f"`{c}`") for c in _DLI_OUT], "broadsign_status", "line_start", "line_end", "line_days", *_RES_OUT,
        "reservation_start", "reservation_end")


# ---- C14 ---------------------------------------------------------------------------------------------------------
_FULL_OUT = [c for c in _DLI_OUT if c not in ("line_price",)] + [
    "campaign_name", "advertiser", "client_id", "client_name", "campaign_suggested_price", "campaign_discount",
    "owner_email", "owner_user_id", "contract_id", "contract_number", "campaign_owner_name"]
_FULL_CARRY = ["campaign_name", "advertiser", "client_id", "client_name", "campaign_start", "campaign_end", "owner_email",
               "owner_user_id", "contract_id"]
FULL_SQL = f"""rows_ AS (
  SELECT {_cols(_FULL_OUT, 'c')}, c.line_price, c.campaign_price, c.line_start, c.line_end, c.campaign_start, c.campaign_end,
         {_LINE_DAYS_SQL}, {_cols(_RES_OUT, 'r')}, r.reservation_start, r.reservation_end, false AS is_adjustment
  FROM campaigns c LEFT JOIN resfull r ON r.line_item_id = c.line_item_id),
full_ AS (SELECT * FROM rows_ UNION ALL BY NAME
  SELECT campaign_id, '{K.ADJUSTMENT_LINE_NAME}' AS line_item_name, max(campaign_price) - coalesce(sum(line_price), 0.0) AS line_price,
         0.0::DOUBLE AS line_suggested_price, max(campaign_price) AS campaign_price,
         {', '.join(f'arg_min({c}, line_item_id) AS {c}' for c in _FULL_CARRY)}, true AS is_adjustment
  FROM rows_ GROUP BY campaign_id HAVING abs(max(campaign_price) - coalesce(sum(line_price), 0.0)) > {K.BALANCE_TOLERANCE})"""
_FULL_DAYS = ["line_start", "line_end", "campaign_start", "campaign_end", "reservation_start", "reservation_end"]


def campaign_full(spark, d, parts=1):
    def inputs():
        lines, res, res22 = stored_lines(spark, d)
        camps = campaigns(spark, d, lines)
        return (camps.select(*[F.col(f"`{c}`") for c in camps.columns if c.split(".")[0] in K.CAMPAIGN_FULL_COLUMNS]),
                G.reservations_full(res22, res))

    camps, full = store_alone(spark, inputs)
    return G.build_campaign_full(camps, None, None, JOB_CFG, full=full, parts=parts)


@register("job_campaign_full", f"""
{with_ctes(CAMPAIGNS_SQL, W.RES22_SQL, W.RES_SQL, RESFULL_SQL, FULL_SQL)}
SELECT {_cols(_FULL_OUT + _RES_OUT, 'f')}, f.line_days, f.is_adjustment, {_days_sql(_FULL_DAYS, 'f.')}, f.campaign_price,
       round(CAST(line_price AS DECIMAL(38,10)), 2)::DOUBLE AS line_price
FROM full_ f""")
def q_job_campaign_full(spark, d):
    full = _days(campaign_full(spark, d, parts=4), _FULL_DAYS[2:])
    return full.select(*[F.col(f"`{c}`") for c in _FULL_OUT + _RES_OUT], "line_days", "is_adjustment", *_FULL_DAYS, "campaign_price",
                       round_half_up(F.col("line_price"), 2).alias("line_price"))


@register("job_campaign_full_check", f"""
{with_ctes(CAMPAIGNS_SQL, W.RES22_SQL, W.RES_SQL, RESFULL_SQL, FULL_SQL)},
per AS (SELECT campaign_id, coalesce(abs(max(campaign_price) - coalesce(sum(line_price), 0.0)) < 1, false) AS ok FROM full_ GROUP BY 1)
SELECT count(*) AS keys, CAST(sum(ok::INT) AS BIGINT) AS ok_keys, round(avg(ok::INT::DOUBLE), 6) AS ok_share FROM per""")
def q_job_campaign_full_check(spark, d):
    share = G.campaign_full_check(campaign_full(spark, d))
    return share.select("keys", "ok_keys", F.round("ok_share", 6).alias("ok_share"))


# ---- C11 dim_content ---------------------------------------------------------------------------------------------
@register("job_dim_content", f"""
WITH {W.CONTENT_SQL},
r AS (SELECT CAST(id AS BIGINT) AS content_id, min(name) AS dict_name FROM resources WHERE type = 'content' GROUP BY 1),
c AS (SELECT c.id AS content_id, coalesce(c.name, r.dict_name) AS content_name, c.domain_id
      FROM content c LEFT JOIN r ON r.content_id = c.id)
SELECT content_id, content_name, domain_id FROM (
  SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY content_name NULLS LAST, domain_id) AS rn FROM c) WHERE rn = 1""")
def q_job_dim_content(spark, d):
    return G.build_dim_content(W.ctrl_content(spark, d), W.resources(spark, d)).select("content_id", "content_name", "domain_id")


# ---- C10 ---------------------------------------------------------------------------------------------------------
FILL_BUY = "saturation bigint, sov double"
FILL_PRIORITY = "level bigint, preemptible boolean"


def fill_rate_raw(spark, d):
    li = A.line_items(spark, d)
    return li.select(
        F.col("line_item_id").alias("line_id"), F.date_format("line_start", "yyyy-MM-dd").alias("start_date"),
        F.date_format("line_end", "yyyy-MM-dd").alias("end_date"),
        F.to_json(F.struct((F.col("screen_count") * 3).alias("saturation"), (F.col("screen_count") / 8.0).alias("sov"))).alias("buy_details"),
        F.when(F.col("line_item_id") % 13 == 0, F.lit("{broken"))
         .otherwise(F.to_json(F.struct((F.col("line_item_id") % 4).alias("level"),
                                       (F.col("line_item_id") % 2 == 0).alias("preemptible")))).alias("priority"))


@register("job_fill_rate", f"""
{with_ctes(W.ITEMS_SQL)}
SELECT li.line_item_id AS line_id, strftime(li.line_start, '%Y-%m-%d') AS start_date, strftime(li.line_end, '%Y-%m-%d') AS end_date,
       li.screen_count * 3 AS buy_saturation, li.screen_count / 8.0 AS buy_sov,
       CASE WHEN li.line_item_id % 13 = 0 THEN NULL ELSE li.line_item_id % 4 END AS priority_level,
       CASE WHEN li.line_item_id % 13 = 0 THEN NULL ELSE li.line_item_id % 2 = 0 END AS priority_preemptible,
       i.status_name AS line_status, i.owner_user_id
FROM li LEFT JOIN items i ON i.id = li.line_item_id""")
def q_job_fill_rate(spark, d):
    fr = S.build_fill_rate(fill_rate_raw(spark, d), W.proposal_items(spark, d), FILL_BUY, FILL_PRIORITY)
    return fr.select("line_id", F.date_format("start_date", "yyyy-MM-dd").alias("start_date"),
                     F.date_format("end_date", "yyyy-MM-dd").alias("end_date"), "buy_saturation", "buy_sov",
                     "priority_level", "priority_preemptible", "line_status", "owner_user_id")


# ---- C4 / A10 ------------------------------------------------------------------------------------------------------
def pop_raw(spark, d):
    ev = A.table(spark, d, "events")
    res = (F.when(F.col("event_type") == "view", "1920 x 540").when(F.col("event_type") == "click", "1920 x 1080")
            .when(F.col("event_type") == "purchase", "3840 x 2160").otherwise("1024 x 768"))
    return ev.select(G.content_format(res).alias("format"), F.col("user_id").alias("content_id"),
                     F.concat(F.lit("C"), (F.col("user_id") % 37).cast("string")).alias("content_name"), res.alias("content_res"),
                     F.date_format("ts", "yyyy-MM-dd").alias("play_date"), F.floor("value").cast("bigint").alias("play_count"),
                     F.floor(F.col("value") * 10).cast("bigint").alias("duration_secs"))


_POP_SQL = """pop AS (
  SELECT CASE event_type WHEN 'view' THEN 'liveline' WHEN 'click' THEN 'stroertv' WHEN 'purchase' THEN 'triplay' ELSE 'other' END AS format,
         user_id AS content_id, 'C' || CAST(user_id % 37 AS VARCHAR) AS content_name, strftime(ts, '%Y-%m-%d') AS play_date,
         CAST(floor(value) AS BIGINT) AS play_count, CAST(floor(value * 10) AS BIGINT) AS duration_secs FROM events)"""


@register("format_summary", f"""
WITH {_POP_SQL}
SELECT format, count(*) AS n_rows, count(DISTINCT content_name) AS n_contents, CAST(sum(play_count) AS BIGINT) AS plays,
       round(sum(duration_secs) / 3600.0, 2) AS hours
FROM pop WHERE format IN ('liveline', 'stroertv', 'triplay') AND play_count > 0 GROUP BY format""")
def q_format_summary(spark, d):
    return G.pop_format_summary(G.build_pop_clean(pop_raw(spark, d)))


@register("pop_clean", f"""
WITH {_POP_SQL}
SELECT format, content_id, content_name, play_date, play_count, duration_secs FROM pop
WHERE format IN ('liveline', 'stroertv', 'triplay') AND play_count > 0""")
def q_pop_clean(spark, d):
    c = G.build_pop_clean(pop_raw(spark, d))
    return c.select("format", "content_id", "content_name", F.date_format("play_date", "yyyy-MM-dd").alias("play_date"),
                    "play_count", "duration_secs")


# ---- the daily chain: bronze -> silver -> gold (dim_line_item -> budget -> health) ------------------------------------
DAILY_CFG = {**JOB_CFG, "calendar_start": A.BUDGET_WINDOW[0], "calendar_end": A.BUDGET_WINDOW[1]}

DLI_SQL = f"""dli AS (
  SELECT c.campaign_id, c.line_item_id, r.reservation_id, c.line_item_name, c.line_price, c.perf_expected_repetitions,
         c.perf_actual_repetitions, c.slot_duration, CAST(c.line_start AS DATE) AS line_start, CAST(c.line_end AS DATE) AS line_end,
         CASE WHEN c.line_start IS NOT NULL AND c.line_end IS NOT NULL
              THEN CAST(greatest(datediff('day', c.line_start, c.line_end) + 1, 1) AS BIGINT) END AS line_days, c.screen_count
  FROM campaigns c LEFT JOIN resfull r ON r.line_item_id = c.line_item_id
  WHERE coalesce(NOT c.campaign_id IN {_in(JOB_CFG['excluded_campaign_ids'])}, true)),
blogs_chain AS (SELECT CampID, PlayerID FROM bronze)"""


def _daily_budget_sql(**window):
    from .q_core import budget_core_sql
    return (with_ctes(BRONZE_SQL, CAMPAIGNS_SQL, W.RES22_SQL, W.RES_SQL, RESFULL_SQL, A.PLAYERS_SQL, DLI_SQL) + ",\n"
            + budget_core_sql(li="dli", blogs="blogs_chain", players="players", **window))


def daily_gold(spark, d):
    from .daily import build_gold, materialize
    return build_gold(spark, W.bronze_tables(spark, d) | materialize({"play_logs": bronze_play_logs(spark, d)}), DAILY_CFG)


@register("daily_fact_budget", _daily_budget_sql())
def q_daily_fact_budget(spark, d):
    return daily_gold(spark, d)["fact_campaign_budget"]


def _daily_health_sql():
    from .q_core import health_sql
    facts = f"""{with_ctes(ENRICHED_SQL, RESMAP_SQL, SINGLE_SQL)}
SELECT e.DateEnd AS date_key, e.PlayerID AS play_log_player_id, e.Impresje FROM enriched e"""
    return health_sql(_daily_budget_sql(), facts)


@register("daily_fact_health", _daily_health_sql())
def q_daily_fact_health(spark, d):
    return daily_gold(spark, d)["fact_health"]


# ---- T3 / C16-C18: a run that changed some days of the log -------------------------------------------------------------
# The log's days are the firsts of months here and the calendar is four months, so that a fact has some hundred days.
REFRESH_CFG = {**DAILY_CFG, "calendar_start": dt.date(1998, 2, 1), "calendar_end": dt.date(1998, 5, 31)}
_LATE, _PART, _GONE = "2001-11-01", "1998-03-01", "1998-07-01"


def monthly_bronze(spark, d):
    raw = W.play_logs_raw(spark, d).withColumn("DateEndTime", F.expr("timestampadd(HOUR, hour(DateEndTime), date_trunc('month', DateEndTime))"))
    logs = hourly_rollup(raw, ["PlayerID", "AdCopyId", "CampID", "FrameID", "DisplayUnitID", "contract_id"],
                         sums={"Duration": "Duration", "Impresje": "Impresje"}, scale=None)
    return {**W.bronze_tables(spark, d), "play_logs": logs}


def _refresh_sql():
    from .q_core import health_sql
    budget = _daily_budget_sql(lo=REFRESH_CFG["calendar_start"], hi=REFRESH_CFG["calendar_end"])
    plays = f"""{with_ctes(ENRICHED_SQL, RESMAP_SQL, SINGLE_SQL, FACT_MAP_SQL)}
SELECT m.DateEnd AS date_key, m.PlayerID AS play_log_player_id, m.CampID AS reservation_id, m.Impresje, m.emisje, m.campaign_id,
       {_FLAG_SQL} AS is_serwisowy FROM fact_rows m"""
    whole = f"""
SELECT 'fact_play_logs' AS fact, date_key, play_log_player_id AS player, reservation_id AS a, campaign_id AS b,
       emisje::DOUBLE AS x, is_serwisowy::DOUBLE AS y FROM ({plays})
UNION ALL SELECT 'fact_campaign_budget', date_key, play_log_player_id, reservation_id, line_item_id, daily_cost_line,
       daily_expected_repetitions FROM ({budget})
UNION ALL SELECT 'fact_health', date_key, play_log_player_id, n_campaigns, n_line_items, expected_impressions,
       actual_impressions FROM ({health_sql(budget, plays)})"""
    by_day = "strftime(DateEndTime, '%Y-%m-%d') AS DateEnd"
    return whole.replace(by_day, by_day.replace("DateEndTime", "date_trunc('month', DateEndTime)"))


@register("refresh_changed_days", _refresh_sql())
def q_refresh_changed_days(spark, d):
    from .refresh import build_all, read_fact, refresh_days
    bronze = {**monthly_bronze(spark, d)}
    bronze["play_logs"] = logs = cut_lineage(bronze["play_logs"])
    # the first run has part of one day, nothing of the last, and plays of a day that are gone in the second
    first = logs.where((F.col("DateEnd") != _LATE) & ((F.col("DateEnd") != _PART) | (F.col("PlayerID") % 2 == 0)))
    more = logs.where((F.col("DateEnd") == _LATE) & (F.col("PlayerID") % 3 == 0)).withColumn("DateEnd", F.lit(_GONE))
    root = scratch_path(spark, "gold")
    build_all(spark, {**bronze, "play_logs": first.unionByName(more)}, root, REFRESH_CFG)
    refresh_days(spark, bronze, [_LATE, _PART, _GONE], root, REFRESH_CFG)

    def out(name, a, b, x, y):
        return read_fact(spark, f"{root}/{name}").select(
            F.lit(name).alias("fact"), "date_key", F.col("play_log_player_id").alias("player"), F.col(a).cast("long").alias("a"),
            F.col(b).cast("long").alias("b"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))

    return out("fact_play_logs", "reservation_id", "campaign_id", "emisje", "is_serwisowy") \
        .unionByName(out("fact_campaign_budget", "reservation_id", "line_item_id", "daily_cost_line", "daily_expected_repetitions")) \
        .unionByName(out("fact_health", "n_campaigns", "n_line_items", "expected_impressions", "actual_impressions"))


# ---- Q3 / Q6 over the pipeline's tables ---------------------------------------------------------------------------------
def _cov(label, left_sql, lk, right_sql, rk):
    return f"""SELECT '{label}' AS label, CAST(count(l.k) AS BIGINT) AS left_rows, CAST(count(r.k) AS BIGINT) AS matched,
  CAST(count(l.k) - count(r.k) AS BIGINT) AS unmatched,
  CASE WHEN count(l.k) > 0 THEN count(r.k) * 100.0 / count(l.k) ELSE 0.0 END AS coverage_pct,
  CASE WHEN count(l.k) > 0 AND count(r.k) * 100.0 / count(l.k) = 100 THEN 'OK'
       WHEN count(l.k) > 0 AND count(r.k) * 100.0 / count(l.k) >= 95 THEN 'WARN' ELSE 'FAIL' END AS status,
  CAST(count(*) - count(l.k) AS BIGINT) AS null_rows,
  CASE WHEN count(*) > 0 THEN (count(*) - count(l.k)) * 100.0 / count(*) ELSE 0.0 END AS null_pct
FROM (SELECT {lk} AS k FROM {left_sql}) l
LEFT JOIN (SELECT DISTINCT {rk} AS k FROM {right_sql} WHERE {rk} IS NOT NULL) r ON r.k = l.k"""


_DLI_ALL_SQL = f"""dli_all AS (SELECT c.line_item_id, c.status_name, r.reservation_id FROM campaigns c LEFT JOIN resfull r ON r.line_item_id = c.line_item_id
            WHERE coalesce(NOT c.campaign_id IN {_in(JOB_CFG['excluded_campaign_ids'])}, true)
            UNION ALL BY NAME SELECT line AS line_item_id, res AS reservation_id FROM ov)"""
_FACT_SQL = f"""{FACT_MAP_SQL},
fact AS (SELECT CampID AS reservation_id, line_item_id, campaign_id FROM fact_rows), {_DLI_ALL_SQL}"""

_COVERAGE_SQL = (with_ctes(ENRICHED_SQL, RESMAP_SQL, W.RES22_SQL, W.RES_SQL, RESFULL_SQL, PLAYERS_FULL_SQL, _FACT_SQL) + "\n" + "\nUNION ALL\n".join([
    _cov("play_log->reservation", "enriched", "CampID", "res", "id"),
    _cov("play_log->display_unit", "enriched", "DisplayUnitID", "du", "id"),
    _cov("fact->reservation_map", "fact", "reservation_id", "res22", "id"),
    _cov("fact->campaign", "fact", "reservation_id", "(SELECT * FROM fact WHERE campaign_id IS NOT NULL)", "reservation_id"),
    _cov("fact->line_item", "fact", "line_item_id", "dli_all", "line_item_id"),
    _cov("line_item->reservation", "dli_all", "reservation_id", "res", "id"),
    _cov("budget->line_item", f"({_daily_budget_sql()})", "line_item_id", "dli_all", "line_item_id"),
    _cov("budget->player", f"({_daily_budget_sql()})", "play_log_player_id", "players_full", "play_log_player_id"),
]))


_COVERAGE_LINES = ["line_item_id", "campaign_id", "line_item_name", "line_price", "line_start", "line_end", "slot_duration", "screen_count",
                   "perf_expected_repetitions", "perf_actual_repetitions"]


@register("job_coverage_report", _COVERAGE_SQL)
def q_job_coverage_report(spark, d):
    # what is stored has the columns that the relations, the fact and the budget read
    logs = cut_lineage(bronze_play_logs(spark, d))
    lines, res, res22 = stored_lines(spark, d)
    camps = cut_lineage(campaigns(spark, d, lines).select(*_COVERAGE_LINES))
    e = S.build_play_logs_enriched(logs, res, W.frames_mapping(spark, d), W.screens(spark, d),
                                   W.display_units(spark, d), W.proposals(spark, d))
    e = cut_lineage(e.select("DateEnd", "CampID", "DisplayUnitID"))
    fact = cut_lineage(G.build_fact_play_logs(e, G.reservation_map(res22, camps),
                                              G.single_panel_campaigns(logs, G.reservation_lines(res22, camps), JOB_CFG), JOB_CFG)
                       .select("reservation_id", "line_item_id", "campaign_id"))
    dli = cut_lineage(G.build_dim_line_item(spark, camps, res22, res.select("id"), JOB_CFG)
                      .select("reservation_id", *_COVERAGE_LINES, "line_days"))
    players = players_full(spark, d)
    budget = budget_intervals(dli, logs, players, DAILY_CFG)
    return G.join_coverage_report(e, res, W.display_units(spark, d), res22, fact, dli, budget,
                                  G.build_dim_player(players))


@register("job_lines_without_reservation", f"""
{with_ctes(CAMPAIGNS_SQL, W.RES22_SQL, W.RES_SQL, RESFULL_SQL, OVERRIDES_SQL, _DLI_ALL_SQL)}
SELECT status_name, count(*) AS n FROM dli_all WHERE reservation_id IS NULL AND status_name IS NOT NULL GROUP BY 1""")
def q_job_lines_without_reservation(spark, d):
    from ..operators.quality import missing_by
    dli = G.build_dim_line_item(spark, campaigns(spark, d), W.reservations_v22(spark, d), W.reservations(spark, d), JOB_CFG)
    return missing_by(dli, "reservation_id", "status_name")
