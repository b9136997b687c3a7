"""Business constants of the campaign star schema.

Everything below the FIXED VALUES marker must equal the source system's values for identical
results; it is kept as plain text, in its natural order.  Jobs receive these through their ``cfg``
argument (a plain dict), so callers can override any of them without touching code.
"""
from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------------------------
# FIXED VALUES (must match the source system)
# ---------------------------------------------------------------------------------------------

# Source field -> star schema column.
PROPOSAL_FIELDS = {
    "id": "campaign_id", "name": "campaign_name", "status": "campaign_status", "client_id": "client_id",
    "client_name": "client_name", "advertiser": "advertiser", "contract_id": "contract_id",
    "contract_number": "contract_number", "start_date": "campaign_start", "end_date": "campaign_end",
    "price": "campaign_price", "discount": "campaign_discount", "suggested_price": "campaign_suggested_price",
    "owner_user_id": "campaign_owner_id", "owner_user_name": "campaign_owner_name", "creation_user_name": "campaign_creator",
}
ITEM_FIELDS = {
    "id": "line_item_id", "campaign_id": "campaign_id", "name": "line_item_name", "type_of_buy": "type_of_buy",
    "is_preemptible": "is_preemptible", "status_id": "status_id", "status_name": "status_name",
    "start_date": "line_start", "end_date": "line_end", "price": "line_price", "suggested_price": "line_suggested_price",
    "slot_duration": "slot_duration", "screen_count": "screen_count", "group_count": "group_count",
    "owner_user_id": "owner_user_id", "owner_name": "owner_name", "creator": "creator", "client_id": "client_id",
    "client_name": "client_name", "advertiser": "advertiser", "buyer": "buyer",
}
# JSON text columns of a line item and the prefix of what they hold.
ITEM_JSON = {"buy_details": "buy_", "performance": "perf_", "delivery": "del_", "priority": "priority_"}
PROPOSAL_JSON = {"performance": "camp_perf_"}

CAMPAIGN_COLUMNS = [
    "campaign_id", "campaign_name", "campaign_status", "advertiser", "client_id", "client_name", "campaign_price",
    "campaign_suggested_price", "campaign_discount", "campaign_start", "campaign_end", "owner_email", "owner_user_id",
    "campaign_owner_name", "contract_id", "contract_number",
]
LINE_ITEM_COLUMNS = [
    "line_item_id", "campaign_id", "line_item_name", "type_of_buy", "slot_duration", "screen_count", "group_count",
    "status_id", "status_name", "is_preemptible", "line_price", "line_suggested_price", "buy_saturation",
    "buy_bs_saturation", "buy_sov", "buy_budget", "perf_expected_repetitions", "perf_actual_repetitions",
    "perf_expected_impressions", "perf_actual_impressions", "perf_status", "line_start", "line_end",
]
CAMPAIGN_FULL_COLUMNS = [
    "line_item_id", "campaign_id", "line_item_name", "campaign_name", "advertiser", "client_id", "client_name",
    "type_of_buy", "slot_duration", "screen_count", "group_count", "status_id", "status_name", "is_preemptible",
    "line_price", "line_suggested_price", "campaign_price", "campaign_suggested_price", "campaign_discount",
    "buy_saturation", "buy_bs_saturation", "buy_sov", "buy_budget", "perf_expected_repetitions",
    "perf_actual_repetitions", "perf_expected_impressions", "perf_actual_impressions", "line_start", "line_end",
    "campaign_start", "campaign_end", "owner_email", "owner_user_id", "contract_id", "contract_number",
    "campaign_owner_name",
]
# What a balancing row carries of its campaign.
BALANCING_CARRY = [
    "campaign_name", "advertiser", "client_id", "client_name", "campaign_start", "campaign_end", "owner_email",
    "owner_user_id", "campaign_price", "contract_id",
]
# Source field -> column, by source table.
FRAME_FIELDS = {
    "frame_id": "frame_id", "screen_id": "panel_id", "screen_uuid": "panel_uuid", "group_id": "screen_id",
    "group_uuid": "screen_uuid",
}
SCREEN_FIELDS = {
    "id": "screen_id", "name": "screen_name", "address": "screen_address", "resolution": "resolution",
    "orientation": "orientation",
}
PLAYER_FIELDS = {
    "id": "player_id", "claimed_resource_id": "play_log_player_id", "name": "player_name", "hostname": "hostname",
    "active": "player_active", "licensed": "licensed", "nscreens": "nscreens", "target_display_unit_id": "display_unit_id",
}
DISPLAY_UNIT_FIELDS = {
    "id": "display_unit_id", "name": "display_unit_name", "address": "du_address", "timezone": "timezone",
    "active": "du_active",
}
LOG_RESERVATION_FIELDS = {
    "id": "CampID", "name": "reservation_name", "start_date": "reservation_start", "end_date": "reservation_end",
    "state": "reservation_state",
}
LOG_PROPOSAL_FIELDS = {
    "id": "proposal_id", "name": "proposal_name", "advertiser": "advertiser", "client_name": "client_name",
    "contract_number": "contract_id", "status": "status", "start_date": "proposal_start", "end_date": "proposal_end",
}
ENRICHED_COLUMNS = [
    "DateEnd", "timeslot", "timeslot_label", "PlayerID", "FrameID", "DisplayUnitID", "AdCopyId", "CampID",
    "contract_id", "emisje", "Impresje", "Duration", "reservation_name", "reservation_state",
    "reservation_start", "reservation_end", "display_unit_name", "du_address", "screen_id", "screen_name",
    "screen_address", "proposal_id", "proposal_name", "advertiser", "client_name", "proposal_start",
    "proposal_end", "status",
]
# Positional layout of the raw play log (13 tab-separated fields; the rest are ignored).
PLAY_LOG_FIELDS = {
    0: "PlayerID", 1: "DateEndTime", 2: "Duration", 3: "AdCopyId", 5: "CampID", 6: "FrameID", 7: "DisplayUnitID",
    8: "Impresje",
}
PLAY_LOG_WIDTH = 13
PLAY_LOG_JSON_FIELD = 12
PLAY_LOG_CSV_COLUMNS = [
    "PlayerID", "DateEnd", "timeslot", "AdCopyId", "CampID", "FrameID", "DisplayUnitID", "contract_id",
    "Duration", "Impresje", "emisje", "timeslot_label",
]
# Tokens in line-item names (lower-cased): a text anywhere, or a word between underscores, spaces or slashes.
NAME_TOKEN_TEXTS = {"LL": "liveline", "STV": "stroertv", "MM": "metromax"}
NAME_TOKEN_PATTERNS = {
    "LL": r"(^|[_ /])ll([_ /]|$)",
    "STV": r"(^|[_ /])stv([_ /]|$)",
    "DMB": r"(^|[_ /])dmb([_ /]|$)",
    "TP": r"(^|[_ /])tp([_ /]|$)",
}
NAME_TOKENS = ["LL", "STV", "MM", "DMB", "TP"]
RESERVATION_FIELDS = {
    "id": "reservation_id", "name": "reservation_name", "start_date": "reservation_start", "end_date": "reservation_end",
    "state": "reservation_state", "saturation": "saturation", "duration_msec": "duration_msec", "active": "active",
}
PLAY_FACT_COLUMNS = [
    "date_key", "play_log_player_id", "frame_id", "display_unit_id", "reservation_id", "content_id", "timeslot",
    "contract_id", "emisje", "Impresje", "Duration", "line_item_id", "campaign_id", "is_serwisowy",
]
# Columns of the line item export.
ITEM_EXPORT_COLUMNS = [
    "id", "proposal_id", "name", "status", "start_date", "end_date", "start_time", "end_time", "price", "custom_price",
    "suggested_price", "actual_impressions", "actual_repetitions", "screen_count", "audience_count", "slot_duration",
    "saturation", "flight_duration", "provider_id", "external_id", "creation_tm", "modification_tm",
]
# Text of a line item without a performance status.
NO_STATUS = "Brak danych"

# Calendar window of dim_date and of every budget row.
CALENDAR_START = _dt.date(2025, 1, 1)
CALENDAR_END = _dt.date(2027, 12, 31)

# Slot length (seconds) used when a line item carries none.
DEFAULT_SLOT_DURATION = 15.0

# Actual-repetition correction per metro format (network totals of two sources over one window).
ACT_CORRECTION = {
    "liveline": 85_273_483 / 111_361_939,
    "stroertv": 88_312_317 / 38_454_559,
}
# Expected = corrected actual x factor, factor in [1/1.13, 1/1.01], stable per line item id.
EXP_FACTOR_LOW = 1 / 1.13
EXP_FACTOR_HIGH = 1 / 1.01
# Row split between the two metro formats used for bundles without any matched player.
MIXED_FORMAT_SPLIT = {
    "liveline": 4481 / (4481 + 2089),
    "stroertv": 2089 / (4481 + 2089),
}
BLENDED_ACT_CORRECTION = sum(MIXED_FORMAT_SPLIT[f] * ACT_CORRECTION[f] for f in ACT_CORRECTION)

# Line-item statuses that count as active for the campaign period bridge (compared lower-cased).
ACTIVE_STATUSES = ["live", "ended", "submitted", "booked"]

# Resource dictionary types that are kept.
KNOWN_RESOURCE_TYPES = ["display_unit", "reservation", "content", "host", "skin"]

# Screen resolution -> content format; anything else is "other".
RESOLUTION_FORMAT = {
    "1920 x 540": "liveline",
    "1920 x 1080": "stroertv",
    "3840 x 2160": "triplay",
}
DEFAULT_FORMAT = "other"

# Location parser.  Technical codes (A01, C11, TP, TP05, DMB, DMB03, CD ...); pure acronyms are not codes.
LOCATION_CODE_PATTERN = r"^(TP\d*|DMB\d*|CD|CA|[A-Z]{1,2}\d+[A-Z]?)$"
# Words that end a station name (directions, "whole station", and one misspelling found in the data).
LOCATION_STOP_WORDS = ["północ", "południe", "wschód", "zachód", "polnoc", "poludnie", "pónoc", "cała", "stacja"]
# Checked in order before any other rule: (label, regex, ignore case).
LOCATION_PRIORITY = [
    ("Wrocław", "Wrocław", True),
    ("Kraków", "Kraków", True),
    ("Katowice", "Katowice", True),
    ("Lotnisko", "Lotnisko", True),
    ("Wagony", "StroerTV|LiveLine", True),
    ("B9D", "B9D", False),
    ("B18D", "B18D", False),
    ("B36D", "B36D", False),
]
# Test / office devices.
TEST_DEVICE_PATTERN = "biuro|test|teltronic"

# Calendar names (ISO weekday 1 = Monday).
MONTH_FULL = ["Styczeń", "Luty", "Marzec", "Kwiecień", "Maj", "Czerwiec",
              "Lipiec", "Sierpień", "Wrzesień", "Październik", "Listopad", "Grudzień"]
MONTH_SHORT = ["sty", "lut", "mar", "kwi", "maj", "cze", "lip", "sie", "wrz", "paź", "lis", "gru"]
WEEKDAY_FULL = ["Poniedziałek", "Wtorek", "Środa", "Czwartek", "Piątek", "Sobota", "Niedziela"]
WEEKDAY_SHORT = ["Pon", "Wt", "Śr", "Czw", "Pt", "Sob", "Nd"]
WEEK_LABEL_PL = ", tydzień: "
WEEK_LABEL_EN = "Week: "

# Coverage thresholds (percent).
COVERAGE_OK = 100.0
COVERAGE_WARN = 95.0

# Balancing-row tolerance (currency units) and its label.
BALANCE_TOLERANCE = 1.0
ADJUSTMENT_LINE_NAME = "[korekta kampanii]"

# Shrink guard: a replacement smaller than this share of the current copy is refused.
SHRINK_RATIO = 0.9

# Campaigns flagged as house / non-commercial (service flag 1).
SERVICE_CAMPAIGN_IDS = [
    2223525, 3238917, 3379967, 3072428, 2312735, 2236243, 2654184, 3324704, 2984174, 2617443,
    2486500, 2288610, 2108200, 3005804, 2464079, 3043940, 3706832, 3706837, 2986317, 3105116,
    3071680, 3609971, 3071824, 900000001, 900000002, 3705906, 3705905, 3705898, 3029333, 3002440,
]
# Reservations flagged as house.
SERVICE_RESERVATION_IDS = [1125116202, 1331907375, 1243202200, 1230744166]
# Line items flagged as house (orphans without a campaign).
SERVICE_LINE_ITEM_IDS = [3270338, 3355830]
# Campaigns forced to service flag 2 (single panel / test).
FORCE_SINGLE_PANEL_CAMPAIGN_IDS = [2534697]
# Campaigns removed from line items and budget entirely.
EXCLUDED_CAMPAIGN_IDS = [2472239]

# Reservations booked without a campaign in the source system, given a synthetic campaign / line item
# (reservation_id, campaign_id, line_item_id, campaign_name, line_item_name, advertiser, client_name).
RESERVATION_OVERRIDES = [
    (1125116202, 900000001, 900000001, "Uwaga Pociąg", "Uwaga Pociąg", "Metro Warszawskie", "Metro Warszawskie"),
    (1230744166, 900000002, 900000003, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1248739280, 900000002, 900000004, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1248760574, 900000002, 900000005, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1249965482, 900000002, 900000006, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1249965517, 900000002, 900000007, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1249965703, 900000002, 900000008, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1320926616, 900000002, 900000009, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1173115467, 900000002, 900000010, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1173115610, 900000002, 900000011, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1287527034, 900000002, 900000012, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1422515259, 900000002, 900000013, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1424533850, 900000002, 900000014, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1444673694, 900000002, 900000015, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1967182419, 900000002, 900000016, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1967518300, 900000002, 900000017, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1987096469, 900000002, 900000018, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1989331182, 900000002, 900000019, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1989334266, 900000002, 900000020, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
    (1991227199, 900000002, 900000021, "Autopromocja", "Autopromocja", "Stroer", "Stroer"),
]
# Control-system tables: table -> (API resource, version); the incremental ones are upserted by id after a
# high-water cursor, the rest are replaced whole (guarded against empty refetches).
CONTROL_ENDPOINTS = {
    "reservations": ("reservation", 7),
    "display_units": ("display_unit", 5),
    "players": ("client_registration", 5),
    "content": ("content", 7),
    "bundles": ("bundle", 12),
    "bundle_content": ("bundle_content", 3),
    "schedules": ("schedule", 5),
    "customers": ("customer", 5),
    "users": ("user", 6),
}
CONTROL_INCREMENTAL = ["reservations", "content", "bundles", "bundle_content", "schedules"]
CURSOR_EPOCH = "1970-01-01 00:00:00"

RESERVATION_OVERRIDE_SCHEMA = ("reservation_id bigint, campaign_id bigint, line_item_id bigint, campaign_name string, "
                               "line_item_name string, advertiser string, client_name string")

# ---------------------------------------------------------------------------------------------


def default_cfg() -> dict:
    """The configuration dict that jobs use when the caller passes none."""
    return {
        "calendar_start": CALENDAR_START,
        "calendar_end": CALENDAR_END,
        "default_slot": DEFAULT_SLOT_DURATION,
        "act_correction": dict(ACT_CORRECTION),
        "blended_correction": BLENDED_ACT_CORRECTION,
        "exp_factor_low": EXP_FACTOR_LOW,
        "exp_factor_high": EXP_FACTOR_HIGH,
        "active_statuses": list(ACTIVE_STATUSES),
        "service_campaign_ids": list(SERVICE_CAMPAIGN_IDS),
        "service_reservation_ids": list(SERVICE_RESERVATION_IDS),
        "service_line_item_ids": list(SERVICE_LINE_ITEM_IDS),
        "force_single_panel_campaign_ids": list(FORCE_SINGLE_PANEL_CAMPAIGN_IDS),
        "excluded_campaign_ids": list(EXCLUDED_CAMPAIGN_IDS),
        "health_skip_head_days": 60,
        "health_skip_tail_days": 1,
        "reservation_overrides": list(RESERVATION_OVERRIDES),
    }
