"""Gold jobs (C11-C16, C20, C4): star-schema dimensions and facts.  ``inputs -> DataFrame``, no I/O."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as K
from ..functions.calendar import iso_week_label
from ..functions.names import classify, is_test, location
from ..functions.semantics import inclusive_days, is_in, keep_not_in, to_long, to_ts
from ..operators.conform import project_existing, union_by_name
from ..operators.expand import balancing_rows, flight_months, flight_weeks
from ..operators.filters import active_status
from ..operators.lookup import lookup_join, override_where_null, service_flag
from ..operators.rollup import dedup
from ..session import cut_lineage


def _cfg(cfg):
    return {**K.default_cfg(), **(cfg or {})}


def overrides_frame(spark: SparkSession, cfg: dict | None = None) -> DataFrame:
    """The configured reservation overrides as a (broadcastable, a few rows) DataFrame."""
    return spark.createDataFrame(_cfg(cfg)["reservation_overrides"], K.RESERVATION_OVERRIDE_SCHEMA)


def synthetic_campaigns(spark: SparkSession, cfg: dict | None = None) -> DataFrame:
    """One row per synthetic campaign of the overrides (the last override of a campaign wins)."""
    ov = overrides_frame(spark, cfg).withColumn("__pos", F.monotonically_increasing_id())
    return dedup(ov, ["campaign_id"], order=["__pos"], keep="last").select("campaign_id", "campaign_name", "advertiser", "client_name")


def synthetic_line_items(spark: SparkSession, cfg: dict | None = None) -> DataFrame:
    return overrides_frame(spark, cfg).select("line_item_id", "campaign_id", "line_item_name", "reservation_id")


def _booked_lines(res22: DataFrame) -> DataFrame:
    return res22.select(to_long("id").alias("reservation_id"), to_long("proposal_line_item_id").alias("line_item_id")).dropna()


def _line_campaigns(campaigns: DataFrame) -> DataFrame:
    """One campaign per line item (the smallest id)."""
    lines = campaigns.select(to_long("line_item_id").alias("line_item_id"), to_long("campaign_id").alias("campaign_id"))
    return lines.groupBy("line_item_id").agg(F.min("campaign_id").alias("campaign_id"))


def reservation_lines(res22: DataFrame, campaigns: DataFrame) -> DataFrame:
    """(reservation, line item, campaign) for every line item of a reservation."""
    return lookup_join(_booked_lines(res22), _line_campaigns(campaigns), "line_item_id")


def reservation_map(res22: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Reservation -> (line item, campaign), one row per reservation (smallest line item first).  The choice is
    a minimum of plain ids (hash aggregates), made before anything is joined."""
    first = _booked_lines(res22).groupBy("reservation_id").agg(F.min("line_item_id").alias("line_item_id"))
    return lookup_join(first, _line_campaigns(campaigns), "line_item_id")


def single_panel_campaigns(play_logs: DataFrame, res_map: DataFrame, cfg: dict | None = None) -> DataFrame:
    """C20/A5: campaigns whose plays come from exactly one panel (distinct players == 1), minus the house
    campaigns; plus the campaigns forced to that flag.  ``res_map`` has every line item of a reservation
    (:func:`reservation_lines`), so a play counts for each of their campaigns.  Returns one column ``campaign_id``."""
    cfg = _cfg(cfg)
    # distinct (reservation, player) pairs first: the play log shrinks to fleet x reservations before the join
    pl = play_logs.select(to_long("CampID").alias("reservation_id"), to_long("PlayerID").alias("PlayerID")).dropna().distinct()
    pl = pl.join(res_map.select("reservation_id", "campaign_id").distinct(), "reservation_id").dropna(subset=["campaign_id"])
    one = (pl.groupBy("campaign_id").agg(F.countDistinct("PlayerID").alias("n")).where("n = 1")
             .where(keep_not_in(F.col("campaign_id"), cfg["service_campaign_ids"])).select("campaign_id"))
    spark = play_logs.sparkSession
    forced = spark.createDataFrame([(int(x),) for x in cfg["force_single_panel_campaign_ids"]], "campaign_id bigint")
    return one.unionByName(forced).distinct()


#: What the play fact takes of the enriched plays.
PLAY_COLUMNS = ["DateEnd", "PlayerID", "FrameID", "DisplayUnitID", "CampID", "AdCopyId", "timeslot", "contract_id", "emisje", "Impresje",
                "Duration"]


def build_fact_play_logs(enriched: DataFrame, res_map: DataFrame, single_panel: DataFrame, cfg: dict | None = None,
                         overrides: DataFrame | None = None) -> DataFrame:
    """Play fact keyed for the star schema, campaign resolved through the reservation map, manual
    overrides where unresolved, and the three-state service flag (1 house > 2 single panel > 0)."""
    cfg = _cfg(cfg)
    df = project_existing(enriched, PLAY_COLUMNS, {"DateEnd": "date_key", "PlayerID": "play_log_player_id", "FrameID": "frame_id",
                                           "DisplayUnitID": "display_unit_id", "CampID": "reservation_id",
                                           "AdCopyId": "content_id"})
    for c in ["play_log_player_id", "frame_id", "display_unit_id", "content_id", "reservation_id", "timeslot"]:
        df = df.withColumn(c, to_long(c)) if c in df.columns else df.withColumn(c, F.lit(None).cast("bigint"))
    for c, t in [("contract_id", "string"), ("emisje", "bigint"), ("Impresje", "bigint"), ("Duration", "double")]:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    ids = ["date_key", "timeslot", "play_log_player_id", "frame_id", "display_unit_id", "content_id", "reservation_id"]
    # the single-panel flag goes to the reservations' campaigns, so that the plays are dealt out once, by reservation
    flags = single_panel.select("campaign_id", F.lit(True).alias("__is_sp")).distinct()
    flagged = lookup_join(res_map.select("reservation_id", "line_item_id", "campaign_id"), flags, "campaign_id", ["__is_sp"], spread=["reservation_id"])
    df = lookup_join(df, flagged, "reservation_id", ["line_item_id", "campaign_id", "__is_sp"], spread=ids)
    if overrides is None and cfg["reservation_overrides"]:
        overrides = overrides_frame(enriched.sparkSession, cfg)
    if overrides is not None:
        own = lookup_join(overrides, flags, "campaign_id", ["__is_sp"])
        df = override_where_null(df, "reservation_id", own, ["campaign_id", "line_item_id", "__is_sp"], when_null="campaign_id",
                                 order=["campaign_id", "line_item_id"], spread=ids)
    flag = service_flag(
        [is_in(F.col("campaign_id"), cfg["service_campaign_ids"]), is_in(F.col("reservation_id"), cfg["service_reservation_ids"]),
         is_in(F.col("line_item_id"), cfg["service_line_item_ids"])],
        [F.col("__is_sp")])
    return df.withColumn("is_serwisowy", flag).select(*K.PLAY_FACT_COLUMNS)


def build_dim_campaign(spark: SparkSession, campaigns: DataFrame, single_panel: DataFrame, cfg: dict | None = None,
                       synthetic: list[dict] | DataFrame | None = None) -> DataFrame:
    """One row per campaign (first line row by line item id), excluded campaigns removed, synthetic
    campaigns from configuration added, service flag."""
    cfg = _cfg(cfg)
    df = campaigns.withColumn("campaign_id", to_long("campaign_id"))
    # the columns of the result and of the order only: the other details of the lines are neither made nor dealt out
    df = dedup(df.select(*[c for c in df.columns if c in K.CAMPAIGN_COLUMNS or c == "line_item_id"]), ["campaign_id"], order=["line_item_id"])
    df = project_existing(df, K.CAMPAIGN_COLUMNS)
    df = df.where(keep_not_in(F.col("campaign_id"), cfg["excluded_campaign_ids"]))
    if synthetic is None and cfg["reservation_overrides"]:
        synthetic = synthetic_campaigns(spark, cfg)
    if synthetic is not None and not isinstance(synthetic, DataFrame):
        synthetic = spark.createDataFrame(synthetic, "campaign_id bigint, campaign_name string, advertiser string, client_name string") \
            if synthetic else None
    for c in ("client_id", "owner_user_id", "campaign_status"):
        if c in df.columns:
            df = df.withColumn(c, to_long(c))  # a whole number or nothing, also beside the synthetic rows' NULLs
    if synthetic is not None:
        df = union_by_name(df, synthetic)
    df = lookup_join(df, single_panel.select("campaign_id", F.lit(True).alias("__is_sp")).distinct(), "campaign_id", ["__is_sp"])
    flag = service_flag([is_in(F.col("campaign_id"), cfg["service_campaign_ids"])], [F.col("__is_sp")])
    return df.withColumn("is_serwisowy", flag).drop("__is_sp")


def reservations_full(res22: DataFrame, reservations: DataFrame) -> DataFrame:
    """The booked reservations with their line item and what is known of them."""
    r = res22.select(to_long("id").alias("reservation_id"), to_long("proposal_line_item_id").alias("line_item_id"),
                     "booking_state").dropna(subset=["line_item_id"])
    full = project_existing(reservations, list(K.RESERVATION_FIELDS), K.RESERVATION_FIELDS)
    return lookup_join(r, full.withColumn("reservation_id", to_long("reservation_id")), "reservation_id")


_LINE_IDS = ["line_item_id", "campaign_id", "line_item_name"]


def _line_attributes(campaigns: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns and the details nested in them (``buy_budget`` stands for ``buy_budget.*``), ids whole, flights
    as timestamps with their inclusive days."""
    nested = [c for c in campaigns.columns if c.split(".")[0] in columns and c not in columns]
    df = project_existing(campaigns, columns + nested)
    for c in ("line_item_id", "campaign_id", "owner_user_id", "screen_count", "group_count"):
        if c in df.columns:
            df = df.withColumn(c, to_long(c))
    df = df.withColumn("line_start", to_ts("line_start")).withColumn("line_end", to_ts("line_end"))
    return df.withColumn("line_days", inclusive_days("line_start", "line_end").cast("bigint"))


def build_dim_line_item(spark: SparkSession, campaigns: DataFrame, res22: DataFrame, reservations: DataFrame,
                        cfg: dict | None = None, synthetic: list[dict] | DataFrame | None = None, full: DataFrame | None = None) -> DataFrame:
    """Line items with inclusive day count and their reservations (1:n, a line with two reservations
    gives two rows), plus synthetic lines from configuration.  ``full``: the :func:`reservations_full` of both, where the
    caller has stored them."""
    cfg = _cfg(cfg)
    df = _line_attributes(campaigns, K.LINE_ITEM_COLUMNS).where(keep_not_in(F.col("campaign_id"), cfg["excluded_campaign_ids"]))
    if "perf_status" in df.columns:
        df = df.withColumn("broadsign_status", F.coalesce("perf_status", F.lit(K.NO_STATUS))).drop("perf_status")
    full = reservations_full(res22, reservations) if full is None else full
    df = lookup_join(df, full, "line_item_id", on_multi="fanout", spread=_LINE_IDS)
    if synthetic is None and cfg["reservation_overrides"]:
        synthetic = synthetic_line_items(spark, cfg)
    if synthetic is not None and not isinstance(synthetic, DataFrame):
        synthetic = spark.createDataFrame(synthetic, "line_item_id bigint, campaign_id bigint, line_item_name string, reservation_id bigint") \
            if synthetic else None
    if synthetic is not None:
        df = union_by_name(df, synthetic)
    return (df.withColumn("line_start", F.date_format("line_start", "yyyy-MM-dd"))
              .withColumn("line_end", F.date_format("line_end", "yyyy-MM-dd")))


def _in_parts(lines: DataFrame, full: DataFrame, parts: int) -> DataFrame:
    """The lines with their reservations, joined part by part of the lines."""
    def of(df, other):
        key = F.when(F.col("line_item_id").isNull(), F.xxhash64(*other)).otherwise(F.xxhash64("line_item_id"))
        return [df.where(F.pmod(key, F.lit(parts)) == p) for p in range(parts)]

    if parts == 1:
        return lookup_join(lines, full, "line_item_id", on_multi="fanout", spread=_LINE_IDS)
    done = [cut_lineage(lookup_join(a, b, "line_item_id", on_multi="fanout", spread=_LINE_IDS))
            for a, b in zip(of(lines, ["campaign_id", "line_item_name"]), of(full, ["reservation_id"]))]
    return reduce(DataFrame.unionByName, done)


def build_campaign_full(campaigns: DataFrame, res22: DataFrame, reservations: DataFrame,
                        cfg: dict | None = None, full: DataFrame | None = None, parts: int = 1) -> DataFrame:
    """C14: line item x reservation rows plus one balancing row per campaign whose price differs from the sum
    of its line prices by more than the tolerance (G7).  A line counts once for each of its reservations, as its rows
    do; the sums come from the narrow lines times that number, so the wide joined rows are neither stored nor summed.
    ``full``: as in :func:`build_dim_line_item`.  ``parts``: the wide lines are dealt out in so many parts, each a stored
    step, so that the shuffle files of one part at a time are on disk."""
    base = _line_attributes(campaigns, K.CAMPAIGN_FULL_COLUMNS)
    booked = reservations_full(res22, reservations.select("id")) if full is None else full
    full = reservations_full(res22, reservations) if full is None else full
    df = _in_parts(base, full, parts).withColumn("is_adjustment", F.lit(False))
    # the sums from narrow lines, the head's columns from the campaigns as they lie: no wide row is shuffled for either
    booked = booked.groupBy("line_item_id").agg(F.count(F.lit(1)).alias("__rows"))
    lines = lookup_join(base.select("campaign_id", "line_item_id", "line_price"), booked, "line_item_id", ["__rows"])
    sums = lines.groupBy("campaign_id").agg(F.sum(F.col("line_price") * F.coalesce("__rows", F.lit(1))).alias("line_price"))
    carry = [c for c in K.BALANCING_CARRY if c != "campaign_price" and c in df.columns]
    heads = base.select("campaign_id", "line_item_id", F.lit(None).cast("double").alias("line_price"), "campaign_price", *carry)
    adj = balancing_rows(heads.unionByName(sums, allowMissingColumns=True), "campaign_id", "line_price", "campaign_price",
                         carry=carry, order="line_item_id")
    adj = cut_lineage(adj) if parts > 1 else adj
    adj = adj.withColumn("line_item_name", F.lit(K.ADJUSTMENT_LINE_NAME)).withColumn("line_suggested_price", F.lit(0.0))
    out = union_by_name(df, adj)
    return (out.withColumn("line_start", F.date_format("line_start", "yyyy-MM-dd"))
               .withColumn("line_end", F.date_format("line_end", "yyyy-MM-dd")))


def campaign_full_check(full: DataFrame) -> DataFrame:
    """Q7 over :func:`build_campaign_full`: how many campaigns' lines, balancing rows included, add up to the price."""
    from ..operators.quality import control_totals
    _, share = control_totals(full, "campaign_id", "line_price", "campaign_price")
    return share


def build_dim_player(players_full: DataFrame) -> DataFrame:
    """C11 dim_player: one row per play-log player id, location from the display unit name, test flag."""
    keep = ["play_log_player_id", "player_id", "player_name", "hostname", "display_unit_id", "display_unit_name",
            "du_address", "timezone", "nscreens"]
    df = dedup(project_existing(players_full, keep), ["play_log_player_id"], order=["player_id"])
    return (df.withColumn("Lokalizacja", location(F.col("display_unit_name")))
              .withColumn("is_test", is_test(F.col("player_name"), F.col("display_unit_name"))))


def build_dim_screen(screens_full: DataFrame) -> DataFrame:
    """C11 dim_screen: one row per frame, location from the screen name."""
    keep = ["frame_id", "screen_id", "screen_name", "screen_address", "panel_id", "panel_uuid", "screen_uuid",
            "resolution", "orientation"]
    df = dedup(project_existing(screens_full, keep), ["frame_id"], order=["screen_id"])
    return df.withColumn("Lokalizacja", location(F.col("screen_name")))


def build_dim_content(content: DataFrame, resources: DataFrame | None) -> DataFrame:
    """C11 dim_content: content names with the resource dictionary as fallback (the dictionary may be absent)."""
    c = content.select(to_long("id").alias("content_id"), F.col("name").alias("content_name"), "domain_id")
    if resources is not None:
        r = resources.where(F.col("type") == "content").select(to_long("id").alias("content_id"),
                                                               F.col("name").alias("dict_name"))
        c = lookup_join(c, r, "content_id", on_multi="first", order=["dict_name"], fallback={"content_name": "dict_name"})
        c = c.drop("dict_name")
    return dedup(c, ["content_id"], order=["content_name", "domain_id"])


def build_pop_clean(pop: DataFrame, formats=("liveline", "stroertv", "triplay")) -> DataFrame:
    """C4 silver: known formats only, positive play counts, typed columns."""
    df = pop.where(is_in(F.col("format"), list(formats)) & (F.col("play_count") > 0))
    return df.select("format", "content_id", "content_name", "content_res",
                     F.to_date(to_ts("play_date")).alias("play_date"),
                     F.coalesce(to_long("play_count"), F.lit(0)).alias("play_count"),
                     F.coalesce(to_long("duration_secs"), F.lit(0)).alias("duration_secs"))


def pop_format_summary(pop_clean: DataFrame) -> DataFrame:
    """A10: per format - rows, distinct contents, plays, hours (rounded once at the end)."""
    return pop_clean.groupBy("format").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("content_name").alias("n_contents"),
        F.sum("play_count").cast("bigint").alias("plays"),
        F.round(F.sum("duration_secs") / 3600.0, 2).alias("hours"))


def content_format(resolution_col) -> F.Column:
    """resolution -> format."""
    return classify(resolution_col, K.RESOLUTION_FORMAT, K.DEFAULT_FORMAT, normalize=True)


def period_bridge(li: DataFrame, cfg: dict | None = None) -> DataFrame:
    """C15 dim_campaign_period: campaign x month rows (grain M) and campaign x ISO week rows (grain W), each built
    independently from the active line items' flights (months from truncated starts, weeks from Mondays)."""
    li = li.where(active_status("status_name", _cfg(cfg)["active_statuses"])).dropna(subset=["campaign_id", "line_start", "line_end"])
    # whole ids and days are told apart; their texts, one to each day, are made of what is left
    m = (flight_months(li.select("campaign_id", "line_start", "line_end"), "line_start", "line_end", "m").select("campaign_id", "m").distinct()
          .select("campaign_id", F.date_format("m", "yyyy-MM").alias("year_month"), F.col("m").alias("year_month_dt")))
    w = (flight_weeks(li.select("campaign_id", "line_start", "line_end"), "line_start", "line_end", "w").select("campaign_id", "w").distinct()
          .select("campaign_id", iso_week_label("w").alias("year_week"), F.col("w").alias("year_week_dt"),
                  F.trunc("w", "month").alias("week_parent_month_dt")))
    return union_by_name(m, w, tag="grain", tags=["M", "W"]).select(
        "campaign_id", "grain", "year_month", F.date_format("year_month_dt", "yyyy-MM-dd").alias("year_month_dt"),
        "year_week", F.date_format("year_week_dt", "yyyy-MM-dd").alias("year_week_dt"),
        F.date_format("week_parent_month_dt", "yyyy-MM-dd").alias("week_parent_month_dt"))


def join_coverage_report(enriched: DataFrame, reservations: DataFrame, display_units: DataFrame, res22: DataFrame,
                         fact_play_logs: DataFrame, dim_line_item: DataFrame, budget: DataFrame | None = None,
                         dim_player: DataFrame | None = None) -> DataFrame:
    """Q3 over the pipeline's own tables: one row per key relation (rows with a key, matched, unmatched, percent,
    OK/WARN/FAIL, rows without a key and their share).  Each table is scanned once for all its relations.  ``budget`` may
    be the narrow intervals: a row then stands for the days of its flight."""
    from ..operators.quality import Relation, relation_coverage
    fact = fact_play_logs.select("reservation_id", "line_item_id",
                                 F.when(F.col("campaign_id").isNotNull(), F.col("reservation_id")).alias("resolved_id"))
    tables = {"play_log": (enriched, None), "fact": (fact, None), "line_item": (dim_line_item, None),
              "reservation": (reservations, None), "display_unit": (display_units, None), "reservation_map": (res22, None)}
    relations = [
        Relation("play_log->reservation", "play_log", "CampID", "reservation", "id"),
        Relation("play_log->display_unit", "play_log", "DisplayUnitID", "display_unit", "id"),
        Relation("fact->reservation_map", "fact", "reservation_id", "reservation_map", "id"),
        Relation("fact->campaign", "fact", "reservation_id", "fact", "resolved_id"),
        Relation("fact->line_item", "fact", "line_item_id", "line_item", "line_item_id"),
        Relation("line_item->reservation", "line_item", "reservation_id", "reservation", "id"),
    ]
    if budget is not None:
        days = F.datediff("d1", "d0") + 1 if "d0" in budget.columns else None
        tables |= {"budget": (budget, days), "player": (dim_player, None)}
        relations += [Relation("budget->line_item", "budget", "line_item_id", "line_item", "line_item_id"),
                      Relation("budget->player", "budget", "play_log_player_id", "player", "play_log_player_id")]
    return relation_coverage(tables, relations)
