"""Operator behaviour on hand-made frames (with NULLs, which the driver tables lack)."""
import datetime as dt

from pyspark.sql import functions as F

from playledger.operators import expand as X
from playledger.operators import lookup as L
from playledger.operators import quality as Q
from playledger.operators import rollup as R
from playledger.plans.budget import build_fact_budget


def test_lookup_policies(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "z")], "k long, v string")
    fan = L.lookup_join(left, dim, "k", ["v"], on_multi="fanout")
    assert sorted((r.k, r.v) for r in fan.collect() if r.k is not None) == [(1, "a"), (1, "b"), (2, "c")]
    assert fan.where("k is null").count() == 1 and fan.where("k is null").first().v is None   # NULL never matches
    first = L.lookup_join(left, dim, "k", ["v"], on_multi="first", order=["v"])
    assert sorted((r.k, r.v) for r in first.collect() if r.k is not None) == [(1, "a"), (2, "c")]


def test_lookup_fallback(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y")], "k long, own string")
    dim = spark.createDataFrame([(1, "dim1")], "k long, name string")
    out = L.lookup_join(left, dim, "k", ["name"], fallback={"name": "own"})
    assert sorted((r.k, r.name) for r in out.collect()) == [(1, "dim1"), (2, "y")]


def test_overlap_join_prefers_right(spark):
    items = spark.createDataFrame([(10, 1, "item adv"), (11, 2, "item adv2"), (12, 3, "solo")], "line long, cid long, advertiser string")
    camps = spark.createDataFrame([(1, "camp adv"), (2, None)], "cid long, advertiser string")
    out = {r.line: r.advertiser for r in L.overlap_join(items, camps, "cid").collect()}
    assert out == {10: "camp adv", 11: "item adv2", 12: "solo"}


def test_override_where_null(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None)], "res long, camp long")
    ov = spark.createDataFrame([(1, 900), (2, 901)], "res long, camp long")
    out = {r.res: r.camp for r in L.override_where_null(df, "res", ov, ["camp"]).collect()}
    assert out == {1: 900, 2: 5, 3: None}


def test_service_flag_precedence(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (None, None)], "a int, b int")
    got = [r[0] for r in df.select(L.service_flag([F.col("a") == 1], [F.col("b") == 1])).collect()]
    assert got == [1, 1, 2, 0, 0]


def test_dedup_keep_first_and_last(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (None, 1, "n1"), (None, 2, "n2")], "k long, o int, v string")
    first = {r.k: r.v for r in R.dedup(df, ["k"], order=["o"]).collect()}
    last = {r.k: r.v for r in R.dedup(df, ["k"], order=["o"], keep="last").collect()}
    assert first == {1: "a", None: "n1"} and last == {1: "c", None: "n2"}


def test_hourly_rollup_null_keys(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 10), None, 1.0), (dt.datetime(2024, 1, 1, 5, 20), None, 2.0),
                                (dt.datetime(2024, 1, 1, 6, 0), 7, None)], "t timestamp, p long, d double")
    keep = R.hourly_rollup(df, ["p"], ts="t", sums={"Duration": "d"}, null_keys="keep").collect()
    drop = R.hourly_rollup(df, ["p"], ts="t", sums={"Duration": "d"}, null_keys="drop").collect()
    assert sorted((r.timeslot, r.p, r.Duration, r.emisje) for r in keep if r.p is None) == [(5, None, 3.0, 2)]
    assert [(r.timeslot, r.Duration, r.timeslot_label) for r in drop] == [(6, 0.0, "06:00-07:00")]


def test_balancing_rows_example(spark):
    lines = spark.createDataFrame([(100, 60.0, 100.0), (100, 39.5, 100.0), (200, 60.0, 100.0), (200, 30.0, 100.0)],
                                  "cid long, line_price double, camp_price double")
    rows = X.balancing_rows(lines, "cid", "line_price", "camp_price").collect()
    assert [(r.cid, r.line_price, r.is_adjustment) for r in rows] == [(200, 10.0, True)]


def test_coverage_example(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    right = spark.createDataFrame([(1,)], "id long")
    r = Q.coverage(left, right, "id").first()
    assert (r.left_rows, r.matched, r.unmatched, round(r.coverage_pct, 1), r.status) == (3, 1, 2, 33.3, "FAIL")
    top = Q.top_unmatched(left, right, "id").collect()
    assert [(t.id, t.n) for t in top] == [(2, 2)]
    assert r.matched + r.unmatched == r.left_rows


def test_flight_days_clamp_and_invalid(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 12, 30), dt.date(2025, 1, 2)), (2, dt.date(2025, 3, 5), dt.date(2025, 3, 1)),
                                (3, None, dt.date(2025, 1, 1))], "id long, s date, e date")
    out = X.flight_days(df, "s", "e").collect()
    assert sorted((r.id, r.day) for r in out) == [(1, dt.date(2025, 1, 1)), (1, dt.date(2025, 1, 2))]


def test_month_and_week_spans(spark):
    df = spark.createDataFrame([(1, dt.date(2025, 1, 31), dt.date(2025, 3, 1))], "id long, s date, e date")
    months = [r.m for r in X.flight_months(df, "s", "e", "m").collect()]
    assert months == [dt.date(2025, 1, 1), dt.date(2025, 2, 1), dt.date(2025, 3, 1)]
    weeks = [r.w for r in X.flight_weeks(df, "s", "e", "w").collect()]
    assert weeks[0] == dt.date(2025, 1, 27) and weeks[-1] == dt.date(2025, 2, 24) and len(weeks) == 5


def _line(spark, rows):
    return spark.createDataFrame(rows, "campaign_id long, line_item_id long, reservation_id long, line_item_name string, "
                                       "line_price double, perf_expected_repetitions double, perf_actual_repetitions double, "
                                       "slot_duration double, line_start date, line_end date, line_days long, screen_count long")


def test_budget_examples(spark):
    lines = _line(spark, [
        (1, 10, 500, "plain", 100.0, 10.0, 10.0, None, dt.date(2025, 2, 1), dt.date(2025, 2, 10), 10, 1),
        (2, 20, None, "plain", 60.0, 0.0, 0.0, 10.0, dt.date(2025, 2, 1), dt.date(2025, 2, 2), 2, 3),
        (3, 30, 700, "plain", 10.0, 0.0, 0.0, None, dt.date(2024, 12, 31), dt.date(2025, 1, 1), 2, 1),
    ])
    logs = spark.createDataFrame([(500, 1), (500, 2), (500, 2), (700, 9)], "CampID long, PlayerID long")
    players = spark.createDataFrame([(1, "x")], "play_log_player_id long, player_name string")
    out = build_fact_budget(lines, logs, players, {"excluded_campaign_ids": []}).collect()
    l10 = [r for r in out if r.line_item_id == 10]
    assert len(l10) == 20 and {r.daily_cost_line for r in l10} == {5.0} and {r.n_players for r in l10} == {2}
    assert {r.duration_expected_sec for r in l10} == {0.5 * 15}
    l20 = [r for r in out if r.line_item_id == 20]
    assert len(l20) == 6 and {r.play_log_player_id for r in l20} == {None} and {r.daily_cost_line for r in l20} == {10.0}
    l30 = [r for r in out if r.line_item_id == 30]
    assert [(r.date_key, r.daily_cost_line) for r in l30] == [("2025-01-01", 5.0)]


def test_budget_correction(spark):
    lines = _line(spark, [
        (1, 10, 500, "plain", 100.0, 50.0, 40.0, None, dt.date(2025, 2, 1), dt.date(2025, 2, 1), 1, 1),
        (2, 20, None, "MetroMax x", 100.0, 50.0, 40.0, None, dt.date(2025, 2, 1), dt.date(2025, 2, 1), 1, 1),
    ])
    logs = spark.createDataFrame([(500, 1)], "CampID long, PlayerID long")
    players = spark.createDataFrame([(1, "LiveLine 1")], "play_log_player_id long, player_name string")
    from playledger import config as K
    out = {r.line_item_id: r for r in build_fact_budget(lines, logs, players, {"excluded_campaign_ids": []}).collect()}
    assert out[10].daily_actual_repetitions == round(40.0 * K.ACT_CORRECTION["liveline"], 2)
    assert out[20].daily_actual_repetitions == round(40.0 * K.BLENDED_ACT_CORRECTION, 2)


def test_budget_conserves_cost(spark):
    """Σ cost per (line, reservation) equals the line price when the flight is inside the window."""
    from playledger.plans import q_core
    from tests.conftest import SF_SMALL
    b = q_core.budget(spark, SF_SMALL)
    from playledger.plans import analogs as A
    li = A.line_items(spark, SF_SMALL)
    lo, hi = A.BUDGET_WINDOW
    inside = li.where((F.col("line_start") >= F.lit(lo)) & (F.col("line_end") <= F.lit(hi)))
    tot = b.groupBy("line_item_id").agg(F.sum("daily_cost_line").alias("s"))
    j = inside.join(tot, "line_item_id").select((F.abs(F.col("s") - F.col("line_price")) /
                                                 F.greatest(F.col("line_price"), F.lit(1.0))).alias("rel"))
    assert j.count() > 0
    assert j.agg(F.max("rel")).first()[0] < 1e-3


def test_reservation_overrides_wiring(spark):
    from playledger import config as K
    from playledger.plans import gold as G
    enriched = spark.createDataFrame([("2026-06-01", 1, 1125116202, 5), ("2026-06-01", 2, 77, 5)],
                                     "DateEnd string, PlayerID long, CampID long, AdCopyId long")
    res_map = spark.createDataFrame([(77, 700, 70)], "reservation_id long, line_item_id long, campaign_id long")
    single = spark.createDataFrame([], "campaign_id long")
    fact = {r.reservation_id: r for r in G.build_fact_play_logs(enriched, res_map, single).collect()}
    assert (fact[1125116202].campaign_id, fact[1125116202].line_item_id, fact[1125116202].is_serwisowy) == (900000001, 900000001, 1)
    assert (fact[77].campaign_id, fact[77].is_serwisowy) == (70, 0)
    syn = {r.campaign_id: r.campaign_name for r in G.synthetic_campaigns(spark).collect()}
    assert syn == {900000001: "Uwaga Pociąg", 900000002: "Autopromocja"}
    assert G.synthetic_line_items(spark).count() == len(K.RESERVATION_OVERRIDES)


def test_merge_intervals(spark):
    from playledger.plans.health import merge_intervals
    d = dt.date
    df = spark.createDataFrame([(1, d(2025, 1, 1), d(2025, 1, 5)), (1, d(2025, 1, 3), d(2025, 1, 8)), (1, d(2025, 1, 3), d(2025, 1, 8)),
                                (1, d(2025, 1, 10), d(2025, 1, 10)), (2, d(2025, 1, 1), d(2025, 1, 1))], "k long, d0 date, d1 date")
    got = sorted((r.k, r.d0, r.d1) for r in merge_intervals(df, ["k"]).collect())
    assert got == [(1, d(2025, 1, 1), d(2025, 1, 8)), (1, d(2025, 1, 10), d(2025, 1, 10)), (2, d(2025, 1, 1), d(2025, 1, 1))]


def test_bridge_sample_is_deterministic(spark):
    from playledger.plans import q_jobs as J
    from playledger.plans import silver as S
    from playledger.plans import world as W
    from tests.conftest import SF_SMALL
    args = (J.bronze_play_logs(spark, SF_SMALL), W.frames_mapping(spark, SF_SMALL), W.screens(spark, SF_SMALL),
            W.display_units(spark, SF_SMALL))
    a = sorted(map(tuple, S.build_screen_bridge(*args, sample_size=200).collect()))
    b = sorted(map(tuple, S.build_screen_bridge(*args, sample_size=200).collect()))
    assert a == b and sum(r[2] for r in a) <= 200


def test_budget_row_count_invariant(spark):
    """Rows per (line, reservation) = clamped days x players, and every row carries the same n_players."""
    from playledger.plans import analogs as A
    from playledger.plans import q_core
    from playledger.plans.budget import budget_intervals
    from tests.conftest import SF_SMALL
    ivals = budget_intervals(A.line_items(spark, SF_SMALL), A.budget_logs(spark, SF_SMALL), A.players(spark, SF_SMALL),
                             q_core.BUDGET_CFG)
    want = (ivals.groupBy("line_item_id", "reservation_id")
                 .agg(F.first((F.datediff("d1", "d0") + 1) * F.col("n_players")).alias("want"),
                      F.count(F.lit(1)).alias("players"), F.first("n_players").alias("n_players")))
    assert want.where(F.col("players") != F.col("n_players")).count() == 0
    got = (q_core.budget(spark, SF_SMALL).groupBy("line_item_id", "reservation_id").agg(F.count(F.lit(1)).alias("got"))
                 .withColumnRenamed("line_item_id", "li").withColumnRenamed("reservation_id", "ri"))
    cond = (want["line_item_id"] == got["li"]) & want["reservation_id"].eqNullSafe(got["ri"])   # NULL reservation = no booking
    j = want.join(got, cond, "full_outer")
    assert j.count() == want.count() and j.where(~F.col("want").eqNullSafe(F.col("got"))).count() == 0
