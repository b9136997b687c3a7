"""What lies on disk while a query runs: shuffled columns, steps, and the results that the narrower plans must keep."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from playledger import session
from playledger.operators import lookup as L
from playledger.plans import daily, gold as G, q_jobs, world as W
from playledger.plans.catalog import load_all
from tests.conftest import SF_SMALL
from tests.test_plans import plan_text, scans


def _query(spark, name):
    return load_all()[name][0](spark, SF_SMALL)


def _same(a, b):
    b = b.select(*a.columns)
    return a.count() == b.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _reads(df, table):
    return any(f"/{table}.parquet" in f for f in df.inputFiles())


def test_unread_columns_are_not_dealt_out(spark):
    """The hash that deals out rows without a key is made before the exchange; unread columns don't pass it."""
    rows = spark.range(100).selectExpr("id", "IF(id % 2 = 0, id, NULL) AS k", "repeat('x', 100) AS wide").checkpoint()
    dim = spark.range(100).selectExpr("id AS k", "id * 2 AS v").checkpoint()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (L.lookup_join(rows, dim, "k", ["v"]), L.overlap_join(rows, dim, "k"), L.lookup_join(rows, dim, "k", ["v"], spread=["id"])):
            got = out.select("id", "v")
            above = got._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter")[0]
            assert "wide" not in above and "Join LeftOuter" in got._jdf.queryExecution().optimizedPlan().toString()
            left = plan_text(got).split("Exchange hashpartitioning(k#")[1].split("\n")[1]
            assert "Project" in left and ", wide#" not in left.split("CASE")[0] and L.SPREAD in left, left
            assert sorted((r.id, r.v) for r in got.collect()) == [(i, 2 * i if i % 2 == 0 else None) for i in range(100)]
            assert L.SPREAD not in out.columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_details_of_lines_are_made_where_they_are_read(spark):
    """of the campaigns' lines the play fact reads two ids, and the campaigns none of the details."""
    assert "from_json" not in plan_text(q_jobs.campaigns(spark, SF_SMALL).select("line_item_id", "campaign_id"))
    assert "from_json" not in plan_text(_query(spark, "job_dim_campaign"))


@pytest.mark.parametrize("name", ["job_fact_play_logs", "job_dim_campaign", "job_dim_line_item", "job_campaign_full", "job_campaign_full_check"])
def test_lines_are_grouped_once(spark, name):
    """The last plan reads stored steps, not the plays' table again."""
    assert not _reads(_query(spark, name), "lineitem")


def test_coverage_reads_the_lines_once(spark, monkeypatch):
    """12 scans of the plays' table before, over all steps."""
    n, _ = scans(spark, monkeypatch, "job_coverage_report", "lineitem")
    assert n <= 3, n


def test_plays_are_dealt_out_once_for_the_fact(spark):
    """the flag comes with the reservation; of an override, with the override's campaign."""
    plays = spark.createDataFrame([("d", 11, 1), ("d", 12, 1), ("d", 13, 2), ("d", 14, 2), ("d", None, 3), ("d", 15, 3)],
                                  "DateEnd string, CampID bigint, PlayerID bigint")
    res_map = spark.createDataFrame([(11, 110, 1), (12, 120, 2), (13, None, None)], "reservation_id bigint, line_item_id bigint, campaign_id bigint")
    single = spark.createDataFrame([(2,), (2,), (7,), (None,)], "campaign_id bigint")
    over = spark.createDataFrame([(13, 130, 7), (14, 140, 7), (14, 141, 8), (11, 999, 7)], "reservation_id bigint, line_item_id bigint, campaign_id bigint")
    cfg = {"service_campaign_ids": [], "service_reservation_ids": [], "service_line_item_ids": [], "reservation_overrides": []}
    got = G.build_fact_play_logs(plays, res_map, single, cfg, overrides=over)
    want = [(11, 110, 1, 0), (12, 120, 2, 2), (13, 130, 7, 2), (14, 141, 8, 0), (15, None, None, 0), (None, None, None, 0)]
    rows = [(r.reservation_id, r.line_item_id, r.campaign_id, r.is_serwisowy) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(want, key=str)
    # the outermost join, which has the plays on its left, was by campaign
    assert got._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter, ((")[1].startswith("reservation_id")


def test_campaign_lines_joined_in_parts(spark):
    """F8: part by part, each a stored step, the same rows; lines and reservations without an id among them."""
    d = dt.datetime(2024, 1, 1)
    lines = [(i if i % 4 else None, i // 3, f"n{i}", 10.0 * i, 25.0, d, d, f"c{i // 3}") for i in range(40)]
    lines += [lines[5], lines[0], (None, None, None, None, None, None, None, None)]
    camps = spark.createDataFrame(lines, "line_item_id bigint, campaign_id bigint, line_item_name string, line_price double, "
                                         "campaign_price double, line_start timestamp, line_end timestamp, campaign_name string")
    res22 = spark.createDataFrame([(100 + i, i % 30 if i % 7 else None, "booked") for i in range(60)], "id bigint, proposal_line_item_id bigint, booking_state string")
    res = spark.createDataFrame([(100 + i, f"r{i}") for i in range(0, 60, 2)], "id bigint, name string")
    full = G.reservations_full(res22, res)
    whole = G.build_campaign_full(camps, res22, res)
    assert _same(G.build_campaign_full(camps, None, None, full=full), whole)
    parts = G.build_campaign_full(camps, None, None, full=full, parts=3)
    assert _same(parts, whole) and whole.where("line_item_id IS NULL").count() > 10
    assert "Join" not in parts._jdf.queryExecution().optimizedPlan().toString()


def test_steps_go_when_their_readers_are_done(spark, monkeypatch):
    """the enriched plays are a step until the play fact is stored; store_alone keeps what is returned only."""
    made, plain = [], session.store

    def noting(df, *a, **kw):
        out = plain(df, *a, **kw)
        made.append((out.columns, out.step_path.removeprefix("file:")))
        return out

    monkeypatch.setattr(session, "store", noting)
    fact = daily.build_gold(spark, W.bronze_tables(spark, SF_SMALL), q_jobs.DAILY_CFG)["fact_play_logs"]
    gone = [set(c) for c, p in made if not os.path.exists(p)]
    assert len(gone) == 1 and {"reservation_name", "proposal_name"} <= gone[0] and fact.count() > 0
    made.clear()
    (kept,) = session.store_alone(spark, lambda: [session.cut_lineage(spark.range(9)).selectExpr("id + 1 AS a")])
    assert [os.path.exists(p) for _, p in made] == [False, True] and kept.agg(F.sum("a")).first()[0] == 45
    with session.scratch_scope(spark):
        session.store_alone(spark, lambda: [spark.range(1)])
    assert not os.path.exists(made[-1][1])


def test_day_rows_are_counted_twice_not_three_times(spark):
    """a day row goes to its line's mask and to its day's sum; lines and campaigns are told apart after that."""
    p = plan_text(_query(spark, "panel_day_health_from_days"))
    first = next(x for x in p.split("Generate explode(")[::-1] if x.startswith("array(struct("))  # the innermost explode of structs
    assert first.split(")")[0].count("line_item_id") == 1 and "CASE" not in first.split("\n")[0] and "struct(kind" not in first.split("\n")[0]
