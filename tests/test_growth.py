"""What grows with the input: shuffled rows, files, scans, and the results that the cheaper plans must keep."""
import datetime as dt

from pyspark.sql import functions as F

from playledger.plans.budget import BLOCK, explode_days, split_blocks
from playledger.plans.catalog import load_all
from playledger.plans.health import build_fact_health, build_fact_health_from_intervals
from tests.conftest import SF_SMALL
from tests.test_plans import plan_text


def _query(spark, name):
    return load_all()[name][0](spark, SF_SMALL)


def _intervals(spark):
    """Flights over several blocks, a line booked twice, a campaign with a gap, ids and measures missing."""
    d = dt.date
    rows = [(1, 10, 100, 7, d(1999, 12, 20), d(2000, 5, 3), 1.25), (1, 10, 101, 7, d(2000, 1, 15), d(2000, 2, 1), 0.5),
            (1, 11, 102, 7, d(2000, 4, 1), d(2000, 4, 2), 2.0), (2, 12, 103, 7, d(2000, 1, 1), d(2000, 1, 1), None),
            (None, 13, 104, 8, d(2000, 1, 5), d(2000, 1, 9), 3.0), (2, None, 105, 8, d(2000, 1, 7), d(2000, 6, 1), 4.0),
            (2, 12, 103, 8, d(2000, 3, 1), d(2000, 3, 3), 1.0), (2, 12, 103, 8, d(2000, 3, 1), d(2000, 3, 3), 1.0),
            (2, 14, 106, None, d(2000, 1, 1), d(2000, 3, 3), 1.0)]
    df = spark.createDataFrame(rows, "campaign_id bigint, line_item_id bigint, reservation_id bigint, play_log_player_id bigint,"
                                     " d0 date, d1 date, daily_expected_repetitions double")
    rest = ["daily_cost_line", "daily_actual_repetitions", "duration_expected_sec", "duration_actual_sec"]
    return df.withColumns({c: F.lit(1.0) for c in rest} | {c: F.lit(1).cast("bigint") for c in ("n_days", "n_players")})


def _by_hand(intervals, logs, lo, hi):
    days, act = {}, {}
    for c, li, _, p, a, b, e, *_ in intervals:
        while p is not None and a <= b:
            if lo <= a <= hi:
                k = days.setdefault((a.isoformat(), p), [set(), set(), 0.0])
                k[0].add(c), k[1].add(li)
                k[2] += e or 0.0
            a += dt.timedelta(1)
    for day, p, n in logs:
        act[day, p] = act.get((day, p), 0.0) + (n or 0.0)
    return sorted((*k, len(c - {None}), len(li - {None}), round(e, 2), act.get(k, 0.0), act.get(k, 0.0) > 0)
                  for k, (c, li, e) in days.items())


def test_health_by_blocks_of_days(spark):
    """the three ways to the health fact agree with a count by hand."""
    iv = _intervals(spark)
    logs = [("1999-11-01", 7, 1.0), ("2000-01-20", 7, 2.0), ("2000-01-20", 7, 3.0), ("2000-03-02", 8, None), ("2000-05-20", 9, 1.0),
            ("2000-05-21", None, 1.0), (None, 7, 1.0)]
    facts = spark.createDataFrame(logs, "date_key string, play_log_player_id bigint, Impresje double")
    want = _by_hand(iv.collect(), [x for x in logs if None not in x[:2]], dt.date(1999, 12, 31), dt.date(2000, 5, 20))
    dealt = explode_days(split_blocks(iv).repartition("play_log_player_id", BLOCK))
    for got in (build_fact_health_from_intervals(facts, iv), build_fact_health(facts, explode_days(iv)), build_fact_health(facts, dealt)):
        assert sorted(tuple(r)[:7] for r in got.collect()) == want
    assert explode_days(iv).exceptAll(dealt.drop(BLOCK)).count() == 0 == dealt.drop(BLOCK).exceptAll(explode_days(iv)).count()


def test_day_rows_of_the_health_fact_are_not_shuffled(spark):
    """the days are made after the exchange by panel and block, and the plan side has no other one."""
    for name, made in (("panel_day_health", "Generate explode(sequence(d0"), ("panel_day_health_from_days", "Generate explode(slice(")):
        p = plan_text(_query(spark, name))
        side = p[p.index(made):p.index("REPARTITION_BY_COL")]
        assert side.count("Exchange") == 1, p


def test_tagged_run_logs_share_a_file(spark, tmp_path):
    """F8: many logs in one file, told apart by the name before the tab; numbers ascend within each log."""
    from playledger.sources.readers import read_run_log
    (tmp_path / "part").write_text("7\tone\n\n8\ta\tb\n7\ttwo\n8\t\n")
    got = sorted((r.log, r.line_no, r.value) for r in read_run_log(spark, str(tmp_path), tagged=True).collect())
    assert got == [("7", 0, "one"), ("7", 3, "two"), ("8", 2, "a\tb")]
