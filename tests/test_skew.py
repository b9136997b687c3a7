"""Hot keys: one reservation / player holding a third of all plays.  Results are checked against pandas,
and the plans must combine map-side (partial aggregates before the shuffle), never gather a group."""
from pyspark.sql import functions as F

from playledger.operators.rollup import dedup, hourly_rollup
from playledger.plans.budget import reservation_players
from playledger.plans import analogs as A
from tests.conftest import SF_SMALL


def skewed_plays(spark):
    pl = A.play_log(spark, SF_SMALL)
    hot = F.col("event_id") % 3 == 0                       # a third of all rows on one key
    return pl.withColumn("CampID", F.when(hot, F.lit(4242)).otherwise(F.col("CampID"))) \
             .withColumn("PlayerID", F.when(hot, F.lit(7)).otherwise(F.col("PlayerID")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hourly_rollup_hot_key(spark):
    pl = skewed_plays(spark)
    out = hourly_rollup(pl, ["PlayerID", "CampID"], sums={"Duration": "Duration"}, scale=None)
    p = plan(out)
    assert "partial_sum" in p and "partial_count" in p
    pdf = pl.toPandas()
    pdf["DateEnd"] = pdf["DateEndTime"].dt.strftime("%Y-%m-%d")
    pdf["timeslot"] = pdf["DateEndTime"].dt.hour
    want = pdf.groupby(["DateEnd", "timeslot", "PlayerID", "CampID"], dropna=False).size()
    got = out.select("DateEnd", "timeslot", "PlayerID", "CampID", "emisje").toPandas()
    assert len(got) == len(want) and int(got["emisje"].sum()) == int(want.sum())


def test_dedup_hot_key_combines_map_side(spark):
    pl = skewed_plays(spark).select("CampID", "event_id", "Duration")
    out = dedup(pl, ["CampID"], order=["event_id"], keep="last")
    assert "partial_max_by" in plan(out) and "Window" not in plan(out)
    pdf = pl.toPandas().sort_values("event_id").groupby("CampID", dropna=False).tail(1)
    got = {r.CampID: r.event_id for r in out.collect()}
    assert got == dict(zip(pdf["CampID"], pdf["event_id"]))


def test_reservation_players_hot_key(spark):
    pl = skewed_plays(spark)
    out = reservation_players(pl)
    p = plan(out)
    assert "collect_set" not in p and "collect_list" not in p
    hot = out.where(F.col("reservation_id") == 4242).collect()
    assert len(hot) >= 1 and {r.n_logged for r in hot} == {len(hot)}


def test_budget_plan_has_no_gathered_groups(spark):
    from playledger.plans import q_core
    p = plan(q_core.budget(spark, SF_SMALL))
    assert "collect_set" not in p and "collect_list" not in p and "CartesianProduct" not in p


def _spread(spark, df, parts=50):
    """The share of the fullest partition when nothing is planned anew at run time."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        out = df()  # all columns are asked for, so that no join is left out
        counts = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), *map(F.max, out.columns)).collect()]
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    return max(counts) / sum(counts), sum(counts)


def test_rows_without_a_key_are_spread(spark):
    from playledger.operators import lookup as L
    dim = spark.range(1000).selectExpr("id AS k", "id * 2 AS v")
    rows = spark.range(40_000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN id % 1000 END AS k")
    for join in (lambda: L.lookup_join(rows, dim, "k", ["v"]), lambda: L.overlap_join(rows, dim, "k"),
                 lambda: L.override_where_null(rows.withColumn("v", F.lit(None).cast("bigint")), "k", dim, ["v"])):
        share, n = _spread(spark, join)
        assert n == 40_000 and share < 0.05


def test_budget_lines_without_a_reservation_are_spread(spark):
    from playledger.plans.budget import budget_intervals
    lines = spark.range(40_000).selectExpr(
        "id % 900 AS campaign_id", "id AS line_item_id", "CASE WHEN id % 2 = 0 THEN id END AS reservation_id", "concat('LL_', id) AS line_item_name",
        "100.0D AS line_price", "1.0D AS perf_expected_repetitions", "1.0D AS perf_actual_repetitions", "10.0D AS slot_duration",
        "DATE '2025-02-01' AS line_start", "DATE '2025-02-03' AS line_end", "3L AS line_days", "1L AS screen_count")
    logs = spark.range(20_000).selectExpr("id * 2 AS CampID", "id % 300 AS PlayerID")
    players = spark.range(300).selectExpr("id AS play_log_player_id", "'liveline x' AS player_name")
    share, n = _spread(spark, lambda: budget_intervals(lines, logs, players))
    assert n == 40_000 and share < 0.05


def test_relations_in_one_pass(spark):
    from playledger.operators.quality import Relation, coverage, relation_coverage
    fact = spark.createDataFrame([(1, 5, 2), (1, None, 1), (2, 6, 1), (None, 7, 3), (None, None, 1)], "a bigint, b bigint, days bigint")
    dim, none = spark.createDataFrame([(1,), (1,), (9,), (None,)], "id bigint"), spark.createDataFrame([], "id bigint")
    rel = [Relation("a", "fact", "a", "dim", "id"), Relation("b", "fact", "b", "fact", "a"), Relation("none", "none", "id", "dim", "id"),
           Relation("to none", "fact", "a", "none", "id")]
    plain = {r.label: r for r in relation_coverage({"fact": (fact, None), "dim": (dim, None), "none": (none, None)}, rel).collect()}
    for label, left, right, lk, rk in (("a", fact, dim, "a", "id"), ("b", fact, fact, "b", "a"), ("none", none, dim, "id", "id"), ("to none", fact, none, "a", "id")):
        want = coverage(left, right, lk, rk, label).first()
        assert tuple(plain[label])[:6] == tuple(want)
    assert (plain["a"].null_rows, plain["a"].null_pct, plain["none"].null_rows) == (2, 40.0, 0)
    days = relation_coverage({"fact": (fact, F.col("days")), "dim": (dim, None)}, rel[:1]).first()
    assert (days.left_rows, days.matched, days.null_rows) == (4, 3, 4)
