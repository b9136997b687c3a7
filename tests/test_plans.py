"""Physical-plan checks: no Python UDF anywhere, no Cartesian product, filters reach the scan,
projections are pruned, and the entry point runs."""
import pytest

from playledger.plans.catalog import load_all
from tests.conftest import SF_SMALL

SIDE_EFFECT = {"play_log_tsv", "dictionary_tsv", "dictionary_rejects", "dictionary_archive", "csv_bootstrap", "json_pages",
               "run_log_text", "stream_hourly", "stream_replace_day", "stream_upsert", "job_ingest_play_logs",
               "job_control_sync", "content_meta", "job_resources_latest", "dictionary_latest_file",
               "csv_bootstrap_guarded", "upsert_null_keys", "upsert_missing_column", "replace_day_null_day",
               "full_rebuild_drops_days", "ingest_spill", "job_pop_month", "dictionary_two_columns", "item_export"}


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in load_all() if n not in SIDE_EFFECT))
def test_no_udf_no_cartesian(spark, name):
    fn, _ = load_all()[name]
    p = plan_text(fn(spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def executed(df):
    run = df._jdf.queryExecution()
    run.toRdd().count()
    final = run.executedPlan().toString()
    return final.split("== Initial Plan ==")[0]


def scans(spark, monkeypatch, name, table):
    """How often a query scans a given table, over all the steps that it stores and its last plan."""
    from playledger import session
    plans, plain = [], session.store

    def noting(df, *a, **kw):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, *a, **kw)

    monkeypatch.setattr(session, "store", noting)
    plans.append(executed(load_all()[name][0](spark, SF_SMALL)))
    return sum(p.count(f"{SF_SMALL}/{table}.parquet") for p in plans), len(plans)


def test_given_tables_are_scanned_for_stored_steps_only(spark, monkeypatch):
    """The play fact and the health fact read stored silver, not the raw tables again and again."""
    fact, steps = scans(spark, monkeypatch, "job_fact_play_logs", "lineitem")
    assert steps >= 4 and fact <= 10, fact
    health, steps = scans(spark, monkeypatch, "daily_fact_health", "lineitem")
    assert steps >= 6 and health <= 20, health


def test_reservation_map_stays_on_the_hash_path(spark):
    from playledger.plans.q_jobs import res_map
    assert "SortAggregate" not in executed(res_map(spark, SF_SMALL))


def test_pushdown_and_pruning(spark):
    fn, _ = load_all()["positive_only"]
    p = plan_text(fn(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_discount), GreaterThan(l_discount,0.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_discount:double>" in p


def test_bounded_dimension_is_broadcast(spark):
    fn, _ = load_all()["lookup_chain_fallback"]
    assert "BroadcastHashJoin" in plan_text(fn(spark, SF_SMALL))


def test_entry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_configure_for_scale(spark):
    from playledger.session import configure_for_scale
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert configure_for_scale(spark, 100 << 40, 8000) == (100 << 40) // (256 << 20) + 1    # 100 TB: ~410 k
        assert configure_for_scale(spark, 10 << 20, 8) == 16                                            # tiny input
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(256 << 20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
