"""Refresh strategies: idempotency (applying a batch twice equals once) and their specific rules."""
from hypothesis import given, settings
from hypothesis import strategies as st

from playledger.operators import merge as M

ROW = st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from([None, "2024-01-01", "2024-01-02", "2024-01-03"]),
                st.integers(0, 9))
SCHEMA = "id long, day string, v long"


def rows(df):
    return sorted((tuple(r) for r in df.select("id", "day", "v").collect()), key=str)


@settings(max_examples=10, deadline=None)
@given(st.lists(ROW, max_size=8), st.lists(ROW, max_size=8))
def test_idempotent(spark, old_rows, new_rows):
    old = spark.createDataFrame(old_rows, SCHEMA)
    new = spark.createDataFrame(new_rows, SCHEMA)
    once = M.upsert(old, new, "id", order=["v", "day"])
    assert rows(M.upsert(once, new, "id", order=["v", "day"])) == rows(once)
    once = M.add_only(old, new, "id")
    assert rows(M.add_only(once, new, "id")) == rows(once)
    once = M.replace_dates(old, new, "day")
    assert rows(M.replace_dates(once, new, "day")) == rows(once)
    once = M.reaggregate_union(old, new, ["id", "day"], ["v"], "day")
    assert rows(M.reaggregate_union(once, new, ["id", "day"], ["v"], "day")) == rows(once)
    once = M.append_new(old, new, "day")
    assert rows(M.append_new(once, new, "day")) == rows(once)


def test_upsert_keeps_last_and_untouched(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "a", 1)], SCHEMA)
    new = spark.createDataFrame([(2, "b", 5), (2, "c", 7), (3, "c", 0)], SCHEMA)
    assert rows(M.upsert(old, new, "id", order=["v"])) == [(1, "a", 1), (2, "c", 7), (3, "c", 0)]
    empty = new.where("false")
    assert rows(M.upsert(old, empty, "id")) == rows(old)
    assert rows(M.overwrite_guarded(old, empty)) == rows(old)


def test_replace_day_with_spill(spark):
    old = spark.createDataFrame([(1, "2024-01-01", 1), (2, "2024-01-02", 1)], SCHEMA)
    new = spark.createDataFrame([(3, "2024-01-01", 9), (4, "2024-01-02", 9)], SCHEMA)   # file of 01-01 spilling into 01-02
    got = rows(M.replace_dates(old, new, "day", dates=["2024-01-01"]))
    assert got == [(2, "2024-01-02", 1), (3, "2024-01-01", 9), (4, "2024-01-02", 9)]


def test_latest_per_key_and_reaggregate(spark):
    old = spark.createDataFrame([(1, "f1", "2024-01-01", "a"), (2, "f2", "2024-01-02", "b")], "id long, src string, fd string, name string")
    new = spark.createDataFrame([(1, "f2", "2024-01-02", "A")], "id long, src string, fd string, name string")
    got = sorted(tuple(r) for r in M.latest_per_key(old, new, "id", "fd", "src").select("id", "name").collect())
    assert got == [(1, "A")]          # f2's old rows are replaced by the new delivery of f2; id 1 takes the newer date
    o = spark.createDataFrame([(1, "d1", 2), (1, "d2", 3)], "k long, day string, n long")
    n = spark.createDataFrame([(1, "d2", 10)], "k long, day string, n long")
    agg = {r.k: r.n for r in M.reaggregate_union(o, n, ["k"], ["n"], "day").collect()}
    assert agg == {1: 12}


def test_changed_files_and_cursor(spark):
    listing = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "file string, size long")
    manifest = spark.createDataFrame([("a", 1), ("b", 5)], "file string, size long")
    got = {r.file: r.status for r in M.changed_files(listing, manifest).collect()}
    assert got == {"a": "skip", "b": "update", "c": "new"}
    df = spark.createDataFrame([(1, 5), (2, 10), (3, 4), (4, None)], "id long, m long")
    rows_, nxt = M.since_cursor(df, "m", 5)
    # rows of the cursor's own instant and rows without a time come again
    assert sorted(r.id for r in rows_.collect()) == [1, 2, 4] and nxt.first().cursor == 10


def test_shrink_guard(spark):
    old = spark.range(100)
    assert not M.shrink_check(old, spark.range(50)).first().ok
    assert M.shrink_check(old, spark.range(95)).first().ok
    assert M.shrink_check(old, spark.range(50), force=True).first().ok


def test_bucketed_upsert_touches_only_its_buckets(spark):
    import os
    from playledger.session import scratch_path
    from playledger.sources import sinks as SK
    path = scratch_path(spark, "upsert-test").replace("file:", "")
    base = spark.range(200).selectExpr("id", "cast(id * 10 as bigint) as v")
    SK.write_upsert(spark, base, path, ["id"], buckets=8)

    def files():
        return {d: sorted(os.listdir(os.path.join(path, d))) for d in os.listdir(path) if d.startswith("__bucket=")}

    before = files()
    batch = spark.createDataFrame([(5, -1), (500, -2)], "id long, v long")
    SK.write_upsert(spark, batch, path, ["id"], buckets=8)
    after = files()
    changed = {d for d in before if before[d] != after.get(d)}
    assert 1 <= len(changed) <= 2                       # only the buckets of keys 5 and 500 were rewritten
    SK.write_upsert(spark, batch, path, ["id"], buckets=8)   # idempotent
    got = {r.id: r.v for r in SK.read_upserted(spark, path).collect()}
    assert len(got) == 201 and got[5] == -1 and got[500] == -2 and got[6] == 60


def test_write_replace_days_spill_and_untouched(spark):
    import os
    import pytest
    from playledger.session import scratch_path
    from playledger.sources import readers as RD
    from playledger.sources import sinks as SK
    path = scratch_path(spark, "days-test").replace("file:", "")
    schema = "id long, v long, day string"
    SK.write_replace_days(spark, spark.createDataFrame([(1, 1, "2024-01-01"), (2, 1, "2024-01-02"), (3, 1, "2024-01-03")], schema),
                          path, "day")
    before = sorted(os.listdir(os.path.join(path, "day=2024-01-03")))
    # the file of 01-01 (replaces that day) spilled one row into 01-02 (appended beside the day's rows)
    batch = spark.createDataFrame([(10, 2, "2024-01-01"), (11, 2, "2024-01-02")], schema)
    SK.write_replace_days(spark, batch, path, "day", dates=["2024-01-01"])
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(path).select("id", "v", "day").collect())
    assert got == [(2, 1, "2024-01-02"), (3, 1, "2024-01-03"), (10, 2, "2024-01-01"), (11, 2, "2024-01-02")]
    assert sorted(os.listdir(os.path.join(path, "day=2024-01-03"))) == before      # untouched partition not rewritten
    with pytest.raises(Exception):
        RD.read_layer(spark, path, "no_such_table").schema


def test_replace_with_guard_and_snapshot(spark):
    from playledger.session import scratch_path
    from playledger.sources import sinks as SK
    path = scratch_path(spark, "guard-test")
    assert SK.replace_with_guard(spark, spark.range(100), path)
    assert not SK.replace_with_guard(spark, spark.range(50), path)                 # shrank below 90 %: refused
    assert spark.read.parquet(path).count() == 100
    assert SK.replace_with_guard(spark, spark.range(50), path, force=True, snapshot_date="2024-01-02")
    assert spark.read.parquet(path).count() == 50
    assert spark.read.parquet(f"{path}_snapshots").where("snapshot_date = '2024-01-02'").count() == 50


def test_reconcile_orphans(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,), (None,)], "rid long")
    known = spark.createDataFrame([(1, "a")], "id long, name string")
    source = spark.createDataFrame([(2, "b"), (9, "z")], "id long, name string")
    table, rec, missing = M.reconcile_orphans(facts, known, source, "id", fact_key="rid")
    assert sorted(tuple(r) for r in table.collect()) == [(1, "a"), (2, "b")]
    assert [r.id for r in rec.collect()] == [2] and [r.id for r in missing.collect()] == [3]


def test_add_only_checked(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c"), (3, "c2")], "id long, v string")
    merged, check = M.add_only_checked(old, new, "id")
    c = check.first()
    assert (c.old_rows, c.added, c.merged_rows, c.rows_ok, c.unique) == (2, 1, 3, True, True)
    assert sorted(tuple(r) for r in merged.collect()) == [(1, "a"), (2, "b"), (3, "c")]
    dup_old = spark.createDataFrame([(1, "a"), (1, "a2")], "id long, v string")
    assert not M.add_only_checked(dup_old, new, "id")[1].first().unique


DEDUP_ROW = st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 4)),
                      st.one_of(st.none(), st.sampled_from(["a", "b", "c"])))


def _dedup_model(rows, keep):
    """first: ascending, NULLs last, ties by the other columns; last: the reverse order (descending, NULLs first)."""
    def k(v):
        return (v is None, v if v is not None else 0)

    def sort_key(r):
        return (k(r[1]), k(r[2]))
    out = {}
    for r in sorted(rows, key=sort_key, reverse=(keep == "last")):
        out.setdefault(r[0], r)
    return sorted(out.values(), key=lambda r: (k(r[0]), k(r[1]), (r[2] is None, r[2] or "")))


@settings(max_examples=15, deadline=None)
@given(st.lists(DEDUP_ROW, min_size=1, max_size=25), st.sampled_from(["first", "last"]))
def test_dedup_matches_model(spark, rows, keep):
    from playledger.operators.rollup import dedup
    df = spark.createDataFrame(rows, "k long, o long, s string")
    got = [tuple(r) for r in dedup(df, ["k"], order=["o"], keep=keep).collect()]
    k = lambda v: (v is None, v if v is not None else 0)
    got = sorted(got, key=lambda r: (k(r[0]), k(r[1]), (r[2] is None, r[2] or "")))
    assert got == _dedup_model(rows, keep)
