"""Raw formats: play-log TSV, dictionary TSV, dated archive, paged JSON, run log."""
import os
import tempfile

from pyspark.sql import functions as F

from playledger.plans.runlog import last_run, parse_run_log
from playledger.sources import readers as RD


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_play_log_cases(spark):
    d = tempfile.mkdtemp(prefix="pl-test-")
    ok = "\t".join(["5", "2026-05-26 10:15:00", "30", "7", "x", "100", "3", "4", "2", "a", "b", "c", '{"contract_id" : "K-1"}'])
    short = "\t".join(["6", "2026-05-26 11:00:00", "15", "8"])
    long_ = ok + "\textra"
    bad_num = "\t".join(["x", "2026-05-26 12:00:00", "abc", "7", "x", "0", "3", "4", "1", "a", "b", "c", "{}"])
    bad_ts = "\t".join(["5", "not a time", "10", "7", "x", "100", "3", "4", "1", "a", "b", "c", '{"k": 1}'])
    write(d, "playlog-2026-05-26.txt", "\n".join([ok, short, long_, bad_num, "", bad_ts]) + "\n")
    rows = sorted(RD.read_play_log(spark, d).collect(), key=lambda r: (r.Duration is None, r.Duration or 0))
    assert len(rows) == 4                                    # 14-field and blank lines skipped
    full = [r for r in rows if r.contract_id == "K-1"][0]
    assert (full.PlayerID, full.CampID, full.Impresje, full.DateEndTime.hour) == (5, 100, 2, 10)
    assert str(full.file_date) == "2026-05-26"
    s = [r for r in rows if r.PlayerID == 6][0]
    assert s.CampID is None and s.contract_id is None       # short line padded with NULLs
    b = [r for r in rows if r.PlayerID is None][0]
    assert b.Duration is None and b.CampID == 0
    assert [r for r in rows if r.DateEndTime is None][0].Impresje == 1


def test_dictionary_cases(spark):
    d = tempfile.mkdtemp(prefix="dict-test-")
    write(d, "resources-2026-06-01.txt", "1\tScreen A\t1\tdisplay_unit\n2\tB\t1\n x3\tC\t1\tcontent\n\n4\tD\t1\tbanner\n 5 \t E \t1\t host \n")
    ok, rej = RD.read_dictionary(spark, d)
    assert sorted((r.id, r.name, r.type) for r in ok.collect()) == [("1", "Screen A", "display_unit"), ("5", "E", "host")]
    assert sorted(r.reason for r in rej.collect()) == ["fields", "id"]


def test_archive_newest_wins(spark):
    d = tempfile.mkdtemp(prefix="arch-test-")
    write(d, "resources-2026-06-02.txt", "1\tnew\t1\tcontent\n")
    write(d, "resources-2026-06-01.txt", "1\told\t1\tcontent\n2\tonly\t1\tskin\n")
    write(d, "readme.txt", "9\tignored\t1\tcontent\n")
    got = sorted((r.id, r.name, str(r.file_date)) for r in RD.read_dictionary_archive(spark, d).collect())
    assert got == [("1", "new", "2026-06-02"), ("2", "only", "2026-06-01")]


def test_paged_json_envelopes(spark):
    d = tempfile.mkdtemp(prefix="json-test-")
    write(d, "p.json", "\n".join([
        '{"total": 2, "data": [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}]}',
        '{"total_rows": 1, "proposal_items": [{"id": 3, "name": "c"}]}',
        '{"total": 1, "data": {"proposal_items": [{"id": 4, "name": "d"}]}}',
        '{"d": {"__count": 1, "results": [{"id": 5, "name": "e"}]}}',
        '{"reservation": [{"id": 6, "name": "f"}], "not_modified_since": "x"}']) + "\n")
    got = sorted(r.id for r in RD.read_paged_json(spark, d, "id bigint, name string").collect())
    assert got == [1, 2, 3, 4, 5, 6]


def test_run_log_last_section(spark):
    text = ["==== 2026-06-01 09:30:00 START ====", "  OK   a", "  FAIL b: boom", "==== 2026-06-01 09:36:00 DONE ====",
            "==== 2026-06-02 09:30:00 START ====", "  OK   a", "  OK   b", "  FAIL c: x", "==== 2026-06-02 09:35:00 DONE ===="]
    df = spark.createDataFrame([("log1", i, t) for i, t in enumerate(text)], "log string, line_no long, value string")
    p = parse_run_log(df)
    r = last_run(p, "log", ["line_no"], F.col("kind") == "start", F.col("kind") == "ok", F.col("kind") == "fail").first()
    assert (r.run_no, r.n_ok, r.n_fail, r.n_lines) == (2, 2, 1, 5)
    done = p.where("kind = 'done'").agg(F.max("marker_ts")).first()[0]
    assert done.hour == 9 and done.minute == 35


def test_run_log_facts_counters_and_unfinished_run(spark):
    from playledger.plans.runlog import run_log_facts
    text = {"a": ["==== 2026-06-01 09:30:00 START ====", "[upsert_date] 2026-05-31: 1 200 wierszy -> lacznie 13 270 307 w play_logs",
                  "  Kampanie: 41", "OK step1", "==== 2026-06-01 09:36:00 DONE ====",
                  "==== 2026-06-02 09:30:00 START ====", "  OK   a", "  FAIL b: boom",
                  "[upsert_date] 2026-06-01: 900 wierszy -> lacznie 13 271 207 w play_logs",
                  "[upsert_date] 2026-06-01: 5 wierszy -> lacznie 13 271 212 w play_logs",
                  "==== 2026-06-02 09:35:00 DONE ===="],
            "b": ["==== 2026-06-01 09:30:00 START ====", "  OK   a", "==== 2026-06-01 09:31:00 DONE ====",
                  "==== 2026-06-02 09:30:00 START ====", "  OK   a"]}
    rows = [(log, i, t) for log, ls in text.items() for i, t in enumerate(ls)]
    df = spark.createDataFrame(rows, "log string, line_no long, value string")
    got = {r.log: r for r in run_log_facts(parse_run_log(df)).collect()}
    a, b = got["a"], got["b"]
    assert (a.run_no, a.n_ok, a.n_fail, a.rows_added, a.rows_total, a.campaigns) == (2, 1, 1, 900, 13271207, None)
    assert a.done_at.day == 2 and a.done_at.minute == 35 and a.last_good.minute == 35
    assert (b.run_no, b.n_ok, b.done_at) == (2, 1, None) and b.last_good.minute == 31   # unfinished: last good DONE


def test_polymorphic_envelope_order(spark):
    d = tempfile.mkdtemp(prefix="poly-test-")
    write(d, "p.json", "\n".join([
        '[{"id": 1}]',                                              # top-level array
        '{"items": {"list": [{"id": 2}]}, "data": [{"id": 99}]}',   # items wins over data
        '{"items": "x", "deviceListBaseBean": {"contents": [{"id": 3}]}}',
        '{"meta": 1, "data": {"contents": [{"id": 4}]}}',
        '{"nothing": []}']) + "\n")
    got = sorted(r.id for r in RD.read_paged_json(spark, d, "id bigint", paths=RD.POLYMORPHIC_PATHS).collect())
    assert got == [1, 2, 3, 4]


def test_control_sync_overwrite_and_incremental(spark):
    from playledger.plans.ingest import sync_control_table
    from playledger.session import scratch_path
    from playledger.sources import sinks as SK
    schema = "id bigint, name string, modified timestamp"
    full, tbl, cur = tempfile.mkdtemp(prefix="ctl-"), scratch_path(spark, "ctl-du"), scratch_path(spark, "ctl-cur")
    write(full, "p1.json", '{"display_unit": [{"id": 1, "name": "a", "modified": "2024-01-01 00:00:00"}], "not_modified_since": "x"}\n')
    sync_control_table(spark, "display_units", full, schema, tbl, cur)
    empty = tempfile.mkdtemp(prefix="ctl-empty-")
    write(empty, "p1.json", '{"display_unit": [], "not_modified_since": "x"}\n')
    sync_control_table(spark, "display_units", empty, schema, tbl, cur)          # empty refetch never replaces data
    assert [r.id for r in spark.read.parquet(tbl).collect()] == [1]
    inc_tbl, inc_cur = scratch_path(spark, "ctl-res"), scratch_path(spark, "ctl-rcur")
    a, b = tempfile.mkdtemp(prefix="ctl-a-"), tempfile.mkdtemp(prefix="ctl-b-")
    write(a, "p.json", '{"reservation": [{"id": 1, "name": "a", "modified": "2024-01-01 00:00:00"},'
                       ' {"id": 2, "name": "b", "modified": "2024-01-02 00:00:00"}]}\n')
    write(b, "p.json", '{"reservation": [{"id": 1, "name": "OLD", "modified": "2024-01-01 00:00:00"},'
                       ' {"id": 2, "name": "B2", "modified": "2024-01-03 00:00:00"}]}\n')
    sync_control_table(spark, "reservations", a, schema, inc_tbl, inc_cur)
    sync_control_table(spark, "reservations", b, schema, inc_tbl, inc_cur)       # only id 2 changed after the cursor
    got = {r.id: r.name for r in SK.read_upserted(spark, inc_tbl).collect()}
    assert got == {1: "a", 2: "B2"}


def test_tsv_export_round_trip(spark):
    from playledger.session import scratch_path
    from playledger.sources import sinks as SK
    df = spark.createDataFrame([(1, "a b", 2.5), (2, None, None)], "id long, name string, v double")
    path = scratch_path(spark, "tsv-export")
    SK.export_csv(df, path, sep="\t")
    back = spark.read.option("header", True).option("sep", "\t").schema("id long, name string, v double").csv(path)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == [(1, "a b", 2.5), (2, None, None)]
