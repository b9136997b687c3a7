"""Null/type rules of SURVEY §1.4 and the literal examples of FIXTURES.md §5."""
import datetime as dt

from pyspark.sql import functions as F

from playledger.functions import calendar as C
from playledger.functions import names as N
from playledger.functions import semantics as S


def one(spark, expr, schema="x string", rows=None):
    df = spark.createDataFrame(rows if rows is not None else [(None,)], schema)
    return [r[0] for r in df.select(expr.alias("r")).collect()]


def test_not_in_keeps_null(spark):
    got = one(spark, S.keep_not_in(F.col("x"), [1, 2]), "x long", [(1,), (3,), (None,)])
    assert got == [False, True, True]


def test_in_with_null_is_false(spark):
    assert one(spark, S.is_in(F.col("x"), [1]), "x long", [(1,), (None,)]) == [True, False]


def test_not_zero_keeps_null(spark):
    assert one(spark, S.not_zero("x"), "x long", [(0,), (5,), (None,)]) == [False, True, True]


def test_sum_of_all_null_is_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "k int, v double")
    assert df.groupBy("k").agg(S.sum0("v").alias("s")).first()["s"] == 0


def test_coercions(spark):
    assert one(spark, S.to_long("x"), rows=[("123.0",), ("1.5",), ("abc",), (None,)]) == [123, None, None, None]
    big = 2 ** 62 + 1                       # above 2**53: must not go through double
    assert one(spark, S.to_long("x"), "x long", [(big,)]) == [big]
    assert one(spark, S.to_long("x"), rows=[(str(big),)]) == [big]
    assert one(spark, S.to_long("x"), "x double", [(3.0,), (2.5,)]) == [3, None]
    assert one(spark, S.to_double("x"), rows=[("1.25",), ("x",)]) == [1.25, None]
    got = one(spark, S.to_ts("x"), rows=[("2026-05-26 10:00:00",), ("not a time",)])
    assert got[1] is None and got[0].hour == 10


def test_inclusive_days(spark):
    rows = [(dt.date(2024, 1, 1), dt.date(2024, 1, 1)), (dt.date(2024, 1, 5), dt.date(2024, 1, 1)),
            (dt.date(2024, 1, 1), dt.date(2024, 1, 10)), (None, dt.date(2024, 1, 1))]
    df = spark.createDataFrame(rows, "a date, b date")
    assert [r[0] for r in df.select(S.inclusive_days("a", "b")).collect()] == [1, 1, 10, None]


def test_round_half_up(spark):
    assert one(spark, S.round_half_up("x", 2), "x double", [(2.675,), (0.125,)]) == [2.68, 0.13]


def test_blank_to_null(spark):
    assert one(spark, S.blank_to_null("x"), "x long", [(0,), (4,)]) == [None, 4]


def test_slot_label(spark):
    assert one(spark, N.slot_label("x"), "x int", [(0,), (23,), (None,)]) == ["00:00-01:00", "23:00-00:00", None]


def test_file_date(spark):
    got = one(spark, N.file_date("x"), rows=[("playlog-2026-05-26.txt",), ("playlog-2026-05-22.txt.gz",), ("x",)])
    assert got == [dt.date(2026, 5, 26), dt.date(2026, 5, 22), None]


def test_location_examples(spark):
    cases = {
        "A01_Kabaty_TP05_południe": "Kabaty",
        "A10_TP_Pole_Mokotowskie_północ": "Pole Mokotowskie",
        "C13_DMB_Centrum_Nauk_Kopernik_cała_stacja": "Centrum Nauk Kopernik",
        "B18D | Plac Konstytucji | 123": "B18D",
        "B9D | Centrum | 456": "B9D",
        "X1 | Ulica Prosta 5 | 77": "Ulica Prosta 5",
        "Panel Centrum 2": "Centrum",
        "Solo": None,
        "C11_TP02": None,
        "Ekran WROCŁAW 1": "Wrocław",
        "LiveLine wagon": "Wagony",
    }
    got = one(spark, N.location("x"), rows=[(k,) for k in cases])
    assert dict(zip(cases, got)) == cases


def test_name_tokens_and_format(spark):
    cases = {"LL_kampania": "liveline", "StroerTV & LL": "BUNDLE", "21/07 DMB/STV/LL": "BUNDLE",
             "MetroMax lato": "BUNDLE", "DMB_x": None, "STV_abc": "stroertv"}
    got = one(spark, N.name_format(N.name_tokens("x")), rows=[(k,) for k in cases])
    assert dict(zip(cases, got)) == cases


def test_stable_factor_md5(spark):
    unit = one(spark, N.unit_hash("x"), "x long", [(7,)])[0]
    assert abs(unit - 2400511071 / 4294967295) < 1e-15
    f = one(spark, N.stable_factor("x"), "x long", [(7,)])[0]
    assert abs(f - (1 / 1.13 + unit * (1 / 1.01 - 1 / 1.13))) < 1e-15


def test_player_format_and_test_flag(spark):
    assert one(spark, N.player_format("x"), rows=[("LiveLine 3",), ("xStroerTV",), ("other",), (None,)]) == \
        ["liveline", "stroertv", None, None]
    df = spark.createDataFrame([("Teltronic_VPN_3", None), ("A", "biuro X"), ("A", "B"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(N.is_test("a", "b")).collect()] == [True, True, False, False]


def test_classify(spark):
    from playledger import config as K
    got = one(spark, N.classify("x", K.RESOLUTION_FORMAT, K.DEFAULT_FORMAT, normalize=True),
              rows=[("1920 x 540",), (" 1920 x 1080 ",), ("3840 x 2160",), ("1 x 1",), (None,)])
    assert got == ["liveline", "stroertv", "triplay", "other", "other"]


def test_calendar_iso(spark):
    df = spark.createDataFrame([(dt.date(2027, 1, 1),)], "d date")
    r = df.select(*C.calendar_columns("d")).first()
    assert (r["iso_year"], r["iso_week"], r["weekday_number"], r["year_week_index"]) == (2026, 53, 5, 202653)
    assert r["month_name"] == "Styczeń" and r["short_weekday"] == "Pt" and r["quarter"] == "Q1"


def test_calendar_complete(spark):
    from playledger.operators.expand import calendar, check_calendar
    chk = check_calendar(calendar(spark)).first()
    assert chk["complete"] and chk["n_days"] == 1095


def test_unpack_json_declared_and_discovered(spark):
    from playledger.functions.jsonfn import unpack_json
    df = spark.createDataFrame([(1, '{"a": 1, "b": {"c": "x"}}'), (2, '{"a": 2, "d": true}'), (3, "not json"), (4, None)],
                               "id int, j string")
    decl = {r.id: (r["j_a"], r["j_b.c"]) for r in unpack_json(df, "j", "a bigint, b struct<c: string>").collect()}
    assert decl == {1: (1, "x"), 2: (2, None), 3: (None, None), 4: (None, None)}
    found = unpack_json(df, "j")
    assert set(found.columns) == {"id", "j_a", "j_b.c", "j_d"}
    assert {r.id: r["j_d"] for r in found.collect()}[2] is True
    untouched = unpack_json(df.where("id >= 3"), "j")
    assert untouched.columns == ["id", "j"]
