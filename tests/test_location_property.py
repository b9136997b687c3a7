"""Property test of the location parser (F9) against a small Python model of the rule it implements."""
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from playledger import config as K
from playledger.functions.names import location

CODE = re.compile(K.LOCATION_CODE_PATTERN)
STOPS = set(K.LOCATION_STOP_WORDS)


def model(v):
    if v is None:
        return None
    for label, pattern, icase in K.LOCATION_PRIORITY:
        if re.search(pattern, v, re.IGNORECASE if icase else 0):
            return label
    if " | " in v:
        return v.split(" | ")[1].strip()
    if "_" in v:
        words, seen_name = [], False
        for part in v.split("_")[1:]:
            if not part:
                continue
            if part.lower() in STOPS:
                break
            if CODE.match(part):
                if seen_name:
                    break
                continue
            words.append(part)
            seen_name = True
        return " ".join(words) or None
    parts = v.split(" ")
    return parts[1] if len(parts) >= 2 else None


TOKENS = ["A01", "C13", "TP", "TP05", "DMB", "DMB03", "CD", "CA", "B12X", "Kabaty", "Pole", "Mokotowskie", "ONZ",
          "Centrum", "Nauk", "północ", "POŁUDNIE", "cała", "stacja", "wschód", "", "x7"]
names = st.one_of(
    st.lists(st.sampled_from(TOKENS), min_size=1, max_size=7).map("_".join),
    st.lists(st.sampled_from(["Panel", "Centrum", "Solo", "Plac", "Ulica 5", "ONZ"]), min_size=1, max_size=4).map(" ".join),
    st.tuples(st.sampled_from(["X1", "B9", "K2"]), st.sampled_from(["Plac Konstytucji", "Centrum ", " Prosta 5"]),
              st.sampled_from(["1", "77"])).map(" | ".join),
    st.sampled_from(["Ekran Kraków 2", "lotnisko_A01", "LiveLine_7", "B36D panel", None]),
)


@settings(max_examples=25, deadline=None)
@given(st.lists(names, min_size=1, max_size=30))
def test_location_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(location("v")).collect()]
    assert got == [model(v) for v in values]


def tokens_model(n):
    if n is None:
        return []
    n = n.lower()
    w = lambda t: re.search(r"(^|[_ /])" + t + r"([_ /]|$)", n) is not None
    out = []
    if "liveline" in n or w("ll"):
        out.append("LL")
    if "stroertv" in n or w("stv"):
        out.append("STV")
    if "metromax" in n:
        out.append("MM")
    if w("dmb"):
        out.append("DMB")
    if w("tp"):
        out.append("TP")
    return out


def format_model(toks):
    t = set(toks)
    if not t & {"LL", "STV", "MM"}:
        return None
    if "MM" in t or len(t) > 1:
        return "BUNDLE"
    return {"LL": "liveline", "STV": "stroertv"}[next(iter(t))]


NAME_PARTS = ["LL", "ll", "STV", "Stv", "MetroMax", "DMB", "TP", "tp2", "kampania", "21/07", "&", "LiveLine", "StroerTV",
              "wall", "x"]
line_names = st.one_of(st.none(), st.lists(st.sampled_from(NAME_PARTS), min_size=1, max_size=5).flatmap(
    lambda ws: st.sampled_from(["_", " ", "/"]).map(lambda sep: sep.join(ws))))


@settings(max_examples=25, deadline=None)
@given(st.lists(line_names, min_size=1, max_size=30))
def test_name_tokens_match_model(spark, values):
    from playledger.functions.names import name_format, name_tokens
    df = spark.createDataFrame([(v,) for v in values], "v string")
    t = name_tokens("v")
    got = [(list(r[0]), r[1]) for r in df.select(t, name_format(t)).collect()]
    assert got == [(tokens_model(v), format_model(tokens_model(v))) for v in values]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.dates(min_value=__import__("datetime").date(2000, 1, 1), max_value=__import__("datetime").date(2040, 12, 31)),
                min_size=1, max_size=40))
def test_calendar_matches_python(spark, days):
    from playledger.functions.calendar import calendar_columns
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(*calendar_columns("d")).collect()
    for d, r in zip(days, rows):
        y, w, wd = d.isocalendar()
        assert (r.iso_year, r.iso_week, r.weekday_number, r.year_week_index) == (y, w, wd, y * 100 + w)
        assert r.month_name == K.MONTH_FULL[d.month - 1] and r.short_weekday == K.WEEKDAY_SHORT[wd - 1]
        assert r.is_weekend == (wd >= 6) and r.quarter == f"Q{(d.month - 1) // 3 + 1}" and r.date_key == d.isoformat()


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=2 ** 62), min_size=1, max_size=40))
def test_stable_factor_matches_md5(spark, ids):
    import hashlib
    from playledger.functions.names import stable_factor
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = [r[0] for r in df.select(stable_factor("id")).collect()]
    for i, g in zip(ids, got):
        unit = int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) / 0xFFFFFFFF
        assert abs(g - (K.EXP_FACTOR_LOW + unit * (K.EXP_FACTOR_HIGH - K.EXP_FACTOR_LOW))) < 1e-12
