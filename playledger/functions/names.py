"""Scalar text/number functions F4-F6, F9-F14, F16, F19, F20 as native Column expressions.

No Python UDF: every function composes built-ins (regex, arrays, higher-order lambdas), so the
expressions stay inside whole-stage codegen and run on the executors.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _str_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


# --- F4: hour slot label ---------------------------------------------------------------------

def slot_label(hour) -> Column:
    """``HH:00-HH:00`` (wrapping at midnight); NULL hour -> NULL (never ``null:00``)."""
    h = _c(hour)
    return F.when(h.isNotNull(), F.format_string("%02d:00-%02d:00", h, (h + 1) % 24))


# --- F5: quoted value of a key inside JSON-ish text --------------------------------------------

def json_text_field(c, key: str) -> Column:
    """Capture ``"key" : "value"`` from raw text; no match -> NULL."""
    return F.nullif(F.regexp_extract(_c(c), r'"' + key + r'"\s*:\s*"([^"]+)"', 1), F.lit(""))


def json_number_field(c, key: str) -> Column:
    """Capture ``"key" : 123`` (number, optionally quoted) from raw text as BIGINT; no match -> NULL."""
    raw = F.nullif(F.regexp_extract(_c(c), r'"' + key + r'"\s*:\s*"?(-?\d+)', 1), F.lit(""))
    return raw.try_cast("bigint")


# --- F6 / F19: dictionary classification -------------------------------------------------------

def classify(c, mapping: dict, default=None, normalize: bool = False) -> Column:
    """Look ``c`` up in a literal dictionary; unknown (or NULL) -> ``default``."""
    key = _c(c)
    if normalize:
        key = trim_lower(key)
    m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    out = F.try_element_at(m, key)
    return F.coalesce(out, F.lit(default)) if default is not None else out


def trim_lower(c) -> Column:
    return F.lower(F.trim(_c(c)))


# --- F9: location from a screen / display-unit name --------------------------------------------

def _in_lower(x: Column, words) -> Column:
    return F.lower(x).isin(list(words))


def location(c) -> Column:
    """Location label of a name.

    1. priority patterns (cities, formats) return their label;
    2. ``A | B | C``  -> ``B`` (trimmed);
    3. underscore station names: skip the first token and leading codes, take the words up to the
       next code or stop word (``A01_Kabaty_TP05_południe`` -> ``Kabaty``);
    4. otherwise the second space-separated word.
    """
    v = _c(c)
    stops = K.LOCATION_STOP_WORDS
    code = K.LOCATION_CODE_PATTERN

    # 3. station parser on arrays (no UDF): positions of the first name word and of its end.
    parts = F.filter(F.split(v, "_"), lambda x, i: (i > 0) & (x != ""))
    is_stop = F.transform(parts, lambda x: _in_lower(x, stops))
    is_name = F.transform(parts, lambda x: ~_in_lower(x, stops) & ~x.rlike(code))
    first_stop = F.array_position(is_stop, True)
    first_name = F.array_position(is_name, True)
    tail = F.slice(parts, (first_name + 1).cast("int"), F.greatest(F.size(parts), F.lit(0)))
    tail_end = F.array_position(F.transform(tail, lambda x: _in_lower(x, stops) | x.rlike(code)), True)
    n_words = F.when(tail_end == 0, F.size(parts) - first_name + 1).otherwise(tail_end)
    station_ok = (first_name > 0) & ((first_stop == 0) | (first_name < first_stop))
    station = F.when(station_ok,
                     F.array_join(F.slice(parts, first_name.cast("int"), n_words.cast("int")), " "))

    pipe_mid = F.trim(F.get(F.split(v, r" \| "), 1))
    words = F.split(v, " ")

    out = F.when(v.isNull(), F.lit(None).cast("string"))
    for label, pattern, icase in K.LOCATION_PRIORITY:
        out = out.when(v.rlike(("(?iu)" if icase else "") + pattern), F.lit(label))
    out = (out.when(v.contains(" | "), pipe_mid)
              .when(v.contains("_"), station)
              .when(F.size(words) >= 2, F.get(words, 1)))
    return out


# --- F10: test-device flag ---------------------------------------------------------------------

def is_test(*cols) -> Column:
    """True when any of the names matches the test/office pattern (case-insensitive); NULLs are False."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.coalesce(_c(c).rlike("(?iu)" + K.TEST_DEVICE_PATTERN), F.lit(False))
    return cond


# --- F11-F13: metro format from player / line-item names -----------------------------------------

def player_format(c) -> Column:
    """'liveline' before 'stroertv' (substring, case-insensitive); otherwise NULL."""
    n = F.lower(_c(c))
    return F.when(n.contains("liveline"), F.lit("liveline")).when(n.contains("stroertv"), F.lit("stroertv"))


def name_tokens(c) -> Column:
    """Format tokens present in a line-item name, in the fixed order of the configuration."""
    n = F.lower(_c(c))

    def there(tok):
        found = F.lit(False)
        if tok in K.NAME_TOKEN_TEXTS:
            found = found | n.contains(K.NAME_TOKEN_TEXTS[tok])
        if tok in K.NAME_TOKEN_PATTERNS:
            found = found | n.rlike(K.NAME_TOKEN_PATTERNS[tok])
        return found

    arr = F.array_compact(F.array(*[F.when(there(t), F.lit(t)) for t in K.NAME_TOKENS]))
    return F.when(_c(c).isNull(), F.array().cast("array<string>")).otherwise(arr)


def name_format(tokens) -> Column:
    """None / 'liveline' / 'stroertv' / 'BUNDLE' from a token array (fallback when no player matched)."""
    t = _c(tokens)
    has = lambda x: F.array_contains(t, x)
    metro = has("LL") | has("STV") | has("MM")
    return (F.when(~metro, F.lit(None).cast("string"))
             .when(has("MM") | (F.size(t) > 1), F.lit("BUNDLE"))
             .when(has("LL"), F.lit("liveline"))
             .when(has("STV"), F.lit("stroertv")))


# --- F14: deterministic factor ---------------------------------------------------------------

def unit_hash(id_col) -> Column:
    """First 32 bits of md5(decimal id) as a number in [0, 1]."""
    h = F.conv(F.substring(F.md5(_c(id_col).cast("bigint").cast("string")), 1, 8), 16, 10).cast("double")
    return h / F.lit(float(0xFFFFFFFF))


def stable_factor(id_col, lo: float = K.EXP_FACTOR_LOW, hi: float = K.EXP_FACTOR_HIGH) -> Column:
    return F.lit(lo) + unit_hash(id_col) * F.lit(hi - lo)


# --- F16: date in a file name ------------------------------------------------------------------

def file_date(c) -> Column:
    """First ``YYYY-MM-DD`` in a file name / path as DATE; none -> NULL."""
    s = F.nullif(F.regexp_extract(_c(c), r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
    return F.try_to_timestamp(s, F.lit("yyyy-MM-dd")).cast("date")


# --- F20: counters in log lines ------------------------------------------------------------------

def regex_long(c, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(_c(c), pattern, group), F.lit("")).try_cast("bigint")
