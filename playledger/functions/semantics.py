"""Column expressions that pin down the null and type rules of SURVEY §1.4.

All of them are built-in Spark expressions (JVM side, inside whole-stage codegen); none is a UDF.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- F1 / F2: tolerant coercion --------------------------------------------------------------

def to_double(c) -> Column:
    """Unparsable text -> NULL (never an ANSI error)."""
    return _c(c).try_cast("double")


def to_long(c) -> Column:
    """Number-like value -> BIGINT; a fractional value is not an integer and becomes NULL instead of being
    truncated.  Integers (and integer text) are cast directly, so 64-bit ids stay exact; only text such as
    '123.0' takes the route through double."""
    col = _c(c)
    d = to_double(col)
    return F.when(d == F.floor(d), F.coalesce(col.try_cast("bigint"), d.try_cast("bigint")))


def to_ts(c, fmt: str | None = None) -> Column:
    """Text -> timestamp; unparsable -> NULL."""
    col = _c(c).cast("string")
    if fmt:
        return F.try_to_timestamp(col, F.lit(fmt))
    return F.try_to_timestamp(col)


def to_day(c) -> Column:
    """Any date/timestamp/text -> DATE (NULL when unparsable)."""
    return F.to_date(_c(c))


# --- P4, P5, P14: zero / blank handling ------------------------------------------------------

def blank_to_null(c, blanks: Iterable = (0,)) -> Column:
    """Zero (or any listed sentinel) -> NULL."""
    out = _c(c)
    for b in blanks:
        out = F.nullif(out, F.lit(b))
    return out


def not_zero(c) -> Column:
    """``x != 0`` where NULL counts as 'not zero' (the row is kept)."""
    return F.coalesce(_c(c) != 0, F.lit(True))


def not_null_and_not_zero(*cols) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & _c(c).isNotNull() & (_c(c) != 0)
    return cond


# --- P6: set membership with explicit NULL rule ----------------------------------------------

def is_in(c, values: Iterable) -> Column:
    """``x IN S`` where NULL -> False."""
    values = list(values)
    if not values:
        return F.lit(False)
    return F.coalesce(_c(c).isin(values), F.lit(False))


def keep_not_in(c, values: Iterable) -> Column:
    """``NOT x IN S`` where NULL -> True (the row is kept)."""
    values = list(values)
    if not values:
        return F.lit(True)
    return F.coalesce(~_c(c).isin(values), F.lit(True))


# --- sums and rounding -----------------------------------------------------------------------

def sum0(c) -> Column:
    """Sum where an all-NULL (or empty) group gives 0, not NULL."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))


def round_half_up(c, scale: int) -> Column:
    """Deterministic decimal rounding (half away from zero) of a double, returned as double.

    Goes through DECIMAL so the tie rule applies to the decimal value, independent of the binary
    representation; any engine that rounds the same decimal gives the same result."""
    return F.round(_c(c).cast("decimal(38,10)"), scale).cast("double")


def sum_round(c, scale: int = 2) -> Column:
    """Sum of money-like doubles, rounded once at the end (summation order can only move the last bits)."""
    return round_half_up(F.sum(_c(c)), scale)


# --- F8: inclusive day count -----------------------------------------------------------------

def inclusive_days(start, end) -> Column:
    """Days between two dates, both ends included, at least 1; NULL when either side is NULL."""
    s, e = F.to_date(_c(start)), F.to_date(_c(end))
    return F.when(s.isNotNull() & e.isNotNull(), F.greatest(F.datediff(e, s) + 1, F.lit(1)))


# --- P11, P16 --------------------------------------------------------------------------------

def fill_from(a, b) -> Column:
    """A where present, else B."""
    return F.coalesce(_c(a), _c(b))
