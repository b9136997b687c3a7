"""Row generators (G1-G7): calendar, flight days / months / weeks, virtual slots, balancing rows.

Expansion is always the *last* widening step of a plan: measures are computed on the narrow rows first
and ``explode(sequence(..))`` runs inside the same stage (no shuffle after it).  Every sequence is
bounded: days are clamped to the calendar window, months/weeks to the line's own flight.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as K
from ..functions.calendar import calendar_columns


def _q(n):
    return F.col(f"`{n}`") if isinstance(n, str) else n


def _date_lit(d) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)))


def calendar(spark: SparkSession, start=K.CALENDAR_START, end=K.CALENDAR_END) -> DataFrame:
    """One row per day ``start..end`` with the dim_date attributes."""
    days = spark.range(1).select(F.explode(F.sequence(_date_lit(start), _date_lit(end))).alias("d"))
    return days.select(*calendar_columns("d"))


def check_calendar(cal: DataFrame, start=K.CALENDAR_START, end=K.CALENDAR_END) -> DataFrame:
    """Completeness assertion of a calendar: expected vs found day count and distinct keys (one row)."""
    s = dt.date.fromisoformat(str(start)) if not isinstance(start, dt.date) else start
    e = dt.date.fromisoformat(str(end)) if not isinstance(end, dt.date) else end
    return cal.agg(F.count(F.lit(1)).alias("n_days"), F.countDistinct("date_key").alias("n_keys")) \
              .withColumn("expected", F.lit((e - s).days + 1)) \
              .withColumn("complete", (F.col("n_days") == F.col("expected")) & (F.col("n_keys") == F.col("expected")))


def clamped_range(start, end, lo=K.CALENDAR_START, hi=K.CALENDAR_END) -> tuple[Column, Column, Column]:
    """(first day, last day, valid) of a flight clamped to ``lo..hi``.  NULL or inverted flights and
    flights wholly outside the window are invalid (no rows) - ``greatest``/``least`` skip NULLs, so the
    NULL guard is explicit."""
    s, e = F.to_date(_q(start)), F.to_date(_q(end))
    a = F.greatest(s, _date_lit(lo))
    b = F.least(e, _date_lit(hi))
    valid = s.isNotNull() & e.isNotNull() & (a <= b)
    return a, b, valid


def flight_days(df: DataFrame, start: str, end: str, lo=K.CALENDAR_START, hi=K.CALENDAR_END,
                out: str = "day") -> DataFrame:
    """One row per day of each flight, clamped to the window; invalid flights give no rows."""
    a, b, valid = clamped_range(start, end, lo, hi)
    return df.where(valid).withColumn(out, F.explode(F.sequence(a, b)))


def flight_months(df: DataFrame, start: str, end: str, out: str = "month_start") -> DataFrame:
    """First day of every calendar month a flight touches.  The start is truncated to its month
    first (a month step from the 31st would land on the 28th)."""
    s = F.trunc(F.to_date(_q(start)), "month")
    e = F.trunc(F.to_date(_q(end)), "month")
    return (df.where(s.isNotNull() & e.isNotNull() & (s <= e))
              .withColumn(out, F.explode(F.sequence(s, e, F.expr("interval 1 month")))))


def flight_weeks(df: DataFrame, start: str, end: str, out: str = "week_monday") -> DataFrame:
    """Monday of every ISO week a flight touches (7-day step between the two Mondays)."""
    s = F.to_date(F.date_trunc("week", _q(start)))
    e = F.to_date(F.date_trunc("week", _q(end)))
    return (df.where(s.isNotNull() & e.isNotNull() & (s <= e))
              .withColumn(out, F.explode(F.sequence(s, e, F.expr("interval 7 day")))))


def virtual_slots(df: DataFrame, n_col: str, out: str = "player_id") -> DataFrame:
    """``max(n, 1)`` rows per input row with a NULL player (no matched log)."""
    n = F.greatest(F.coalesce(_q(n_col).cast("int"), F.lit(1)), F.lit(1))
    return df.withColumn(out, F.explode(F.array_repeat(F.lit(None).cast("bigint"), n)))


def balancing_rows(lines: DataFrame, key: str, line_value: str, head_value: str,
                   tolerance: float = K.BALANCE_TOLERANCE, carry: list[str] | None = None,
                   out_value: str | None = None, order: str | None = None) -> DataFrame:
    """One adjustment row per ``key`` where ``|head - Σ lines| > tolerance``; its value is the
    difference.  ``head_value`` is the first non-NULL head value of the group; ``carry`` columns are
    carried as their first non-NULL value in ``order`` (deterministic ``min_by``; without an order the
    smallest non-NULL value, which is the same thing for head attributes that are constant per key)."""
    out_value = out_value or line_value
    carry = carry or []

    def first_non_null(c):
        o = _q(order) if order else _q(c)
        return F.min_by(_q(c), F.when(_q(c).isNotNull(), o)).alias(c)

    aggs = [F.coalesce(F.sum(_q(line_value)), F.lit(0.0)).alias("__sum"), first_non_null(head_value)]
    aggs += [first_non_null(c) for c in carry if c != head_value]
    g = lines.groupBy(key).agg(*aggs)
    diff = F.col(head_value) - F.col("__sum")
    return (g.where(F.abs(diff) > tolerance)
             .withColumn(out_value, diff)
             .withColumn("is_adjustment", F.lit(True))
             .drop("__sum"))


def synthetic_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """Rows defined in configuration (a few literals), typed by ``schema``."""
    return spark.createDataFrame(rows, schema)
