"""Aggregations and de-duplication.

Every aggregate is a declarative ``groupBy().agg()``: Spark runs a map-side partial aggregate before
the shuffle, so a hot key (one player holding a third of the rows) is combined on the map side and
ships one partial row per task, not its raw rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import slot_label
from ..functions.semantics import round_half_up


def _q(name):
    return F.col(f"`{name}`") if isinstance(name, str) else name


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``keys``."""
    return df.dropna(subset=list(keys))


def hourly_rollup(df: DataFrame, keys: list[str], ts: str = "DateEndTime", sums: dict | None = None,
                  count_as: str = "emisje", null_keys: str = "keep", scale: int | None = 2) -> DataFrame:
    """Group by day, hour and ``keys``; sum measures, count plays, label the hour slot.

    ``null_keys='keep'`` keeps NULL group keys as their own group; ``'drop'`` removes rows with any NULL
    key first.  A NULL timestamp gives NULL day/hour (never the text 'NaT').
    """
    sums = sums or {}
    d = df.withColumn("DateEnd", F.date_format(_q(ts), "yyyy-MM-dd")).withColumn("timeslot", F.hour(_q(ts)))
    gkeys = [k for k in ["DateEnd", "timeslot"]] + [k for k in keys]
    if null_keys == "drop":
        d = d.dropna(subset=gkeys)
    aggs = []
    for out, src in sums.items():
        s = F.coalesce(F.sum(_q(src)), F.lit(0))
        aggs.append((round_half_up(s, scale) if scale is not None else s).alias(out))
    aggs.append(F.count(F.lit(1)).alias(count_as))
    return d.groupBy(*gkeys).agg(*aggs).withColumn("timeslot_label", slot_label("timeslot"))


def rollup(df: DataFrame, keys: list[str], sums: dict | None = None, counts: dict | None = None,
           distincts: dict | None = None, firsts: dict | None = None, order: list | None = None,
           null_keys: str = "keep", scale: int | None = None) -> DataFrame:
    """General grouped aggregate.

    ``sums`` {out: col} with 0 for an all-NULL group; ``counts`` {out: col or '*'};
    ``distincts`` {out: col}; ``firsts`` {out: col} = first non-NULL value in ``order`` (deterministic,
    via ``min_by`` on the order key instead of 'first row seen').
    """
    if null_keys == "drop":
        df = df.dropna(subset=keys)
    aggs: list[Column] = []
    for out, c in (sums or {}).items():
        s = F.coalesce(F.sum(_q(c)), F.lit(0))
        aggs.append((round_half_up(s, scale) if scale is not None else s).alias(out))
    for out, c in (counts or {}).items():
        aggs.append((F.count(F.lit(1)) if c == "*" else F.count(_q(c))).alias(out))
    for out, c in (distincts or {}).items():
        aggs.append(F.countDistinct(_q(c)).alias(out))
    if firsts:
        if not order:
            raise ValueError("firsts needs an explicit order")
        okey = F.struct(*[_q(o) for o in order])
        for out, c in firsts.items():
            aggs.append(F.min_by(_q(c), F.when(_q(c).isNotNull(), okey)).alias(out))
    return df.groupBy(*keys).agg(*aggs)


def sorted_distinct(col: str, sep: str | None = None) -> Column:
    """Sorted distinct values of a group (as array, or joined text with ``sep``).

    Use only where the number of distinct values per group has a known bound (players of a
    reservation, screens of a frame); the values are gathered in one task."""
    arr = F.array_sort(F.collect_set(_q(col)))
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep) if sep is not None else arr


_ORDERABLE = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType)


def dedup(df: DataFrame, keys: list[str], order: list | None = None, keep: str = "first") -> DataFrame:
    """One row per key, chosen by an explicit order (never 'whatever came first').

    ``order`` lists column names; ``keep='first'`` takes the first row in ascending order with NULLs last,
    ``keep='last'`` the last one (descending, NULLs first).  NULL keys form one group, as pandas does.

    Implemented as a ``min_by`` aggregate over an order struct (ties broken by the remaining columns), so
    the choice is combined map-side: a key holding a third of all rows ships one candidate per task, not
    its rows.  Sort expressions (Column objects) fall back to a ``row_number`` window.  Without an order the
    rows must be identical on the kept columns (then ``dropDuplicates`` is exact)."""
    if not order:
        return df.dropDuplicates(keys)
    if not all(isinstance(o, str) for o in order):
        w = Window.partitionBy(*[_q(k) for k in keys]).orderBy(*order)
        return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    rest = [f.name for f in df.schema.fields if f.name not in keys and isinstance(f.dataType, _ORDERABLE)]
    parts = []
    for o in list(order) + [c for c in rest if c not in order]:
        c = _q(o)
        # (is NULL, value): ascending puts NULLs last; for 'last' the whole struct is negated via max_by
        parts += [c.isNull(), c]
    okey = F.struct(*[p.alias(f"o{i}") for i, p in enumerate(parts)])
    val = F.struct(*[_q(c) for c in df.columns if c not in keys])
    pick = F.min_by(val, okey) if keep == "first" else F.max_by(val, okey)
    out = df.groupBy(*[_q(k) for k in keys]).agg(pick.alias("__v"))
    return out.select(*[_q(c) if c in keys else F.col("__v").getField(c).alias(c) for c in df.columns])


def latest_by(df: DataFrame, keys: list[str], version: str, cols: list[str]) -> DataFrame:
    """M8: newest value per key by ``version`` regardless of input order (``max_by`` aggregate, which
    combines map-side and so handles hot keys without a sort of the whole group)."""
    best = F.max_by(F.struct(*[_q(c) for c in cols + [version]]), F.struct(_q(version), *[_q(c) for c in cols]))
    return df.groupBy(*keys).agg(best.alias("__b")).select(*keys, *[F.col(f"__b.{c}").alias(c) for c in cols + [version]])


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Frequency of each value (NULL dropped, as pandas)."""
    return df.where(_q(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
