"""Lookup joins (J1-J18) and masked overrides.

Every join in the source system is a LEFT equi-join on one or two id columns.  Here the dimension side
is reduced to the columns taken, its keys are checked for NULL, and duplicate keys follow an explicit
policy instead of silently multiplying rows:

* ``on_multi='fanout'`` - keep every match (the source system's behaviour; facts can multiply);
* ``on_multi='first'``  - keep one dimension row per key, chosen by ``order``;
* ``on_multi='error'``  - same as 'first' after the caller asserted uniqueness (see quality.assert_unique).

Broadcast: a side is hinted only when the caller declares it bounded (``bounded=True``: a calendar, a
fixed list of formats, a country table).  Otherwise Spark decides from its statistics
(``spark.sql.autoBroadcastJoinThreshold``) and AQE re-plans on the real shuffle sizes, so a dimension
that grows with the data falls back to a sort-merge join instead of blowing up driver memory.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rollup import _ORDERABLE, dedup
from ..functions.semantics import is_in


def _q(n):
    return F.col(f"`{n}`")


SPREAD = "__spread"


def keyed(df: DataFrame, on: dict[str, str], spread: list[str] | None = None) -> tuple[DataFrame, Column]:
    """``df`` and the join condition  df[l] = right[r]  for each l: r of ``on``, which deals out the rows without a key.

    Such rows match nothing, but a plain left join sends them all to one task.  They get a second join key instead, a
    hash of the row, so they lie evenly over all partitions however many there are; rows with a key have 0 there,
    as the right side has, and their partitions are those of the key.  (Taking them out of the join and adding them by
    a union would compute ``df`` twice, and 2^n times in a chain of n lookups.)

    The hash is of the ``spread`` columns, which tell such rows apart, or of the whole row.  It is a column of its own, made
    before the exchange (the caller drops ``SPREAD`` afterwards): in the condition it would send every column that it reads."""
    cond = reduce(Column.__and__, [_q(l) == _q(r) for l, r in on.items()])
    told = [_q(f.name) for f in df.schema.fields if isinstance(f.dataType, _ORDERABLE) and (spread is None or f.name in spread)]
    if not told or not any(df.schema[l].nullable for l in on):
        return df, cond
    no_key = reduce(Column.__or__, [_q(l).isNull() for l in on])
    # written as expressions of the keys, so that the optimizer takes neither side for a constant
    there = F.pmod(F.xxhash64(*[_q(r) for r in on.values()]), F.lit(1))
    here = F.when(no_key, F.xxhash64(*told)).otherwise(F.pmod(F.xxhash64(*[_q(l) for l in on]), F.lit(1)))
    return df.withColumn(SPREAD, here), cond & (F.col(SPREAD) == there)


def lookup_join(df: DataFrame, dim: DataFrame, on, take: list[str] | dict | None = None,
                fallback: dict | None = None, on_multi: str = "fanout", order: list | None = None,
                bounded: bool = False, null_safe: bool = False, spread: list[str] | None = None) -> DataFrame:
    """LEFT join ``df`` to ``dim``.

    ``on``: a key name, a list of names, or a dict {df_key: dim_key}.  ``take``: dim columns to bring
    (dict renames).  ``fallback``: {out: other_col} -> ``coalesce(out, other_col)`` after the join.
    ``spread``: see :func:`keyed`.
    """
    if isinstance(on, str):
        on = {on: on}
    elif isinstance(on, (list, tuple)):
        on = {k: k for k in on}
    if take is None:
        take = [c for c in dim.columns if c not in on.values()]
    if isinstance(take, (list, tuple)):
        take = {c: c for c in take}
    keys = list(on.values())
    tmp = {k: f"__k{i}" for i, k in enumerate(keys)}
    right = dim.select(*[_q(k).alias(tmp[k]) for k in keys], *[_q(s).alias(t) for s, t in take.items()])
    if not null_safe:
        right = right.dropna(subset=list(tmp.values()))
    if on_multi in ("first", "error"):
        right = dedup(right, list(tmp.values()), order=order or list(take.values()) or None)
    if bounded:
        right = F.broadcast(right)
    clash = [t for t in take.values() if t in df.columns]
    if null_safe:
        left, cond = df, reduce(Column.__and__, [_q(l).eqNullSafe(F.col(tmp[r])) for l, r in on.items()])
    elif bounded:
        left, cond = df, reduce(Column.__and__, [_q(l) == F.col(tmp[r]) for l, r in on.items()])
    else:
        left, cond = keyed(df, {l: tmp[r] for l, r in on.items()}, spread)
    left = left.drop(*clash) if clash else left
    out = left.join(right, cond, "left").drop(*tmp.values(), SPREAD)
    for col_name, other in (fallback or {}).items():
        out = out.withColumn(col_name, F.coalesce(_q(col_name), other if isinstance(other, Column) else _q(other)))
    return out


def overlap_join(left: DataFrame, right: DataFrame, on: str | dict, prefer: str = "right",
                 suffix: str = "_r", spread: list[str] | None = None) -> DataFrame:
    """Left join where both sides carry columns of the same name; the shared columns take the
    preferred side's value and fall back to the other side's where it is NULL.  ``spread``: see :func:`keyed`."""
    if isinstance(on, str):
        on = {on: on}
    rkeys = list(on.values())
    shared = [c for c in right.columns if c in left.columns and c not in rkeys]
    tmp = {k: f"__rk{i}" for i, k in enumerate(rkeys)}
    r = right.select(*[_q(c).alias(tmp[c]) if c in tmp else (_q(c).alias(c + suffix) if c in shared else _q(c))
                       for c in right.columns])
    r = r.dropna(subset=list(tmp.values()))
    left, cond = keyed(left, {l: tmp[rk] for l, rk in on.items()}, spread)
    out = left.join(r, cond, "left").drop(*tmp.values(), SPREAD)
    for c in shared:
        a, b = (_q(c + suffix), _q(c)) if prefer == "right" else (_q(c), _q(c + suffix))
        out = out.withColumn(c, F.coalesce(a, b)).drop(c + suffix)
    return out


def override_where_null(df: DataFrame, key: str, overrides: DataFrame, cols: list[str],
                        override_key: str | None = None, when_null: str | None = None,
                        order: list[str] | None = None, spread: list[str] | None = None) -> DataFrame:
    """Rows whose ``key`` is in the override table take its ``cols``: all of them where ``when_null`` is
    NULL, or, without ``when_null``, each column where it is NULL itself.

    Of several overrides of a key the last by ``order`` wins (D5; without an order the greatest values).  The table is
    configuration; Spark broadcasts it by its size, as any other.  ``spread``: see :func:`keyed`."""
    ok = override_key or key
    ov = dedup(overrides, [ok], order=order or cols, keep="last")
    ov = ov.select(_q(ok).alias("__ok"), F.lit(True).alias("__hit"), *[_q(c).alias(f"__ov_{c}") for c in cols])
    df, cond = keyed(df, {key: "__ok"}, spread)
    out = df.join(ov.dropna(subset=["__ok"]), cond, "left")
    mask = (F.col("__hit") & _q(when_null).isNull()) if when_null else None
    out = out.select(*[F.when(F.col("__hit") & _q(c).isNull() if mask is None else mask, F.col(f"__ov_{c}"))
                       .otherwise(_q(c)).alias(c) if c in cols else _q(c) for c in out.columns])
    return out.drop("__ok", "__hit", SPREAD, *[f"__ov_{c}" for c in cols])


def service_flag(primary: list[Column], secondary: list[Column]) -> Column:
    """Three-state flag, precedence 1 > 2 > 0, as TINYINT.  Each argument is a list of boolean
    conditions (NULL counts as False)."""
    any1 = F.lit(False)
    for c in primary:
        any1 = any1 | F.coalesce(c, F.lit(False))
    any2 = F.lit(False)
    for c in secondary:
        any2 = any2 | F.coalesce(c, F.lit(False))
    return F.when(any1, F.lit(1)).when(any2, F.lit(2)).otherwise(F.lit(0)).cast("tinyint")


def member_of(c: str | Column, ids) -> Column:
    return is_in(_q(c) if isinstance(c, str) else c, ids)


def unknown_keys(df: DataFrame, known: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``known`` (left-anti join)."""
    if isinstance(on, str):
        on = [on]
    return df.join(known.select(*on).dropna(), list(on), "left_anti")


def known_keys(df: DataFrame, known: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key exists in ``known`` (left-semi join)."""
    if isinstance(on, str):
        on = [on]
    return df.join(known.select(*on), list(on), "left_semi")


def two_sided_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys only in ``a`` ('missing') and only in ``b`` ('surplus') in one pass (full outer join of the
    two distinct key sets)."""
    ka = a.select(_q(key).alias("__k")).distinct().withColumn("__a", F.lit(True))
    kb = b.select(_q(key).alias("__k")).distinct().withColumn("__b", F.lit(True))
    j = ka.join(kb, "__k", "full_outer")
    return (j.where(F.col("__a").isNull() | F.col("__b").isNull())
             .select(F.col("__k").alias(key),
                     F.when(F.col("__b").isNull(), F.lit("missing")).otherwise(F.lit("surplus")).alias("side")))
