"""Refresh strategies (M1-M11) and incremental change selection (I1-I7) as pure functions.

Each strategy takes the current table and the new batch as DataFrames and returns the table after the
refresh; writers in ``sources.sinks`` persist the result.  Being pure, the same function runs in batch,
inside ``foreachBatch`` of a stream, and in tests - and applying it twice equals applying it once.
All of them are joins and unions on keys: nothing is collected, nothing is looped over on the driver.
"""
from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .conform import union_by_name
from .rollup import dedup


def _q(n):
    return F.col(f"`{n}`")


def match_keys(df: DataFrame, other: DataFrame, keys: list[str] | str, how: str) -> DataFrame:
    """Semi or anti join on ``keys`` in which a NULL key equals a NULL key, so a replayed batch finds its own rows."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    right = other.select(*[_q(k).alias(f"__m{i}") for i, k in enumerate(keys)])
    cond = reduce(Column.__and__, [_q(k).eqNullSafe(F.col(f"__m{i}")) for i, k in enumerate(keys)])
    return df.join(right, cond, how)


def overwrite_guarded(old: DataFrame, new: DataFrame) -> DataFrame:
    """M1: the new table replaces the old one, except that an empty batch never replaces data."""
    return old if new.isEmpty() else new


def upsert(old: DataFrame, new: DataFrame, keys: list[str] | str, order: list | None = None,
           types: dict | None = None) -> DataFrame:
    """M2/M5: de-duplicate the batch keep-last per key (by ``order``; input position is not a thing in
    a distributed batch), drop the old rows with those keys, append the batch."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    # without an explicit order the remaining columns break ties, so the surviving row never depends on input order
    batch = dedup(new, keys, order=order or [c for c in new.columns if c not in keys], keep="last") \
        if order or len(new.columns) > len(keys) else new.dropDuplicates(keys)
    return union_by_name(match_keys(old, batch, keys, "left_anti"), batch, types=types)


def append_new(old: DataFrame, new: DataFrame, date_col: str) -> DataFrame:
    """M3: append only the batch rows of dates the table does not have yet (no date counts as a date)."""
    fresh = match_keys(new, old.select(date_col).distinct(), date_col, "left_anti")
    return union_by_name(old, fresh)


def replace_dates(old: DataFrame, new: DataFrame, date_col: str, dates: list | DataFrame | None = None,
                  undated: str = "keep") -> DataFrame:
    """Delete the rows of the replaced dates, append every new row.

    Rows without a date belong to no day, so no batch replaces them: those of the table stay, and those of the batch
    are added unless the very same row is there (``undated='keep'``).  With ``undated='replace'`` a batch that has
    undated rows replaces the table's.  Either way a batch applied twice leaves the same table.

    ``dates`` defaults to the dates present in the batch.  When a file spills rows into the next day,
    pass the file's own date only: the spill rows are then appended beside that day's existing rows
    (the source system's rule) instead of wiping it."""
    if dates is None:
        dates = new.select(date_col)
    if isinstance(dates, DataFrame):
        gone = dates.select(date_col).distinct()
        if undated == "keep":
            gone = gone.where(_q(date_col).isNotNull())
        kept = match_keys(old, gone, date_col, "left_anti")
    else:
        listed = _q(date_col).isin([d for d in dates if d is not None])
        if undated == "replace" and None in dates:
            listed = listed | _q(date_col).isNull()
        kept = old.where(~F.coalesce(listed, F.lit(False)))
    if undated == "keep":
        shared = [c for c in new.columns if c in kept.columns]
        kept = match_keys(kept, new.where(_q(date_col).isNull()), shared, "left_anti")
    return union_by_name(kept, new)


def add_only(old: DataFrame, new: DataFrame, key: str | list[str]) -> DataFrame:
    """M6: add only ids absent from the table; existing ids are never touched (idempotent)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in new.columns if c not in keys]
    first = dedup(new, keys, order=rest) if rest else new.dropDuplicates(keys)
    return union_by_name(old, match_keys(first, old, keys, "left_anti"))


def latest_per_key(old: DataFrame, new: DataFrame, key: str, version: str, source_col: str | None = None) -> DataFrame:
    """M7: drop the old rows that came from the batch's own source file(s), union, keep the newest
    ``version`` per key (ties broken by the remaining columns for a deterministic result)."""
    if source_col:
        # the names come out of an aggregate: a batch whose file name is a constant would else leave no join key
        names = new.groupBy(source_col).agg(F.max(source_col).alias("__file")).select(F.col("__file").alias(source_col))
        old = match_keys(old, names, source_col, "left_anti")
    both = union_by_name(old, new)
    rest = [c for c in both.columns if c not in (key, version)]
    # newest version per key (an aggregate), then one row among its ties (min_by over the other columns)
    newest = both.groupBy(key).agg(F.max(version).alias("__v"))
    cand = both.join(newest, key).where(_q(version).eqNullSafe(F.col("__v"))).drop("__v")
    return dedup(cand, [key], order=rest)


def reaggregate_union(old: DataFrame, new: DataFrame, keys: list[str], sums: list[str], date_col: str,
                      dates: list | None = None) -> DataFrame:
    """M9: replace the batch's dates, then re-aggregate the union on ``keys`` (partial aggregation
    happens map-side, so the union is combined before the shuffle)."""
    merged = replace_dates(old, new, date_col, dates, undated="replace")
    return merged.groupBy(*keys).agg(*[F.sum(_q(c)).alias(c) for c in sums])


def shrink_check(old: DataFrame, new: DataFrame, ratio: float = 0.9, force: bool = False) -> DataFrame:
    """One row (old_rows, new_rows, ok): a replacement with fewer than ``ratio`` x the current rows
    is refused unless forced.  Row counts, not bytes: compression makes bytes a poor guard."""
    tagged = old.select(F.lit(1).alias("__o"), F.lit(0).alias("__n")).unionByName(
        new.select(F.lit(0).alias("__o"), F.lit(1).alias("__n")))
    counts = tagged.agg(F.coalesce(F.sum("__o"), F.lit(0)).cast("bigint").alias("old_rows"),
                        F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("new_rows"))
    return counts.withColumn("ok", F.lit(force) | (F.col("old_rows") == 0) |
                             (F.col("new_rows") >= F.col("old_rows") * F.lit(ratio)))


# --- incremental selection -----------------------------------------------------------------------

def since_cursor(df: DataFrame, modified_col: str, cursor) -> tuple[DataFrame, DataFrame]:
    """Rows changed since the high-water mark, and a one-row DataFrame with the next cursor (the previous one when
    nothing changed).

    Rows of the mark's own instant come again, since others of that instant may have been written after the last
    read, and so do rows without a modification time; what takes them up is a key upsert, to which repeats do nothing."""
    cur = F.lit(cursor).cast(df.schema[modified_col].dataType)
    rows = df.where(_q(modified_col).isNull() | (_q(modified_col) >= cur))
    nxt = df.agg(F.greatest(F.max(_q(modified_col)), cur).alias("cursor"))
    return rows, nxt


def unseen_dates(listing: DataFrame, loaded: DataFrame, date_col: str) -> DataFrame:
    """Listed files whose *date* is not loaded yet (names may differ, e.g. .txt vs .txt.gz)."""
    return match_keys(listing, loaded.select(date_col).distinct(), date_col, "left_anti")


def changed_files(listing: DataFrame, manifest: DataFrame, name: str = "file", size: str = "size") -> DataFrame:
    """Classify every listed file as 'new', 'update' (size differs) or 'skip'."""
    m = manifest.select(_q(name), _q(size).alias("__known"))
    j = listing.join(m, name, "left")
    status = (F.when(F.col("__known").isNull(), F.lit("new"))
               .when(F.col("__known") != _q(size), F.lit("update"))
               .otherwise(F.lit("skip")))
    return j.withColumn("status", status).drop("__known")


def months_to_fetch(available: DataFrame, seen: DataFrame, month_col: str, current_month,
                    force: bool = False) -> DataFrame:
    """I4: months not fetched yet, plus the current month (always refetched), or all when forced."""
    if force:
        return available
    fresh = available.join(seen.select(month_col).distinct(), month_col, "left_anti")
    return union_by_name(fresh, available.where(_q(month_col) == F.lit(current_month))).distinct()


def rolling_window(end: dt.date, days: int) -> tuple[dt.date, dt.date]:
    """``days`` days ending the day before ``end``."""
    last = end - dt.timedelta(days=1)
    return last - dt.timedelta(days=days - 1), last


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    """First and last day of a month."""
    first = dt.date(year, month, 1)
    nxt = dt.date(year + (month == 12), month % 12 + 1, 1)
    return first, nxt - dt.timedelta(days=1)


def reconcile_orphans(fact_ids: DataFrame, known: DataFrame, source: DataFrame, key: str,
                      fact_key: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ids referenced by the facts but missing from ``known`` are looked up in a recovery ``source``.

    Returns (known upserted with the recovered rows, the recovered rows, the ids still missing).  One
    anti join and one semi join - never a per-id loop; call again with the parents' tables for the next level."""
    fact_key = fact_key or key
    orphans = fact_ids.select(F.col(fact_key).alias(key)).dropna().distinct() \
                      .join(known.select(key), key, "left_anti")
    recovered = source.join(orphans, key, "left_semi")
    unrecovered = orphans.join(source.select(key), key, "left_anti")
    return upsert(known, recovered, key), recovered, unrecovered


def add_only_checked(old: DataFrame, new: DataFrame, key: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """M6 with its checks: the merged table and one row (old_rows, added, merged_rows, rows_ok, unique) - the
    merged count must equal old + added and the key must stay unique.  Nothing is written, so a dry run is
    simply not persisting the first result."""
    keys = [key] if isinstance(key, str) else list(key)
    merged = add_only(old, new, keys)
    added = match_keys(new.select(*keys).distinct(), old, keys, "left_anti")
    tagged = (old.select(F.lit(1).alias("__o"), F.lit(0).alias("__a"))
                 .unionByName(added.select(F.lit(0).alias("__o"), F.lit(1).alias("__a"))))
    counts = tagged.agg(F.sum("__o").cast("bigint").alias("old_rows"), F.sum("__a").cast("bigint").alias("added"))
    per_key = merged.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c"))
    shape = per_key.agg(F.sum("__c").cast("bigint").alias("merged_rows"), F.max("__c").alias("__max"))
    check = counts.unionByName(shape, allowMissingColumns=True).agg(
        F.max("old_rows").alias("old_rows"), F.max("added").alias("added"), F.max("merged_rows").alias("merged_rows"),
        F.max("__max").alias("__max"))
    check = check.select("old_rows", "added", "merged_rows",
                         (F.col("merged_rows") == F.col("old_rows") + F.col("added")).alias("rows_ok"),
                         F.coalesce(F.col("__max") <= 1, F.lit(True)).alias("unique"))
    return merged, check
