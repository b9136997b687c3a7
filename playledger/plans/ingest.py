"""C4 proof-of-play months and C3 control tables.  C3: control-table sync from landed API pages: incremental tables go through a high-water cursor and a key
upsert (I1 + M2), the others are replaced whole unless the refetch came back empty (M1)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as K
from ..functions.semantics import to_long
from ..operators.lookup import lookup_join
from ..operators.merge import match_keys, months_to_fetch, since_cursor
from ..operators.rollup import dedup
from ..session import cut_lineage
from ..sources import readers as RD
from ..sources import sinks as SK


CURSORS = "table_name string, cursor timestamp"


def read_cursors(spark: SparkSession, cursors_path: str) -> dict:
    """The stored high-water marks, one for each table that has one (a control table of a few rows)."""
    if not SK.table_exists(spark, cursors_path):
        return {}
    return {r.table_name: r.cursor for r in spark.read.schema(CURSORS).parquet(cursors_path).collect()}


def save_cursors(spark: SparkSession, new: dict, cursors_path: str) -> None:
    """Keep, for each table, the larger of the stored and the new mark; tables that ``new`` lacks keep theirs."""
    known = read_cursors(spark, cursors_path)
    both = {t: max(c for c in (known.get(t), new.get(t)) if c is not None) for t in {*known, *new} if known.get(t) or new.get(t)}
    if both:
        SK.write_guarded(spark.createDataFrame(sorted(both.items()), CURSORS).coalesce(1), cursors_path)


def _load_control_table(spark: SparkSession, table: str, pages_path: str, item_schema: str, table_path: str, cursors_path: str,
                        modified_col: str, key: str) -> tuple:
    """(rows landed, strategy, new cursor or None); the cursor is not saved."""
    resource, _version = K.CONTROL_ENDPOINTS[table]
    recs = cut_lineage(RD.read_paged_json(spark, pages_path, item_schema, paths=[f"$.{resource}"]).drop("page_file"))
    if table not in K.CONTROL_INCREMENTAL:
        landed = recs.count()
        return landed, "overwrite" if SK.write_guarded(recs, table_path) else "overwrite/empty", None
    since = read_cursors(spark, cursors_path).get(table, K.CURSOR_EPOCH)
    changed, _ = since_cursor(recs, modified_col, since)
    landed, newest = recs.agg(F.count(F.lit(1)), F.max(modified_col)).first()
    if not landed:
        return 0, "incremental/no-change", None
    SK.write_upsert(spark, changed, table_path, [key])
    return landed, "incremental", newest


def sync_control_table(spark: SparkSession, table: str, pages_path: str, item_schema: str, table_path: str,
                       cursors_path: str, modified_col: str = "modified", key: str = "id") -> None:
    """C3 for one table, from its landed pages (``{"<resource>": [...], "not_modified_since": ...}``): an incremental
    table is upserted by id with the rows changed since its cursor, any other is replaced whole unless the refetch is
    empty.  The cursor is saved after the data."""
    *_, cursor = _load_control_table(spark, table, pages_path, item_schema, table_path, cursors_path, modified_col, key)
    if cursor is not None:
        save_cursors(spark, {table: cursor}, cursors_path)


def sync_control_tables(spark: SparkSession, landed: dict[str, tuple[str, str]], root: str, cursors_path: str,
                        modified_col: str = "modified", key: str = "id") -> DataFrame:
    """One run over the control tables, ``landed`` being {table: (its pages, the records' schema)}; table t goes to
    ``root``/ctrl_t.

    A table that fails is reported and does not stop the others.  The cursors of all tables are saved once, after all
    data: a run that dies before loads the same rows again, which an upsert by key does not notice.  Returns one row for
    each table: table_name, ok, strategy, n_rows, error."""
    done, cursors = [], {}
    for table, (pages, schema) in landed.items():
        try:
            n, strategy, cursor = _load_control_table(spark, table, pages, schema, f"{root.rstrip('/')}/ctrl_{table}", cursors_path,
                                                      modified_col, key)
            done.append((table, True, strategy, n, None))
            if cursor is not None:
                cursors[table] = cursor
        except Exception as e:  # noqa: BLE001  whatever is wrong with one source is that source's matter
            done.append((table, False, None, None, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:300]))
    save_cursors(spark, cursors, cursors_path)
    return spark.createDataFrame(done, "table_name string, ok boolean, strategy string, n_rows long, error string")


POP_KEYS = ["format", "content_id", "play_date"]


def load_pop_months(spark: SparkSession, stats: DataFrame, contents: DataFrame, table_path: str, seen: DataFrame,
                    current_month: str, force: bool = False) -> DataFrame:
    """C4 bronze: proof-of-play statistics (content_id, content_name, play_date, play_count, duration_secs) of the months
    not yet ``seen`` and of the current one (I4), with the content's format and resolution (``contents``: content_id,
    format, res; an unknown content is "other"), one row per key, upserted on the key: days that the source's window has
    lost stay.  Returns the months loaded (column ``month``)."""
    rows = stats.select(F.coalesce(F.col("content_id").cast("string"), F.lit("")).alias("content_id"),
                        F.coalesce("content_name", F.lit("")).alias("content_name"),
                        F.date_format(F.to_date("play_date"), "yyyy-MM-dd").alias("play_date"),
                        F.coalesce(to_long("play_count"), F.lit(0)).alias("play_count"),
                        F.coalesce(to_long("duration_secs"), F.lit(0)).alias("duration_secs"))
    rows = rows.withColumn("month", F.substring("play_date", 1, 7))
    available = rows.select("month").dropna().distinct()
    months = cut_lineage(months_to_fetch(available, seen, "month", current_month, force))
    meta = contents.select(F.col("content_id").cast("string").alias("content_id"), "format", F.col("res").alias("content_res"))
    rows = lookup_join(match_keys(rows, months, "month", "left_semi"), meta, "content_id", on_multi="first", order=["format", "content_res"])
    rows = rows.select(F.coalesce("format", F.lit(K.DEFAULT_FORMAT)).alias("format"), "content_id", "content_name",
                       F.coalesce("content_res", F.lit("")).alias("content_res"), "play_date", "play_count", "duration_secs")
    SK.write_upsert(spark, dedup(rows, POP_KEYS, order=["content_name", "play_count", "duration_secs"]), table_path, POP_KEYS)
    return months
