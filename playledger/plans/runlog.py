"""C19 run-log facts: last run per log, its finish time, OK/FAIL counts and counters.

A log is a sequence of lines; a START marker opens a run.  The last run of each log starts at the log's
latest START marker, found with a grouped ``max_by`` (map-side combined) instead of a window over the
whole log, so one huge log never has to be sorted inside a single task.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_run(lines: DataFrame, log_col: str, order_cols: list[str], is_start, is_ok, is_fail,
             counter=None) -> DataFrame:
    """One row per log: run_no (number of START markers), started, finished (last line of the run),
    n_ok, n_fail, n_lines and the sum of ``counter`` (a numeric Column) within the last run."""
    pos = F.struct(*[F.col(c) for c in order_cols])
    marks = (lines.where(is_start)
                  .groupBy(log_col)
                  .agg(F.count(F.lit(1)).alias("run_no"), F.max(pos).alias("__start")))
    run = lines.join(marks, log_col).where(pos >= F.col("__start"))
    aggs = [F.max("run_no").alias("run_no"),
            F.min(pos).getField(order_cols[0]).alias("started"),
            F.max(pos).getField(order_cols[0]).alias("finished"),
            F.count_if(is_ok).alias("n_ok"), F.count_if(is_fail).alias("n_fail"), F.count(F.lit(1)).alias("n_lines")]
    if counter is not None:
        aggs.append(F.coalesce(F.sum(counter), F.lit(0)).alias("counter"))
    return run.groupBy(log_col).agg(*aggs)


# FIXED VALUES: line formats of the daily run log.
START_PATTERN = r"==== (\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) START ===="
DONE_PATTERN = r"==== (\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) DONE ===="
OK_PATTERN = r"^\s*OK\s+\S"
FAIL_PATTERN = r"^\s*FAIL\s+\S"
STEP_PATTERN = r"^\s*(?:OK|FAIL)\s+([^:]+?)\s*(?::.*)?$"
UPSERT_PATTERN = r"\[upsert_date\] \d{4}-\d{2}-\d{2}: ([\d ]+) wierszy -> lacznie ([\d ]+) w play_logs"
CAMPAIGNS_PATTERN = r"^\s*Kampanie: (\d+)\s*$"


def parse_run_log(text_lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Classify raw log lines (S17/F20): kind (start/done/fail/ok/other), the timestamp of markers, the step
    name of OK/FAIL lines, and the counters of upsert / campaign-count lines (digit groups may be
    space-separated)."""
    v = F.col(value_col)
    kind = (F.when(v.rlike(START_PATTERN), "start").when(v.rlike(DONE_PATTERN), "done")
             .when(v.rlike(FAIL_PATTERN), "fail").when(v.rlike(OK_PATTERN), "ok").otherwise("other"))
    ts = F.coalesce(F.nullif(F.regexp_extract(v, START_PATTERN, 1), F.lit("")),
                    F.nullif(F.regexp_extract(v, DONE_PATTERN, 1), F.lit("")))
    step = F.nullif(F.regexp_extract(v, STEP_PATTERN, 1), F.lit(""))

    def number(pattern, group):
        return F.nullif(F.regexp_replace(F.regexp_extract(v, pattern, group), " ", ""), F.lit("")).try_cast("bigint")

    return text_lines.select("*", kind.alias("kind"), F.try_to_timestamp(ts).alias("marker_ts"), step.alias("step"),
                             number(UPSERT_PATTERN, 1).alias("rows_added"), number(UPSERT_PATTERN, 2).alias("rows_total"),
                             number(CAMPAIGNS_PATTERN, 1).alias("campaigns"))


def run_log_facts(parsed: DataFrame, log_col: str = "log", order_col: str = "line_no") -> DataFrame:
    """C19 per log (from :func:`parse_run_log` rows): number of runs, start of the last run, its DONE time
    (NULL when the run did not finish), the last DONE anywhere in the log (when the data was last good),
    OK/FAIL line counts of the last run, and the first upsert / campaign counters of the last run."""
    o = F.col(order_col)
    marks = (parsed.where(F.col("kind") == "start").groupBy(log_col)
                   .agg(F.count(F.lit(1)).alias("run_no"), F.max(o).alias("__start"),
                        F.max_by("marker_ts", o).alias("started")))
    last_good = (parsed.where(F.col("kind") == "done").groupBy(log_col)
                       .agg(F.max_by("marker_ts", o).alias("last_good")))
    run = parsed.join(marks, log_col).where(o >= F.col("__start"))

    def first(col, cond):
        return F.min_by(F.col(col), F.when(cond, o))

    facts = run.groupBy(log_col).agg(
        F.max("run_no").alias("run_no"), F.max("started").alias("started"),
        first("marker_ts", F.col("kind") == "done").alias("done_at"),
        F.count_if(F.col("kind") == "ok").alias("n_ok"), F.count_if(F.col("kind") == "fail").alias("n_fail"),
        first("rows_added", F.col("rows_added").isNotNull()).alias("rows_added"),
        first("rows_total", F.col("rows_total").isNotNull()).alias("rows_total"),
        first("campaigns", F.col("campaigns").isNotNull()).alias("campaigns"))
    return facts.join(last_good, log_col, "left")
