"""Registered queries: one per operator / job of SURVEY §2, each with its DuckDB oracle.

``QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, oracle_sql or None)``.  Every query reads the whole
driver tables (or data Spark derives from them); nothing is sampled or capped unless the operator *is*
a top-k / sample.  Column names are identical on both sides.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = (fn, sql.strip() if sql else None)
        return fn
    return deco


def load_all() -> dict:
    # importing the modules registers their queries
    from . import q_core, q_io, q_jobs, q_merge, q_more, q_ops, q_sinks  # noqa: F401
    return QUERIES
