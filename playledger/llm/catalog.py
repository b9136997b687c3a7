"""Registered queries of the training-data operators: ``QUERIES[name] = (fn(spark, sf_dir), DuckDB SQL or None)``."""
from __future__ import annotations

QUERIES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql.strip() if sql else None)
        return fn
    return deco


def load_all() -> dict:
    from . import queries  # noqa: F401
    return QUERIES
