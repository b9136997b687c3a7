"""Schema conformance and name-aligned unions."""
from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SNAKE = re.compile(r"^[a-z_][a-z0-9_.]*$")


def _q(name: str):
    return F.col(f"`{name}`")


def conform(df: DataFrame, schema: T.StructType | str, rename: dict | None = None,
            strict_names: bool = False) -> DataFrame:
    """Project ``df`` onto a declared schema.

    ``rename`` maps source -> target names first; columns of the schema that are missing become typed
    NULLs; present ones are cast (try_cast: bad values become NULL instead of failing the job); extra
    columns are dropped; the output follows the schema's order.  ``strict_names`` refuses names that a
    name-mapped reader (a Hive-style catalog) cannot resolve.
    """
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    rename = rename or {}
    src = {rename.get(c, c): c for c in df.columns}
    cols = []
    for f in schema.fields:
        if strict_names and not _SNAKE.match(f.name):
            raise ValueError(f"column name {f.name!r} is not snake_case")
        if f.name in src:
            c = _q(src[f.name])
            cols.append(c.try_cast(f.dataType).alias(f.name) if not isinstance(f.dataType, T.StringType)
                        else c.cast("string").alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def project_existing(df: DataFrame, wanted: list[str], rename: dict | None = None) -> DataFrame:
    """Keep the listed columns that exist (in the listed order), optionally renamed."""
    rename = rename or {}
    return df.select(*[_q(c).alias(rename.get(c, c)) for c in wanted if c in df.columns])


def prefixed(df: DataFrame, *prefixes: str) -> list[str]:
    """Names of the columns that start with any prefix (``buy_``, ``perf_`` ...)."""
    return [c for c in df.columns if any(c.startswith(p) for p in prefixes)]


def drop_audit(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*(cols or [c for c in df.columns if c.startswith("_") and c.endswith("_at")]))


def stamp(df: DataFrame, col: str = "_gold_at") -> DataFrame:
    """Audit column: UTC ISO-8601 time of the write."""
    return df.withColumn(col, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def union_by_name(*dfs: DataFrame, tag: str | None = None, tags: list | None = None,
                  types: dict | None = None) -> DataFrame:
    """Union-all aligned by name; missing columns become NULL.

    ``tag``/``tags`` add a discriminator column (U2).  ``types`` casts named columns on every input
    first, so a column that is text on one side and number on the other unions cleanly (M15).
    """
    parts = []
    for i, d in enumerate(dfs):
        if types:
            d = d.select(*[(_q(c).try_cast(types[c]) if types[c] != "string" else _q(c).cast("string")).alias(c)
                           if c in types else _q(c) for c in d.columns])
        if tag is not None:
            d = d.withColumn(tag, F.lit(tags[i] if tags else i))
        parts.append(d)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
