"""JSON columns: flatten with a declared schema (F7), envelope unwrap (S11/S12), nested -> text."""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flatten_fields(struct: T.StructType, prefix: str, path: str):
    for f in struct.fields:
        name = f"{prefix}{f.name}"
        p = f"{path}.`{f.name}`"
        if isinstance(f.dataType, T.StructType):
            yield from _flatten_fields(f.dataType, name + ".", p)
        else:
            yield p, name


def unpack_json(df: DataFrame, col: str, schema: T.StructType | str | None = None, prefix: str | None = None,
                keep_source: bool = False) -> DataFrame:
    """Parse a JSON text column with a *declared* schema into flat ``prefix + key`` columns.

    Nested objects become dotted names (``perf_goal.amount``).  Unparsable text gives NULLs (the
    permissive parser), and a JSON scalar keeps the row instead of dropping every expanded column.  Without a
    schema the keys are discovered first; if no row holds an object the column is left as it is.
    """
    if schema is None:
        # the keys that exist, as the source system does (declared schemas are preferred in production)
        schema = infer_json_schema(df, col)
        if not schema.fields:
            return df
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    prefix = f"{col}_" if prefix is None else prefix
    tmp = f"__{col}_parsed"
    parsed = df.withColumn(tmp, F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"}))
    flat = [F.col(f"{tmp}{p}").alias(name)
            for p, name in _flatten_fields(schema, prefix, "")]
    keep = [F.col(f"`{c}`") for c in df.columns if keep_source or c != col]
    return parsed.select(*keep, *flat)


def infer_json_schema(df: DataFrame, col: str) -> T.StructType:
    """Discover the union of the object keys of a JSON text column (one distributed aggregate, one schema
    string back to the driver).  Unparsable text is ignored; a column with no objects gives an empty struct."""
    parsed = df.select(F.try_parse_json(F.col(col)).alias("v"))
    # a scalar or an array beside the objects would make the common schema a bare VARIANT
    objects = parsed.where(F.schema_of_variant("v").startswith("OBJECT<"))
    found = objects.select(F.schema_of_variant_agg("v").alias("s")).first()["s"]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType([])
    # the type's name differs from DDL; names in backticks are keys and stay
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found)
    return T.DataType.fromDDL(ddl)


def unwrap(df: DataFrame, col: str, paths: list[str], element_type: str = "variant") -> DataFrame:
    """Explode the first array found under any of ``paths`` (JSON paths like ``$.data``) of a JSON text
    column; one output row per element, the element kept as ``item`` (VARIANT or a cast type)."""
    v = F.try_parse_json(F.col(col))
    arr = F.coalesce(*[F.try_variant_get(v, p, f"array<{element_type}>") for p in paths])
    return df.select("*", F.explode(arr).alias("item"))


def nested_to_json(df: DataFrame) -> DataFrame:
    """Struct / array / map columns -> JSON text, schema-driven (others unchanged)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            out.append(F.to_json(F.col(f"`{f.name}`")).alias(f.name))
        elif isinstance(f.dataType, T.VariantType):
            out.append(F.to_json(F.col(f"`{f.name}`")).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def json_path(c, path: str) -> Column:
    """Scalar at a JSON path of a text column, as text."""
    return F.get_json_object(F.col(c) if isinstance(c, str) else c, path)
