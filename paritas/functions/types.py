"""Logical type names shared by legacy and target tables."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Accepted spellings of each logical type.
SPELLINGS = {
    "INT64": ("tinyint", "smallint", "int", "integer", "bigint", "int64"),
    "FLOAT64": ("float", "double", "double precision", "real", "float64"),
    "NUMERIC": ("decimal", "numeric", "bignumeric"),
    "STRING": ("string", "varchar", "char", "text"),
    "BYTES": ("binary", "bytes"),
    "BOOL": ("boolean", "bool"),
    "TIMESTAMP": ("timestamp",),
    "DATETIME": ("datetime", "timestamp_ntz"),
    "DATE": ("date",),
    "JSON": ("json", "variant"),
}
_LOGICAL = {spelling: name for name, spellings in SPELLINGS.items() for spelling in spellings}


def logical_name(spelling: str) -> str:
    """``DECIMAL(12,2)`` -> ``NUMERIC``, ``BIGINT`` -> ``INT64``; unknown names upper-cased."""
    base = re.split(r"[(<]", spelling.strip(), maxsplit=1)[0].strip().lower()
    return _LOGICAL.get(base, base.upper())


def signature(dtype: T.DataType, *, with_scale: bool = False) -> str:
    """Canonical nested type text, e.g. ``ARRAY<STRUCT<id:INT64,qty:INT64>>``."""
    if isinstance(dtype, T.ArrayType):
        return f"ARRAY<{signature(dtype.elementType, with_scale=with_scale)}>"
    if isinstance(dtype, T.StructType):
        inner = ",".join(f"{f.name.lower()}:{signature(f.dataType, with_scale=with_scale)}" for f in dtype.fields)
        return f"STRUCT<{inner}>"
    if isinstance(dtype, T.MapType):
        key = signature(dtype.keyType, with_scale=with_scale)
        return f"MAP<{key},{signature(dtype.valueType, with_scale=with_scale)}>"
    if isinstance(dtype, T.DecimalType) and with_scale:
        return f"NUMERIC({dtype.scale})"
    return logical_name(dtype.simpleString())


def leaf_paths(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    """Every field path with its type; array elements are written ``[]``, a map's sides ``{key}`` and ``{value}``."""
    out: list[tuple[str, T.DataType]] = []

    def visit(prefix: str, dtype: T.DataType) -> None:
        out.append((prefix, dtype))
        inner = dtype
        path = prefix
        while isinstance(inner, T.ArrayType):
            inner, path = inner.elementType, path + "[]"
        if isinstance(inner, T.StructType):
            for f in inner.fields:
                visit(f"{path}.{f.name.lower()}", f.dataType)
        if isinstance(inner, T.MapType):
            visit(f"{path}{{key}}", inner.keyType)
            visit(f"{path}{{value}}", inner.valueType)

    for f in schema.fields:
        visit(f.name.lower(), f.dataType)
    return out
