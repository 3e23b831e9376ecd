"""Declared inline tables: columns and rows written in a test or a spec."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.functions.types import logical_name

# Spark type of each declared logical type.
_SPARK_TYPES = {
    "INT64": "bigint",
    "FLOAT64": "double",
    "BOOL": "boolean",
    "STRING": "string",
    "TIMESTAMP": "timestamp",
    "DATETIME": "timestamp_ntz",
    "DATE": "date",
    "BYTES": "binary",
}
DEFAULT_SCALE = 9


def spark_type(column: Mapping) -> str:
    name = logical_name(column["type"])
    if name == "NUMERIC":
        return f"decimal(38,{column.get('scale', DEFAULT_SCALE)})"
    return _SPARK_TYPES.get(name, column["type"].lower())


def seed_given(spark: SparkSession, table: Mapping) -> DataFrame:
    """DataFrame of ``{columns: [{name, type, scale?, mode?}], rows: [{...}]}``.

    Values travel as text and are cast to the declared type, so decimals and
    instants may be written as strings; a ``REQUIRED`` column rejects NULL.
    """
    columns = table["columns"]
    rows = []
    for row in table["rows"]:
        values = []
        for c in columns:
            value = row.get(c["name"])
            if value is None and c.get("mode", "NULLABLE").upper() == "REQUIRED":
                raise ValueError(f"column {c['name']} is REQUIRED")
            values.append(None if value is None else str(value).lower() if isinstance(value, bool) else str(value))
        rows.append(tuple(values))
    layout = ", ".join(f"`{c['name']}` string" for c in columns)
    text = spark.createDataFrame(rows, layout)
    return text.select(*[F.col(f"`{c['name']}`").cast(spark_type(c)).alias(c["name"]) for c in columns])


def seed_all(spark: SparkSession, given: Mapping[str, Mapping | DataFrame]) -> dict[str, DataFrame]:
    """Every declared table; one that is already a DataFrame stays as it is."""
    return {name: t if isinstance(t, DataFrame) else seed_given(spark, t) for name, t in given.items()}
