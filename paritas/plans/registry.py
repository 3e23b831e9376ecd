"""Registered queries and the SQL that restates each one."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.plans.inputs import DEALT, DEALT_ROWS, STAND_INS, TABLES
from paritas.session import pin_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_NAME = re.compile(r"\{(\w+)\}")
# Spellings that differ: [ms:c] epoch milliseconds, [sec:c] epoch seconds, [key:c] yyyyMMdd.
_MACRO = re.compile(r"\[(ms|sec|key):([\w.]+)\]")
_SPARK = {
    "ms": "unix_millis(CAST({0} AS TIMESTAMP))",
    "sec": "unix_seconds(CAST({0} AS TIMESTAMP))",
    "key": "CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS BIGINT)",
}
_DUCKDB = {
    "ms": "(epoch_us({0}) // 1000)",
    "sec": "(epoch_us({0}) // 1000000)",
    "key": _SPARK["key"],
}


def _expand(sql: str, dialect: dict[str, str]) -> str:
    return _MACRO.sub(lambda m: dialect[m.group(1)].format(m.group(2)), sql)


class Inputs:
    """The driver tables of one scale factor and the stand-ins derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = pin_utc(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in STAND_INS:
            return self.sql(STAND_INS[name], **self._dealt(name))
        raise AttributeError(name)

    def sql(self, text: str, **tables: DataFrame) -> DataFrame:
        """``text`` over the tables and stand-ins it names, or over those given instead."""
        names = set(_NAME.findall(text))
        return self.spark.sql(_expand(text, _SPARK), **{n: tables[n] if n in tables else getattr(self, n) for n in names})

    def _dealt(self, name: str) -> dict[str, DataFrame]:
        if name not in DEALT:
            return {}
        source, columns = DEALT[name]
        table = getattr(self, source)
        parts = max(self.spark.sparkContext.defaultParallelism, 1 + table.count() // DEALT_ROWS)
        return {source: table.repartition(parts, *[F.expr(_expand(c, _SPARK)) for c in columns])}


def plain(df: DataFrame) -> DataFrame:
    """Dates and instants as text, decimals as doubles, so every client reads them alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


def oracle(body: str) -> str:
    """DuckDB text of ``body`` with every stand-in it names as a CTE."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in _NAME.findall(text):
            if name in STAND_INS and name not in order:
                need(STAND_INS[name])
                order.append(name)

    need(body)
    flat = lambda text: _NAME.sub(lambda m: m.group(1), _expand(text, _DUCKDB)).strip()
    ctes = [f"{name} AS (\n{flat(STAND_INS[name])}\n)" for name in order]
    # A comment may lead the query; what follows decides how its CTEs are joined.
    text = "\n".join(line for line in flat(body).splitlines() if not line.strip().startswith("--")).strip()
    recursive = text.upper().startswith("WITH RECURSIVE")
    if text.upper().startswith("WITH"):
        text = text[len("WITH RECURSIVE" if recursive else "WITH"):].strip()
        head = ",\n".join(ctes) + (",\n" if ctes else "")
        return f"WITH {'RECURSIVE ' if recursive else ''}{head}{text}"
    return (f"WITH {','.join(ctes)}\n" if ctes else "") + text


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under ``name`` with its restatement."""

    def decorate(fn: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(Inputs(spark, folder)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return decorate
