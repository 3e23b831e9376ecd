"""Transforms under test: run them on declared inputs and judge the output."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.operators.integrity import assert_no_nulls, assert_unique
from paritas.operators.parity import multiset_counts
from paritas.operators.report import ERROR, as_checks, check_row, error_text, verdict
from paritas.sources.files import load
from paritas.sources.inline import seed_all

SCRATCH_PREFIX = "scratch_build"
_SCRATCH_PROPERTY = "ephemeral"
_CREATE_AS = re.compile(r"\s*CREATE\s+(?:OR\s+REPLACE\s+)?TABLE\s+([\w.`]+)\s+AS\s+", re.IGNORECASE)


def _plain(sql: str) -> str:
    """The statement without comment lines and trailing semicolon."""
    kept = [line for line in sql.splitlines() if not line.strip().startswith("--")]
    return "\n".join(kept).strip().rstrip(";")


def query_of(sql: str) -> tuple[str | None, str]:
    """Target table, if the text is ``CREATE … TABLE x AS``, and the query itself."""
    text = _plain(sql)
    match = _CREATE_AS.match(text)
    return (match.group(1).strip("`"), text[match.end():]) if match else (None, text)


@contextmanager
def visible(tables: Mapping[str, DataFrame]) -> Iterator[None]:
    """Make the tables readable by name while a query is analysed; the caller's views of these names come back after."""
    spark = next(iter(tables.values())).sparkSession
    taken = {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary}
    before = {name: spark.table(name) for name in tables if name.lower() in taken}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        for name, df in before.items():
            df.createOrReplaceTempView(name)


def run_transform(spark: SparkSession, given: Mapping[str, Mapping | DataFrame], sql: str) -> DataFrame:
    """Result of ``sql`` over the given tables; its plan keeps no link to their names."""
    with visible(seed_all(spark, given)):
        return spark.sql(query_of(sql)[1])


def _aligned(expected: DataFrame, actual: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Expected values written as text, read as the actual column's date or instant."""
    out = []
    for c in columns:
        value, dtype = F.col(c), actual.schema[c].dataType if c in actual.columns else None
        if isinstance(expected.schema[c].dataType, T.StringType) and isinstance(
            dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)
        ):
            value = F.coalesce(value.try_cast(dtype.simpleString()).cast("string"), value)
            if not isinstance(dtype, T.DateType):
                value = F.regexp_replace(value, r"\.\d+$", "")
        out.append(value.alias(c))
    return expected.select(*out)


def _message(missing: Column, unexpected: Column) -> Column:
    return F.concat(missing.cast("string"), F.lit(" missing, "), unexpected.cast("string"), F.lit(" unexpected"))


def _multiset_check(expected: DataFrame, actual: DataFrame, columns: Sequence[str], pattern: str, name: str) -> DataFrame:
    totals = multiset_counts(expected, actual, columns, coerce_numeric_strings=True)
    return as_checks(
        totals,
        pattern,
        target=F.lit(name),
        status=verdict((F.col("missing") == 0) & (F.col("unexpected") == 0)),
        message=_message(F.col("missing"), F.col("unexpected")),
        expected=F.lit("0 missing, 0 unexpected"),
        actual=_message(F.col("missing"), F.col("unexpected")),
    )


def _assertion(actual: DataFrame, table: str, spec: Mapping) -> DataFrame:
    if "rowcount" in spec:
        want = spec["rowcount"]
        n = actual.agg(F.count(F.lit(1)).alias("n"))
        return as_checks(
            n, "transform_unit", target=F.lit(f"{table}.rowcount"), status=verdict(F.col("n") == want),
            message=F.lit("row count"), expected=F.lit(want), actual=F.col("n"),
        )
    if "unique" in spec:
        keys = list(spec["unique"])
        found = assert_unique(actual, keys)
        return as_checks(
            found, "transform_unit", target=F.lit(f"{table}.unique({', '.join(keys)})"),
            status=verdict(F.col("n_rows") == F.col("n_distinct")), message=F.lit("distinct keys"),
            expected=F.col("n_rows"), actual=F.col("n_distinct"),
        )
    if "no_nulls" in spec:
        return as_checks(
            assert_no_nulls(actual, list(spec["no_nulls"])), "transform_unit",
            target=F.concat(F.lit(table + "."), F.col("column"), F.lit(" no_nulls")),
            status=verdict(F.col("nulls") == 0), message=F.lit("NULLs"), expected=F.lit(0), actual=F.col("nulls"),
        )
    return check_row(actual.sparkSession, "transform_unit", table, ERROR, f"unknown assert: {sorted(spec)}")


def transform_unit(
    spark: SparkSession, given: Mapping[str, Mapping | DataFrame], sql: str, expect: Mapping, *, name: str | None = None
) -> DataFrame:
    """Run ``sql`` over ``given`` and check ``expect``: ``{table, rows?, assert?}``.

    ``rows`` (a list of dicts, or a DataFrame) is compared as a multiset over
    the columns it names.  ``assert`` lists ``rowcount``, ``unique``, ``no_nulls``.
    """
    table = expect["table"]
    try:
        actual = run_transform(spark, given, sql)
        checks = []
        if "rows" in expect:
            rows = expect["rows"]
            if isinstance(rows, DataFrame):
                expected = rows
            else:
                names = sorted({k for r in rows for k in r})
                text = [tuple(None if r.get(c) is None else str(r[c]) for c in names) for r in rows]
                expected = spark.createDataFrame(text, ", ".join(f"`{c}` string" for c in names))
            names = sorted(expected.columns)
            missing = [c for c in names if c not in actual.columns]
            shown = actual.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])
            checks.append(_multiset_check(_aligned(expected, shown, names), shown, names, "transform_unit", table))
        checks += [_assertion(actual, table, a) for a in expect.get("assert", [])]
        return reduce(DataFrame.unionByName, checks)
    except Exception as e:  # noqa: BLE001 - a transform that cannot run is an ERROR check
        return check_row(spark, "transform_unit", name or table, ERROR, error_text(e))


def transform_diff(
    spark: SparkSession,
    given: Mapping[str, Mapping | DataFrame],
    legacy_sql: str,
    migrated_sql: str,
    *,
    name: str = "transform_diff",
) -> DataFrame:
    """The rewritten query must return the legacy query's rows.

    Columns come from the legacy result, lower-cased; columns only the rewrite
    has are reported as a measurement.
    """
    try:
        legacy, migrated = (run_transform(spark, given, q) for q in (legacy_sql, migrated_sql))
        legacy, migrated = (df.toDF(*[c.lower() for c in df.columns]) for df in (legacy, migrated))
    except Exception as e:  # noqa: BLE001
        return check_row(spark, "transform_diff", name, ERROR, error_text(e))
    checks = _multiset_check(legacy, migrated, sorted(legacy.columns), "transform_diff", name)
    added = sorted(set(migrated.columns) - set(legacy.columns))
    if added:
        checks = checks.unionByName(
            check_row(spark, "transform_diff", f"{name} (added columns)", "PASS", ", ".join(added), measurement=True)
        )
    return checks


# -- migrations into a scratch database ----------------------------------------


class ScratchGuardError(RuntimeError):
    """A database that is not a scratch database was named."""


def _guard(database: str) -> None:
    if database != SCRATCH_PREFIX and not database.startswith(SCRATCH_PREFIX + "_"):
        raise ScratchGuardError(f"{database!r} is not a scratch database ({SCRATCH_PREFIX} or {SCRATCH_PREFIX}_*)")


def provision(spark: SparkSession, database: str = SCRATCH_PREFIX, location: str | None = None) -> None:
    """Drop and recreate a scratch database; refuses one without the scratch mark."""
    _guard(database)
    if spark.catalog.databaseExists(database):
        facts = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {database}").collect()}
        if _SCRATCH_PROPERTY not in (facts.get("Properties") or ""):
            raise ScratchGuardError(f"{database!r} exists without the scratch mark")
        spark.sql(f"DROP DATABASE {database} CASCADE")
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE {database}{at} WITH DBPROPERTIES ('{_SCRATCH_PROPERTY}' = 'true')")


def teardown(spark: SparkSession, database: str) -> None:
    _guard(database)
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def _apply(spark: SparkSession, database: str, step: Mapping) -> None:
    kind = step.get("kind")
    if kind == "load":
        df = load(spark, step["from"], step.get("format", "CSV"), step.get("schema"), **step.get("options", {}))
        df.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{step['target']}")
    elif kind in ("ddl", "transform"):
        target, query = query_of(step["sql_text"])
        target = step.get("target") or target
        if target is None:
            spark.sql(query)
        else:
            spark.sql(query).write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{target.split('.')[-1]}")
    else:
        raise ValueError(f"unsupported migration step kind {kind!r}")


def build_and_verify(
    spark: SparkSession,
    steps: Sequence[Mapping],
    suites: Sequence,
    database: str = SCRATCH_PREFIX,
    location: str | None = None,
) -> DataFrame:
    """Apply ``steps`` in order inside a fresh scratch database, then run ``suites``.

    A step is ``{kind: ddl | load | transform, sql_text?, from?, format?, target?}``;
    unqualified names resolve to the scratch database.  A failing step stops the
    build with one ERROR check and nothing is verified.  Each suite is a function
    of the session that returns checks.
    """
    before = spark.catalog.currentDatabase()
    provision(spark, database, location)
    try:
        spark.catalog.setCurrentDatabase(database)
        for i, step in enumerate(steps):
            try:
                _apply(spark, database, step)
            except Exception as e:  # noqa: BLE001
                return check_row(spark, "build", f"step {i + 1} ({step.get('kind')})", ERROR, error_text(e))
        return reduce(DataFrame.unionByName, [suite(spark) for suite in suites])
    finally:
        spark.catalog.setCurrentDatabase(before)
