"""The checks table every validation returns, and what is folded from it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PASS, FAIL, ERROR = "PASS", "FAIL", "ERROR"

CHECK_SCHEMA = (
    "pattern string, suite_id string, target string, status string, message string, "
    "expected string, actual string, measurement boolean, story_id string, "
    "criteria_index int, metrics map<string,string>"
)

# The patterns each flow group needs at sign-off.
FLOW_REQUIRED = {
    "Target Schema": ("epoch_conversion", "schema_conformance"),
    "Extract-Load": ("decimal_roundtrip", "bulk_load"),
    "Transform": (
        "rowcount_parity",
        "aggregate_parity",
        "fingerprint_parity",
        "epoch_conversion",
        "scd2_continuity",
        "merge_idempotency",
        "fk_orphan",
    ),
    "Consumer Migration": ("query_parity",),
    "Egress": ("egress_parity",),
    "Historical Backfill": (
        "rowcount_parity",
        "aggregate_parity",
        "fingerprint_parity",
        "epoch_conversion",
        "scd2_continuity",
        "fk_orphan",
    ),
}
PATTERNS = (
    "schema_conformance",
    "rowcount_parity",
    "aggregate_parity",
    "fingerprint_parity",
    "query_parity",
    "bulk_load",
    "epoch_conversion",
    "decimal_roundtrip",
    "scd2_continuity",
    "merge_idempotency",
    "fk_orphan",
    "egress_parity",
    "query_performance",
    "transform_unit",
    "transform_diff",
)


def verdict(ok: Column) -> Column:
    return F.when(ok, F.lit(PASS)).otherwise(F.lit(FAIL))


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _fields(
    pattern: str,
    *,
    target: Column,
    status: Column,
    message: Column | None = None,
    expected: Column | None = None,
    actual: Column | None = None,
    measurement: Column | None = None,
    metrics: Mapping[str, Column] | None = None,
    suite_id: str | None = None,
    story_id: str | None = None,
    criteria_index: int | None = None,
) -> list[Column]:
    def text(c: Column | None, name: str) -> Column:
        return F.expr(f"CAST(NULL AS STRING) AS {name}") if c is None else c.cast("string").alias(name)

    pairs = [x for k, v in (metrics or {}).items() for x in (F.lit(k), v.cast("string"))]
    return [
        F.expr(f"{_literal(pattern)} AS pattern"),
        F.expr(f"{_literal(suite_id or pattern)} AS suite_id"),
        target.alias("target"),
        status.alias("status"),
        text(message, "message"),
        text(expected, "expected"),
        text(actual, "actual"),
        F.expr("false AS measurement") if measurement is None else measurement.alias("measurement"),
        F.expr(f"CAST({_literal(story_id)} AS STRING) AS story_id"),
        F.expr(f"CAST({_literal(criteria_index)} AS INT) AS criteria_index"),
        (F.create_map(*pairs) if pairs else F.expr("map()")).cast("map<string,string>").alias("metrics"),
    ]


def as_checks(df: DataFrame, pattern: str, **fields) -> DataFrame:
    """Shape the rows of ``df`` as checks; ``fields`` are ``target``, ``status`` and
    optionally the other columns of the checks table."""
    return df.select(*_fields(pattern, **fields))


def several_checks(df: DataFrame, pattern: str, specs: Iterable[Mapping], **labels) -> DataFrame:
    """Several checks per row of ``df``, which is computed once.

    Each spec holds the fields of :func:`as_checks`, and ``when`` if the check
    is made only under a condition.
    """
    cells = []
    for spec in specs:
        rest = {k: v for k, v in spec.items() if k != "when"}
        cells.append(F.struct(*_fields(pattern, **rest, **labels), spec.get("when", F.lit(True)).alias("_made")))
    return df.select(F.inline(F.array(*cells))).where("_made").drop("_made")


def check_fields(pattern: str, target: str, status: str, message: str = "", **fields) -> tuple:
    """The row of a check known on the driver; collect rows and make one table of them with :func:`check_table`."""
    row = {
        "pattern": pattern,
        "suite_id": fields.pop("suite_id", None) or pattern,
        "target": target,
        "status": status,
        "message": message,
        "measurement": fields.pop("measurement", False),
        "metrics": {k: str(v) for k, v in fields.pop("metrics", {}).items()},
        "story_id": fields.pop("story_id", None),
        "criteria_index": fields.pop("criteria_index", None),
    }
    row.update({k: None if v is None else str(v) for k, v in fields.items()})
    return tuple(row.get(c.split()[0]) for c in CHECK_SCHEMA.split(", "))


def check_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """One local table of checks, however many."""
    return spark.createDataFrame(list(rows), CHECK_SCHEMA)


def check_row(spark: SparkSession, pattern: str, target: str, status: str, message: str = "", **fields) -> DataFrame:
    """One check known on the driver, such as a load that could not start."""
    return check_table(spark, [check_fields(pattern, target, status, message, **fields)])


def error_text(e: Exception) -> str:
    """Type and first line of an error."""
    return f"{type(e).__name__}: {(str(e).splitlines() or [''])[0]}"


def reconcile(suites: Iterable[DataFrame]) -> DataFrame:
    """All suites' checks as one sign-off table."""
    return reduce(DataFrame.unionByName, suites)


def report_rollup(checks: DataFrame) -> DataFrame:
    """Per suite: the worst status and the number of checks in each."""
    severity = F.when(F.col("status") == ERROR, 2).when(F.col("status") == FAIL, 1).otherwise(0)
    counts = [F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in (PASS, FAIL, ERROR)]
    rolled = checks.groupBy("suite_id", "pattern").agg(F.max(severity).alias("_worst"), *counts)
    status = F.when(F.col("_worst") == 2, ERROR).when(F.col("_worst") == 1, FAIL).otherwise(PASS)
    return rolled.select("suite_id", "pattern", status.alias("status"), "n_pass", "n_fail", "n_error")


def criteria_rows(checks: DataFrame) -> DataFrame:
    """Flat per-criterion rows: one per check, status in lower case."""
    return checks.select(
        "story_id",
        "criteria_index",
        "pattern",
        "target",
        F.lower("status").alias("status"),
        F.col("message").alias("detail"),
    )


def coverage_gaps(
    checks: DataFrame,
    flows: Mapping[str, Iterable[str]] = FLOW_REQUIRED,
    patterns: Iterable[str] = PATTERNS,
) -> DataFrame:
    """Patterns without a passing check: ``gap`` is ``pattern`` or ``flow``."""
    spark = checks.sparkSession
    wanted = [("pattern", p, p) for p in patterns]
    wanted += [("flow", flow, p) for flow, needed in flows.items() for p in needed]
    required = spark.createDataFrame(wanted, "gap string, name string, pattern string")
    passed = checks.where(F.col("status") == PASS).select("pattern").distinct()
    return required.join(passed, "pattern", "left_anti").select("gap", "name", "pattern")
