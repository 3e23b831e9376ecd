"""Run metrics of queries: fold, gate, compare, and prove that filters skip data."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.functions.tolerance import allowed
from paritas.operators.ordering import running_total
from paritas.operators.report import FAIL, PASS, as_checks, verdict
from paritas.session import durable

METRIC_SCHEMA = "query string, run bigint, metric string, value double"


def _scan_metrics(plan, subqueries: bool = True) -> dict[str, int]:
    """Sum of file-scan metrics over an executed plan and its subqueries."""
    totals = {"files_read": 0, "bytes_scanned": 0, "rows_scanned": 0}
    names = {"numFiles": "files_read", "filesSize": "bytes_scanned", "numOutputRows": "rows_scanned"}
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    if subqueries:  # nested ones are listed too
        found = plan.subqueriesAll()
        for sub in (found.apply(i) for i in range(found.size())):
            if sub.getClass().getSimpleName() != "ReusedSubqueryExec":
                inner = _scan_metrics(sub, False)
                totals = {k: totals[k] + inner[k] for k in totals}
    nodes = plan.collectLeaves()
    for i in range(nodes.size()):
        node = nodes.apply(i)
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            inner = _scan_metrics(node, subqueries)
            totals = {k: totals[k] + inner[k] for k in totals}
        elif kind.endswith("QueryStageExec"):
            inner = _scan_metrics(node.plan())
            totals = {k: totals[k] + inner[k] for k in totals}
        elif kind == "FileSourceScanExec":
            for metric, name in names.items():
                found = node.metrics().get(metric)
                if found.isDefined():
                    totals[name] += found.get().value()
        elif kind in ("ReusedExchangeExec",):
            continue
        elif node.children().size():
            inner = _scan_metrics(node)
            totals = {k: totals[k] + inner[k] for k in totals}
    return totals


def run_once(df: DataFrame) -> dict[str, float]:
    """Execute ``df`` on the cluster, discard its rows, and return its metrics."""
    started = time.perf_counter()
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    elapsed = (time.perf_counter() - started) * 1000
    return {**_scan_metrics(execution.executedPlan()), "elapsed_ms": elapsed}


def perf_measure(spark: SparkSession, queries: Mapping[str, Callable[[], DataFrame]], runs: int = 1) -> DataFrame:
    """Metrics table of every query, run ``runs`` times on a fresh plan."""
    rows = [
        (name, run, metric, float(value))
        for name, build in queries.items()
        for run in range(1, runs + 1)
        for metric, value in run_once(build()).items()
    ]
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def perf_percentiles(metrics: DataFrame) -> DataFrame:
    """``query, metric, runs, p50, p95, max_value, min_value`` by the nearest-rank rule.

    Equal values are counted first; ranks come from a running total of those
    counts, so no group is held in one buffer.
    """
    keys = ["query", "metric"]
    counted = metrics.where(F.col("value").isNotNull()).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_n"))
    counted = durable(counted, "metric_values")  # read three times below
    totals = counted.groupBy(*keys).agg(
        F.sum("_n").alias("runs"), F.max("value").alias("max_value"), F.min("value").alias("min_value")
    )
    ranked = running_total(counted, keys, ["value"], "_n", "_upto")
    r, t = ranked.alias("r"), totals.alias("t")
    same = F.col("r.query").eqNullSafe(F.col("t.query")) & F.col("r.metric").eqNullSafe(F.col("t.metric"))
    joined = r.join(t, same).select("r.query", "r.metric", "value", "_upto", "runs", "max_value", "min_value")

    def nearest(percent: int) -> Column:
        # ceil(p/100 * runs) in whole numbers, at least 1
        place = F.greatest(F.floor((F.col("runs") * percent + 99) / 100), F.lit(1))
        return F.min(F.when(F.col("_upto") >= place, F.col("value")))

    return joined.groupBy(*keys, "runs", "max_value", "min_value").agg(
        nearest(50).alias("p50"), nearest(95).alias("p95")
    ).select(*keys, "runs", "p50", "p95", "max_value", "min_value")


def _values(metrics: DataFrame) -> DataFrame:
    """The comparable value of each metric: its p95."""
    return perf_percentiles(metrics).select("query", "metric", F.col("p95").alias("value"))


def measured(metrics: DataFrame) -> DataFrame:
    """Record the p95 of every metric as a passing check that gates nothing."""
    return as_checks(
        _values(metrics),
        "query_performance",
        target=F.concat_ws(":", "query", "metric"),
        status=F.lit(PASS),
        message=F.lit("measured"),
        actual=F.col("value"),
        measurement=F.lit(True),
    )


def perf_assert(metrics: DataFrame, thresholds: Sequence[tuple[str, str, float]]) -> DataFrame:
    """Every (query, metric, limit) must hold; a metric that was not measured fails."""
    spark = metrics.sparkSession
    limits = spark.createDataFrame([(q, m, float(x)) for q, m, x in thresholds], "query string, metric string, max_value double")
    joined = F.broadcast(limits).join(_values(metrics), ["query", "metric"], "left")
    return as_checks(
        joined,
        "query_performance",
        target=F.concat_ws(":", "query", "metric"),
        status=verdict(F.coalesce(F.col("value") <= F.col("max_value"), F.lit(False))),
        message=F.when(F.col("value").isNull(), "metric unavailable").otherwise("threshold"),
        expected=F.col("max_value"),
        actual=F.col("value"),
    )


_CONDITION = re.compile(r"\s*b\s*(<=|<|>=|>)\s*a(?:\s*\*\s*([\d.]+))?\s*")


def perf_compare(metrics: DataFrame, a: str, b: str, conditions: Mapping[str, str]) -> DataFrame:
    """Gate query ``b`` against ``a`` per metric.

    A condition is ``b <= a``, ``b < a * 1.25`` and the like, or ``report``,
    which records the ratio without gating.
    """
    spark = metrics.sparkSession
    rows = []
    for metric, text in conditions.items():
        if text.strip() == "report":
            rows.append((metric, "report", 1.0))
            continue
        parsed = _CONDITION.fullmatch(text)
        if parsed is None:
            raise ValueError(f"bad compare condition {text!r}")
        rows.append((metric, parsed.group(1), float(parsed.group(2) or 1.0)))
    wanted = spark.createDataFrame(rows, "metric string, op string, factor double")
    pick = lambda q: F.max(F.when(F.col("query") == q, F.col("value")))
    values = _values(metrics).where(F.col("query").isin(a, b)).groupBy("metric").agg(pick(a).alias("a"), pick(b).alias("b"))
    joined = F.broadcast(wanted).join(values, "metric", "left")
    x, limit, op = F.col("b"), F.col("a") * F.col("factor"), F.col("op")
    holds = F.when(op == "<=", x <= limit).when(op == "<", x < limit).when(op == ">=", x >= limit).when(op == ">", x > limit)
    measured = F.col("a").isNotNull() & F.col("b").isNotNull()
    ok = measured & F.coalesce((op == "report") | holds, F.lit(False))
    return as_checks(
        joined,
        "query_performance",
        target=F.concat(F.lit(f"{a}->{b}:"), F.col("metric")),
        status=verdict(ok),
        message=F.when(~measured, "metric unavailable").otherwise(op),
        expected=limit,
        actual=x,
        measurement=(op == "report") & measured,
    )


def perf_regression(metrics: DataFrame, baseline: DataFrame, tolerances: Mapping[str, str]) -> DataFrame:
    """Metrics must not exceed the baseline (``query, metric, value``) plus tolerance.

    A query the baseline does not know establishes it: that check passes as a
    measurement and its value is the one to store.
    """
    def wide(values: DataFrame, suffix: str) -> DataFrame:
        picks = [F.max(F.when(F.col("metric") == m, F.col("value"))).alias(f"{suffix}{i}") for i, m in enumerate(tolerances)]
        return values.groupBy("query").agg(*picks, F.lit(True).alias(f"_{suffix}"))

    # One row per query on each side: a metric that is missing stays visible as NULL.
    both = wide(_values(metrics), "now").join(wide(baseline, "base"), "query", "left")
    fresh = F.col("_base").isNull()
    cells = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"now{i}").alias("value"),
            (F.col(f"base{i}") + allowed(spec, F.col(f"base{i}"))).alias("max_value"),
        )
        for i, (m, spec) in enumerate(tolerances.items())
    ]
    return as_checks(
        both.select("query", fresh.alias("fresh"), F.inline(F.array(*cells))),
        "query_performance",
        target=F.concat_ws(":", "query", "metric"),
        status=verdict(F.col("fresh") | F.coalesce(F.col("value") <= F.col("max_value"), F.lit(False))),
        message=F.when(F.col("fresh"), "baseline established").otherwise("baseline"),
        expected=F.col("max_value"),
        actual=F.col("value"),
        measurement=F.col("fresh"),
    )


class PartitionFilterRequired(RuntimeError):
    """A query reads a table without the partition filter it demands."""


def require_partition_filter(df: DataFrame) -> DataFrame:
    """Return ``df`` if every partitioned file scan in its plan prunes partitions."""
    plan = df._jdf.queryExecution().sparkPlan()
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "FileSourceScanExec":
            continue
        partitioned = leaf.relation().partitionSchema().size() > 0
        if partitioned and leaf.partitionFilters().size() == 0:
            raise PartitionFilterRequired("this table must be read with a filter on its partition column")
    return df


def scan_reduction(full: DataFrame, filtered: DataFrame, *, name: str) -> DataFrame:
    """One check: the filtered query reads fewer bytes than the full one."""
    spark = full.sparkSession
    a, b = run_once(full), run_once(filtered)
    rows = [(name, int(a["bytes_scanned"]), int(b["bytes_scanned"]), int(a["files_read"]), int(b["files_read"]))]
    df = spark.createDataFrame(rows, "name string, full_bytes bigint, filtered_bytes bigint, full_files bigint, filtered_files bigint")
    return as_checks(
        df,
        "query_performance",
        target=F.col("name"),
        status=F.when(F.col("filtered_bytes") < F.col("full_bytes"), PASS).otherwise(FAIL),
        message=F.format_string("%d of %d files read", "filtered_files", "full_files"),
        expected=F.concat(F.lit("<"), F.col("full_bytes").cast("string")),
        actual=F.col("filtered_bytes"),
        metrics={c: F.col(c) for c in ("full_bytes", "filtered_bytes", "full_files", "filtered_files")},
    )


# -- estimates without running -----------------------------------------------------


class TooExpensive(RuntimeError):
    """A query or a generated table would be larger than its limit."""


def _size_of(text: str) -> int:
    """Bytes of a size as the optimiser prints it, like ``1.5 MiB``."""
    number, _, unit = text.partition(" ")
    return round(float(number) * 1024 ** ("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB").index(unit))


def _listed(plan) -> tuple[int, int]:
    """Files and bytes that the file scans of a planned query list, subqueries included; nothing is run or opened."""
    files = size = 0
    found = plan.subqueriesAll()
    for at in [plan, *(found.apply(i) for i in range(found.size()))]:
        leaves = at.collectLeaves()
        for leaf in (leaves.apply(i) for i in range(leaves.size())):
            if leaf.getClass().getSimpleName() == "FileSourceScanExec":
                files += leaf.selectedPartitions().totalNumberOfFiles()
                size += leaf.selectedPartitions().totalFileSize()
    return files, size


def estimate(df: DataFrame) -> dict[str, int]:
    """What a query would read, without running it: ``files``, ``bytes_scanned`` and ``result_bytes``.

    Files are those left after the planner pruned partitions, with their lengths as
    listed.  Scans whose filter is only known at run time count whole.  The
    result's size is the optimiser's statistic for the plan's top.
    """
    files, size = _listed(df._jdf.queryExecution().sparkPlan())
    plan = df.sparkSession.sql("EXPLAIN COST SELECT * FROM {df}", df=df).first()[0]
    top = re.search(r"sizeInBytes=([\d.]+(?:E\+\d+)? \w+)", plan)
    return {"files": files, "bytes_scanned": size, "result_bytes": _size_of(top.group(1)) if top else 0}


def within_limit(df: DataFrame, max_bytes: int) -> DataFrame:
    """``df``, unless it would scan more than ``max_bytes``."""
    expected = estimate(df)["bytes_scanned"]
    if expected > max_bytes:
        raise TooExpensive(f"the query would scan {expected} bytes; the limit is {max_bytes}")
    return df


def perf_dry_run(queries: Mapping[str, DataFrame], max_bytes: int | None = None, factor: float = 1.0) -> DataFrame:
    """Checks that each query's estimate is within ``factor`` of what a run scans, and, with a limit, below it.

    The second kind is a gate that runs nothing; the first runs each query once.
    """
    spark = next(iter(queries.values())).sparkSession
    rows = []
    for name, df in queries.items():
        expected = estimate(df)
        found = run_once(df)["bytes_scanned"]
        rows.append((name, expected["files"], expected["bytes_scanned"], int(found)))
    table = spark.createDataFrame(rows, "name string, files bigint, expected bigint, found bigint")
    close = F.col("expected").between(F.col("found") / factor, F.col("found") * factor)
    checks = as_checks(
        table, "query_performance", target=F.concat("name", F.lit(":estimate")), status=verdict(close),
        message=F.format_string("%d files", "files"), expected=F.col("expected"), actual=F.col("found"),
    )
    if max_bytes is None:
        return checks
    return checks.unionByName(
        as_checks(
            table, "query_performance", target=F.concat("name", F.lit(":limit")), status=verdict(F.col("expected") <= max_bytes),
            message=F.lit("not run"), expected=F.lit(f"<={max_bytes}"), actual=F.col("expected"),
        )
    )


def cluster_reduction(full: DataFrame, filtered: DataFrame, *, name: str) -> DataFrame:
    """One check: file and row-group statistics let the filtered query read fewer rows than the full one.

    Rows are those the scans hand on, after row groups and pages were skipped and
    before the filter is applied to each.
    """
    a, b = run_once(full), run_once(filtered)
    rows = [(name, int(a["rows_scanned"]), int(b["rows_scanned"]))]
    df = full.sparkSession.createDataFrame(rows, "name string, full_rows bigint, filtered_rows bigint")
    return as_checks(
        df,
        "query_performance",
        target=F.col("name"),
        status=verdict(F.col("filtered_rows") < F.col("full_rows")),
        message=F.format_string("%d of %d rows read", "filtered_rows", "full_rows"),
        expected=F.concat(F.lit("<"), F.col("full_rows").cast("string")),
        actual=F.col("filtered_rows"),
    )
