"""Run metrics read from Spark's event logs.

What a query cost is in the log its application wrote, whichever client started
it and however long ago.  ``logged_runs`` folds the logs of any number of
applications into the metrics table that ``perf_percentiles``, ``perf_assert``,
``perf_compare`` and ``perf_regression`` take.

Logs must be uncompressed (``spark.eventLog.compress=false``).  Runs are named by
their job group (``spark.jobGroup.id``), else by their description.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.operators.ordering import running_total

# Fields of the log's events that are read.
EVENTS = """
    Event string, executionId bigint, rootExecutionId bigint, description string, time bigint, errorMessage string,
    `Job ID` bigint, `Stage IDs` array<bigint>, Properties map<string, string>, `Stage ID` bigint,
    `Task Metrics` struct<
        `Executor CPU Time`: bigint, `JVM GC Time`: bigint, `Memory Bytes Spilled`: bigint, `Disk Bytes Spilled`: bigint,
        `Peak Execution Memory`: bigint,
        `Input Metrics`: struct<`Bytes Read`: bigint, `Records Read`: bigint>,
        `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: bigint, `Shuffle Records Written`: bigint>>
"""
_START, _END = "SparkListenerSQLExecutionStart", "SparkListenerSQLExecutionEnd"


def _tasks() -> dict[str, Column]:
    """Metric by name, folded over tasks."""
    of = F.col("`Task Metrics`").getField
    added = {
        "cpu_ms": of("Executor CPU Time") / 1e6,
        "gc_ms": of("JVM GC Time"),
        "bytes_scanned": of("Input Metrics").getField("Bytes Read"),
        "rows_scanned": of("Input Metrics").getField("Records Read"),
        "shuffle_bytes": of("Shuffle Write Metrics").getField("Shuffle Bytes Written"),
        "shuffle_rows": of("Shuffle Write Metrics").getField("Shuffle Records Written"),
        "spilled_bytes": of("Disk Bytes Spilled"),
    }
    return {**{name: F.sum(value.cast("double")) for name, value in added.items()}, "tasks": F.count(F.lit(1)).cast("double")}


def _peak() -> Column:
    return F.max(F.col("`Task Metrics`").getField("Peak Execution Memory").cast("double"))


def logged_runs(spark: SparkSession, path: str) -> DataFrame:
    """``query, run, metric, value`` of every finished query in the event logs at ``path`` (files, folders or a glob).

    Runs of one name are numbered from 1 in order of their start, over all
    applications.  Queries that a query starts count towards it, jobs outside any query
    (those that only learn a table's schema) towards none.  Every task attempt
    counts, failed ones too: they were paid for.  A failed query has ``failed`` 1, one
    without an end is left out, as is a last line that was cut off.  A stage is
    charged to the first query that names it; ``largest_task_bytes`` is the most
    execution memory that one task held.
    """
    # A rolled log is several files in one folder, and ids are only unique within an application.
    file = F.col("_metadata.file_path")
    rolled = F.regexp_extract(file, r"^(.*)/events_\d+_[^/]*$", 1)
    app = F.when(rolled != "", rolled).otherwise(file).alias("app")
    events = spark.read.schema(EVENTS).option("recursiveFileLookup", True).json(path).select(app, "*")
    kind = F.substring_index("Event", ".", -1)

    started = events.where(kind == _START).select(
        "app", "executionId", F.coalesce("rootExecutionId", "executionId").alias("execution"), "description", F.col("time").alias("start")
    )
    ended = events.where(kind == _END).select("app", "executionId", F.col("time").alias("end"), F.col("errorMessage").alias("error"))
    tops = started.where("execution = executionId").join(ended, ["app", "executionId"]).drop("executionId")

    jobs = events.where("Event = 'SparkListenerJobStart'").select(
        "app", "`Job ID`", F.col("Properties")["spark.sql.execution.id"].cast("bigint").alias("executionId"),
        F.col("Properties")["spark.jobGroup.id"].alias("named"), "`Stage IDs`",
    ).where("executionId IS NOT NULL")
    jobs = jobs.join(started.select("app", "executionId", "execution"), ["app", "executionId"])
    names = jobs.groupBy("app", "execution").agg(F.min("named").alias("named"))
    owners = jobs.select("app", "execution", "`Job ID`", F.explode("`Stage IDs`").alias("stage"))
    owners = owners.groupBy("app", "stage").agg(F.min_by("execution", "`Job ID`").alias("execution"))

    # Tasks fold to a row per stage before they meet anything.
    folds = _tasks()
    stages = events.where("Event = 'SparkListenerTaskEnd' AND `Task Metrics` IS NOT NULL").groupBy("app", F.col("`Stage ID`").alias("stage"))
    stages = stages.agg(*[fold.alias(name) for name, fold in folds.items()], _peak().alias("largest_task_bytes"))
    spent = stages.join(owners, ["app", "stage"]).groupBy("app", "execution")
    spent = spent.agg(*[F.sum(name).alias(name) for name in folds], F.max("largest_task_bytes").alias("largest_task_bytes"))

    runs = tops.join(names, ["app", "execution"], "left").join(spent, ["app", "execution"], "left")
    measured = {name: F.coalesce(F.col(name), F.lit(0.0)) for name in (*folds, "largest_task_bytes")}
    measured["elapsed_ms"] = (F.col("end") - F.col("start")).cast("double")
    measured["failed"] = F.when(F.coalesce("error", F.lit("")) != "", 1.0).otherwise(0.0)
    cells = F.array(*[F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in measured.items()])
    runs = runs.select(F.coalesce("named", "description").alias("query"), "start", "app", "execution", cells.alias("cells"), F.lit(1).alias("one"))
    # Sorted by ranges, as a name may have any number of runs.
    numbered = running_total(runs, ["query"], ["start", "app", "execution"], "one", "run")
    return numbered.select("query", F.col("run").cast("int").alias("run"), F.inline("cells"))
