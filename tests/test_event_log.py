"""Metrics from event logs of an application of its own."""

import json
import subprocess
import sys

import pytest

from paritas.operators import perf
from paritas.operators.event_log import logged_runs

APPLICATION = """
import sys
from pyspark.sql import SparkSession, functions as F
shared, rolling = sys.argv[1:]
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", shared + "/log").config("spark.eventLog.compress", "false")
    .config("spark.eventLog.rolling.enabled", rolling).getOrCreate())
context = spark.sparkContext
context.setLogLevel("ERROR")
data = shared + "/data-" + rolling
spark.range(0, 5000, 1, 4).selectExpr("id", "id % 7 AS k").write.partitionBy("k").parquet(data)
for run in range(3):
    context.setJobGroup("all of it", "")
    spark.read.parquet(data).groupBy("k").agg(F.sum("id")).collect()
context.setJobGroup("one part", "")
spark.read.parquet(data).where("k = 3").groupBy("k").agg(F.sum("id")).collect()
context.setJobGroup("fails", "")
try:
    spark.range(10).select(F.raise_error(F.lit("no")).cast("int")).collect()
except Exception:
    pass
spark.stop()
"""


@pytest.fixture(scope="module")
def logs(tmp_path_factory):
    shared = tmp_path_factory.mktemp("logged")
    (shared / "log").mkdir()
    for rolling in ("true", "false"):
        subprocess.run([sys.executable, "-c", APPLICATION, str(shared), rolling], check=True, capture_output=True, timeout=120)
    return shared / "log"


def test_runs_of_two_applications(spark, logs):
    rows = logged_runs(spark, str(logs)).where("query IN ('all of it', 'one part', 'fails')").collect()
    value = {(r["query"], r["run"], r["metric"]): r["value"] for r in rows}
    assert len(value) == len(rows)
    assert {k[:2] for k in value} == {*(("all of it", i) for i in range(1, 7)), *((q, i) for q in ("one part", "fails") for i in (1, 2))}
    for run in range(1, 7):
        assert value["all of it", run, "rows_scanned"] == 5000 and value["all of it", run, "failed"] == 0
        assert value["all of it", run, "shuffle_bytes"] > 0 and value["all of it", run, "elapsed_ms"] > 0
    assert all(value["one part", run, "rows_scanned"] in (714, 715) for run in (1, 2))
    assert value["one part", 1, "bytes_scanned"] < value["all of it", 1, "bytes_scanned"]
    assert value["fails", 1, "failed"] == value["fails", 2, "failed"] == 1


def test_tasks_equal_a_reading_line_by_line(spark, logs):
    cpu = tasks = 0
    for file in sorted(f for f in logs.rglob("*") if f.is_file() and not f.name.startswith((".", "appstatus"))):
        lines = [json.loads(line) for line in file.read_text().splitlines()]
        jobs = [e for e in lines if e["Event"] == "SparkListenerJobStart" and e["Properties"].get("spark.jobGroup.id") == "all of it"]
        jobs = [e for e in jobs if "spark.sql.execution.id" in e["Properties"]]  # others read a table's schema
        stages = {s for e in jobs for s in e["Stage IDs"]}
        ends = [e for e in lines if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages]
        tasks += len(ends)
        cpu += sum(e["Task Metrics"]["Executor CPU Time"] for e in ends) / 1e6
    got = {r["metric"]: r["value"] for r in logged_runs(spark, str(logs)).where("query = 'all of it'").groupBy("metric").agg({"value": "sum"}).toDF("metric", "value").collect()}
    assert got["tasks"] == tasks > 0 and got["cpu_ms"] == pytest.approx(cpu)


def test_logged_runs_feed_the_gates(spark, logs):
    metrics = logged_runs(spark, str(logs))
    checks = perf.perf_assert(metrics, [("all of it", "rows_scanned", 5000.0), ("all of it", "rows_scanned", 4999.0), ("absent", "rows_scanned", 1.0)])
    assert [c["status"] for c in checks.collect()] == ["PASS", "FAIL", "FAIL"]


def test_a_line_that_was_cut_and_a_query_without_end(spark, tmp_path):
    start = {"Event": "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart", "executionId": 0, "description": "d", "time": 5}
    end = {"Event": "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd", "executionId": 0, "time": 9}
    lines = [json.dumps(e) for e in (start, {**start, "executionId": 1}, end, end)]
    (tmp_path / "app").write_text("\n".join(lines[:3]) + "\n" + lines[3][:40])
    rows = {(r["query"], r["run"], r["metric"]): r["value"] for r in logged_runs(spark, str(tmp_path)).collect()}
    assert rows["d", 1, "elapsed_ms"] == 4 and rows["d", 1, "tasks"] == 0 and {k[1] for k in rows} == {1}
