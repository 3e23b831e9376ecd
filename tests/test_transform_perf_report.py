import pytest
from pyspark.sql import functions as F

from paritas.operators import parity, perf, report, transform
from paritas.session import release_scratch, scratch_path
from paritas.sources.files import write_partitioned

GIVEN = {
    "raw": {
        "columns": [{"name": "id", "type": "INT64"}, {"name": "ms", "type": "INT64"}, {"name": "amount", "type": "NUMERIC"}, {"name": "op", "type": "STRING"}],
        "rows": [{"id": 1, "ms": 1767225600000, "amount": "10.50", "op": "I"}, {"id": 2, "ms": 1767312000000, "amount": "3", "op": "U"}, {"id": 3, "ms": 0, "amount": "1", "op": "D"}],
    }
}
SQL = "-- comment\nCREATE OR REPLACE TABLE out AS\nSELECT id, amount, timestamp_millis(ms) AS at FROM raw WHERE op IN ('I', 'U');"


def summary(checks):
    return {c["target"]: c["status"] for c in checks.collect()}


def test_transform_unit_golden(spark):
    expect = {
        "table": "out",
        "rows": [{"id": 1, "amount": "10.5", "at": "2026-01-01T00:00:00Z"}, {"id": 2, "amount": 3, "at": "2026-01-02T00:00:00Z"}],
        "assert": [{"rowcount": 2}, {"unique": ["id"]}, {"no_nulls": ["id", "at"]}],
    }
    assert set(summary(transform.transform_unit(spark, GIVEN, SQL, expect)).values()) == {"PASS"}


def test_transform_unit_twins(spark):
    wrong = {"table": "out", "rows": [{"id": 1}, {"id": 1}, {"id": 9}], "assert": [{"rowcount": 3}, {"sorted": ["id"]}]}
    found = transform.transform_unit(spark, GIVEN, SQL, wrong).collect()
    assert [c["status"] for c in found] == ["FAIL", "FAIL", "ERROR"]
    assert found[0]["actual"] == "2 missing, 1 unexpected"
    assert summary(transform.transform_unit(spark, GIVEN, "SELECT nope FROM raw", {"table": "out"})) == {"out": "ERROR"}
    assert not spark.catalog.tableExists("raw")


def test_transform_diff(spark):
    legacy = "SELECT op, count(*) AS N FROM raw GROUP BY op"
    good = transform.transform_diff(spark, GIVEN, legacy, "SELECT op, sum(1) AS n, 7 AS extra FROM raw GROUP BY op")
    assert summary(good) == {"transform_diff": "PASS", "transform_diff (added columns)": "PASS"}
    bad = transform.transform_diff(spark, GIVEN, legacy, "SELECT op, sum(1) AS n FROM raw WHERE id < 3 GROUP BY op")
    assert summary(bad) == {"transform_diff": "FAIL"}


def test_build_stops_at_the_first_error_and_guards_names(spark, tmp_path):
    seeded = transform.seed_all(spark, GIVEN)["raw"]
    seeded.write.json(str(tmp_path / "raw"))
    steps = [{"kind": "load", "from": str(tmp_path / "raw"), "format": "JSON", "schema": seeded.schema, "target": "raw"}, {"kind": "transform", "sql_text": SQL}]
    suite = lambda s: parity.rowcount_parity(seeded.where("op != 'D'"), s.table("out"), name="out")
    run = lambda steps: transform.build_and_verify(spark, steps, [suite], "scratch_build_t", scratch_path(spark, "b"))
    assert summary(run(steps)) == {"out": "PASS"}
    assert summary(run(steps[:1] + [{"kind": "transform", "sql_text": "SELECT broken FROM raw", "target": "out"}] + steps[1:])) == {"step 2 (transform)": "ERROR"}
    assert summary(run([{"kind": "external"}])) == {"step 1 (external)": "ERROR"}
    for name in ("prod", "scratch_builder", "default"):
        with pytest.raises(transform.ScratchGuardError):
            transform.provision(spark, name)
    spark.sql(f"CREATE DATABASE scratch_build_real LOCATION '{tmp_path / 'real'}'")
    with pytest.raises(transform.ScratchGuardError):
        transform.provision(spark, "scratch_build_real")
    transform.teardown(spark, "scratch_build_t")
    assert not spark.catalog.databaseExists("scratch_build_t") and spark.catalog.currentDatabase() == "default"


def test_percentiles_are_nearest_rank(spark):
    import math

    data = {("a", "ms"): [5.0, 1.0, 9.0, 9.0, 2.0, 7.0, 3.0], ("a", "bytes"): [4.0], ("b", "ms"): [float(i % 17) for i in range(100)]}
    rows = [(q, i, m, v) for (q, m), vs in data.items() for i, v in enumerate(vs)] + [("a", 99, "ms", None)]
    df = spark.createDataFrame(rows, perf.METRIC_SCHEMA)
    got = {(r["query"], r["metric"]): (r["runs"], r["p50"], r["p95"], r["max_value"], r["min_value"]) for r in perf.perf_percentiles(df).collect()}
    pick = lambda vs, p: sorted(vs)[max(0, math.ceil(p / 100 * len(vs)) - 1)]
    assert got == {k: (len(vs), pick(vs, 50), pick(vs, 95), max(vs), min(vs)) for k, vs in data.items()}


def test_gates(spark):
    df = spark.createDataFrame([("a", 1, "ms", 100.0), ("b", 1, "ms", 60.0), ("b", 1, "bytes", 5.0)], perf.METRIC_SCHEMA)
    assert summary(perf.perf_assert(df, [("a", "ms", 100), ("a", "bytes", 1), ("b", "bytes", 4)])) == {"a:ms": "PASS", "a:bytes": "FAIL", "b:bytes": "FAIL"}
    compare = lambda text: summary(perf.perf_compare(df, "a", "b", {"ms": text}))["a->b:ms"]
    assert [compare(t) for t in ("b <= a", "b <= a * 0.5", "b > a", "report")] == ["PASS", "FAIL", "FAIL", "PASS"]
    assert summary(perf.perf_compare(df, "a", "b", {"bytes": "report"})) == {"a->b:bytes": "FAIL"}
    with pytest.raises(ValueError):
        perf.perf_compare(df, "a", "b", {"ms": "a < b"})
    assert {c["measurement"] for c in perf.measured(df).collect()} == {True}
    base = spark.createDataFrame([("a", "ms", 90.0)], "query string, metric string, value double")
    found = perf.perf_regression(df, base, {"ms": "10%"}).collect()
    assert {(c["target"], c["status"], c["measurement"]) for c in found} == {("a:ms", "FAIL", False), ("b:ms", "PASS", True)}
    assert summary(perf.perf_regression(df, base, {"ms": "20%"}))["a:ms"] == "PASS"


def test_scan_reduction_reads_fewer_files(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(spark.range(5000).selectExpr("id", "id % 10 AS p"), path, ["p"], ["id"])
    table = spark.read.parquet(path)
    check = perf.scan_reduction(table.agg(F.sum("id")), table.where("p = 3").agg(F.sum("id")), name="prune").first()
    assert check["status"] == "PASS" and int(check["metrics"]["filtered_files"]) < int(check["metrics"]["full_files"])
    assert perf.scan_reduction(table.agg(F.sum("id")), table.agg(F.sum("id")), name="same").first()["status"] == "FAIL"
    perf.require_partition_filter(table.where("p = 3"))
    with pytest.raises(perf.PartitionFilterRequired):
        perf.require_partition_filter(table.where("id = 3"))


def test_rollup_and_coverage(spark):
    rows = [report.check_row(spark, p, "t", s, suite_id=suite) for p, s, suite in
            [("rowcount_parity", "PASS", "x"), ("rowcount_parity", "FAIL", "x"), ("fk_orphan", "FAIL", "y"), ("fk_orphan", "ERROR", "y"), ("query_parity", "PASS", "z")]]
    checks = report.reconcile(rows)
    assert {(r["suite_id"], r["status"], r["n_pass"], r["n_fail"], r["n_error"]) for r in report.report_rollup(checks).collect()} == {
        ("x", "FAIL", 1, 1, 0), ("y", "ERROR", 0, 1, 1), ("z", "PASS", 1, 0, 0)}
    assert {r["status"] for r in report.criteria_rows(checks).collect()} == {"pass", "fail", "error"}
    gaps = {(r["name"], r["pattern"]) for r in report.coverage_gaps(checks).where("gap = 'flow'").collect()}
    assert ("Consumer Migration", "query_parity") not in gaps and ("Transform", "rowcount_parity") not in gaps
    assert ("Transform", "fk_orphan") in gaps


def test_scratch_is_released(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    spark.range(3).write.parquet(path)
    assert release_scratch(spark) >= 1
    with pytest.raises(Exception):
        spark.read.parquet(path)
