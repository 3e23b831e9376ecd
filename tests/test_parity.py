import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paritas.operators import parity

SCHEMA = "id bigint, contact bigint, amount decimal(12,2), at timestamp"


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(2000).selectExpr(
        "id", "id % 70 AS contact", "CAST(id / 8 AS DECIMAL(12,2)) AS amount", "timestamp_seconds(1700000000 + id) AS at"
    ).cache()


def status(checks):
    return {r["target"]: r["status"] for r in checks.collect()}


def test_rowcount_golden_and_twin(table):
    assert status(parity.rowcount_parity(table, table)) == {"target": "PASS"}
    short = table.where("id >= 3")
    assert status(parity.rowcount_parity(table, short)) == {"target": "FAIL"}
    assert status(parity.rowcount_parity(table, short, "3")) == {"target": "PASS"}
    assert status(parity.rowcount_parity(table, short, "0.1%")) == {"target": "FAIL"}
    assert status(parity.rowcount_parity(table, short, "0.2%")) == {"target": "PASS"}
    assert status(parity.rowcount_parity(table, short, source_filter="id >= 3")) == {"target": "PASS"}


def test_aggregates_name_the_broken_one(table):
    wanted = [
        {"column": "amount", "fn": "sum"}, {"column": "id", "fn": "count"}, {"column": "contact", "fn": "count_distinct"},
        {"column": "at", "fn": "max", "tolerance": "2"}, {"column": "at", "fn": "min"},
    ]
    assert set(status(parity.aggregate_parity(table, table, wanted)).values()) == {"PASS"}
    later = table.withColumn("at", F.col("at") + F.expr("INTERVAL 1 SECOND"))
    found = status(parity.aggregate_parity(table, later, wanted))
    assert found["target.at:min"] == "FAIL" and found["target.at:max"] == "PASS" and found["target.amount:sum"] == "PASS"
    micros = table.withColumn("at", F.col("at") + F.expr("INTERVAL 0.4 SECOND"))
    assert set(status(parity.aggregate_parity(table, micros, wanted)).values()) == {"PASS"}
    empty = table.where("false")
    assert status(parity.aggregate_parity(empty, empty, [{"column": "amount", "fn": "sum"}])) == {"target.amount:sum": "PASS"}
    as_double = table.withColumn("amount", F.col("amount").cast("double"))
    assert status(parity.aggregate_parity(table, as_double, [{"column": "amount", "fn": "sum"}])) == {"target.amount:sum": "PASS"}


@pytest.mark.parametrize("seed", range(3))
def test_exactly_the_perturbed_keys_are_found(spark, table, seed):
    rng = random.Random(seed)
    picked = rng.sample(range(2000), 30)
    gone, changed, added = picked[:10], picked[10:20], [100_000 + k for k in picked[20:]]
    extra = spark.createDataFrame([(k, 1, Decimal("1.00"), None) for k in added], SCHEMA)
    amount = F.when(F.col("id").isin(changed), F.col("amount") + Decimal("0.01")).otherwise(F.col("amount")).cast("decimal(12,2)")
    target = table.where(~F.col("id").isin(gone)).withColumn("amount", amount).unionByName(extra)
    want = {**{k: "missing" for k in gone}, **{k: "changed" for k in changed}, **{k: "extra" for k in added}}
    columns = ["id", "contact", "amount", "at"]
    for found in (parity.diff_keys(table, target, ["id"], columns), parity.localised_differences(table, target, ["id"], columns, 16)):
        assert {r["id"]: r["difference"] for r in found.collect()} == want
    checks = parity.fingerprint_parity(table, target, columns, ["id"]).collect()
    assert [c["status"] for c in checks] == ["FAIL", "FAIL"]
    assert checks[1]["actual"] == "30"
    first = [r["id"] for r in parity.diff_sample(parity.diff_keys(table, target, ["id"], columns), ["id"], 5).collect()]
    assert first == sorted(want)[:5]


def test_equal_tables_have_no_differences(table):
    shuffled = table.repartition(5).select("at", "amount", "contact", "id")
    columns = ["id", "contact", "amount", "at"]
    assert parity.localised_differences(table, shuffled, ["id"], columns).count() == 0
    assert [c["status"] for c in parity.fingerprint_parity(table, shuffled, columns, ["id"]).collect()] == ["PASS"]


def test_empty_tables_and_one_sided_emptiness(table):
    columns, none = ["id", "contact"], table.where("false")
    status_of = lambda a, b: [c["status"] for c in parity.fingerprint_parity(a, b, columns, ["id"]).collect()]
    assert status_of(none, none) == ["PASS"]
    assert status_of(table, none) == ["FAIL", "FAIL"]
    keyless = parity.fingerprint_parity(none, none, columns).first()["expected"]
    assert parity.fingerprint_parity(none, none, columns, ["id"]).first()["expected"] == keyless
    assert parity.fingerprint_parity(table, table, columns, ["id"]).first()["expected"] == parity.fingerprint_parity(table, table, columns).first()["expected"]


def test_first_keys_are_named_in_key_order(table):
    found = parity.fingerprint_parity(table, table.where("id NOT IN (9, 10, 100)"), ["id", "contact"], ["id"]).collect()[1]
    assert found["metrics"]["differing_keys"] == "9, 10, 100"


def test_duplicate_keys_compare_as_multisets(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (1, "x"), (2, "z"), (2, "z"), (None, "n")], "k int, v string")
    found = parity.diff_keys(a, b, ["k"], ["k", "v"]).collect()
    assert [tuple(r) for r in found] == [(2, "changed", 1, 2)]


def test_multiset_diff_keeps_multiplicity(spark):
    a = spark.createDataFrame([(1,), (1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(1,), (3,), (3,)], "v bigint")
    found = {(r["row_text"], r["difference"], r["copies"]) for r in parity.multiset_diff(a, b).collect()}
    assert found == {("1", "missing", 2), ("2", "missing", 1), ("3", "unexpected", 2)}
    assert tuple(parity.multiset_counts(a, b).first()) == (3, 2)
    assert tuple(parity.multiset_counts(a, a).first()) == (0, 0)


def test_query_parity_modes(spark, table):
    n = lambda d: d.agg(F.count(F.lit(1)).alias("n"))
    assert status(parity.query_parity(n(table), n(table.limit(1990)), "scalar", "1%")) == {"query": "PASS"}
    assert status(parity.query_parity(n(table), n(table.limit(1990)), "scalar")) == {"query": "FAIL"}
    null = spark.sql("SELECT CAST(NULL AS INT) AS v")
    assert status(parity.query_parity(null, null, "scalar")) == {"query": "PASS"}
    assert status(parity.query_parity(spark.sql("SELECT 'a' AS v"), spark.sql("SELECT 'b' AS v"), "scalar")) == {"query": "FAIL"}
    extra = table.withColumn("more", F.lit(1))
    assert status(parity.query_parity(table, extra)) == {"query": "FAIL"}
    assert status(parity.query_parity(table, table.repartition(3))) == {"query": "PASS"}
