from decimal import Decimal

import pytest

from paritas.operators import integrity, merge


@pytest.fixture(scope="module")
def invoices(spark):
    return spark.createDataFrame([(5000 + i, 100 + i, Decimal(f"{i}.00"), "kept") for i in range(1, 6)], "id bigint, contact bigint, amount decimal(12,2), note string")


@pytest.fixture(scope="module")
def changes(spark):
    rows = [(5001, 101, Decimal("9.99"), "U"), (5006, 106, Decimal("6.00"), "I"), (5005, 105, Decimal("5.00"), "D"), (7000, 1, Decimal("1.00"), "D"), (7001, 2, Decimal("2.00"), "U")]
    return spark.createDataFrame(rows, "id bigint, contact bigint, amount decimal(12,2), op string")


def test_merge_branches(invoices, changes):
    after = {r["id"]: (r["amount"], r["note"]) for r in merge.cdc_merge(invoices, changes, ["id"]).collect()}
    assert after.keys() == {5001, 5002, 5003, 5004, 5006, 7001}
    assert after[5001] == (Decimal("9.99"), "kept") and after[5006] == (Decimal("6.00"), None)
    split = {r["branch"]: r["n"] for r in merge.upsert_split(invoices, changes, ["id"]).collect()}
    assert split == {"kept": 3, "updated": 1, "deleted": 1, "inserted": 2, "ignored": 1}


def test_merge_matches_null_keys(spark):
    target = spark.createDataFrame([(None, 1), (2, 2)], "k int, v int")
    delta = spark.createDataFrame([(None, 9, "U")], "k int, v int, op string")
    assert {(r["k"], r["v"]) for r in merge.cdc_merge(target, delta, ["k"]).collect()} == {(None, 9), (2, 2)}


def test_idempotency_and_its_broken_twin(invoices, changes):
    compare = ["id", "contact", "amount"]
    good = merge.merge_idempotency(invoices, changes, ["id"], compare)
    assert {c["status"] for c in good.collect()} == {"PASS"}
    append = lambda t, d: t.unionByName(d.drop("op"), allowMissingColumns=True)
    bad = {c["target"]: c["status"] for c in merge.merge_idempotency(invoices, changes, ["id"], compare, append).collect()}
    assert bad == {"target": "FAIL", "target (deletes applied)": "FAIL"}
    assert {r["id"] for r in merge.deleted_keys_present(invoices, changes, ["id"]).collect()} == {5005}


def test_incremental_runs_do_not_overlap(spark):
    feed = spark.range(100).selectExpr("id", "id AS mark")
    table, audit = merge.incremental_append(feed.where("false"), feed, "mark", ["id"], [40, 70, 99])
    assert table.count() == 100
    rows = [(r["run"], r["rows_loaded"], r["duplicate_keys"], r["status"]) for r in audit.orderBy("run").collect()]
    assert rows == [(1, 41, 0, "SUCCESS"), (2, 30, 0, "SUCCESS"), (3, 29, 0, "SUCCESS")]


def test_incremental_runs_start_at_the_table(spark):
    feed = spark.createDataFrame([(i, i) for i in range(100)] + [(3, 50), (60, 61), (200, None)], "id bigint, mark bigint")
    table, audit = merge.incremental_append(feed.where("id < 5 AND mark < 5"), feed, "mark", ["id"], [40, 70])
    rows = [tuple(r) for r in audit.orderBy("run").collect()]
    # Behind the start: 5 rows; without a mark: 1; ahead of 70: 29.  Key 3 is in the table, key 60 comes twice in run 2.
    assert rows == [(1, "4", 36, 0, 5 + 1 + 29 + 32, "SUCCESS"), (2, "40", 32, 2, 5 + 1 + 29, "FAILED")]
    assert table.count() == 5 + 36 + 32


def test_several_changes_of_a_key_need_an_order(spark, invoices):
    twice = spark.createDataFrame([(5001, 1, Decimal("1.00"), "U", 1), (5001, 1, Decimal("2.00"), "U", 2)], "id bigint, contact bigint, amount decimal(12,2), op string, at int")
    with pytest.raises(Exception, match="several changes"):
        merge.cdc_merge(invoices, twice, ["id"]).collect()
    after = merge.cdc_merge(invoices, twice, ["id"], order=["at"]).where("id = 5001").collect()
    assert [r["amount"] for r in after] == [Decimal("2.00")]


def test_orphans_count_null_and_hot_keys(spark):
    child = spark.createDataFrame([(1,)] * 50 + [(9,)] * 30 + [(None,)] * 3, "k int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    row = integrity.fk_orphan_rate(child, parent, "k", "k").first()
    assert (row["orphans"], row["total"]) == (33, 83)
    assert {(r["key"], r["n_rows"]) for r in integrity.orphans(child, parent, "k", "k").collect()} == {(9, 30), (None, 3)}
    empty = integrity.fk_orphan_rate(child.where("false"), parent, "k", "k").first()
    assert (empty["orphans"], empty["total"], empty["rate"]) == (0, 0, 0.0)


def test_fk_orphan_gate(spark):
    child = spark.range(1000).selectExpr("id AS k")
    parent = spark.range(999).selectExpr("id AS k")
    full = spark.range(1000).selectExpr("id AS k")
    status = lambda **kw: [c["status"] for c in integrity.fk_orphan((child, full), (child, parent), "k", "k", **kw).collect()]
    assert status() == ["FAIL"]
    assert status(tolerance_pp=0.1) == ["PASS"]
    assert status(tolerance_pp=0.1, max_orphan_rate=0.05) == ["PASS", "FAIL"]


def test_unique_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert tuple(integrity.assert_unique(df, ["a", "b"]).first()) == (3, 2, 1)
    assert {tuple(r) for r in integrity.assert_no_nulls(df, ["a", "b"]).collect()} == {("a", 0), ("b", 2)}


def test_fk_types(spark):
    tables = {"c": spark.range(3).selectExpr("id AS k", "CAST(id AS STRING) AS s"), "p": spark.range(2).selectExpr("CAST(id AS INT) AS k")}
    found = integrity.fk_type_consistency(spark, tables, [("c", "k", "p", "k"), ("c", "s", "p", "k"), ("c", "zz", "p", "k")]).collect()
    assert [(r["status"], r["orphans"]) for r in found] == [("PASS", 1), ("FAIL", None), ("FAIL", None)]
