import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paritas.operators import encoding, history

UTC = dt.timezone.utc


def test_epochs_outside_the_range_become_null_not_errors(spark):
    df = spark.createDataFrame([(1, 1700000000123), (2, 99999999999999999), (3, -5), (4, None), (5, 2**63 - 1)], "id bigint, raw bigint")
    got = dict(map(tuple, df.select("id", encoding.epoch_to_timestamp(F.col("raw"), "millis").cast("string")).collect()))
    assert got == {1: "2023-11-14 22:13:20.123", 2: None, 3: None, 4: None, 5: None}
    audit = encoding.epoch_quarantine(df, "id", "raw", "millis", table="t").collect()
    assert {r["row_id"]: r["reason"] for r in audit}.keys() == {2, 3, 4, 5}
    assert spark.range(1).select(encoding.epoch_to_timestamp(F.lit(1700000000), "seconds").cast("string")).first()[0] == "2023-11-14 22:13:20"


def test_epoch_outcomes_and_audit(spark):
    source = spark.createDataFrame(
        [(1, 1700000000999), (2, 99999999999999999), (3, -5), (4, None), (5, 1700000000000), (6, 1700000), (7, 1700000000000)], "id bigint, raw bigint"
    )
    at = dt.datetime(2023, 11, 14, 22, 13, 20)
    target = spark.createDataFrame(
        [(1, at), (2, None), (3, at), (4, None), (5, at + dt.timedelta(seconds=1)), (6, dt.datetime(1970, 1, 1, 0, 28, 20)), (8, at)], "id bigint, ts timestamp"
    )
    args = (source, target, "id", "raw", "ts", "millis")
    found = {r["id"]: r["outcome"] for r in encoding.classify_epochs(*args, expect_years=(2000, 2030)).collect()}
    assert found == {1: "matched", 2: "nulled", 3: "not_nulled", 4: "null_source", 5: "mismatch", 6: "lying_column", 7: "mismatch", 8: "target_only"}
    audit = encoding.epoch_quarantine(source, "id", "raw", "millis", table="s").where("row_id != 3")
    checks = encoding.epoch_check(*args, expect_years=(2000, 2030), audit=audit, source_table="s").collect()
    assert [(c["target"], c["status"], c["actual"]) for c in checks] == [("target", "FAIL", "4"), ("target (audit)", "FAIL", "2")]
    good = source.where("id IN (1, 2, 4)"), target.where("id IN (1, 2, 4)")
    assert encoding.epoch_check(*good, "id", "raw", "ts", "millis").first()["status"] == "PASS"


def test_decimals_are_counted_per_column(spark):
    a = spark.createDataFrame([(1, Decimal("1.50"), Decimal("2.00")), (2, Decimal("3.00"), None)], "id int, x decimal(9,2), y decimal(9,2)")
    b = spark.createDataFrame([(1, 1.5, Decimal("2.01")), (9, 1.0, None)], "id int, x double, y decimal(9,4)")
    checks = {c["target"]: (c["status"], c["actual"]) for c in encoding.decimal_roundtrip(a, b, ["id"], ["x", "y"]).collect()}
    assert checks == {"target.x": ("FAIL", "1"), "target.y": ("FAIL", "1")}
    rows = {(r["id"], r["column"]): (r["source_value"], r["target_value"]) for r in encoding.decimal_differences(a, b, ["id"], ["x", "y"]).collect()}
    assert rows == {(1, "y"): ("2", "2.01"), (2, "x"): ("3", None)}


def test_vendor_timestamp(spark):
    df = spark.createDataFrame([("20240229133059",), ("garbage",)], "s string")
    assert [r[0] for r in df.select(encoding.vendor_timestamp(F.col("s")).cast("string")).collect()] == ["2024-02-29 13:30:59", None]


@pytest.fixture(scope="module")
def versions(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    end = dt.datetime(9999, 12, 31)
    rows = [
        (101, "a", day(1), day(5), False), (101, "b", day(5), end, True),  # sound
        (201, "a", day(1), day(3), True), (201, "b", day(3), end, True),  # two current
        (202, "a", day(1), day(2), False), (202, "b", day(4), end, True),  # gap
        (203, "a", day(1), end, False), (203, "b", day(2), day(9), True),  # overlap, wrong ends
        (204, "a", day(1), None, False), (204, "b", day(2), end, True),  # open gap
        (205, None, day(1), end, True),
    ]
    df = spark.createDataFrame(rows, "who bigint, name string, eff_from timestamp, eff_to timestamp, cur boolean")
    hashed = history.row_hash(df, ["who", "name", "cur"])
    return df.withColumn("h", F.when(F.col("who") == 202, F.lit("bad")).otherwise(hashed)).cache()


def test_scd2_findings_name_the_entities(versions):
    gaps = history.scd2_gaps(versions, "who", "eff_from", "eff_to")
    assert {r["who"] for r in gaps.collect()} == {202, 203, 204}
    assert {r["who"]: r["n_current"] for r in history.scd2_current(versions, "who", "eff_to", "cur").collect()} == {201: 2}
    assert {r["who"] for r in history.scd2_terminal(versions, "who", "eff_to", "cur").collect()} == {203}
    assert {r["who"] for r in history.row_hash_mismatches(versions, "who", "h", ["who", "name", "cur"]).collect()} == {202}
    checks = history.scd2_continuity(
        versions, "who", "eff_from", "eff_to", "cur", row_hash_column="h", hash_columns=["who", "name", "cur"]
    )
    assert {c["target"]: c["actual"] for c in checks.collect()} == {
        "target (gaps)": "3", "target (current)": "1", "target (terminal)": "2", "target (row_hash)": "2"
    }
    sound = versions.where("who IN (101, 205)")
    golden = history.scd2_continuity(sound, "who", "eff_from", "eff_to", "cur", row_hash_column="h", hash_columns=["who", "name", "cur"], source=sound)
    assert {c["status"] for c in golden.collect()} == {"PASS"}


def test_row_hash_text(spark):
    import hashlib

    df = spark.createDataFrame([(1, None, True, "x")], "a int, b string, c boolean, d string")
    assert df.select(history.row_hash(df, df.columns)).first()[0] == hashlib.md5(b"1|None|True|x").hexdigest()


def test_cdc_latest_breaks_ties_by_extract(spark):
    df = spark.createDataFrame([(1, "I", 5, "a"), (1, "U", 5, "b"), (1, "D", 4, "z"), (2, "I", 1, "a")], "k int, op string, change_ms bigint, extract_ts string")
    assert {(r["k"], r["op"]) for r in history.cdc_latest(df, ["k"]).collect()} == {(1, "U"), (2, "I")}
