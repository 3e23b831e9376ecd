import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paritas.plans import marts, registry


def test_first_contact_resolution_equals_the_pairwise_join(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        # One customer holds a third of all contacts; instants repeat.
        who = "hot" if i % 3 == 0 else (None if i % 31 == 0 else f"c{rng.randrange(25)}")
        at = start + dt.timedelta(hours=rng.randrange(24 * 40))
        rows.append((i, who, at, at + dt.timedelta(hours=rng.randrange(3)), rng.random() < 0.5, 20240100 + rng.randrange(3), rng.randrange(2)))
    fact = spark.createDataFrame(rows, "interaction_id int, customer_ref string, start_ts timestamp, end_ts timestamp, resolved_flag boolean, date_key int, program_sk int")
    week = dt.timedelta(days=7)
    repeats = {r[0]: sum(1 for q in rows if q[1] == r[1] and r[1] is not None and r[3] < q[2] <= r[3] + week) for r in rows if r[4]}
    got = {r["interaction_id"]: r["n_repeats"] for r in marts.repeats_after(fact).collect()}
    assert got == repeats
    want = {}
    for r in rows:
        if r[4]:
            total, first = want.get((r[5], r[6]), (0, 0))
            want[(r[5], r[6])] = (total + max(1, repeats[r[0]]), first + (repeats[r[0]] == 0))
    view = marts.first_contact_resolution(fact).collect()
    assert {(r["date_key"], r["program_sk"]): (r["resolved_interactions"], r["fcr_count"]) for r in view} == want


def test_org_hierarchy_depth_and_missing_parents(spark):
    rows = [(i, i - 1 if i else None, f"u{i}") for i in range(10)] + [(50, 99, "lost"), (60, None, "other"), (61, 60, "leaf")]
    rows += [(70, 72, "ring"), (71, 70, "ring"), (72, 71, "ring"), (73, 72, "below a ring")]
    units = spark.createDataFrame(rows, "org_unit_id bigint, parent_unit_id bigint, unit_name string").selectExpr(
        "*", "unit_name AS unit_code", "'T' AS unit_type", "'S' AS site_code"
    )
    got = {r["org_unit_id"]: (r["root_unit_id"], r["depth"], r["path_names"]) for r in marts.org_hierarchy(units).collect()}
    assert set(got) == {*range(10), 60, 61}
    assert {r["org_unit_id"] for r in marts.org_hierarchy(units, max_depth=6).collect()} == {*range(7), 60, 61}
    assert got[9] == (0, 9, " > ".join(f"u{i}" for i in range(10)))
    assert got[0] == (0, 0, "u0") and got[2] == (0, 2, "u0 > u1 > u2") and got[61] == (60, 1, "other > leaf")


def test_repeat_contact(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    df = spark.createDataFrame(
        [(1, "a", day(1)), (2, "a", day(4)), (3, "a", day(8)), (4, "b", day(1)), (5, "", day(1)), (6, None, day(1))],
        "interaction_id int, customer_ref string, start_ts timestamp",
    ).withColumn("channel", F.lit("x"))
    got = {r["interaction_id"]: (r["prev_contact_ts"], r["repeat_within_72h"]) for r in marts.repeat_contact(df).collect()}
    assert got == {1: (None, 0), 2: (day(1), 1), 3: (day(4), 0), 4: (None, 0)}


def test_call_driver_precedence(spark):
    texts = ["Invoice password", "LOCKED out", "please cancel", "[ABC] hello ref#12", "[abc] x", "plain ref#", "[TOOLONG] x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(marts.call_driver(F.col("t"))).collect()] == ["BILLING", "ACCESS", "RETENTION", "ABC", "OTHER", "OTHER", "OTHER"]


def test_shrinkage_counts_minutes_once_per_schedule(spark):
    fact = spark.createDataFrame([(20240105, 1, 100, 80, 10, 5), (20240106, 1, 60, 60, 0, 0)], "date_key bigint, agent_sk int, scheduled_minutes int, worked_minutes int, exception_minutes int, timeoff_minutes int")
    agent = spark.createDataFrame([(1, 11, "S")], "agent_sk int, agent_id int, site_code string")
    schedule = spark.createDataFrame([(1, 11, dt.date(2024, 1, 5), 7), (2, 11, dt.date(2024, 1, 5), 8)], "schedule_id int, agent_id int, sched_date date, shift_id int")
    shift = spark.createDataFrame([(70, 7, True), (71, 7, True), (80, 8, False)], "shift_sk int, shift_id int, overnight_flag boolean")
    got = {r["date_key"]: r.asDict() for r in marts.shrinkage(fact, agent, schedule, shift).collect()}
    # schedule 1 meets two overnight shifts, schedule 2 none: three joined rows
    assert (got[20240105]["scheduled_minutes"], got[20240105]["shrinkage_minutes"]) == (300, 45)
    assert (got[20240105]["schedules"], got[20240105]["overnight_shifts"]) == (2, 2)
    assert (got[20240106]["scheduled_minutes"], got[20240106]["schedules"], got[20240106]["shrinkage_pct"]) == (60, 0, 0.0)


def test_ratios_guard_zero(spark):
    row = spark.range(1).select(marts.percent(F.lit(1), F.lit(0)), marts.percent(F.lit(1), F.lit(4))).first()
    assert tuple(row) == (None, 25.0)


@pytest.mark.parametrize("name, value", [("agg_agent_daily", "avg_handle_seconds"), ("fact_adherence_daily", "worked_minutes")])
def test_agent_days_come_in_parts_of_bounded_size(spark, tmp_path, monkeypatch, name, value):
    rng = random.Random(8)
    days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    # A fifth of the rows is one agent's; agents and days may be missing, rows repeat.
    rows = [(rng.choice([0, *range(9), *range(9), None]), rng.choice([*days, None]), rng.randrange(1, 4), float(rng.randrange(50)), 0.01 * rng.randrange(9), 0.02) for _ in range(3000)]
    rows += rows[:500]
    lines = spark.createDataFrame(rows, "l_suppkey bigint, l_shipdate timestamp, l_linenumber int, l_quantity double, l_discount double, l_tax double")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, i % 3) for i in range(8)], "s_suppkey bigint, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(registry, "DEALT_ROWS", 100)
    found = getattr(registry.Inputs(spark, str(tmp_path)), name).withColumn("part", F.spark_partition_id()).collect()
    want = {}
    for who, at, line, quantity, discount, _ in rows:
        if name == "fact_adherence_daily" or who in range(8):
            key = None if at is None else at.year * 10000 + at.month * 100 + at.day
            want.setdefault((who, key), []).append((line, quantity, discount))
    day = {(r["agent_sk"], r["date_key"]): r for r in found}
    assert len(found) == len(day) and set(day) == set(want)
    for key, own in want.items():
        counted = day[key]["interactions_handled" if name == "agg_agent_daily" else "exception_minutes"]
        assert (counted, day[key][value]) == (len(own), max(q for _, q, _ in own) if name == "agg_agent_daily" else sum(n for n, _, _ in own))
    sizes = Counter(r["part"] for r in found)
    assert len(sizes) > 8 and max(sizes.values()) <= 40
