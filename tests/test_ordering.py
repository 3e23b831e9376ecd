import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from paritas.operators import ordering


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one key; NULL is a key too."""
    rng = random.Random(5)
    rows = [("hot" if i % 3 == 0 else (None if i % 11 == 0 else f"k{rng.randrange(40)}"), rng.randrange(200), i) for i in range(3000)]
    return spark.createDataFrame(rows, "k string, at int, id int").repartition(6).cache()


@pytest.mark.parametrize("following", [False, True])
def test_neighbour_equals_the_plain_window(skewed, following):
    w = Window.partitionBy("k").orderBy("at", "id")
    step = F.lead if following else F.lag
    want = skewed.select("id", step("at").over(w).alias("x"), step("id").over(w).alias("y"))
    got = ordering.neighbour(skewed, ["k"], ["at", "id"], {"x": "at", "y": "id"}, following=following)
    assert sorted(map(tuple, got.select("id", "x", "y").collect()), key=lambda r: r[0]) == sorted(map(tuple, want.collect()), key=lambda r: r[0])


def test_running_total_equals_the_plain_window(skewed):
    w = Window.partitionBy("k").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = dict(map(tuple, skewed.select("id", F.sum("at").over(w)).collect()))
    got = ordering.running_total(skewed, ["k"], ["at", "id"], "at", "total")
    assert dict(map(tuple, got.select("id", "total").collect())) == want


def test_a_key_with_most_rows_spreads_over_partitions(spark):
    df = spark.range(10_000).selectExpr("if(id % 10 = 0, id, -1) AS k", "id AS at")
    rows = ordering.placed(df, [F.col("k"), F.col("at")])
    parts = rows.where("k = -1").groupBy("_part").count().collect()
    assert len(parts) > 2 and max(r["count"] for r in parts) < 5000
    got = ordering.running_total(df, ["k"], ["at"], "at", "upto").where("k = -1").agg(F.max("upto")).first()[0]
    assert got == sum(i for i in range(10_000) if i % 10)


def test_building_the_plan_runs_no_job_but_the_write(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "")
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS at")
    ordering.placed(df, [F.col("k"), F.col("at")])
    write = len(tracker.getJobIdsForGroup("plan-only"))
    ordering.neighbour(df, ["k"], ["at"], {"x": "at"})
    assert len(tracker.getJobIdsForGroup("plan-only")) == 2 * write
    spark.sparkContext.setJobGroup("rest", "")


@pytest.mark.parametrize("descending", [False, True])
def test_table_rank_equals_global_windows(spark, descending):
    rng = random.Random(9)
    # Half the rows are tied, so ties span partitions.
    values = [None if i % 50 == 0 else (7.0 if i % 2 else float(rng.randrange(30))) for i in range(1001)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double").repartition(5)
    by = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    want = df.select(
        "id", F.row_number().over(Window.orderBy(by, "id")), F.percent_rank().over(Window.orderBy(by)),
        F.ntile(4).over(Window.orderBy(by, "id")), F.ntile(5).over(Window.orderBy(by, "id")),
    )
    ranked = ordering.table_rank(df, "v", ["id"], descending=descending)
    row, total = F.col("_row"), F.col("_total")
    got = ranked.select("id", "_row", ordering.percent_rank(F.col("_rank"), total), ordering.ntile(row, total, 4), ordering.ntile(row, total, 5))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_small_tables(spark, n):
    df = spark.range(n).selectExpr("id", "CAST(id AS DOUBLE) AS v")
    ranked = ordering.table_rank(df, "v", ["id"])
    got = ranked.select("id", ordering.ntile(F.col("_row"), F.col("_total"), 4), ordering.percent_rank(F.col("_rank"), F.col("_total")))
    want = df.select("id", F.ntile(4).over(Window.orderBy("v")), F.percent_rank().over(Window.orderBy("v")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
