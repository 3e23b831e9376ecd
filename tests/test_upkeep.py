"""Digest trees, JSON and separators, tables that change by whole commits, rollups, pairs, estimates and chains."""

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paritas.functions import canon
from paritas.operators import integrity, intervals, merge, parity, perf
from paritas.operators.rollups import MaintainedRollup, Rollup
from paritas.sources import files, ledger, synth


def statuses(checks):
    return {r["target"]: r["status"] for r in checks.collect()}


# -- digest trees


def test_tree_shape_follows_the_rows():
    assert parity.tree_bits(0) == (1, 2) and parity.tree_bits(1) == (1, 2)
    for n in (10, 15_000, 10**6, 10**9, 10**12, 10**17):
        bits = parity.tree_bits(n)
        assert list(bits) == sorted(set(bits)) and (2 ** bits[-1] > n or bits[-1] == canon.HASH_BITS)
        assert max(b - a for a, b in zip((0, *bits), bits)) <= parity.WIDEST
    assert parity.tree_bits(15_000, 4)[0] == 4


@pytest.mark.parametrize("share", [0.0, 0.001, 0.4])
def test_tree_finds_every_difference(spark, share):
    rng = random.Random(4)
    n = 4000
    rows = spark.range(n).selectExpr("id AS k", "id % 7 AS v", "CAST(id AS STRING) AS s")
    changed = sorted(rng.sample(range(n), round(share * n)))
    other = rows.withColumn("v", F.when(F.col("k").isin(changed), 99).otherwise(F.col("v")))
    tree = parity.DigestTree(rows, other, ["k"], ["k", "v", "s"])
    assert sorted(r["k"] for r in tree.differences().collect()) == changed
    passes = tree.passes().collect()
    assert [p["pass"] for p in passes] == list(range(1, len(tree.bits) + 2))
    assert passes[0]["rows_read"] == 2 * n and passes[-1]["unequal"] == len(changed)
    if share == 0.001:
        assert passes[-1]["rows_read"] <= 0.01 * 2 * n
    if not share:
        assert all(p["rows_read"] == 0 for p in passes[1:])


# -- canonical text


def test_separators_and_null_tags_in_values_stay_apart(spark):
    rows = [("a\x1fb", "c"), ("a", "b\x1fc"), ("\x1e__NULL__", "x"), (None, "x"), ("a\x1e", "s"), ("a", "\x1es"), ("\x1es", "q"), ("\x1f", "q"), ("\x1ee", "q"), ("\x1e", "eq")]
    df = spark.createDataFrame(rows, "a string, b string")
    texts = [r[0] for r in df.select(canon.canon_row(df, ["a", "b"])).collect()]
    assert len(set(texts)) == len(rows)


def json_of(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    as_text = [r[0] for r in df.select(canon.canon_row(df, ["j"], json_columns=["j"])).collect()]
    typed = df.select(F.try_parse_json("j").alias("j"))
    as_variant = [r[0] for r in typed.select(canon.canon_row(typed, ["j"])).collect()]
    return as_text, as_variant


def test_json_order_and_number_spelling_are_free(spark):
    same = ['{"a":1,"b":[1.50,"x,:{}\\"7.0",null],"c":{"z":0.1,"y":-0.0}}', ' { "c" : {"y":0, "z":1e-1}, "b":[1.5, "x,:{}\\u00227.0", null], "a":1.0 }']
    for found in json_of(spark, *same):
        assert found[0] == found[1]
    for a, b in (('{"a":1}', '{"a":"1"}'), ('{"a":[1,2]}', '{"a":[2,1]}'), ('{"a":null}', "{}"), ('{"a":10}', '{"a":1}'), ('"1.0"', '"1"'), ('{"a":1e300}', '{"a":2e300}'), ("null", '"null"'), ("123456789012345678901234567890.10", "123456789012345678901234567890.2")):
        for found in json_of(spark, a, b):
            assert found[0] != found[1], (a, b)
    text, _ = json_of(spark, "no json {", "12.500", "100", "1.5E3")
    assert text == ["no json {", "12.5", "100", "1500"]


# -- exact differences


@pytest.mark.parametrize("kind", ["decimal(20,15)", "double"])
def test_tolerances_below_twelve_digits_count(spark, kind):
    a, b = (spark.sql(f"SELECT CAST({v} AS {kind}) AS v") for v in ("4e-13BD", "1e-13BD"))
    check = lambda t: statuses(parity.aggregate_parity(a, b, [{"column": "v", "fn": "max", "tolerance": t}])).popitem()[1]
    assert (check("1e-13"), check("2.9e-13"), check("3.1e-13"), check("50%")) == ("FAIL", "FAIL", "PASS", "FAIL")
    scalar = lambda t: statuses(parity.query_parity(a, b, "scalar", t)).popitem()[1]
    assert (scalar("1e-13"), scalar("4e-13")) == ("FAIL", "PASS")


def test_sums_of_doubles_are_exact_at_any_magnitude(spark):
    import math

    values = [5e-324, 3e-320, 1e-305, -2.5e-310, 1e300, -1e300, 0.1, 2.0**40 * (1 - 2**-53), 2.0**-1021]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    assert parity._float_sum(df, "v").first()["a0"] == math.fsum(values)
    tiny = [v for v in values if abs(v) < 1e-300]
    assert parity._float_sum(spark.createDataFrame([(v,) for v in tiny], "v double"), "v").first()["a0"] == math.fsum(tiny)


# -- whole commits


def test_a_failing_load_leaves_the_table(spark, tmp_path):
    (tmp_path / "good.csv").write_text("".join(f"{i},{i}.5\n" for i in range(5)))
    (tmp_path / "bad.csv").write_text("7,1.5\nx,2.5\n")
    folder = str(tmp_path / "landed")

    def load(name, n):
        spec = {"table": "t", "uri": str(tmp_path / name), "format": "CSV", "expected_count": n, "schema": "id int, v double"}
        return files.bulk_load(spark, [spec], folder).first()["status"]

    ids = lambda: sorted(r["id"] for r in files.landed_table(spark, folder, "t").collect())
    assert files.landed_table(spark, folder, "t") is None and load("bad.csv", 2) == "FAIL" and files.landed_table(spark, folder, "t") is None
    assert load("good.csv", 5) == "PASS" and ids() == list(range(5))
    assert load("bad.csv", 2) == "FAIL" and load("good.csv", 6) == "FAIL" and load("none.csv", 1) == "FAIL" and ids() == list(range(5))
    (tmp_path / "next.csv").write_text("9,1\n")
    assert load("next.csv", 1) == "PASS" and ids() == [9]
    assert ledger.sweep(spark, f"{folder}/t") == 1 and ids() == [9]


def test_appends_take_place_once(spark, tmp_path):
    path = str(tmp_path / "t")
    feed = spark.range(100).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS day")

    def fail():
        raise KeyError("lost")

    assert merge.audited_append(feed, path, "id", 39, "a") == (40, True)
    with pytest.raises(KeyError):
        merge.audited_append(feed, path, "id", 79, "b", before_commit=fail)
    assert ledger.table(spark, path).count() == 40
    assert merge.audited_append(feed, path, "id", 79, "b") == (40, True)
    assert merge.audited_append(feed, path, "id", 79, "b") == (40, False) and merge.audited_append(feed, path, "id", 39, "a") == (40, False)
    assert merge.audited_append(feed, path, "id", 79, "c") == (0, True) and merge.audited_append(feed, path, "id", 200, "d") == (20, True)
    assert sorted(r["id"] for r in ledger.table(spark, path).collect()) == list(range(100))
    assert [tuple(r) for r in merge.append_audit(spark, path).collect()] == [("a", None, "39", 40), ("b", "39", "79", 40), ("c", "79", "79", 0), ("d", "79", "200", 20)]


def test_lines_written_side_by_side_count_once(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5)
    staged = [ledger.stage(df, path)[0] for _ in range(2)]
    line = lambda folder: (1, "run", folder, df.schema.json(), 5, None, False, dt.datetime(2024, 1, 1))
    for folder in staged:
        spark.createDataFrame([line(folder)], ledger.LINE).write.mode("append").json(f"{path}/ledger")
    assert ledger.table(spark, path).count() == 5


# -- headers


def bytes_read(spark):
    found = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(found.get(i).getBytesRead() for i in range(found.size()))


def test_only_the_front_of_a_file_is_read_for_its_header(spark, tmp_path):
    (tmp_path / "large.csv").write_text("id,v\n" + "1,some text that fills the file\n" * 1_000_000)
    (tmp_path / "small.csv").write_text("id,w\n1,a\n")
    (tmp_path / "none.csv").write_text("")
    before = bytes_read(spark)
    found = {r["file"]: r["status"] for r in files.header_drift(spark, str(tmp_path), ["id", "v"]).collect()}
    assert found == {"large.csv": "ACCEPTED", "small.csv": "QUARANTINED"}
    assert bytes_read(spark) - before < 4 << 20  # of 32 MB


def test_drifted_files_are_copied_with_their_reason(spark, tmp_path):
    feed, aside = tmp_path / "feed", str(tmp_path / "aside")
    feed.mkdir()
    (feed / "good.csv").write_text("id,v\n1,a\n")
    (feed / "turned.csv").write_text("v,id\na,1\nb,2\n")
    (feed / "renamed.csv").write_text("id,value\n" + "".join(f"{i},x\n" for i in range(300)))
    reasons = {r["file"]: r["reason"] for r in files.quarantine(spark, str(feed), ["id", "v"], aside).collect()}
    assert reasons == {"turned.csv": "other order", "renamed.csv": "missing: v; unexpected: value"}
    kept = defaultdict(list)
    for r in spark.read.parquet(f"{aside}/lines").orderBy("line_no").collect():
        kept[r["file"]].append(r["line"])
    assert {k: "\n".join(v) + "\n" for k, v in kept.items()} == {n: (feed / n).read_text() for n in reasons}
    assert spark.read.json(f"{aside}/reasons").count() == 2
    assert sorted(r["id"] for r in files.accepted_rows(spark, str(feed), ["id", "v"], "id int, v string").collect()) == [1]


def test_a_clean_feed_has_an_empty_quarantine(spark, tmp_path):
    (tmp_path / "good.csv").write_text("id,v\n1,a\n")
    assert files.quarantine(spark, str(tmp_path / "good.csv"), ["id", "v"], str(tmp_path / "aside")).count() == 0


# -- rollups


def test_rollup_after_random_batches_equals_the_whole(spark, tmp_path):
    rng = random.Random(3)
    layout = "g string, h int, v decimal(9,2), w int, u string"
    rollup = Rollup(["g", "h"], ["v", "w"], ["u", "w"])
    kept, held = MaintainedRollup(spark, str(tmp_path / "r"), rollup), []
    for batch in range(4):
        gone = rng.sample(held, len(held) // 3)
        come = [(rng.choice(["a", "b", None]), rng.randrange(3), rng.choice([None, Decimal(rng.randrange(-999, 999)) / 100]), rng.choice([None, rng.randrange(5)]), rng.choice(["x", "y", "z", None])) for _ in range(60)]
        for row in gone:
            held.remove(row)
        held += come
        df = spark.createDataFrame([(*r, "I") for r in come] + [(*r, "D") for r in gone], layout + ", op string").repartition(3)
        assert kept.apply(df, f"run {batch}", "op") and not kept.apply(df, f"run {batch}", "op")
    want = rollup.table(*rollup.state(spark.createDataFrame(held, layout)))
    assert Counter(map(str, kept.table().collect())) == Counter(map(str, want.collect()))
    direct = spark.createDataFrame(held, layout).groupBy("g", "h").agg(F.count(F.lit(1)).alias("rows"), F.sum("v").cast("double").alias("v"), F.countDistinct("u").alias("u"))
    assert {(r["g"], r["h"], r["rows"], r["v"], r["u"]) for r in direct.collect()} == {
        (r["g"], r["h"], r["rows"], None if r["sum_v"] is None else float(r["sum_v"]), r["distinct_u"]) for r in kept.table().collect()
    }


def test_rollup_refuses_what_it_cannot_take_away(spark, tmp_path):
    kept = MaintainedRollup(spark, str(tmp_path / "r"), Rollup(["g"], ["v"]))
    kept.apply(spark.sql("SELECT 'a' AS g, 1 AS v, 'I' AS op"), "1", "op")
    with pytest.raises(Exception, match="takes away more"):
        kept.apply(spark.sql("SELECT 'b' AS g, 1 AS v, 'D' AS op"), "2", "op")
    assert [tuple(r)[:2] for r in kept.table().collect()] == [("a", 1)]
    kept.apply(spark.sql("SELECT 'a' AS g, 1 AS v, 'D' AS op"), "3", "op")
    assert kept.table().count() == 0
    with pytest.raises(ValueError, match="exact"):
        Rollup(["g"], ["v"]).state(spark.sql("SELECT 'a' AS g, 1D AS v"))


# -- pairs


@pytest.mark.parametrize("slice_rows", [1, 7, 2000])
def test_interval_pairs_equal_brute_force(spark, slice_rows):
    rng = random.Random(8)
    start = dt.datetime(1969, 12, 20)
    rows = [(i, rng.choice(["hot", "hot", "a", "b", None]), start + dt.timedelta(seconds=rng.randrange(40 * 86400))) for i in range(300)]
    rows += [(1000 + i, "hot", start + dt.timedelta(days=i)) for i in range(15)] + [(2000, "hot", None), (2001, "a", start), (2002, "a", start)]
    df = spark.createDataFrame(rows, "id int, k string, at timestamp").repartition(4)
    got = Counter((r["anchor_id"], r["event_id"]) for r in intervals.interval_pairs(df, df, "k", "id", "at", "id", "at", 2, slice_rows).collect())
    want = Counter((a[0], b[0]) for a in rows for b in rows if a[1] is not None and a[1] == b[1] and None not in (a[2], b[2]) and dt.timedelta(0) < b[2] - a[2] <= dt.timedelta(days=2))
    assert got == want


def test_interval_pairs_make_no_product(spark):
    df = spark.range(10).selectExpr("id", "id % 2 AS k", "timestamp_seconds(id) AS at")
    plan = intervals.interval_pairs(df, df, "k", "id", "at", "id", "at", 1)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# -- estimates, layouts


def test_estimates_follow_pruned_files_and_guard(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_partitioned(spark.range(5000).selectExpr("id", "id % 5 AS p", "uuid() AS u"), path, ["p"])
    table = spark.read.parquet(path)
    whole, part = perf.estimate(table), perf.estimate(table.where("p = 3"))
    assert 0 < part["bytes_scanned"] < whole["bytes_scanned"] / 4 and part["files"] < whole["files"]
    assert perf.run_once(table.where("p = 3"))["bytes_scanned"] == part["bytes_scanned"]
    assert perf.within_limit(table.where("p = 3"), part["bytes_scanned"]).count() == 1000
    with pytest.raises(perf.TooExpensive):
        perf.within_limit(table, whole["bytes_scanned"] - 1)
    assert perf.estimate(spark.range(10))["bytes_scanned"] == 0
    with pytest.raises(perf.TooExpensive):
        synth.write_synth_table(spark, str(tmp_path / "s"), "medium", [{"name": "id", "gen": "sequence"}], max_bytes=10**6)
    assert not (tmp_path / "s").exists()
    assert synth.write_synth_table(spark, str(tmp_path / "s"), 100, [{"name": "id", "gen": "sequence"}], max_bytes=10**6).count() == 100


def test_clusters_are_skipped_by_statistics(spark, tmp_path):
    df = spark.range(20000).selectExpr("id", "(id * 7919) % 20000 AS k", "id % 3 AS v")
    files.write_clustered(df, str(tmp_path / "c"), ["k"], files=8)
    files.write_clustered(df.repartition(8), str(tmp_path / "u"), [])
    for name, status in (("c", "PASS"), ("u", "FAIL")):
        table = spark.read.parquet(str(tmp_path / name))
        assert statuses(perf.cluster_reduction(table.agg(F.sum("v")), table.where("k BETWEEN 30 AND 90").agg(F.sum("v")), name=name)) == {name: status}


# -- chains


def test_chains_follow_references_once(spark):
    refs = [("a", "x", "b", "x"), ("b", "y", "c", "y"), ("b", "z", "d", "z"), ("c", "up", "c", "y"), ("c", "back", "a", "x")]
    assert [[r[2] for r in chain] for chain in integrity.reference_chains(refs, "a")] == [["b", "c"], ["b", "d"]]
    assert integrity.reference_chains(refs, "d") == []


def test_rows_lost_along_a_chain_are_counted_where_they_are_lost(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "b_id int")
    b = spark.createDataFrame([(1, 10), (2, 99), (2, 99), (4, 10)], "id int, c_id bigint")
    c = spark.createDataFrame([("10",)], "id string")
    found = integrity.fk_chain({"a": a, "b": b, "c": c}, [("a", "b_id", "b", "id"), ("b", "c_id", "c", "id")]).orderBy("hop").collect()
    assert [(r["hop"], r["reached"], r["broken"], r["types_agree"], r["status"]) for r in found] == [(1, 5, 2, True, "FAIL"), (2, 3, 1, False, "FAIL")]


def test_latest_of_tied_rows_is_the_same_at_any_order(spark):
    from paritas.operators.history import latest_version

    rows = [(k, 1, f"v{i}") for k in range(20) for i in range(6)]
    picks = []
    for seed in (1, 2, 3):
        df = spark.createDataFrame(sorted(rows, key=lambda r: hash((seed, r))), "k int, at int, v string").repartition(seed * 2)
        picks.append(sorted(map(tuple, latest_version(df, ["k"], ["at"]).collect())))
    assert picks[0] == picks[1] == picks[2] and len(picks[0]) == 20
