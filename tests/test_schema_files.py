import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.functions.types import leaf_paths, logical_name, signature
from paritas.operators import schema
from paritas.sources import files, inline, synth


def by_target(checks):
    return {c["target"]: c["status"] for c in checks.collect()}


@pytest.mark.parametrize("spelling,name", [
    ("tinyint", "INT64"), ("INTEGER", "INT64"), ("double precision", "FLOAT64"), ("DECIMAL(12,2)", "NUMERIC"), ("varchar(10)", "STRING"),
    ("timestamp_ntz", "DATETIME"), ("boolean", "BOOL"), ("binary", "BYTES"), ("geography", "GEOGRAPHY"),
])
def test_logical_names(spelling, name):
    assert logical_name(spelling) == name


def test_signatures(spark):
    dtype = T.DataType.fromDDL("array<struct<Id:int,qty:decimal(9,2),tags:array<string>>>")
    assert signature(dtype) == "ARRAY<STRUCT<id:INT64,qty:NUMERIC,tags:ARRAY<STRING>>>"
    paths = [p for p, _ in leaf_paths(T.DataType.fromDDL("a int, items array<struct<id:int,sub:struct<x:string>>>"))]
    assert paths == ["a", "items", "items[].id", "items[].sub", "items[].sub.x"]


def test_schema_conformance_and_twins(spark):
    df = spark.sql("SELECT 1L AS id, CAST(1.5 AS DECIMAL(12,2)) AS amount, CAST(NULL AS STRING) AS name, array(named_struct('k', 'a', 'n', 1)) AS items")
    golden = [
        {"name": "id", "type": "BIGINT", "nullable": False}, {"name": "amount", "type": "NUMERIC", "scale": 2},
        {"name": "items", "type": "array<struct<k:string,n:bigint>>"}, {"name": "name", "type": "varchar"},
    ]
    assert set(by_target(schema.schema_conformance(df, golden)).values()) == {"PASS"}
    twin = [
        {"name": "id", "type": "STRING"}, {"name": "amount", "type": "NUMERIC"}, {"name": "amount", "type": "NUMERIC", "scale": 3},
        {"name": "items", "type": "array<struct<k:string,n:string>>"}, {"name": "name", "type": "string", "nullable": False}, {"name": "gone", "type": "date"},
    ]
    checks = schema.schema_conformance(df, twin).collect()
    assert [c["target"] for c in checks if c["status"] == "PASS"] == ["table.name"]
    legacy = spark.sql("SELECT 1L AS issued_ms, 1 AS id")
    mapped = [{"name": "id", "type": "INT64", "source_name": "issued_ms", "source_type": "BIGINT"}, {"name": "name", "type": "STRING", "source_name": "absent"}]
    found = by_target(schema.schema_conformance(df, mapped, source=legacy))
    assert found["table.id (source map)"] == "PASS" and found["table.name (source map)"] == "FAIL"
    facts = {"object_type": "TABLE", "external": False, "partition_by": ["d"], "cluster_by": ["id"], "options": {"partition_expiration_days": 365.2, "labels": {"a": "1"}}}
    want = {"object_type": "VIEW", "partition_by": "d", "cluster_by": ["id", "x"], "options": {"partition_expiration_days": 365, "labels": {"a": "2"}}}
    found = by_target(schema.schema_conformance(df, [], catalog=facts, expect=want))
    assert found == {"table (object_type)": "FAIL", "table (partition_by)": "PASS", "table (cluster_by)": "FAIL",
                     "table (partition_expiration_days)": "PASS", "table (labels)": "FAIL", "table (native)": "PASS"}


def test_profile_and_nested_counts(spark):
    df = spark.createDataFrame([(Decimal("120.50"), [1, None]), (Decimal("-7.00"), []), (None, None)], "x decimal(9,2), a array<int>")
    rows = {r["column"]: r for r in schema.column_profile(df).collect()}
    assert (rows["x"]["nulls"], rows["x"]["int_digits"], rows["x"]["scale_used"]) == (1, 3, 1)
    nested = spark.sql("SELECT array(named_struct('k', 1, 'v', CAST(NULL AS INT)), NULL) AS a UNION ALL SELECT NULL")
    assert {r["path"]: r["n_values"] for r in schema.nested_signature(nested).collect()} == {"a": 1, "a[].k": 1, "a[].v": 0}


def test_type_map_counts_lossy_rows(spark):
    assert [schema.target_type(t) for t in ("SMALLINT", "DECIMAL(9,2)", "MAP<STRING,STRING>", "ARRAY<STRUCT<a:INT>>")] == [
        "INT64", "NUMERIC(9,2)", "JSON", "ARRAY<STRUCT<a:INT64>>"
    ]
    rows = {r["column"]: r["lossy_rows"] for r in schema.type_map(spark.sql("SELECT CAST(5 AS SMALLINT) AS s, 1.5D AS d, DATE '2024-01-01' AS t")).collect()}
    assert rows == {"s": 0, "d": 0, "t": 0}


def test_queryability_reports_each_object(spark):
    found = schema.queryability(spark, {"good": "SELECT 1 AS a", "bad": "SELECT nope", "also": "SELECT * FROM missing_table"}).collect()
    assert [(r["object"], r["status"]) for r in found] == [("good", "PASS"), ("bad", "FAIL"), ("also", "FAIL")]


# -- files ---------------------------------------------------------------------

LAYOUT = "id bigint, amount decimal(12,2), at timestamp, day date"


@pytest.fixture(scope="module")
def fact(spark):
    return spark.range(500).selectExpr(
        "id", "CAST(id / 4 AS DECIMAL(12,2)) AS amount", "timestamp_seconds(1700000000 + id * 3600) AS at", "date_add(DATE '2024-01-01', CAST(id % 5 AS INT)) AS day"
    )


def test_staged_copies_read_back_equal(spark, fact, tmp_path):
    paths = files.stage_formats(fact, str(tmp_path / "s"), "day")
    loads = {
        "json": files.load(spark, paths["json"], "JSON", LAYOUT),
        "csv": files.load(spark, paths["csv"], "csv", LAYOUT, field_delimiter="|", skip_leading_rows=1),
        "parquet": files.load(spark, paths["parquet"], "PARQUET"),
        "hive": files.load(spark, paths["hive_json"], "JSON", LAYOUT, hive_partitioning={"source_uri_prefix": paths["hive_json"], "mode": "CUSTOM"}),
    }
    want = sorted(map(tuple, fact.collect()))
    for name, df in loads.items():
        assert sorted(map(tuple, df.select("id", "amount", "at", "day").collect())) == want, name


def test_hive_modes_type_the_partition_column(spark, fact, tmp_path):
    path = str(tmp_path / "h")
    files.write_partitioned(fact.withColumn("y", F.year("at")), path, ["y"], fmt="json")
    types = {}
    for mode in ("AUTO", "STRINGS"):
        df = files.load(spark, path, "JSON", hive_partitioning={"source_uri_prefix": path, "mode": mode})
        types[mode] = df.schema["y"].dataType.simpleString()
    assert types == {"AUTO": "int", "STRINGS": "string"}


def test_leading_rows_are_skipped_per_file(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f{i}.csv").write_text("banner\nmore; text\nid;v\n" + "".join(f"{i * 10 + k};x{k}\n" for k in range(4)))
    df = files.load(spark, str(tmp_path), "CSV", "id int, v string", field_delimiter=";", skip_leading_rows=3)
    assert sorted(r["id"] for r in df.collect()) == sorted(i * 10 + k for i in range(3) for k in range(4))


def test_bulk_load_goes_on_after_a_failure(spark, fact, tmp_path):
    fact.write.parquet(str(tmp_path / "p"))
    checks = files.bulk_load(spark, [
        {"table": "a", "uri": str(tmp_path / "none"), "format": "PARQUET", "expected_count": 1},
        {"table": "b", "uri": str(tmp_path / "p"), "format": "XML", "expected_count": 1},
        {"table": "c", "uri": str(tmp_path / "p"), "format": "PARQUET", "expected_count": 500},
        {"table": "d", "uri": str(tmp_path / "p"), "format": "PARQUET", "expected_count": 501},
    ], str(tmp_path / "landed"))
    assert [c["status"] for c in checks.collect()] == ["FAIL", "FAIL", "PASS", "FAIL"]


def test_dynamic_write_replaces_only_given_partitions(spark, fact, tmp_path):
    path = str(tmp_path / "d")
    files.dynamic_partition_write(fact, path, ["day"])
    files.dynamic_partition_write(fact.where("day = '2024-01-02'").withColumn("amount", F.lit(Decimal("1.00")).cast("decimal(12,2)")), path, ["day"])
    back = spark.read.schema(LAYOUT).parquet(path)
    assert back.count() == 500
    assert {str(r["day"]) for r in back.groupBy("day").agg(F.max("amount").alias("m")).where("m = 1").collect()} == {"2024-01-02"}


def test_partition_collapse(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 2, 3, 4), 2024, 2)], "id int, at timestamp, y int, m int")
    out = files.partition_collapse(df, "at", ["y", "m"])
    assert out.columns == ["id", "at", "event_date"] and str(out.first()["event_date"]) == "2024-02-03"


def test_egress_golden_and_twin(spark, fact, tmp_path):
    back = files.export_json(fact, str(tmp_path / "e"))
    text = back.withColumn("amount", F.col("amount").cast("string"))
    assert set(by_target(files.egress_parity(fact, text, ["id", "amount"], "amount")).values()) == {"PASS"}
    twin = by_target(files.egress_parity(fact, back.where("id != 9"), ["id", "amount"], "amount"))
    assert set(twin.values()) == {"FAIL"}
    odd = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    assert tuple(files.control_totals(odd, "v").first()) == (3, Decimal("1.500000000"))


def test_header_drift_quarantines_files(spark, tmp_path):
    (tmp_path / "good.csv").write_text("id,v\n1,a\n2,b\n")
    (tmp_path / "drift.csv").write_text("id,value\n3,c\n")
    found = {r["file"]: r["status"] for r in files.header_drift(spark, str(tmp_path), ["id", "v"]).collect()}
    assert found == {"good.csv": "ACCEPTED", "drift.csv": "QUARANTINED"}
    rows = files.accepted_rows(spark, str(tmp_path), ["id", "v"], "id int, v string")
    assert sorted(r["id"] for r in rows.collect()) == [1, 2]


def test_inline_tables(spark):
    df = inline.seed_given(spark, {
        "columns": [{"name": "id", "type": "INT64", "mode": "REQUIRED"}, {"name": "x", "type": "NUMERIC"}, {"name": "at", "type": "TIMESTAMP"}, {"name": "ok", "type": "BOOL"}],
        "rows": [{"id": 1, "x": "1.5", "at": "2024-01-01T00:00:00Z", "ok": True}, {"id": 2}],
    })
    assert df.schema["x"].dataType == T.DecimalType(38, 9)
    first = df.orderBy("id").first()
    assert (first["x"], first["at"], first["ok"]) == (Decimal("1.500000000"), dt.datetime(2024, 1, 1), True)
    with pytest.raises(ValueError):
        inline.seed_given(spark, {"columns": [{"name": "id", "type": "INT64", "mode": "REQUIRED"}], "rows": [{}]})


def test_synthetic_rows_depend_only_on_their_id(spark, tmp_path):
    columns = [{"name": "id", "gen": "sequence"}, {"name": "amount", "type": "decimal(9,2)", "gen": "round(rand() * 1000, 2)"}, {"name": "u", "gen": "rand() - rand()"},
               {"name": "day", "gen": "date_add(DATE'2026-01-01', CAST(id % 3 AS INT))"}]
    few = sorted(map(tuple, synth.synth_table(spark, 100, columns, partitions=3).collect()))
    many = sorted(map(tuple, synth.synth_table(spark, "200", columns, partitions=7).where("id <= 100").collect()))
    assert few == many and [r[0] for r in few] == list(range(1, 101))
    assert len({r[1] for r in few}) > 80 and all(r[2] != 0 for r in few)
    assert synth.row_count("small") == 1_000_000 and synth.row_count("1e3") == 1000
    back = synth.write_synth_table(spark, str(tmp_path / "t"), 300, columns, ["day"], ["id"])
    assert back.count() == 300 and back.where("day = '2026-01-02'").count() == 100


def test_expired_partitions_are_dropped(spark, fact, tmp_path):
    path = str(tmp_path / "r")
    files.write_partitioned(fact, path, ["day"])
    dropped = files.drop_expired_partitions(spark, path, "day", 2, dt.date(2024, 1, 5))
    assert dropped == ["2024-01-01", "2024-01-02"]
    assert spark.read.parquet(path).count() == 300


def test_database_conformance(spark, fact, tmp_path):
    from paritas.operators import transform

    transform.provision(spark, "scratch_build_schema", str(tmp_path / "db"))
    files.create_table_as(fact, "scratch_build_schema.fact", ["day"])
    declared = [
        {"table": "fact", "columns": [{"name": "id", "type": "INT64", "nullable": False}], "expect": {"object_type": "TABLE", "partition_by": "day"}},
        {"table": "absent", "columns": []},
    ]
    found = by_target(schema.database_conformance(spark, "scratch_build_schema", declared, expect_table_count=1))
    assert found == {
        "scratch_build_schema": "PASS", "scratch_build_schema.fact.id": "PASS", "scratch_build_schema.fact.id (not null)": "PASS",
        "scratch_build_schema.fact (object_type)": "PASS", "scratch_build_schema.fact (partition_by)": "PASS",
        "scratch_build_schema.fact (native)": "PASS", "scratch_build_schema.absent": "FAIL",
    }
    transform.teardown(spark, "scratch_build_schema")
