"""Loads, writes, generated tables, catalog checks and builds, all through files."""

from __future__ import annotations

from pyspark.sql import functions as F

from paritas.operators import perf, schema, transform
from paritas.operators.parity import rowcount_parity
from paritas.plans.inputs import TABLES
from paritas.plans.registry import query
from paritas.plans.relational import TRANSFORM_INVOICE
from paritas.plans.validation import ORDER_COLUMNS, shown
from paritas.session import scratch_path
from paritas.sources import files, inline, synth

ORDER_LAYOUT = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, amount decimal(14,2), o_orderdate timestamp_ntz, o_orderpriority string"
)
_PER_STATUS = """
    SELECT o_orderstatus, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS amount, strftime(MAX(o_orderdate), '%Y-%m-%d %H:%M:%S') AS latest
    FROM {orders_source} GROUP BY 1"""


def _per_status(df):
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.max("o_orderdate").alias("latest")
    )


@query("load_json", _PER_STATUS)
def load_json(t):
    path = scratch_path(t.spark, "json")
    t.orders_source.write.json(path)
    return _per_status(files.load(t.spark, path, "NEWLINE_DELIMITED_JSON", ORDER_LAYOUT))


@query("load_csv", _PER_STATUS)
def load_csv(t):
    path = scratch_path(t.spark, "csv")
    t.orders_source.write.option("sep", "|").option("header", True).csv(path)
    return _per_status(files.load(t.spark, path, "CSV", ORDER_LAYOUT, field_delimiter="|", skip_leading_rows=1))


@query("load_parquet", _PER_STATUS)
def load_parquet(t):
    path = scratch_path(t.spark, "parquet")
    t.orders_source.write.parquet(path)
    return _per_status(files.load(t.spark, path, "PARQUET"))


@query("load_orc", _PER_STATUS)
def load_orc(t):
    path = scratch_path(t.spark, "orc")
    t.orders_source.write.orc(path)
    return _per_status(files.load(t.spark, path, "ORC", ORDER_LAYOUT))


@query(
    "load_hive_partitioned",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderstatus, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS amount FROM {orders_source} GROUP BY 1, 2""",
)
def load_hive_partitioned(t):
    path = scratch_path(t.spark, "hive")
    df = t.orders_source.withColumn("order_year", F.year("o_orderdate"))
    files.write_partitioned(df, path, ["order_year"], fmt="json")
    back = files.load(t.spark, path, "JSON", ORDER_LAYOUT, hive_partitioning={"source_uri_prefix": path, "mode": "AUTO"})
    return back.groupBy("order_year", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


_STAGED = ["json", "csv", "parquet", "hive_json"]


@query(
    "stage_formats",
    " UNION ALL ".join(
        f"SELECT '{f}' AS layout, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS amount, COUNT(DISTINCT o_orderstatus) AS statuses FROM {{orders_source}}"
        for f in _STAGED
    ),
)
def stage_formats(t):
    paths = files.stage_formats(t.orders_source, scratch_path(t.spark, "staged"), "o_orderstatus")
    back = {
        "json": files.load(t.spark, paths["json"], "JSON", ORDER_LAYOUT),
        "csv": files.load(t.spark, paths["csv"], "CSV", ORDER_LAYOUT, field_delimiter="|", skip_leading_rows=1),
        "parquet": files.load(t.spark, paths["parquet"], "PARQUET"),
        "hive_json": files.load(
            t.spark, paths["hive_json"], "JSON", ORDER_LAYOUT, hive_partitioning={"source_uri_prefix": paths["hive_json"], "mode": "STRINGS"}
        ),
    }
    out = None
    for name, df in back.items():
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.countDistinct("o_orderstatus").alias("statuses"))
        row = row.withColumn("layout", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


@query("egress_export", _PER_STATUS)
def egress_export(t):
    return _per_status(files.export_json(t.orders_source, scratch_path(t.spark, "export")))


@query(
    "egress_parity",
    """
    WITH d AS (SELECT (SELECT COUNT(*) FROM (FROM {orders_source} EXCEPT ALL FROM {faulty_export}) x)
                    + (SELECT COUNT(*) FROM (FROM {faulty_export} EXCEPT ALL FROM {orders_source}) y) AS n),
    e AS (SELECT COUNT(*) AS n FROM (FROM {orders_source} EXCEPT ALL FROM {orders_source}) z),
    s AS (SELECT COUNT(*) AS n, SUM(amount) AS a FROM {orders_source}), t AS (SELECT COUNT(*) AS n, SUM(amount) AS a FROM {faulty_export})
    SELECT 'true (identity)' AS target, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, '0' AS expected, CAST(n AS STRING) AS actual FROM e
    UNION ALL SELECT 'true (row_cnt)', CASE WHEN n = (SELECT COUNT(*) FROM {orders}) THEN 'PASS' ELSE 'FAIL' END, CAST(n AS STRING), CAST((SELECT COUNT(*) FROM {orders}) AS STRING) FROM s
    UNION ALL SELECT 'true (control_total:amount)', CASE WHEN a = (SELECT SUM(CAST(o_totalprice AS DECIMAL(14,2))) FROM {orders}) THEN 'PASS' ELSE 'FAIL' END,
      rtrim(rtrim(CAST(a AS STRING), '0'), '.'), rtrim(rtrim(CAST((SELECT SUM(CAST(o_totalprice AS DECIMAL(14,2))) FROM {orders}) AS STRING), '0'), '.') FROM s
    UNION ALL SELECT 'faulty (identity)', CASE WHEN d.n = 0 THEN 'PASS' ELSE 'FAIL' END, '0', CAST(d.n AS STRING) FROM d
    UNION ALL SELECT 'faulty (row_cnt)', CASE WHEN s.n = t.n THEN 'PASS' ELSE 'FAIL' END, CAST(s.n AS STRING), CAST(t.n AS STRING) FROM s, t
    UNION ALL SELECT 'faulty (control_total:amount)', CASE WHEN s.a = t.a THEN 'PASS' ELSE 'FAIL' END,
      rtrim(rtrim(CAST(s.a AS STRING), '0'), '.'), rtrim(rtrim(CAST(t.a AS STRING), '0'), '.') FROM s, t""",
)
def egress_parity(t):
    legacy = t.orders_source
    columns = ORDER_COLUMNS
    good = files.export_json(legacy, scratch_path(t.spark, "export"))
    bad = files.export_json(t.faulty_export, scratch_path(t.spark, "export"))
    return shown(
        files.egress_parity(legacy, good, columns, "amount", name="true").unionByName(
            files.egress_parity(legacy, bad, columns, "amount", name="faulty")
        )
    )


@query(
    "bulk_load",
    """
    WITH n AS (SELECT CAST(COUNT(*) AS STRING) AS n, CAST(COUNT(*) + 1 AS STRING) AS more FROM {orders_source})
    SELECT 'o_json (NEWLINE_DELIMITED_JSON)' AS target, 'PASS' AS status, n AS expected, n AS actual FROM n
    UNION ALL SELECT 'o_csv (CSV)', 'PASS', n, n FROM n
    UNION ALL SELECT 'o_short (PARQUET)', 'FAIL', more, n FROM n
    UNION ALL SELECT 'o_orc (ORC)', 'PASS', n, n FROM n
    UNION ALL SELECT 'o_hive (NEWLINE_DELIMITED_JSON)', 'PASS', n, n FROM n
    UNION ALL SELECT 'o_hive (partition meta)', 'PASS', 'o_orderstatus', 'o_orderstatus'
    UNION ALL SELECT 'o_broken_json', 'FAIL', NULL, NULL
    UNION ALL SELECT 'o_broken_csv', 'FAIL', NULL, NULL
    UNION ALL SELECT 'o_absent', 'FAIL', NULL, NULL""",
)
def bulk_load(t):
    folder = scratch_path(t.spark, "bulk")
    paths = files.stage_formats(t.orders_source, folder, "o_orderstatus")
    t.orders_source.write.orc(f"{folder}/orc")
    # The same rows with one line cut off, and with one that holds a word for a number.
    lines = t.spark.read.text(paths["json"])
    lines.unionByName(lines.limit(1).select(F.expr("left(value, 20)").alias("value"))).write.text(f"{folder}/broken_json")
    lines = t.spark.read.text(paths["csv"])
    lines.unionByName(lines.limit(1).select(F.lit("zz|1|O|1.00|1996-01-01 00:00:00|5-LOW").alias("value"))).write.text(f"{folder}/broken_csv")
    n = t.orders.count()
    hive = {"source_uri_prefix": paths["hive_json"], "mode": "STRINGS", "expect_partition_column": "o_orderstatus"}
    loads = [
        {"table": "o_json", "uri": paths["json"], "format": "NEWLINE_DELIMITED_JSON", "expected_count": n, "schema": ORDER_LAYOUT},
        {"table": "o_csv", "uri": paths["csv"], "format": "CSV", "expected_count": n, "schema": ORDER_LAYOUT, "field_delimiter": "|", "skip_leading_rows": 1},
        {"table": "o_short", "uri": paths["parquet"], "format": "PARQUET", "expected_count": n + 1},
        {"table": "o_broken_json", "uri": f"{folder}/broken_json", "format": "JSON", "expected_count": n, "schema": ORDER_LAYOUT},
        {"table": "o_broken_csv", "uri": f"{folder}/broken_csv", "format": "CSV", "expected_count": n, "schema": ORDER_LAYOUT, "field_delimiter": "|"},
        {"table": "o_absent", "uri": f"{folder}/absent", "format": "PARQUET", "expected_count": 1},
        {"table": "o_orc", "uri": f"{folder}/orc", "format": "ORC", "expected_count": n},
        {"table": "o_hive", "uri": paths["hive_json"], "format": "NEWLINE_DELIMITED_JSON", "expected_count": n, "schema": ORDER_LAYOUT, "hive_partitioning": hive},
    ]
    return shown(files.bulk_load(t.spark, loads, f"{folder}/landed"))


@query(
    "header_drift",
    """
    SELECT o_orderstatus, COUNT(*) AS n, TRUE AS drift_found FROM {orders_source} WHERE o_orderpriority <> '5-LOW' GROUP BY 1""",
)
def header_drift(t):
    path = scratch_path(t.spark, "drift")
    good = t.orders_source.where("o_orderpriority <> '5-LOW'")
    drifted = t.orders_source.where("o_orderpriority = '5-LOW'").withColumnRenamed("amount", "amt")
    good.write.option("header", True).csv(path)
    drifted.write.mode("append").option("header", True).csv(path)
    found = files.header_drift(t.spark, path, ORDER_COLUMNS).where("status = 'QUARANTINED'").agg(F.count(F.lit(1)) > 0)
    rows = files.accepted_rows(t.spark, path, ORDER_COLUMNS, ORDER_LAYOUT)
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).withColumn("drift_found", found.scalar())


_STATUS_NAMES = {
    "columns": [{"name": "code", "type": "STRING", "mode": "REQUIRED"}, {"name": "label", "type": "STRING"},
                {"name": "weight", "type": "NUMERIC", "scale": 2}, {"name": "since", "type": "DATE"}],
    "rows": [{"code": "O", "label": "open", "weight": "1.50", "since": "2020-01-01"}, {"code": "P", "label": "pending", "weight": "0.25"},
             {"code": "F", "weight": "2", "since": "2021-06-30"}],
}


@query(
    "seed_given",
    """
    SELECT o_orderstatus, s.label, s.since, COUNT(*) AS n, CAST(SUM(s.weight) AS DOUBLE) AS weight
    FROM {orders} JOIN (VALUES ('O', 'open', 1.50, '2020-01-01'), ('P', 'pending', 0.25, NULL), ('F', NULL, 2.00, '2021-06-30')) s(code, label, weight, since)
      ON s.code = o_orderstatus GROUP BY 1, 2, 3""",
)
def seed_given(t):
    names = inline.seed_given(t.spark, _STATUS_NAMES)
    return t.orders.join(names, F.col("o_orderstatus") == F.col("code")).groupBy("o_orderstatus", "label", "since").agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight")
    )


@query(
    "dynamic_partition_write",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, COUNT(*) AS n, CAST(SUM(CASE WHEN year(o_orderdate) = 1997 THEN amount + 1 ELSE amount END) AS DOUBLE) AS amount
    FROM {orders_source} GROUP BY 1, 2""",
)
def dynamic_partition_write(t):
    """Load everything, then rewrite one year's partitions with corrected amounts."""
    path = scratch_path(t.spark, "dynamic")
    keyed = t.orders_source.withColumns({"y": F.year("o_orderdate"), "m": F.month("o_orderdate")})
    files.dynamic_partition_write(keyed, path, ["y", "m"])
    files.dynamic_partition_write(keyed.where("y = 1997").withColumn("amount", (F.col("amount") + 1).cast("decimal(14,2)")), path, ["y", "m"])
    return t.spark.read.parquet(path).groupBy("y", "m").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


@query(
    "partition_collapse",
    """SELECT CAST(CAST(ts AS DATE) AS STRING) AS event_date, COUNT(*) AS n, COUNT(DISTINCT user_id) AS users, MIN(user_id) AS first_user FROM {events} GROUP BY 1""",
)
def partition_collapse(t):
    path = scratch_path(t.spark, "collapse")
    two_level = t.events.withColumns({"event_year": F.year("ts"), "event_month": F.month("ts")})
    collapsed = files.partition_collapse(two_level, "ts", ["event_year", "event_month"])
    files.write_partitioned(collapsed, path, ["event_date"], ["user_id"])
    return t.spark.read.parquet(path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"), F.min("user_id").alias("first_user")
    )


def _scratch_database(t, name: str) -> str:
    transform.provision(t.spark, name, scratch_path(t.spark, name))
    return name


@query("ctas", "SELECT o_orderpriority, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS amount FROM {orders_source} GROUP BY 1")
def ctas(t):
    db = _scratch_database(t, "scratch_build_ctas")
    files.create_table_as(t.orders_source.limit(0), f"{db}.orders_copy")
    table = files.create_table_as(t.orders_source, f"{db}.orders_copy")
    return table.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


_FACT = [
    {"name": "id", "gen": "sequence"},
    {"name": "customer_id", "gen": "id % 1500"},
    {"name": "points", "type": "bigint", "gen": "floor(rand() * 1000)"},
    {"name": "event_date", "gen": "date_add(date'2026-01-01', cast(id % 30 AS int))"},
    {"name": "channel", "gen": "element_at(array('voice', 'chat', 'email'), cast(id % 3 AS int) + 1)"},
]


@query(
    "synth_table",
    """
    WITH g AS (SELECT i AS id, i % 1500 AS customer_id,
                      CAST(floor(CAST('0x' || substr(md5(CAST(i AS STRING) || ':42:points0'), 1, 12) AS BIGINT) / 281474976710656.0 * 1000) AS BIGINT) AS points,
                      CAST(DATE '2026-01-01' + CAST(i % 30 AS INTEGER) AS DATE) AS event_date, ['voice', 'chat', 'email'][i % 3 + 1] AS channel
               FROM (SELECT unnest(generate_series(1, (SELECT COUNT(*) FROM {lineitem}))) AS i) s)
    SELECT CAST(event_date AS STRING) AS event_date, channel, c_mktsegment, COUNT(*) AS n, CAST(SUM(points) AS BIGINT) AS points, MAX(id) AS last_id
    FROM g JOIN {customer} ON c_custkey = customer_id GROUP BY 1, 2, 3""",
)
def synth_table(t):
    """A generated fact as large as ``lineitem``, laid out by day and customer, joined to real customers."""
    fact = synth.write_synth_table(
        t.spark, scratch_path(t.spark, "synth"), t.lineitem.count(), _FACT, ["event_date"], ["customer_id"]
    )
    joined = fact.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("customer_id") == F.col("c_custkey"))
    return joined.groupBy("event_date", "channel", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("points").alias("points"), F.max("id").alias("last_id")
    )


# -- schemas and catalogs --------------------------------------------------------

_EXPECTED = [
    {"name": "o_orderkey", "type": "BIGINT", "nullable": False},
    {"name": "o_custkey", "type": "INT64", "nullable": False},
    {"name": "o_orderstatus", "type": "STRING"},
    {"name": "amount", "type": "NUMERIC(14,2)", "scale": 2, "nullable": False},
    {"name": "o_orderdate", "type": "DATE"},
    {"name": "o_comment", "type": "STRING"},
]


@query(
    "schema_conformance",
    """
    SELECT * FROM (VALUES ('orders.o_orderkey', 'PASS', 'INT64', 'INT64'), ('orders.o_custkey', 'PASS', 'INT64', 'INT64'), ('orders.o_orderstatus', 'PASS', 'STRING', 'STRING'),
      ('orders.amount', 'PASS', 'NUMERIC(2)', 'NUMERIC(2)'), ('orders.o_orderdate', 'FAIL', 'DATE', 'DATETIME'), ('orders.o_comment', 'FAIL', 'STRING', NULL)) v(target, status, expected, actual)
    UNION ALL SELECT 'orders.' || c || ' (not null)', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, '0', CAST(n AS STRING)
    FROM (SELECT 'o_orderkey' AS c, COUNT(*) FILTER (o_orderkey IS NULL) AS n FROM {orders_source} UNION ALL
          SELECT 'o_custkey', COUNT(*) FILTER (o_custkey IS NULL) FROM {orders_source} UNION ALL
          SELECT 'amount', COUNT(*) FILTER (amount IS NULL) FROM {orders_source}) x""",
)
def schema_conformance(t):
    return shown(schema.schema_conformance(t.orders_source, _EXPECTED, name="orders"))


@query(
    "column_profile",
    """
    SELECT 'event_id' AS "column", 'INT64' AS type, COUNT(*) AS n_rows, COUNT(*) FILTER (event_id IS NULL) AS nulls, NULL AS int_digits, NULL AS scale_used FROM {epoch_source}
    UNION ALL SELECT 'raw_ms', 'INT64', COUNT(*), COUNT(*) FILTER (raw_ms IS NULL), NULL, NULL FROM {epoch_source}
    UNION ALL SELECT 'amount', 'NUMERIC', COUNT(*), COUNT(*) FILTER (amount IS NULL), CAST(MAX(length(CAST(CAST(floor(amount) AS BIGINT) AS STRING))) AS INTEGER),
      CAST(MAX(length(split_part(rtrim(rtrim(CAST(amount AS STRING), '0'), '.'), '.', 2))) AS INTEGER) FROM {orders_source}""",
)
def column_profile(t):
    return schema.column_profile(t.epoch_source).unionByName(schema.column_profile(t.orders_source.select("amount")))


@query(
    "nested_signature",
    """
    SELECT path, type, CAST(n_values AS BIGINT) AS n_values FROM (
      SELECT unnest(['vec_id', 'embedding', 'tag', 'tag.label', 'parts', 'parts[].k', 'parts[].v']) AS path,
             unnest(['INT64', 'ARRAY<FLOAT64>', 'STRUCT<label:INT64>', 'INT64', 'ARRAY<STRUCT<k:STRING,v:INT64>>', 'STRING', 'INT64']) AS type,
             unnest([COUNT(vec_id), COUNT(embedding), COUNT(*), COUNT(label), COUNT(*), 2 * COUNT(*), COUNT(vec_id) + COUNT(NULLIF(label, 0))]) AS n_values FROM {embeddings}) x""",
)
def nested_signature(t):
    df = t.embeddings.selectExpr(
        "vec_id", "embedding", "named_struct('Label', label) AS tag",
        "array(named_struct('k', 'a', 'v', vec_id), named_struct('k', 'b', 'v', CAST(nullif(label, 0) AS BIGINT))) AS parts",
    )
    return schema.nested_signature(df)


@query(
    "nested_signature_maps",
    """
    SELECT path, type, CAST(n_values AS BIGINT) AS n_values FROM (
      SELECT unnest(['k', 'facts', 'facts{{key}}', 'facts{{value}}', 'lines', 'lines[]{{key}}', 'lines[]{{value}}', 'lines[]{{value}}.qty', 'lines[]{{value}}.tags']) AS path,
             unnest(['INT64', 'MAP<STRING,NUMERIC>', 'STRING', 'NUMERIC', 'ARRAY<MAP<STRING,STRUCT<qty:INT64,tags:ARRAY<STRING>>>>', 'STRING',
                     'STRUCT<qty:INT64,tags:ARRAY<STRING>>', 'INT64', 'ARRAY<STRING>']) AS type,
             unnest([COUNT(o_orderkey), COUNT(*) FILTER (o_orderstatus <> 'P'), 2 * COUNT(*) FILTER (o_orderstatus <> 'P'),
                     COUNT(*) FILTER (o_orderstatus <> 'P') + COUNT(*) FILTER (o_orderstatus = 'O'), COUNT(*), COUNT(*), COUNT(*),
                     COUNT(*) FILTER (o_orderkey % 3 <> 0), COUNT(*)]) AS n_values FROM {orders_source}) x""",
)
def nested_signature_maps(t):
    """Maps by their sides, also inside arrays: a map that is NULL at times, one with NULL values, structs as values."""
    df = t.orders_source.selectExpr(
        "o_orderkey AS k",
        "CASE WHEN o_orderstatus <> 'P' THEN map('amount', amount, 'open', CASE WHEN o_orderstatus = 'O' THEN amount END) END AS facts",
        "array(map(o_orderpriority, named_struct('qty', nullif(o_orderkey % 3, 0), 'tags', array(o_orderstatus)))) AS lines",
    )
    return schema.nested_signature(df)


@query(
    "catalog_presence",
    " UNION ALL ".join(
        f"SELECT '{n}' AS object, 'TABLE' AS expected_type, 'TABLE' AS actual_type, COUNT(*) AS n_rows, 'PASS' AS status FROM {{{n}}}"
        for n in TABLES
    )
    + " UNION ALL SELECT 'shipments', 'TABLE', NULL, NULL, 'FAIL'",
)
def catalog_presence(t):
    """Every driver table, and one that is not there."""
    return schema.catalog_presence(t.spark, {n: getattr(t, n) for n in TABLES}, {n: "TABLE" for n in (*TABLES, "shipments")})


@query(
    "object_types",
    """
    SELECT 'orders_copy' AS object, 'TABLE' AS expected_type, 'TABLE' AS actual_type, COUNT(*) AS n_rows, 'PASS' AS status FROM {orders_source}
    UNION ALL SELECT 'open_orders', 'VIEW', 'VIEW', COUNT(*), 'PASS' FROM {orders_source} WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'mv_status', 'MATERIALIZED_VIEW', 'MATERIALIZED_VIEW', COUNT(DISTINCT o_orderstatus), 'PASS' FROM {orders_source}
    UNION ALL SELECT 'flipped', 'TABLE', 'VIEW', COUNT(*), 'FAIL' FROM {orders_source}""",
)
def object_types(t):
    db = _scratch_database(t, "scratch_build_objects")
    files.create_table_as(t.orders_source, f"{db}.orders_copy")
    t.spark.sql(f"CREATE VIEW {db}.open_orders AS SELECT * FROM {db}.orders_copy WHERE o_orderstatus = 'O'")
    t.spark.sql(f"CREATE VIEW {db}.flipped AS SELECT * FROM {db}.orders_copy")
    per_status = t.orders_source.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    files.create_table_as(per_status, f"{db}.mv_status")
    t.spark.sql(f"ALTER TABLE {db}.mv_status SET TBLPROPERTIES ('object_type' = 'MATERIALIZED_VIEW')")
    wanted = {"orders_copy": "TABLE", "open_orders": "VIEW", "mv_status": "MATERIALIZED_VIEW", "flipped": "TABLE"}
    return schema.catalog_presence(t.spark, {n: f"{db}.{n}" for n in wanted}, wanted)


@query(
    "queryability",
    " UNION ALL ".join(f"SELECT '{n}' AS object, 'PASS' AS status, CAST(NULL AS STRING) AS error, COUNT(*) AS n_rows FROM {{{n}}}" for n in TABLES)
    + " UNION ALL SELECT 'broken view', 'FAIL', 'UNRESOLVED_COLUMN.WITH_SUGGESTION', NULL",
)
def queryability(t):
    """Every driver table, and a query that does not analyse."""
    objects = {n: f"SELECT * FROM probe_{n}" for n in TABLES} | {"broken view": "SELECT no_such_column FROM probe_orders"}
    with transform.visible({f"probe_{n}": getattr(t, n) for n in TABLES}):
        return schema.queryability(t.spark, objects)


@query(
    "type_map",
    """
    SELECT 'event_id' AS "column", 'BIGINT' AS legacy_type, 'INT64' AS target_type, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS lossy_rows FROM {events}
    UNION ALL SELECT 'event_type', 'STRING', 'STRING', COUNT(*), 0 FROM {events}
    UNION ALL SELECT 'value', 'DOUBLE', 'FLOAT64', COUNT(*), 0 FROM {events}
    UNION ALL SELECT 'amount', 'DECIMAL(12,2)', 'NUMERIC(12,2)', COUNT(*), 0 FROM {events}
    UNION ALL SELECT 'k', 'INT', 'INT64', COUNT(*), 0 FROM {events}
    UNION ALL SELECT 'props', 'STRING', 'STRING', COUNT(*), 0 FROM {events}
    UNION ALL SELECT 'fine', 'DECIMAL(25,12)', 'NUMERIC(25,12)', COUNT(*), COUNT(*) FILTER (event_id * 1001 % 1000 <> 0) FROM {events}""",
)
def type_map(t):
    """Columns whose values come back, and one with more places than the target keeps."""
    df = t.events.selectExpr(
        "event_id", "event_type", "value", "CAST(value AS DECIMAL(12,2)) AS amount", "CAST(user_id AS INT) AS k", "props",
        "CAST(event_id * 0.000000001001BD AS DECIMAL(25,12)) AS fine",
    )
    return schema.type_map(df)


# -- transforms and builds ---------------------------------------------------------


@query(
    "transform_unit",
    """
    WITH o AS (SELECT COUNT(*) AS n FROM {ods_invoice_raw} WHERE op IN ('I', 'U')), u AS (SELECT COUNT(*) AS n FROM {ods_invoice_raw} WHERE op = 'u')
    SELECT 'ods_invoice' AS target, 'PASS' AS status, '0 missing, 0 unexpected' AS expected, '0 missing, 0 unexpected' AS actual
    UNION ALL SELECT 'ods_invoice.rowcount', 'PASS', CAST(n AS STRING), CAST(n AS STRING) FROM o
    UNION ALL SELECT 'ods_invoice.unique(invoice_id)', 'PASS', CAST(n AS STRING), CAST(n AS STRING) FROM o
    UNION ALL SELECT 'ods_invoice.issued_ts no_nulls', 'PASS', '0', '0'
    UNION ALL SELECT 'upper expected', CASE WHEN u.n = 0 THEN 'PASS' ELSE 'FAIL' END, '0 missing, 0 unexpected', CAST(u.n AS STRING) || ' missing, 0 unexpected' FROM u""",
)
def transform_unit(t):
    given = {"ods_invoice_raw": t.ods_invoice_raw}
    expected = t.orders.where("o_orderstatus = 'O'").selectExpr(
        "o_orderkey AS invoice_id", "CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS STRING) AS amount", "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS issued_ts"
    )
    folded = t.orders.where("o_orderstatus IN ('O', 'P')").selectExpr("o_orderkey AS invoice_id")
    n = t.orders.where("o_orderstatus = 'O'").count()
    checks = transform.transform_unit(
        t.spark, given, TRANSFORM_INVOICE,
        {"table": "ods_invoice", "rows": expected, "assert": [{"rowcount": n}, {"unique": ["invoice_id"]}, {"no_nulls": ["issued_ts"]}]},
    )
    wrong = transform.transform_unit(t.spark, given, TRANSFORM_INVOICE, {"table": "upper expected", "rows": folded})
    return shown(checks.unionByName(wrong))


@query(
    "transform_diff",
    """
    WITH l AS (SELECT COUNT(*) AS n FROM {ods_invoice_raw} WHERE op = 'u')
    SELECT 'channel totals' AS target, 'PASS' AS status, '0 missing, 0 unexpected' AS actual
    UNION ALL SELECT 'case rewrite', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, '0 missing, ' || CAST(n AS STRING) || ' unexpected' FROM l
    UNION ALL SELECT 'broken rewrite', 'ERROR', NULL""",
)
def transform_diff(t):
    given = {"ods_invoice_raw": t.ods_invoice_raw}
    cases = {
        "channel totals": ("SELECT op, count(*) AS N, sum(amount) AS amt FROM ods_invoice_raw GROUP BY op",
                           "SELECT op, sum(amount) AS amt, sum(1) AS n FROM ods_invoice_raw GROUP BY op"),
        "case rewrite": ("SELECT invoice_id FROM ods_invoice_raw WHERE op IN ('I', 'U')",
                         "SELECT invoice_id FROM ods_invoice_raw WHERE upper(op) IN ('I', 'U')"),
        "broken rewrite": ("SELECT invoice_id FROM ods_invoice_raw", "SELECT invoice_no FROM ods_invoice_raw"),
    }
    out = None
    for name, (legacy, migrated) in cases.items():
        checks = transform.transform_diff(t.spark, given, legacy, migrated, name=name)
        out = checks if out is None else out.unionByName(checks)
    return out.select("target", "status", "actual")


@query(
    "build_and_verify",
    """
    WITH n AS (SELECT CAST(COUNT(*) FILTER (o_orderstatus = 'O') AS STRING) AS o, CAST(COUNT(*) AS STRING) AS a FROM {orders})
    SELECT 'ods_invoice' AS target, 'PASS' AS status, o AS expected, o AS actual FROM n
    UNION ALL SELECT 'staging', 'PASS', a, a FROM n
    UNION ALL SELECT 'short', CASE WHEN o = a THEN 'PASS' ELSE 'FAIL' END, a, o FROM n
    UNION ALL SELECT 'step 2 (transform)', 'ERROR', NULL, NULL""",
)
def build_and_verify(t):
    path = scratch_path(t.spark, "feed")
    t.ods_invoice_raw.write.parquet(path)
    steps = [
        {"kind": "load", "from": path, "format": "PARQUET", "target": "ods_invoice_raw"},
        {"kind": "transform", "sql_text": TRANSFORM_INVOICE},
    ]
    suites = [
        lambda spark: rowcount_parity(t.orders.where("o_orderstatus = 'O'"), spark.table("ods_invoice"), name="ods_invoice"),
        lambda spark: rowcount_parity(t.orders, spark.table("ods_invoice_raw"), name="staging"),
    ]
    suites.append(lambda spark: rowcount_parity(t.orders, spark.table("ods_invoice"), name="short"))
    whole = transform.build_and_verify(t.spark, steps, suites, "scratch_build_verify", scratch_path(t.spark, "build"))
    # A step that fails ends the build: the steps after it and the suites do not run.
    broken = [steps[0], {"kind": "transform", "sql_text": "CREATE TABLE ods_invoice AS SELECT no_such_column FROM ods_invoice_raw"}, steps[1]]
    ended = transform.build_and_verify(t.spark, broken, suites, "scratch_build_broken", scratch_path(t.spark, "build"))
    return shown(whole.unionByName(ended))


@query(
    "scan_reduction",
    """
    SELECT target, 'PASS' AS status, n_filtered, n_full FROM (
      SELECT 'partition filter' AS target, COUNT(*) FILTER (year(o_orderdate) = 1997) AS n_filtered, COUNT(*) AS n_full FROM {orders_source}
      UNION ALL SELECT 'unfiltered rejected', 0, COUNT(*) FROM {orders_source}) x
    UNION ALL SELECT 'no partitions', 'FAIL', COUNT(*) FILTER (year(o_orderdate) = 1997), COUNT(*) FROM {orders_source}""",
)
def scan_reduction(t):
    path = scratch_path(t.spark, "pruned")
    df = t.orders_source.withColumn("order_year", F.year("o_orderdate"))
    files.write_partitioned(df, path, ["order_year"], ["o_custkey"])
    table = t.spark.read.parquet(path)
    # Both sides read the same columns, so only pruning can make a difference.
    full = table.groupBy("o_orderstatus").agg(F.sum("amount"))
    pruned = table.where("order_year = 1997").groupBy("o_orderstatus").agg(F.sum("amount"))
    reduced = perf.scan_reduction(full, pruned, name="partition filter").select("target", "status")
    counts = table.agg(F.count_if(F.col("order_year") == 1997).alias("n_filtered"), F.count(F.lit(1)).alias("n_full"))
    perf.require_partition_filter(pruned)
    try:
        perf.require_partition_filter(full)
        rejected = "FAIL"
    except perf.PartitionFilterRequired:
        rejected = "PASS"
    status = reduced.select("status").scalar()
    flat = scratch_path(t.spark, "flat")
    df.write.parquet(flat)
    twin = t.spark.read.parquet(flat)
    sums = lambda x: x.groupBy("o_orderstatus").agg(F.sum("amount"))
    unpruned = perf.scan_reduction(sums(twin), sums(twin.where("order_year = 1997")), name="no partitions").select("status").scalar()
    flat_counts = counts.select(F.lit("no partitions").alias("target"), unpruned.alias("status"), "n_filtered", "n_full")
    return flat_counts.unionByName(counts.select(F.lit("partition filter").alias("target"), status.alias("status"), "n_filtered", "n_full")).unionByName(
        counts.select(
            F.lit("unfiltered rejected").alias("target"), F.lit(rejected).alias("status"), F.lit(0).cast("bigint").alias("n_filtered"), "n_full"
        )
    )
