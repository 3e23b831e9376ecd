"""Validation operators on pairs of copies with known differences."""

from __future__ import annotations

from pyspark.sql import functions as F

from paritas.functions import canon
from paritas.operators import encoding, history, integrity, merge, parity, report
from paritas.plans.registry import query

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "amount", "o_orderdate", "o_orderpriority"]


def shown(checks):
    """The comparable columns of a checks table."""
    return checks.select("target", "status", "expected", "actual")


# Canonical text of an orders copy, spelled in SQL.
_STRIP = "rtrim(rtrim(CAST({0} AS STRING), '0'), '.')"
_ORDER_TEXT = (
    "concat_ws(chr(31), CAST(o_orderkey AS STRING), CAST(o_custkey AS STRING), o_orderstatus, "
    + _STRIP.format("amount")
    + ", strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderpriority)"
)
_H1 = "CAST('0x' || substr(md5({0}), 1, 15) AS BIGINT)"
_H2 = "CAST('0x' || substr(md5({0}), 16, 15) AS BIGINT)"


def _hashed(table: str) -> str:
    key = _H1.format("CAST(o_orderkey AS STRING)")
    return (
        f"SELECT o_orderkey, {key} AS key_hash, {_H1.format(_ORDER_TEXT)} AS h1, {_H2.format(_ORDER_TEXT)} AS h2 "
        f"FROM {{{table}}}"
    )


#: Bits of the last and of the first level of a digest tree over at most 2**30 rows.
_LEAF_BITS = "(CAST(floor(log2(n)) AS INTEGER) + 2)"
_FIRST_BITS = f"({_LEAF_BITS} // 2)"


_DIGEST = (
    "COUNT(*) AS n, CAST(SUM(h1) AS STRING) AS sum1, CAST(SUM(h2) AS STRING) AS sum2, "
    "bit_xor(h1) AS xor1, bit_xor(h2) AS xor2"
)


def _digest_text(digest):
    return digest.withColumn("sum1", F.col("sum1").cast("string")).withColumn("sum2", F.col("sum2").cast("string")).drop("digest")


@query(
    "canonical_row",
    f"""SELECT o_orderkey, {_ORDER_TEXT} AS row_text FROM {{orders_target}}""",
)
def canonical_row(t):
    return t.orders_target.select("o_orderkey", canon.canon_row(t.orders_target, ORDER_COLUMNS).alias("row_text"))


@query("table_fingerprint", f"SELECT {_DIGEST} FROM ({_hashed('orders_target')}) x")
def table_fingerprint(t):
    return _digest_text(canon.fingerprint(t.orders_target, ORDER_COLUMNS))


_EVENT_TEXT = (
    "concat_ws(chr(31), CAST(event_id AS STRING), strftime(ts, '%Y-%m-%d %H:%M:%S'), CAST(user_id AS STRING), event_type, "
    + _STRIP.format("CAST(round(value * 1000000.0) AS DECIMAL(30,0)) * 0.000001")
    + ", props)"
)


@query(
    "fingerprint_pushdown",
    f"""SELECT {_DIGEST} FROM (SELECT {_H1.format(_EVENT_TEXT)} AS h1, {_H2.format(_EVENT_TEXT)} AS h2 FROM {{events}}) x""",
)
def fingerprint_pushdown(t):
    return _digest_text(canon.fingerprint(t.events, ["event_id", "ts", "user_id", "event_type", "value", "props"]))


@query(
    "bucket_digests",
    f"""
    WITH t AS (SELECT COUNT(*) AS n FROM {{orders_source}})
    SELECT key_hash >> (60 - {_FIRST_BITS}) AS bucket, {_DIGEST} FROM ({_hashed('orders_source')}) x, t GROUP BY 1""",
)
def bucket_digests(t):
    return _digest_text(parity.bucket_digests(t.orders_source, ["o_orderkey"], ORDER_COLUMNS))


@query(
    "sorted_digest",
    f"""
    WITH a AS ({_hashed('orders_source')}), b AS ({_hashed('orders_target')})
    SELECT 'identical copy' AS copy, TRUE AS same, (SELECT COUNT(*) FROM a) AS n
    UNION ALL
    SELECT 'changed copy', (SELECT SUM(h1) FROM a) = (SELECT SUM(h1) FROM b), (SELECT COUNT(*) FROM b)""",
)
def sorted_digest(t):
    """Equality of whole tables irrespective of row order, without sorting either."""
    base = canon.fingerprint(t.orders_source, ORDER_COLUMNS).select(F.col("digest").alias("want"))
    reordered = t.orders_source.orderBy(F.col("amount").desc())
    copies = [("identical copy", reordered), ("changed copy", t.orders_target)]
    found = [canon.fingerprint(df, ORDER_COLUMNS).select(F.lit(name).alias("copy"), "digest", "n") for name, df in copies]
    return report.reconcile(found).select("copy", (F.col("digest") == base.scalar()).alias("same"), "n")


@query(
    "rowcount_parity",
    """
    WITH s AS (SELECT COUNT(*) AS n FROM {orders_source}), t AS (SELECT COUNT(*) AS n FROM {orders_target}),
         sf AS (SELECT COUNT(*) AS n FROM {orders_source} WHERE o_orderstatus = 'F'), tf AS (SELECT COUNT(*) AS n FROM {orders_target} WHERE o_orderstatus = 'F')
    SELECT 'orders exact' AS target, CASE WHEN s.n = t.n THEN 'PASS' ELSE 'FAIL' END AS status, CAST(s.n AS STRING) AS expected, CAST(t.n AS STRING) AS actual FROM s, t
    UNION ALL
    SELECT 'orders 1%', CASE WHEN abs(s.n - t.n) <= s.n * 0.01 THEN 'PASS' ELSE 'FAIL' END, CAST(s.n AS STRING), CAST(t.n AS STRING) FROM s, t
    UNION ALL
    SELECT 'orders F', CASE WHEN abs(sf.n - tf.n) <= 5000 THEN 'PASS' ELSE 'FAIL' END, CAST(sf.n AS STRING), CAST(tf.n AS STRING) FROM sf, tf""",
)
def rowcount_parity(t):
    s, g = t.orders_source, t.orders_target
    only_f = "o_orderstatus = 'F'"
    return shown(
        report.reconcile(
            [
                parity.rowcount_parity(s, g, name="orders exact"),
                parity.rowcount_parity(s, g, "1%", name="orders 1%"),
                parity.rowcount_parity(s, g, "5000", only_f, only_f, name="orders F"),
            ]
        )
    )


_AGGREGATES = [
    {"column": "amount", "fn": "sum", "tolerance": "0.5%"},
    {"column": "amount", "fn": "max"},
    {"column": "o_orderkey", "fn": "count_distinct"},
    {"column": "o_orderkey", "fn": "count"},
    {"column": "o_orderkey", "fn": "max"},
    {"column": "o_orderdate", "fn": "min", "tolerance": "0"},
    {"column": "o_orderstatus", "fn": "max"},
]


@query(
    "aggregate_parity",
    f"""
    WITH a AS (
      SELECT 0 AS side, SUM(amount) AS v1, MAX(amount) AS v2, COUNT(DISTINCT o_orderkey) AS v3, COUNT(o_orderkey) AS v4,
             MAX(o_orderkey) AS v5, [sec:MIN] AS v6, MAX(o_orderstatus) AS v7 FROM {{orders_source}}
      UNION ALL
      SELECT 1, SUM(amount), MAX(amount), COUNT(DISTINCT o_orderkey), COUNT(o_orderkey), MAX(o_orderkey), [sec:MIN], MAX(o_orderstatus) FROM {{orders_target}}),
    l AS (
      SELECT side, unnest([1, 2, 3, 4, 5, 6, 7]) AS i, unnest(['amount:sum', 'amount:max', 'o_orderkey:count_distinct', 'o_orderkey:count', 'o_orderkey:max', 'o_orderdate:min', 'o_orderstatus:max']) AS name,
             unnest([{_STRIP.format('v1')}, {_STRIP.format('v2')}, CAST(v3 AS STRING), CAST(v4 AS STRING), CAST(v5 AS STRING), CAST(v6 AS STRING), v7]) AS v
      FROM a)
    SELECT 'orders.' || s.name AS target,
           CASE WHEN s.v = t.v THEN 'PASS'
                WHEN s.i = 1 AND abs(CAST(s.v AS DECIMAL(38,9)) - CAST(t.v AS DECIMAL(38,9))) <= CAST(s.v AS DOUBLE) * 0.005 THEN 'PASS' ELSE 'FAIL' END AS status,
           s.v AS expected, t.v AS actual
    FROM l s JOIN l t ON s.i = t.i AND s.side = 0 AND t.side = 1""".replace("[sec:MIN]", "CAST(floor(epoch(MIN(o_orderdate))) AS BIGINT)"),
)
def aggregate_parity(t):
    return shown(parity.aggregate_parity(t.orders_source, t.orders_target, _AGGREGATES, name="orders"))


_DIFF = """
    SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey,
           CASE WHEN t.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS difference,
           CAST(s.o_orderkey IS NOT NULL AS BIGINT) AS n_source, CAST(t.o_orderkey IS NOT NULL AS BIGINT) AS n_target
    FROM {orders_source} s FULL OUTER JOIN {orders_target} t ON s.o_orderkey = t.o_orderkey
    WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL OR s.amount <> t.amount"""


def _tree_passes(name: str, table: str) -> str:
    """The passes of a digest tree over ``orders_source`` and a copy: nodes, unequal ones and rows read."""
    moved = "sum(sign) AS dn, sum(sign * h1) AS d1, sum(sign * h2) AS d2, COUNT(*) AS c"
    differs = "(dn <> 0 OR d1 <> 0 OR d2 <> 0)"
    row = f"COUNT(*) AS nodes, COUNT(*) FILTER {differs} AS unequal, CAST(coalesce(SUM(c), 0) AS BIGINT) AS rows_read"
    return f"""
    SELECT * FROM (
      WITH u AS (SELECT *, 1 AS sign FROM ({_hashed('orders_source')}) x UNION ALL SELECT *, -1 FROM ({_hashed(table)}) y),
           b AS (SELECT {_LEAF_BITS} AS leaf, {_FIRST_BITS} AS first_bits
                 FROM (SELECT greatest((SELECT COUNT(*) FROM {{orders_source}}), (SELECT COUNT(*) FROM {{{table}}})) AS n) z),
           k AS (SELECT u.*, key_hash >> (60 - first_bits) AS upper_node, key_hash >> (60 - leaf) AS lower_node FROM u, b),
           l1 AS (SELECT upper_node, {moved} FROM k GROUP BY 1),
           l2 AS (SELECT lower_node, {moved} FROM k WHERE upper_node IN (SELECT upper_node FROM l1 WHERE {differs}) GROUP BY 1),
           l3 AS (SELECT o_orderkey, {moved} FROM k WHERE lower_node IN (SELECT lower_node FROM l2 WHERE {differs}) GROUP BY 1)
      SELECT '{name}' AS copy, 1 AS pass, {row} FROM l1 UNION ALL SELECT '{name}', 2, {row} FROM l2 UNION ALL SELECT '{name}', 3, {row} FROM l3) v"""


_COPIES = {"golden": "orders_source", "faulty": "orders_target", "badly faulty": "orders_ruined"}


@query("digest_tree", " UNION ALL ".join(_tree_passes(name, table) for name, table in _COPIES.items()))
def digest_tree(t):
    """What each pass of the drill-down reads, for an equal copy, one with a few differences and one with very many."""
    found = []
    for name, table in _COPIES.items():
        tree = parity.DigestTree(t.orders_source, getattr(t, table), ["o_orderkey"], ORDER_COLUMNS)
        found.append(tree.passes().select(F.lit(name).alias("copy"), "pass", "nodes", "unequal", "rows_read"))
    return report.reconcile(found)


@query("digest_tree_differences", _DIFF.replace("{orders_target}", "{orders_ruined}"))
def digest_tree_differences(t):
    """Every differing key of the copy with very many differences."""
    return parity.localised_differences(t.orders_source, t.orders_ruined, ["o_orderkey"], ORDER_COLUMNS)


@query(
    "separator_parity",
    """
    SELECT 'same names' AS target, CASE WHEN (SELECT COUNT(*) FROM (FROM {nation_left} EXCEPT ALL FROM {nation_left}) x) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    UNION ALL SELECT 'separator moved', CASE WHEN (SELECT COUNT(*) FROM (FROM {nation_left} EXCEPT ALL FROM {nation_right}) x) = 0 THEN 'PASS' ELSE 'FAIL' END""",
)
def separator_parity(t):
    """Rows whose values differ only in where a separator sign stands."""
    columns = ["n_nationkey", "a", "b"]
    checks = parity.fingerprint_parity(t.nation_left, t.nation_left, columns, name="same names").unionByName(
        parity.fingerprint_parity(t.nation_left, t.nation_right, columns, name="separator moved")
    )
    return checks.select("target", "status")


@query(
    "small_tolerances",
    """
    WITH m AS (SELECT MAX(v) AS a, MAX(CASE WHEN v < 0.0000000000003 THEN v END) AS b FROM {small_numbers})
    SELECT 'decimal ' || label || ':max' AS target, CASE WHEN abs(a - b) <= tolerance THEN 'PASS' ELSE 'FAIL' END AS status
    FROM m, (VALUES ('below.v', 0.0000000000001), ('above.v', 0.0000000000005)) x(label, tolerance)
    UNION ALL SELECT 'double ' || label || ':max', CASE WHEN abs(a - b) <= tolerance THEN 'PASS' ELSE 'FAIL' END
    FROM m, (VALUES ('below.v', 0.0000000000001), ('above.v', 0.0000000000005)) x(label, tolerance)
    UNION ALL SELECT 'scalar ' || label, CASE WHEN abs(a - b) <= tolerance THEN 'PASS' ELSE 'FAIL' END
    FROM m, (VALUES ('below', 0.0000000000001), ('above', 0.0000000000005)) x(label, tolerance)""",
)
def small_tolerances(t):
    """Maxima that differ by 4e-13, with tolerances below and above that."""
    full = t.small_numbers.selectExpr("event_id", "CAST(v AS DECIMAL(32,20)) AS v")
    part = full.where("v < 3e-13BD")
    checks = []
    for label, tolerance in (("below", "0.0000000000001"), ("above", "0.0000000000005")):
        spec = [{"column": "v", "fn": "max", "tolerance": tolerance}]
        doubles = [df.withColumn("v", F.col("v").cast("double")) for df in (full, part)]
        checks.append(parity.aggregate_parity(full, part, spec, name=f"decimal {label}"))
        checks.append(parity.aggregate_parity(*doubles, spec, name=f"double {label}"))
        tops = [df.agg(F.max("v").alias("v")) for df in (full, part)]
        checks.append(parity.query_parity(*tops, "scalar", tolerance, name=f"scalar {label}"))
    return report.reconcile(checks).select("target", "status")


_PLAIN_PROPS = "regexp_extract(props, '([0-9]+)', 1)"


@query(
    "json_parity",
    f"""
    WITH a AS (SELECT event_id, user_id, CAST({_PLAIN_PROPS} AS BIGINT) AS k FROM {{events}}),
         changed AS (SELECT event_id, user_id, CASE WHEN event_id % 97 = 3 THEN k + 1 ELSE k END AS k FROM a)
    SELECT 'reordered (rows)' AS target, '0' AS actual, CASE WHEN (SELECT COUNT(*) FROM (FROM a EXCEPT ALL FROM a) x) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    UNION ALL SELECT 'changed (rows)', CAST(COUNT(*) AS STRING), CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END FROM (FROM a EXCEPT ALL FROM changed) x""",
)
def json_parity(t):
    """JSON with other key order and number spelling is the same; one with another number is not.  As text and as VARIANT."""
    k = F.expr(f"CAST({_PLAIN_PROPS} AS BIGINT)")
    source = t.events.select("event_id", F.format_string('{"k": %d, "user": {"id": %d, "tags": ["a", null, true]}, "x": 2}', k, "user_id").alias("props"))
    other = F.format_string('{ "x":2.0, "user":{"tags":["\\u0061",null,true],"id":%d.00},"k":%de0 }', "user_id", k)
    wrong = F.format_string('{"k": %d, "user": {"id": %d, "tags": ["a", null, true]}, "x": 2}', k + F.expr("if(event_id % 97 = 3, 1, 0)"), "user_id")
    out = []
    for label, text in (("reordered", other), ("changed", wrong)):
        copy = t.events.select("event_id", text.alias("props"))
        as_text = parity.fingerprint_parity(source, copy, ["event_id", "props"], ["event_id"], name=label, json_columns=["props"])
        typed = [df.select("event_id", F.parse_json("props").alias("props")) for df in (source, copy)]
        counted = parity.diff_keys(*typed, ["event_id"], ["event_id", "props"]).agg(F.count(F.lit(1)).alias("n"))
        verdicts = as_text.where(~F.col("target").contains("localized")).select("status")
        out.append(counted.select(F.lit(f"{label} (rows)").alias("target"), F.col("n").cast("string").alias("actual"), verdicts.scalar().alias("status")))
    return out[0].unionByName(out[1])


@query("diff_keys", _DIFF)
def diff_keys(t):
    return parity.diff_keys(t.orders_source, t.orders_target, ["o_orderkey"], ORDER_COLUMNS)


@query("localised_differences", _DIFF)
def localised_differences(t):
    return parity.localised_differences(t.orders_source, t.orders_target, ["o_orderkey"], ORDER_COLUMNS)


@query(
    "fingerprint_parity",
    f"""
    WITH s AS (SELECT count(*) AS n, sum(h1) AS s1, sum(h2) AS s2, bit_xor(h1) AS x1, bit_xor(h2) AS x2 FROM ({_hashed('orders_source')}) x),
         g AS (SELECT count(*) AS n, sum(h1) AS s1, sum(h2) AS s2, bit_xor(h1) AS x1, bit_xor(h2) AS x2 FROM ({_hashed('orders_target')}) x),
         src AS (SELECT md5(concat_ws('|', n, s1, s2, x1, x2)) AS digest FROM s), tgt AS (SELECT md5(concat_ws('|', n, s1, s2, x1, x2)) AS digest FROM g),
         d AS (SELECT count(*) AS n, array_to_string(list_sort(list(o_orderkey))[:10], ', ') AS names FROM ({_DIFF}) y)
    SELECT 'golden' AS target, CASE WHEN a.digest = b.digest THEN 'PASS' ELSE 'FAIL' END AS status, a.digest AS expected, b.digest AS actual,
           CAST(NULL AS STRING) AS first_keys FROM src a, src b
    UNION ALL SELECT 'faulty', CASE WHEN src.digest = tgt.digest THEN 'PASS' ELSE 'FAIL' END, src.digest, tgt.digest, NULL FROM src, tgt
    UNION ALL SELECT 'faulty (localized)', 'FAIL', '0', CAST(n AS STRING), names FROM d WHERE n > 0""",
)
def fingerprint_parity(t):
    """The operator on an equal and on a faulty copy: digests, and how many keys differ and which come first."""
    compare = lambda copy, name: parity.fingerprint_parity(t.orders_source, copy, ORDER_COLUMNS, ["o_orderkey"], name=name)
    checks = compare(t.orders_source, "golden").unionByName(compare(t.orders_target, "faulty"))
    return checks.select("target", "status", "expected", "actual", F.col("metrics")["differing_keys"].alias("first_keys"))


@query("diff_sample", f"SELECT * FROM ({_DIFF}) x ORDER BY o_orderkey LIMIT 10")
def diff_sample(t):
    return parity.diff_sample(diff_keys(t), ["o_orderkey"])




@query(
    "query_parity",
    """
    WITH s AS (SELECT o_orderpriority, COUNT(*) AS n, SUM(amount) AS amt FROM {orders_source} GROUP BY 1),
         t AS (SELECT o_orderpriority, COUNT(*) AS n, SUM(amount) AS amt FROM {orders_target} GROUP BY 1),
         d AS (SELECT COUNT(*) AS n FROM s FULL OUTER JOIN t ON s.o_orderpriority = t.o_orderpriority AND s.n = t.n AND s.amt = t.amt
               WHERE s.n IS NULL OR t.n IS NULL)
    SELECT 'priority rollup' AS target, CASE WHEN d.n = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM d
    UNION ALL SELECT 'same rollup', 'PASS'
    UNION ALL SELECT 'distinct customers', CASE WHEN abs((SELECT COUNT(DISTINCT o_custkey) FROM {orders_source}) - (SELECT COUNT(DISTINCT o_custkey) FROM {orders_target}))
                <= 0.05 * (SELECT COUNT(DISTINCT o_custkey) FROM {orders_source}) THEN 'PASS' ELSE 'FAIL' END
    UNION ALL SELECT 'channel class', 'PASS'""",
)
def query_parity(t):
    def rollup(df):
        return df.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amt"))

    s, g = t.orders_source, t.orders_target
    distinct = lambda df: df.agg(F.approx_count_distinct("o_custkey", 0.01).alias("d"))
    realtime = F.when(F.col("event_type").rlike("^(view|click)$"), "realtime").otherwise("async").alias("cls")
    listed = F.when(F.col("event_type").isin("view", "click"), "realtime").otherwise("async").alias("cls")
    count = F.count(F.lit(1)).alias("n")
    checks = [
        parity.query_parity(rollup(s), rollup(g), name="priority rollup"),
        parity.query_parity(rollup(s), rollup(s), name="same rollup"),
        parity.query_parity(distinct(s), distinct(g), "scalar", "5%", name="distinct customers"),
        parity.query_parity(t.events.groupBy(realtime).agg(count), t.events.groupBy(listed).agg(count), name="channel class"),
    ]
    return report.reconcile(checks).select("target", "status")


@query(
    "multiset_diff",
    f"""
    WITH s AS (SELECT {_ORDER_TEXT} AS row_text, count(*) AS n FROM {{orders_source}} GROUP BY 1),
         g AS (SELECT {_ORDER_TEXT} AS row_text, count(*) AS n FROM {{orders_repeated}} GROUP BY 1)
    SELECT row_text, CASE WHEN coalesce(s.n, 0) > coalesce(g.n, 0) THEN 'missing' ELSE 'unexpected' END AS difference,
           abs(coalesce(s.n, 0) - coalesce(g.n, 0)) AS copies
    FROM s FULL JOIN g USING (row_text) WHERE coalesce(s.n, 0) <> coalesce(g.n, 0)""",
)
def multiset_diff(t):
    """Against a copy with changed, absent and repeated rows."""
    return parity.multiset_diff(t.orders_source, t.orders_repeated, ORDER_COLUMNS)


# -- encodings -----------------------------------------------------------------

_SANE = "raw_ms >= 0 AND raw_ms < 4133980800000"


@query(
    "keyed_compare",
    """
    WITH s AS (SELECT event_id, count(*) AS n, CASE WHEN count(*) = 1 THEN max(raw_ms) END AS raw FROM {epoch_source} GROUP BY event_id),
         t AS (SELECT event_id, count(*) AS n, CASE WHEN count(*) = 1 THEN max(converted_ts) END AS found FROM {epoch_doubled} GROUP BY event_id)
    SELECT event_id, coalesce(s.n, 0) AS n_source, coalesce(t.n, 0) AS n_target, coalesce(s.n, 0) > 1 OR coalesce(t.n, 0) > 1 AS duplicated,
           raw AS source_raw_ms, strftime(found, '%Y-%m-%d %H:%M:%S') AS target_raw_ms
    FROM s FULL JOIN t USING (event_id)""",
)
def keyed_compare(t):
    return parity.keyed_compare(t.epoch_source, t.epoch_doubled, ["event_id"], {"raw_ms": "converted_ts"})


@query(
    "epoch_duplicates",
    """
    SELECT event_id FROM {epoch_doubled} GROUP BY event_id HAVING count(*) > 1""",
)
def epoch_duplicates(t):
    found = encoding.classify_epochs(t.epoch_source, t.epoch_doubled, "event_id", "raw_ms", "converted_ts", "millis")
    return found.where("outcome = 'duplicate'").select("event_id")


@query(
    "decimal_duplicates",
    """
    SELECT o_orderkey, 'amount' AS "column", '1 rows' AS source_value, CAST(count(*) AS STRING) || ' rows' AS target_value
    FROM {orders_doubled} GROUP BY o_orderkey HAVING count(*) > 1""",
)
def decimal_duplicates(t):
    """A copy that is right but for a second row under some keys, one of them with another amount."""
    return encoding.decimal_differences(t.orders_source, t.orders_doubled, ["o_orderkey"], ["amount"])


@query(
    "decimal_duplicates_check",
    """
    SELECT 'orders.amount' AS target, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, '0' AS expected, CAST(count(*) AS STRING) AS actual
    FROM (SELECT o_orderkey FROM {orders_doubled} GROUP BY o_orderkey HAVING count(*) > 1) x""",
)
def decimal_duplicates_check(t):
    return shown(encoding.decimal_roundtrip(t.orders_source, t.orders_doubled, ["o_orderkey"], ["amount"], name="orders"))


@query(
    "epoch_convert",
    f"""SELECT event_id, CASE WHEN {_SANE} THEN strftime(make_timestamp(raw_ms * 1000), '%Y-%m-%d %H:%M:%S') END AS converted_ts
        FROM {{epoch_source}}""",
)
def epoch_convert(t):
    return t.epoch_source.select("event_id", encoding.epoch_to_timestamp(F.col("raw_ms"), "millis").alias("converted_ts"))


@query(
    "epoch_encodings",
    """
    SELECT event_id, strftime(make_timestamp(floor(epoch(ts)) :: BIGINT * 1000000), '%Y-%m-%d %H:%M:%S') AS from_seconds,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS from_micros,
           CASE WHEN event_id % 50 <> 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS from_text
    FROM {events}""",
)
def epoch_encodings(t):
    """Seconds, microseconds and vendor text of the same instants; some texts name a 13th month."""
    ts = F.col("ts").cast("timestamp")
    text = F.when(F.col("event_id") % 50 == 3, F.lit("20241399000000")).otherwise(F.date_format(ts, "yyyyMMddHHmmss"))
    return t.events.select(
        "event_id",
        encoding.epoch_to_timestamp(F.unix_seconds(ts), "seconds").alias("from_seconds"),
        encoding.epoch_to_timestamp(F.unix_micros(ts), "micros").alias("from_micros"),
        encoding.vendor_timestamp(text).alias("from_text"),
    )


@query(
    "epoch_quarantine",
    f"""SELECT 'events' AS src_table, 'raw_ms' AS src_column, event_id AS row_id,
               CASE WHEN raw_ms IS NULL THEN 'null epoch' ELSE 'epoch outside 1970-2100' END AS reason
        FROM {{epoch_source}} WHERE raw_ms IS NULL OR NOT ({_SANE})""",
)
def epoch_quarantine(t):
    return encoding.epoch_quarantine(t.epoch_source, "event_id", "raw_ms", "millis", table="events")


_OUTCOMES = f"""
    SELECT s.event_id, CASE WHEN s.raw_ms IS NULL AND t.converted_ts IS NULL THEN 'null_source'
             WHEN s.raw_ms IS NULL THEN 'not_nulled'
             WHEN NOT ({_SANE}) AND t.converted_ts IS NOT NULL THEN 'not_nulled' WHEN NOT ({_SANE}) THEN 'nulled'
             WHEN raw_ms < 1577836800000 OR raw_ms >= 1924992000000 THEN 'lying_column'
             WHEN raw_ms // 1000 = [sec:t.converted_ts] THEN 'matched' ELSE 'mismatch' END AS outcome
    FROM {{epoch_source}} s LEFT JOIN {{epoch_target}} t ON t.event_id = s.event_id"""


@query(
    "epoch_check",
    f"""
    WITH o AS ({_OUTCOMES}),
    c AS (SELECT COUNT(*) FILTER (outcome IN ('not_nulled', 'lying_column', 'mismatch')) AS bad,
                 COUNT(*) FILTER (outcome IN ('nulled', 'null_source', 'not_nulled')) AS nulled FROM o)
    SELECT 'events.converted_ts' AS target, CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status, '0' AS expected, CAST(bad AS STRING) AS actual FROM c
    UNION ALL
    SELECT 'events.converted_ts (audit)', 'PASS', '>=' || CAST(nulled AS STRING),
           (SELECT CAST(COUNT(*) AS STRING) FROM {{epoch_source}} WHERE raw_ms IS NULL OR NOT ({_SANE})) FROM c""",
)
def epoch_check(t):
    return shown(
        encoding.epoch_check(
            t.epoch_source, t.epoch_target, "event_id", "raw_ms", "converted_ts", "millis", expect_years=(2020, 2030),
            audit=epoch_quarantine(t), source_table="events", name="events.converted_ts",
        )
    )


@query("epoch_outcomes", f"SELECT outcome, COUNT(*) AS n FROM ({_OUTCOMES}) x GROUP BY 1")
def epoch_outcomes(t):
    found = encoding.classify_epochs(
        t.epoch_source, t.epoch_target, "event_id", "raw_ms", "converted_ts", "millis", expect_years=(2020, 2030)
    )
    return found.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    "decimal_roundtrip",
    """
    WITH j AS (SELECT s.o_orderkey, s.amount IS DISTINCT FROM t.amount AS a, s.o_custkey IS DISTINCT FROM t.o_custkey AS b
               FROM {orders_source} s LEFT JOIN {orders_target} t ON t.o_orderkey = s.o_orderkey)
    SELECT 'orders.amount' AS target, CASE WHEN COUNT(*) FILTER (a) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, '0' AS expected, CAST(COUNT(*) FILTER (a) AS STRING) AS actual FROM j
    UNION ALL
    SELECT 'orders.o_custkey', CASE WHEN COUNT(*) FILTER (b) = 0 THEN 'PASS' ELSE 'FAIL' END, '0', CAST(COUNT(*) FILTER (b) AS STRING) FROM j""",
)
def decimal_roundtrip(t):
    return shown(encoding.decimal_roundtrip(t.orders_source, t.orders_target, ["o_orderkey"], ["amount", "o_custkey"], name="orders"))


# -- histories -------------------------------------------------------------------

_GAPS = """
    SELECT contact_id, strftime(eff_from, '%Y-%m-%d %H:%M:%S') AS eff_from, strftime(eff_to, '%Y-%m-%d %H:%M:%S') AS eff_to,
           strftime(next_from, '%Y-%m-%d %H:%M:%S') AS next_from
    FROM (SELECT *, LEAD(eff_from) OVER (PARTITION BY contact_id ORDER BY eff_from, version_id) AS next_from FROM {history_broken}) x
    WHERE next_from IS NOT NULL AND [sec:eff_to] <> [sec:next_from]"""
_ENTITIES = """
    SELECT contact_id, COUNT(*) AS versions, COUNT(*) FILTER (is_current) AS n_current,
           COUNT(*) FILTER (is_current AND CAST(eff_to AS DATE) <> DATE '9999-12-31') AS current_not_open,
           COUNT(*) FILTER (NOT is_current AND CAST(eff_to AS DATE) = DATE '9999-12-31') AS closed_but_open
    FROM {history_broken} GROUP BY 1"""
_TERMINAL = f"""
    SELECT contact_id, CASE WHEN n_current = 1 THEN current_not_open ELSE 0 END AS current_not_open, closed_but_open
    FROM ({_ENTITIES}) e WHERE CASE WHEN n_current = 1 THEN current_not_open ELSE 0 END + closed_but_open > 0"""
_HASHES = """
    SELECT contact_id, row_hash AS stored_hash, md5(concat_ws('|', CAST(contact_id AS STRING), CAST(version_id AS STRING), segment)) AS expected_hash
    FROM {history_broken} WHERE row_hash <> md5(concat_ws('|', CAST(contact_id AS STRING), CAST(version_id AS STRING), segment))"""
_HASH_COLUMNS = ["contact_id", "version_id", "segment"]


@query("scd2_gaps", _GAPS)
def scd2_gaps(t):
    return history.scd2_gaps(t.history_broken, "contact_id", "eff_from", "eff_to")


@query("scd2_current", f"SELECT contact_id, versions, n_current FROM ({_ENTITIES}) e WHERE n_current <> 1")
def scd2_current(t):
    return history.scd2_current(t.history_broken, "contact_id", "eff_to", "is_current")


@query("scd2_terminal", _TERMINAL)
def scd2_terminal(t):
    return history.scd2_terminal(t.history_broken, "contact_id", "eff_to", "is_current")


@query("row_hash", _HASHES)
def row_hash(t):
    return history.row_hash_mismatches(t.history_broken, "contact_id", "row_hash", _HASH_COLUMNS)


def _violations(what: str, sql: str, total: str = "COUNT(*)") -> str:
    return (
        f"SELECT 'history ({what})' AS target, CASE WHEN {total} = 0 THEN 'PASS' ELSE 'FAIL' END AS status, '0' AS expected, "
        f"CAST({total} AS STRING) AS actual FROM ({sql}) v"
    )


@query(
    "scd2_continuity",
    " UNION ALL ".join(
        [
            _violations("gaps", _GAPS),
            _violations("current", f"SELECT * FROM ({_ENTITIES}) e WHERE n_current <> 1"),
            _violations("terminal", _TERMINAL, "CAST(COALESCE(SUM(current_not_open + closed_but_open), 0) AS BIGINT)"),
            _violations("row_hash", _HASHES),
            _violations(
                "source_hash",
                """SELECT h FROM (SELECT row_hash AS h, 1 AS s FROM {history} UNION ALL SELECT row_hash, -1 FROM {history_broken}) u
                   GROUP BY h HAVING SUM(s) <> 0""",
            ),
        ]
    ),
)
def scd2_continuity(t):
    return shown(
        history.scd2_continuity(
            t.history_broken, "contact_id", "eff_from", "eff_to", "is_current", row_hash_column="row_hash",
            hash_columns=_HASH_COLUMNS, source=t.history, name="history",
        )
    )


@query(
    "scd2_latest",
    """
    SELECT agent_id, version_id, strftime(eff_from_ts, '%Y-%m-%d %H:%M:%S') AS eff_from_ts, status
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY agent_id ORDER BY eff_from_ts DESC, version_id DESC) AS rn FROM {ods_agent_scd2}) x
    WHERE rn = 1""",
)
def scd2_latest(t):
    latest = history.latest_version(t.ods_agent_scd2, ["agent_id"], ["eff_from_ts", "version_id"])
    return latest.select("agent_id", "version_id", "eff_from_ts", "status")


# -- change feeds ----------------------------------------------------------------


@query(
    "cdc_latest",
    "SELECT invoice_id, contact_id, CAST(amount AS DOUBLE) AS amount, op, change_ms, extract_ts FROM {invoice_last_changes}",
)
def cdc_latest(t):
    return history.cdc_latest(t.invoice_changes, ["invoice_id"])


_ORDER = ("change_ms", "extract_ts")
_MERGED = """
    SELECT COALESCE(d.invoice_id, t.invoice_id) AS invoice_id, COALESCE(d.contact_id, t.contact_id) AS contact_id,
           CAST(COALESCE(d.amount, t.amount) AS DOUBLE) AS amount
    FROM {invoices} t FULL OUTER JOIN {invoice_last_changes} d ON d.invoice_id = t.invoice_id
    WHERE d.op IS NULL OR d.op <> 'D'"""


@query("cdc_merge", _MERGED)
def cdc_merge(t):
    return merge.cdc_merge(t.invoices, t.invoice_changes, ["invoice_id"], order=_ORDER)


@query(
    "upsert_split",
    """
    SELECT CASE WHEN d.invoice_id IS NULL THEN 'kept' WHEN t.invoice_id IS NOT NULL AND d.op = 'D' THEN 'deleted'
                WHEN t.invoice_id IS NOT NULL THEN 'updated' WHEN d.op = 'D' THEN 'ignored' ELSE 'inserted' END AS branch, COUNT(*) AS n
    FROM {invoices} t FULL OUTER JOIN {invoice_last_changes} d ON d.invoice_id = t.invoice_id GROUP BY 1""",
)
def upsert_split(t):
    return merge.upsert_split(t.invoices, t.invoice_changes, ["invoice_id"], order=_ORDER)


@query(
    "merge_idempotency",
    f"""
    WITH m AS ({_MERGED})
    SELECT 'invoices' AS target, 'PASS' AS status, CAST(COUNT(*) AS STRING) AS expected, CAST(COUNT(*) AS STRING) AS actual FROM m
    UNION ALL
    SELECT 'invoices (deletes applied)', CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END, '0', CAST(COUNT(*) AS STRING)
    FROM m WHERE invoice_id IN (SELECT invoice_id FROM {{invoice_last_changes}} WHERE op = 'D')""",
)
def merge_idempotency(t):
    batch = history.cdc_latest(t.invoice_changes, ["invoice_id"])
    return shown(merge.merge_idempotency(t.invoices, batch, ["invoice_id"], ["invoice_id", "contact_id", "amount"], name="invoices"))


@query(
    "merge_idempotency_broken",
    """
    -- A merge that only appends: the second run adds the batch again, and deleted keys stay.
    WITH b AS (SELECT invoice_id, op FROM {invoice_last_changes}), n AS (SELECT (SELECT count(*) FROM {invoices}) AS base, (SELECT count(*) FROM b) AS batch),
    gone AS (SELECT count(DISTINCT invoice_id) AS left_over FROM (SELECT invoice_id FROM {invoices} UNION ALL SELECT invoice_id FROM b UNION ALL SELECT invoice_id FROM b) t
             WHERE invoice_id IN (SELECT invoice_id FROM b WHERE op = 'D'))
    SELECT 'appended' AS target, CASE WHEN batch = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(base + batch AS STRING) AS expected,
           CAST(base + 2 * batch AS STRING) AS actual FROM n
    UNION ALL SELECT 'appended (deletes applied)', CASE WHEN left_over = 0 THEN 'PASS' ELSE 'FAIL' END, '0', CAST(left_over AS STRING) FROM gone""",
)
def merge_idempotency_broken(t):
    batch = history.cdc_latest(t.invoice_changes, ["invoice_id"])
    append = lambda table, delta: table.unionByName(delta.select("invoice_id", "contact_id", "amount"))
    columns = ["invoice_id", "contact_id", "amount"]
    return shown(merge.merge_idempotency(t.invoices, batch, ["invoice_id"], columns, append, name="appended"))


@query(
    "deleted_keys_absent",
    """
    SELECT DISTINCT t.invoice_id FROM {invoices} t JOIN {invoice_changes} d ON d.invoice_id = t.invoice_id WHERE d.op = 'D'""",
)
def deleted_keys_absent(t):
    """Keys a batch deletes that the table before the merge still holds."""
    return merge.deleted_keys_present(t.invoices, t.invoice_changes, ["invoice_id"])


@query(
    "incremental_append",
    """
    -- The table holds the orders before 1996 of every seventh customer; the feed repeats some keys with a later date.
    WITH held AS (SELECT o_orderkey, o_orderdate FROM {orders} WHERE o_custkey % 7 = 0 AND o_orderdate < TIMESTAMP '1996-01-01'),
    feed AS (
      SELECT o_orderkey, CASE WHEN o_orderkey % 83 = 1 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END AS mark FROM {orders}
      UNION ALL SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + INTERVAL '900' DAY FROM {orders} WHERE o_orderkey % 101 = 2),
    marks AS (SELECT unnest([1, 2, 3]) AS run, unnest([CAST((SELECT max(o_orderdate) FROM held) AS TIMESTAMP), TIMESTAMP '1997-01-01', TIMESTAMP '1999-06-30']) AS lo,
                     unnest([TIMESTAMP '1997-01-01', TIMESTAMP '1999-06-30', TIMESTAMP '2001-01-01']) AS hi),
    taken AS (SELECT run, o_orderkey FROM feed JOIN marks ON mark > coalesce(lo, TIMESTAMP '0001-01-01') AND mark <= hi),
    all_keys AS (SELECT o_orderkey, 0 AS run FROM held UNION ALL SELECT o_orderkey, run FROM taken)
    SELECT run, strftime(lo, '%Y-%m-%d %H:%M:%S') AS watermark_from, (SELECT count(*) FROM taken t WHERE t.run = m.run) AS rows_loaded,
           (SELECT count(DISTINCT t.o_orderkey) FROM taken t WHERE t.run = m.run
              AND (SELECT count(*) FROM all_keys k WHERE k.o_orderkey = t.o_orderkey AND k.run <= m.run) > 1) AS duplicate_keys,
           (SELECT count(*) FROM feed) - (SELECT count(*) FROM taken t WHERE t.run <= m.run) AS rows_not_taken,
           CASE WHEN EXISTS (SELECT 1 FROM taken t WHERE t.run = m.run
              AND (SELECT count(*) FROM all_keys k WHERE k.o_orderkey = t.o_orderkey AND k.run <= m.run) > 1) THEN 'FAILED' ELSE 'SUCCESS' END AS status,
           (SELECT count(*) FROM all_keys) AS table_rows
    FROM marks m""",
)
def incremental_append(t):
    orders = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("at"))
    held = orders.where("o_custkey % 7 = 0 AND at < '1996-01-01'").drop("o_custkey")
    feed = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 83 == 1, None).otherwise(F.col("at")).alias("at")).unionByName(
        orders.where("o_orderkey % 101 = 2").select("o_orderkey", (F.col("at") + F.expr("INTERVAL '900' DAY")).alias("at"))
    )
    table, audit = merge.incremental_append(held, feed, "at", ["o_orderkey"], ["1997-01-01 00:00:00", "1999-06-30 00:00:00", "2001-01-01 00:00:00"])
    return audit.withColumn("table_rows", table.agg(F.count(F.lit(1))).scalar())


# -- integrity ---------------------------------------------------------------------

_ORPHANS = """
    SELECT COUNT(*) FILTER (p.o_orderkey IS NULL) AS orphans, COUNT(*) AS total
    FROM {lineitem} c LEFT JOIN (SELECT DISTINCT o_orderkey FROM {orders_partial}) p ON p.o_orderkey = c.l_orderkey"""


@query("fk_orphan_rate", f"SELECT orphans, total, CAST(orphans AS DOUBLE) / total AS rate FROM ({_ORPHANS}) x")
def fk_orphan_rate(t):
    return integrity.fk_orphan_rate(t.lineitem, t.orders_partial, "l_orderkey", "o_orderkey")


@query(
    "anti_join_orphans",
    """
    SELECT l_orderkey AS key, COUNT(*) AS n_rows FROM {lineitem}
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM {orders_partial}) GROUP BY 1""",
)
def anti_join_orphans(t):
    return integrity.orphans(t.lineitem, t.orders_partial, "l_orderkey", "o_orderkey")


@query(
    "fk_orphan",
    f"""
    WITH s AS ({_ORPHANS}), t AS (SELECT COUNT(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM {{orders}})) AS orphans, COUNT(*) AS total FROM {{lineitem}})
    SELECT 'lineitem->orders (parity)' AS target, CASE WHEN abs(CAST(s.orphans AS DOUBLE) / s.total - CAST(t.orphans AS DOUBLE) / t.total) <= 0.0005 THEN 'PASS' ELSE 'FAIL' END AS status,
           CAST(s.orphans AS STRING) || '/' || CAST(s.total AS STRING) AS expected, CAST(t.orphans AS STRING) || '/' || CAST(t.total AS STRING) AS actual FROM s, t
    UNION ALL
    SELECT 'lineitem->orders (max)', CASE WHEN t.orphans <= 0.01 * t.total THEN 'PASS' ELSE 'FAIL' END, '<=1.0%', CAST(t.orphans AS STRING) || '/' || CAST(t.total AS STRING) FROM t""",
)
def fk_orphan(t):
    return shown(
        integrity.fk_orphan(
            (t.lineitem, t.orders_partial), (t.lineitem, t.orders), "l_orderkey", "o_orderkey", 0.05, 1.0, name="lineitem->orders"
        )
    )


# Child, child key, parent, parent key: every reference between the driver tables, and a pair of unlike types.
_REFERENCES = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("nation", "n_name", "region", "r_regionkey"),
]


@query(
    "fk_type_consistency",
    " UNION ALL ".join(
        f"""
    SELECT '{child}.{ck}' AS child, '{parent}.{pk}' AS parent, 'INT64' AS child_type, 'INT64' AS parent_type, 'PASS' AS status,
           COUNT(*) FILTER ({ck} IS NULL OR {ck} NOT IN (SELECT {pk} FROM {{{parent}}})) AS orphans, COUNT(*) AS total FROM {{{child}}}"""
        for child, ck, parent, pk in _REFERENCES[:-1]
    )
    + " UNION ALL SELECT 'nation.n_name', 'region.r_regionkey', 'STRING', 'INT64', 'FAIL', NULL, NULL",
)
def fk_type_consistency(t):
    names = {n for child, _, parent, _ in _REFERENCES for n in (child, parent)}
    return integrity.fk_type_consistency(t.spark, {n: getattr(t, n) for n in names}, _REFERENCES)


@query(
    "assert_unique",
    """
    SELECT 'o_orderkey' AS keys, COUNT(*) AS n_rows, COUNT(DISTINCT o_orderkey) AS n_distinct, CAST(0 AS BIGINT) AS duplicate_keys FROM {orders}
    UNION ALL
    SELECT 'l_orderkey,l_linenumber', CAST(SUM(n) AS BIGINT), COUNT(*), COUNT(*) FILTER (n > 1)
    FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM {lineitem} GROUP BY 1, 2) x
    UNION ALL
    SELECT 'doubled o_orderkey', CAST(SUM(n) AS BIGINT), COUNT(*), COUNT(*) FILTER (n > 1)
    FROM (SELECT o_orderkey, COUNT(*) AS n FROM {orders_doubled} GROUP BY 1) y""",
)
def assert_unique(t):
    one = integrity.assert_unique(t.orders, ["o_orderkey"]).withColumn("keys", F.lit("o_orderkey"))
    two = integrity.assert_unique(t.lineitem, ["l_orderkey", "l_linenumber"]).withColumn("keys", F.lit("l_orderkey,l_linenumber"))
    twice = integrity.assert_unique(t.orders_doubled, ["o_orderkey"]).withColumn("keys", F.lit("doubled o_orderkey"))
    return one.unionByName(two).unionByName(twice)


@query(
    "assert_no_nulls",
    """
    SELECT 'event_id' AS "column", COUNT(*) FILTER (event_id IS NULL) AS nulls FROM {epoch_source}
    UNION ALL SELECT 'raw_ms', COUNT(*) FILTER (raw_ms IS NULL) FROM {epoch_source}""",
)
def assert_no_nulls(t):
    return integrity.assert_no_nulls(t.epoch_source, ["event_id", "raw_ms"])


# -- sign-off ------------------------------------------------------------------------


def _all_checks(t):
    golden = t.orders_source
    suites = {
        "golden": [
            parity.rowcount_parity(golden, t.orders, name="orders", suite_id="golden"),
            parity.aggregate_parity(golden, golden, _AGGREGATES, name="orders", suite_id="golden"),
            parity.fingerprint_parity(golden, golden, ORDER_COLUMNS, ["o_orderkey"], name="orders", labels={"suite_id": "golden"}),
        ],
        "faulty": [
            parity.rowcount_parity(golden, t.orders_target, name="orders", suite_id="faulty"),
            encoding.decimal_roundtrip(golden, t.orders_target, ["o_orderkey"], ["amount"], name="orders", suite_id="faulty"),
            integrity.fk_orphan(
                (t.lineitem, t.orders_partial), (t.lineitem, t.orders), "l_orderkey", "o_orderkey", 0.05, 1.0,
                name="lineitem->orders", suite_id="faulty",
            ),
        ],
    }
    return report.reconcile([c for checks in suites.values() for c in checks])


@query(
    "reconcile",
    """
    SELECT * FROM (VALUES ('golden', 'rowcount_parity', 'orders', 'PASS'), ('golden', 'fingerprint_parity', 'orders', 'PASS'),
      ('golden', 'aggregate_parity', 'orders.amount:sum', 'PASS'), ('golden', 'aggregate_parity', 'orders.amount:max', 'PASS'),
      ('golden', 'aggregate_parity', 'orders.o_orderkey:count_distinct', 'PASS'), ('golden', 'aggregate_parity', 'orders.o_orderkey:count', 'PASS'),
      ('golden', 'aggregate_parity', 'orders.o_orderkey:max', 'PASS'), ('golden', 'aggregate_parity', 'orders.o_orderdate:min', 'PASS'),
      ('golden', 'aggregate_parity', 'orders.o_orderstatus:max', 'PASS'),
      ('faulty', 'fk_orphan', 'lineitem->orders (max)', 'PASS')) v(suite_id, pattern, target, status)
    UNION ALL SELECT 'faulty', 'rowcount_parity', 'orders', CASE WHEN (SELECT COUNT(*) FROM {orders_source}) = (SELECT COUNT(*) FROM {orders_target}) THEN 'PASS' ELSE 'FAIL' END
    UNION ALL SELECT 'faulty', 'decimal_roundtrip', 'orders.amount',
      CASE WHEN (SELECT COUNT(*) FROM {orders_source} s LEFT JOIN {orders_target} t USING (o_orderkey) WHERE s.amount IS DISTINCT FROM t.amount) = 0 THEN 'PASS' ELSE 'FAIL' END
    UNION ALL SELECT 'faulty', 'fk_orphan', 'lineitem->orders (parity)',
      CASE WHEN (SELECT COUNT(*) FROM {lineitem} WHERE l_orderkey NOT IN (SELECT o_orderkey FROM {orders_partial})) <= 0.0005 * (SELECT COUNT(*) FROM {lineitem}) THEN 'PASS' ELSE 'FAIL' END""",
)
def reconcile(t):
    return _all_checks(t).select("suite_id", "pattern", "target", "status")


@query(
    "report_rollup",
    """
    WITH c AS (SELECT (SELECT COUNT(*) FROM {orders_source}) <> (SELECT COUNT(*) FROM {orders_target}) AS rc,
                      (SELECT COUNT(*) FROM {orders_source} s LEFT JOIN {orders_target} t USING (o_orderkey) WHERE s.amount IS DISTINCT FROM t.amount) > 0 AS dr,
                      (SELECT COUNT(*) FROM {lineitem} WHERE l_orderkey NOT IN (SELECT o_orderkey FROM {orders_partial})) > 0.0005 * (SELECT COUNT(*) FROM {lineitem}) AS fk)
    SELECT suite_id, pattern, status, CAST(n_pass AS BIGINT) AS n_pass, CAST(n_fail AS BIGINT) AS n_fail, CAST(n_error AS BIGINT) AS n_error
    FROM (VALUES ('golden', 'rowcount_parity', 'PASS', 1, 0, 0), ('golden', 'aggregate_parity', 'PASS', 7, 0, 0), ('golden', 'fingerprint_parity', 'PASS', 1, 0, 0)) v(suite_id, pattern, status, n_pass, n_fail, n_error)
    UNION ALL SELECT 'faulty', 'rowcount_parity', CASE WHEN rc THEN 'FAIL' ELSE 'PASS' END, CASE WHEN rc THEN 0 ELSE 1 END, CASE WHEN rc THEN 1 ELSE 0 END, 0 FROM c
    UNION ALL SELECT 'faulty', 'decimal_roundtrip', CASE WHEN dr THEN 'FAIL' ELSE 'PASS' END, CASE WHEN dr THEN 0 ELSE 1 END, CASE WHEN dr THEN 1 ELSE 0 END, 0 FROM c
    UNION ALL SELECT 'faulty', 'fk_orphan', CASE WHEN fk THEN 'FAIL' ELSE 'PASS' END, CASE WHEN fk THEN 1 ELSE 2 END, CASE WHEN fk THEN 1 ELSE 0 END, 0 FROM c""",
)
def report_rollup(t):
    return report.report_rollup(_all_checks(t))


_NEEDED = ", ".join(
    [f"('pattern', '{p}', '{p}')" for p in report.PATTERNS]
    + [f"('flow', '{flow}', '{p}')" for flow, patterns in report.FLOW_REQUIRED.items() for p in patterns]
)


@query(
    "coverage_gaps",
    f"""
    WITH passed AS (
      SELECT * FROM (VALUES ('rowcount_parity'), ('aggregate_parity'), ('fingerprint_parity'), ('fk_orphan')) v(pattern)
      UNION ALL SELECT 'decimal_roundtrip' WHERE (SELECT COUNT(*) FROM {{orders_source}} s LEFT JOIN {{orders_target}} t USING (o_orderkey) WHERE s.amount IS DISTINCT FROM t.amount) = 0)
    SELECT gap, name, pattern FROM (VALUES {_NEEDED}) needed(gap, name, pattern) WHERE pattern NOT IN (SELECT pattern FROM passed)""",
)
def coverage_gaps(t):
    return report.coverage_gaps(_all_checks(t))
