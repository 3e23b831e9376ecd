"""Scans, projections, joins, aggregates and rankings on their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from paritas.operators import ordering, perf
from paritas.operators.transform import run_transform
from paritas.plans import marts
from paritas.plans.registry import query
from paritas.sources.files import control_totals as totals_of


@query("table_scan_filter", "SELECT o_orderkey, o_orderpriority FROM {orders} WHERE o_orderstatus = 'F' AND o_orderkey > 100")
def table_scan_filter(t):
    return t.orders.where("o_orderstatus = 'F' AND o_orderkey > 100").select("o_orderkey", "o_orderpriority")


TRANSFORM_INVOICE = """
    -- keep inserts and updates, turn epoch milliseconds into instants
    CREATE OR REPLACE TABLE ods_invoice AS
    SELECT invoice_id, amount, timestamp_millis(issued_ms) AS issued_ts FROM ods_invoice_raw WHERE op IN ('I', 'U');"""
TRANSFORM_INVOICE_UPPER = """
    CREATE OR REPLACE TABLE ods_invoice AS
    SELECT invoice_id, upper(op) AS op, amount, timestamp_millis(issued_ms) AS issued_ts FROM ods_invoice_raw WHERE upper(op) IN ('I', 'U')"""


@query(
    "transform_invoice",
    """SELECT invoice_id, CAST(amount AS DOUBLE) AS amount, strftime(make_timestamp(issued_ms * 1000), '%Y-%m-%d %H:%M:%S') AS issued_ts
       FROM {ods_invoice_raw} WHERE op IN ('I', 'U')""",
)
def transform_invoice(t):
    return run_transform(t.spark, {"ods_invoice_raw": t.ods_invoice_raw}, TRANSFORM_INVOICE)


@query(
    "transform_invoice_upper",
    """SELECT invoice_id, upper(op) AS op, CAST(amount AS DOUBLE) AS amount, strftime(make_timestamp(issued_ms * 1000), '%Y-%m-%d %H:%M:%S') AS issued_ts
       FROM {ods_invoice_raw} WHERE upper(op) IN ('I', 'U')""",
)
def transform_invoice_upper(t):
    return run_transform(t.spark, {"ods_invoice_raw": t.ods_invoice_raw}, TRANSFORM_INVOICE_UPPER)


@query(
    "elt_mart",
    """SELECT id, channel, CAST(amount AS DOUBLE) AS amount, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_ts
       FROM {elt_staging} WHERE status = 'raw'""",
)
def elt_mart(t):
    return t.elt_staging.where("status = 'raw'").select("id", "channel", "amount", "event_ts")


@query(
    "inject_fault",
    """SELECT id, channel, CAST(CASE WHEN id % 101 = 1 THEN 99.99 ELSE amount END AS DOUBLE) AS amount FROM {elt_staging} WHERE status = 'raw'""",
)
def inject_fault(t):
    wrong = F.lit("99.99").cast("decimal(12,2)")
    amount = F.when(F.col("id") % 101 == 1, wrong).otherwise(F.col("amount"))
    return elt_mart(t).select("id", "channel", amount.alias("amount"))


@query(
    "case_banding",
    """
    SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'HIGH' WHEN o_totalprice >= 100000 THEN 'MEDIUM' ELSE 'LOW' END AS band,
           CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority BETWEEN '2' AND '3' THEN 'MET' ELSE 'MISSED' END AS attainment
    FROM {orders} WHERE o_orderstatus <> 'P' AND o_orderdate IS NOT NULL""",
)
def case_banding(t):
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    return t.orders.where("o_orderstatus <> 'P' AND o_orderdate IS NOT NULL").select(
        "o_orderkey",
        F.when(price >= 300000, "HIGH").when(price >= 100000, "MEDIUM").otherwise("LOW").alias("band"),
        F.when(priority.like("1%") | priority.between("2", "3"), "MET").otherwise("MISSED").alias("attainment"),
    )


@query(
    "join_inner",
    """SELECT o.o_orderkey, c.c_mktsegment, n.n_name FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey
       JOIN {nation} n ON n.n_nationkey = c.c_nationkey""",
)
def join_inner(t):
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return t.orders.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_mktsegment", "n_name")


@query(
    "join_left",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_orderstatus FROM {lineitem} l LEFT JOIN {orders_partial} o ON o.o_orderkey = l.l_orderkey""",
)
def join_left(t):
    o = t.orders_partial.select("o_orderkey", "o_orderstatus")
    joined = t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderstatus")


@query(
    "join_left_filtered",
    """SELECT q.queue_sk, q.queue_code, CAST(s.target_value AS DOUBLE) AS target_value
       FROM {dim_queue} q LEFT JOIN {stg_crm_sla_target} s ON s.queue_id = q.queue_id AND s.metric_code = 'SL_20_80'""",
)
def join_left_filtered(t):
    targets = t.stg_crm_sla_target.where("metric_code = 'SL_20_80'").select("queue_id", "target_value")
    return t.dim_queue.join(targets, "queue_id", "left").select("queue_sk", "queue_code", "target_value")


@query(
    "cross_join_preserve",
    """
    SELECT 'supplier x customer' AS pair, (SELECT COUNT(*) FROM {supplier}) * (SELECT COUNT(*) FROM {customer}) AS n
    UNION ALL SELECT 'nation x nation', (SELECT COUNT(*) FROM {nation} a CROSS JOIN {nation} b)""",
)
def cross_join_preserve(t):
    """Row count of a cross join: the product of both counts, so no pair is formed."""
    count = lambda df: df.agg(F.count(F.lit(1)))

    def pair(name, left, right):
        return left.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("pair"), (F.col("n") * count(right).scalar()).alias("n"))

    return pair("supplier x customer", t.supplier, t.customer).unionByName(pair("nation x nation", t.nation, t.nation))


@query(
    "executive_summary_join",
    """
    WITH o AS (SELECT c_nationkey AS k, COUNT(*) AS n_orders, SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS billed
               FROM {orders} JOIN {customer} ON c_custkey = o_custkey GROUP BY 1),
    c AS (SELECT c_nationkey AS k, COUNT(*) AS n_customers FROM {customer} GROUP BY 1),
    s AS (SELECT s_nationkey AS k, COUNT(DISTINCT s_suppkey) AS n_suppliers, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS shipped
          FROM {supplier} JOIN {lineitem} ON l_suppkey = s_suppkey GROUP BY 1)
    SELECT r.r_name, n.n_name, c.n_customers, o.n_orders, CAST(o.billed AS DOUBLE) AS billed, s.n_suppliers, s.shipped
    FROM {region} r JOIN {nation} n ON n.n_regionkey = r.r_regionkey LEFT JOIN c ON c.k = n.n_nationkey
    LEFT JOIN o ON o.k = n.n_nationkey LEFT JOIN s ON s.k = n.n_nationkey""",
)
def executive_summary_join(t):
    amount = F.col("o_totalprice").cast("decimal(14,2)")
    per_customer = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_billed"))
    orders = (
        per_customer.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("k")).agg(F.sum("_n").alias("n_orders"), F.sum("_billed").alias("billed"))
    )
    customers = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n_customers"))
    per_supplier = t.lineitem.groupBy("l_suppkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("_shipped"))
    suppliers = (
        per_supplier.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("s_nationkey").alias("k")).agg(F.countDistinct("s_suppkey").alias("n_suppliers"), F.sum("_shipped").alias("shipped"))
    )
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).withColumn("k", F.col("n_nationkey"))
    return nations.join(customers, "k", "left").join(orders, "k", "left").join(suppliers, "k", "left").select(
        "r_name", "n_name", "n_customers", "n_orders", "billed", "n_suppliers", "shipped"
    )


@query(
    "group_rollup",
    "SELECT event_type AS channel, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS amt FROM {events} GROUP BY 1",
)
def group_rollup(t):
    return t.events.groupBy(F.col("event_type").alias("channel")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(12,2)")).alias("amt")
    )


@query(
    "approx_distinct",
    """SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS exact_orders, TRUE AS within_5pct FROM {lineitem} GROUP BY 1""",
)
def approx_distinct(t):
    # Apart: next to an exact distinct count, Spark would keep one sketch per
    # distinct value instead of one per group.
    approx = t.lineitem.groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey", 0.01).alias("_approx"))
    exact = t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_orderkey").alias("exact_orders"))
    close = F.abs(F.col("_approx") - F.col("exact_orders")) <= F.col("exact_orders") * 0.05
    return exact.join(approx, "l_returnflag").select("l_returnflag", "exact_orders", close.alias("within_5pct"))


@query("count_distinct", "SELECT l_returnflag, COUNT(DISTINCT l_suppkey) AS suppliers, COUNT(DISTINCT l_partkey) AS parts FROM {lineitem} GROUP BY 1")
def count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_partkey").alias("parts")
    )


@query(
    "rollup_grouping",
    """
    SELECT c_mktsegment, o_orderstatus, COUNT(*) AS n, CAST(GROUPING(o_orderstatus) + 2 * GROUPING(c_mktsegment) AS BIGINT) AS grouping_level
    FROM {orders} JOIN {customer} ON c_custkey = o_custkey GROUP BY ROLLUP(c_mktsegment, o_orderstatus)""",
)
def rollup_grouping(t):
    folded = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("_n"))
    joined = folded.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.rollup("c_mktsegment", "o_orderstatus").agg(
        F.sum("_n").alias("n"), F.grouping_id().cast("bigint").alias("grouping_level")
    )


@query(
    "state_pivot",
    """
    SELECT user_id, COUNT(*) FILTER (event_type IN ('view', 'click')) AS browsing, COUNT(*) FILTER (event_type = 'purchase') AS buying,
           COUNT(*) FILTER (event_type LIKE 'err%') AS failing,
           CAST(COUNT(*) FILTER (event_type = 'purchase') AS DOUBLE) / NULLIF(COUNT(*) FILTER (event_type IN ('view', 'click')), 0) * 100 AS buying_pct
    FROM {events} GROUP BY 1""",
)
def state_pivot(t):
    kind = F.col("event_type")
    browsing, buying = F.count_if(kind.isin("view", "click")), F.count_if(kind == "purchase")
    return t.events.groupBy("user_id").agg(
        browsing.alias("browsing"), buying.alias("buying"), F.count_if(kind.like("err%")).alias("failing"),
        marts.percent(buying, browsing).alias("buying_pct"),
    )


@query(
    "safe_ratio",
    """
    SELECT c.c_custkey, CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(CAST(COUNT(o_orderkey) AS DOUBLE), 0) * 100 AS finished_pct
    FROM {customer} c LEFT JOIN {orders} o ON o.o_custkey = c.c_custkey GROUP BY 1""",
)
def safe_ratio(t):
    per = t.orders.groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("_f"), F.count(F.lit(1)).alias("_n"))
    joined = t.customer.select("c_custkey").join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", marts.percent(F.coalesce("_f", F.lit(0)), F.coalesce("_n", F.lit(0))).alias("finished_pct"))


@query(
    "control_totals",
    """
    SELECT 'amount' AS col, COUNT(*) AS row_cnt, CAST(SUM(amount) AS DOUBLE) AS control_total FROM {orders_source}
    UNION ALL SELECT 'o_orderstatus', COUNT(*), 0.0 FROM {orders_source}""",
)
def control_totals(t):
    both = [totals_of(t.orders_source, c).withColumn("col", F.lit(c)) for c in ("amount", "o_orderstatus")]
    return both[0].unionByName(both[1])


_RANKED = """
    WITH c AS (SELECT query, metric, value, ROW_NUMBER() OVER (PARTITION BY query, metric ORDER BY value) AS rn,
                      COUNT(*) OVER (PARTITION BY query, metric) AS n FROM {run_metrics}),
    p AS (SELECT query, metric, MAX(n) AS runs, MAX(CASE WHEN rn = greatest(1, (n * 50 + 99) // 100) THEN value END) AS p50,
                 MAX(CASE WHEN rn = greatest(1, (n * 95 + 99) // 100) THEN value END) AS p95, MAX(value) AS max_value, MIN(value) AS min_value
          FROM c GROUP BY 1, 2)
"""


@query("perf_percentiles", _RANKED + "SELECT * FROM p")
def perf_percentiles(t):
    return perf.perf_percentiles(t.run_metrics)


@query(
    "perf_assert",
    _RANKED + """
    SELECT l.query || ':' || l.metric AS target, CASE WHEN p.p95 <= l.x THEN 'PASS' ELSE 'FAIL' END AS status,
           CASE WHEN p.p95 IS NULL THEN 'metric unavailable' ELSE 'threshold' END AS message, l.x AS max_value, p.p95 AS value
    FROM (VALUES ('q1', 'elapsed_ms', 200000.0::DOUBLE), ('q2', 'bytes_scanned', 1.0::DOUBLE), ('q3', 'peak_memory', 10.0::DOUBLE)) l(query, metric, x)
    LEFT JOIN p ON p.query = l.query AND p.metric = l.metric""",
)
def perf_assert(t):
    checks = perf.perf_assert(t.run_metrics, [("q1", "elapsed_ms", 200000), ("q2", "bytes_scanned", 1), ("q3", "peak_memory", 10)])
    return checks.select(
        "target", "status", "message", F.col("expected").cast("double").alias("max_value"), F.col("actual").cast("double").alias("value")
    )


@query(
    "perf_compare",
    _RANKED + """
    SELECT 'q1->q2:' || l.metric AS target,
           CASE WHEN a.p95 IS NULL OR b.p95 IS NULL THEN 'FAIL' WHEN l.op = 'report' THEN 'PASS'
                WHEN l.op = '<=' AND b.p95 <= a.p95 * l.f THEN 'PASS' WHEN l.op = '<' AND b.p95 < a.p95 * l.f THEN 'PASS' ELSE 'FAIL' END AS status,
           l.op = 'report' AND a.p95 IS NOT NULL AND b.p95 IS NOT NULL AS measurement
    FROM (VALUES ('elapsed_ms', '<=', 1.25), ('bytes_scanned', '<', 0.5), ('rows', 'report', 1.0), ('peak_memory', 'report', 1.0)) l(metric, op, f)
    LEFT JOIN p a ON a.query = 'q1' AND a.metric = l.metric LEFT JOIN p b ON b.query = 'q2' AND b.metric = l.metric""",
)
def perf_compare(t):
    conditions = {"elapsed_ms": "b <= a * 1.25", "bytes_scanned": "b < a * 0.5", "rows": "report", "peak_memory": "report"}
    return perf.perf_compare(t.run_metrics, "q1", "q2", conditions).select("target", "status", "measurement")


@query(
    "perf_regression",
    _RANKED + """
    , b AS (SELECT query, metric, p50 AS base FROM p WHERE query <> 'q7'), w AS (SELECT unnest(['elapsed_ms', 'bytes_scanned']) AS metric, unnest([0.0, 5.0]) AS tol)
    SELECT q.query || ':' || w.metric AS target,
           CASE WHEN q.query = 'q7' THEN 'PASS' WHEN p.p95 <= b.base + b.base * (w.tol * 100 / 100) THEN 'PASS' ELSE 'FAIL' END AS status, q.query = 'q7' AS measurement
    FROM (SELECT DISTINCT query FROM p) q CROSS JOIN w LEFT JOIN p ON p.query = q.query AND p.metric = w.metric
    LEFT JOIN b ON b.query = q.query AND b.metric = w.metric""",
)
def perf_regression(t):
    baseline = perf.perf_percentiles(t.run_metrics).where("query <> 'q7'").select("query", "metric", F.col("p50").alias("value"))
    return perf.perf_regression(t.run_metrics, baseline, {"elapsed_ms": "0%", "bytes_scanned": "500%"}).select("target", "status", "measurement")


def _per_customer(t):
    amount = F.col("o_totalprice").cast("decimal(14,2)")
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.sum(amount).alias("total"))


@query(
    "percent_rank",
    """SELECT o_custkey, n_orders, PERCENT_RANK() OVER (ORDER BY n_orders ASC NULLS FIRST) AS pctile
       FROM (SELECT o_custkey, COUNT(*) AS n_orders FROM {orders} GROUP BY 1) x""",
)
def percent_rank(t):
    ranked = ordering.table_rank(_per_customer(t).select("o_custkey", "n_orders"), "n_orders", ["o_custkey"])
    return ranked.select("o_custkey", "n_orders", ordering.percent_rank(F.col("_rank"), F.col("_total")).alias("pctile"))


@query(
    "ntile_banding",
    """
    SELECT o_custkey, NTILE(4) OVER (ORDER BY total DESC NULLS LAST, o_custkey) AS quartile, NTILE(5) OVER (ORDER BY total ASC NULLS FIRST, o_custkey) AS quintile
    FROM (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS total FROM {orders} GROUP BY 1) x""",
)
def ntile_banding(t):
    base = _per_customer(t).select("o_custkey", "total")
    down = ordering.table_rank(base, "total", ["o_custkey"], descending=True, prefix="_d_")
    both = ordering.table_rank(down, "total", ["o_custkey"], prefix="_u_")
    return both.select(
        "o_custkey",
        ordering.ntile(F.col("_d_row"), F.col("_d_total"), 4).alias("quartile"),
        ordering.ntile(F.col("_u_row"), F.col("_u_total"), 5).alias("quintile"),
    )


@query(
    "tier_join_probe",
    """
    SELECT 'lineitem>orders' AS probe, 1 AS readable, COUNT(*) AS n_rows FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey
    UNION ALL SELECT 'orders>customer', 1, COUNT(*) FROM {orders} JOIN {customer} ON c_custkey = o_custkey
    UNION ALL SELECT 'customer>nation', 1, COUNT(*) FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey""",
)
def tier_join_probe(t):
    """Each tier joins to the next: one row can be fetched, and how many there are."""
    tiers = [
        ("lineitem>orders", t.lineitem, t.orders, "l_orderkey", "o_orderkey"),
        ("orders>customer", t.orders, t.customer, "o_custkey", "c_custkey"),
        ("customer>nation", t.customer, t.nation, "c_nationkey", "n_nationkey"),
    ]
    out = None
    for name, child, parent, ck, pk in tiers:
        joined = child.select(ck).join(parent.select(pk), F.col(ck) == F.col(pk))
        fetched = joined.limit(1).agg(F.count(F.lit(1)))
        keys = child.groupBy(ck).agg(F.count(F.lit(1)).alias("_n")).join(parent.select(pk), F.col(ck) == F.col(pk))
        row = keys.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows")).select(
            F.lit(name).alias("probe"), fetched.scalar().cast("int").alias("readable"), "n_rows"
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "perf_measure",
    """
    SELECT 'lineitem sum' AS query, 'rows_scanned' AS metric, CAST(COUNT(*) AS DOUBLE) AS p95 FROM {lineitem}
    UNION ALL SELECT 'orders sum', 'rows_scanned', CAST(COUNT(*) AS DOUBLE) FROM {orders}""",
)
def perf_measure(t):
    queries = {
        "lineitem sum": lambda: t.lineitem.groupBy("l_returnflag").agg(F.sum("l_quantity")),
        "orders sum": lambda: t.orders.groupBy("o_orderstatus").agg(F.sum("o_totalprice")),
    }
    measured = perf.perf_percentiles(perf.perf_measure(t.spark, queries, runs=2))
    return measured.where("metric = 'rows_scanned'").select("query", "metric", "p95")
