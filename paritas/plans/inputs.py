"""Stand-ins of warehouse tables over the driver tables.

Each text reads with both engines; ``{name}`` is a table or another stand-in.
Faulty copies change rows by modular arithmetic on the key, so that every
parity check has known differences to find.
"""

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

#: Stand-ins that fold a large table to groups nearly as many as its rows: the table is dealt by the group's columns
#: before, into parts of at most about DEALT_ROWS rows, so that a task's groups stay few however large the table is.
DEALT = {
    "agg_agent_daily": ("lineitem", ["l_suppkey", "[key:l_shipdate]"]),
    "fact_adherence_daily": ("lineitem", ["l_suppkey", "[key:l_shipdate]"]),
}
DEALT_ROWS = 500_000

STAND_INS = {
    # -- dimensions
    "dim_agent": """
        SELECT s_suppkey AS agent_sk, s_suppkey + 10000 AS agent_id, s_name AS full_name,
               'S' || CAST(s_nationkey AS STRING) AS site_code, 'G' || CAST(s_suppkey % 5 AS STRING) AS job_grade,
               s_suppkey % 20 <> 0 AS is_current,
               CASE WHEN s_suppkey % 9 = 0 THEN 'LEAVE' ELSE 'ACTIVE' END AS status
        FROM {supplier}""",
    "dim_program": """
        SELECT CAST(n_nationkey AS BIGINT) AS program_sk, CAST(n_nationkey AS BIGINT) AS program_id,
               n_name AS program_code, CAST(n_regionkey AS BIGINT) AS client_id
        FROM {nation}""",
    "dim_client": """
        SELECT CAST(r_regionkey AS BIGINT) AS client_id, 'C' || CAST(r_regionkey AS STRING) AS client_code,
               r_name AS client_name
        FROM {region}""",
    "dim_disposition": """
        SELECT p_partkey AS disposition_code,
               CASE p_size % 6 WHEN 0 THEN 'Refund of ' || p_name
                               WHEN 1 THEN 'Password reset ref#' || CAST(p_size AS STRING)
                               WHEN 2 THEN 'wants to CANCEL ' || p_name
                               WHEN 3 THEN '[' || substr(upper(p_type), 1, 3) || '] ' || p_name
                               ELSE p_name || ' ref#' || CAST(p_partkey % 100 AS STRING) END AS disposition_desc
        FROM {part}""",
    "dim_queue": """
        SELECT p_partkey AS queue_sk, p_partkey + 500 AS queue_id, p_brand AS queue_code, p_type AS media_type
        FROM {part}""",
    "dim_shift": """
        SELECT CAST(n_nationkey AS BIGINT) AS shift_sk, CAST(n_nationkey AS BIGINT) AS shift_id,
               n_regionkey IN (1, 3) AS overnight_flag
        FROM {nation}""",
    # -- facts
    "contacts": """
        SELECT l_suppkey AS agent_sk, l_returnflag AS channel, [key:l_shipdate] AS date_key
        FROM {lineitem}""",
    "fact_interaction": """
        SELECT event_id AS interaction_id, 'CUST' || CAST(user_id AS STRING) AS customer_ref, event_type AS channel,
               ts AS start_ts, ts + INTERVAL '5' MINUTE AS end_ts, event_type = 'purchase' AS resolved_flag,
               event_id % 25 AS program_sk, [key:ts] AS date_key
        FROM {events}""",
    "fact_csat_survey": """
        SELECT o_custkey % 25 AS program_sk, 1 + o_orderkey % 5 AS csat_score, o_orderkey % 11 AS nps_score
        FROM {orders}""",
    "ods_call": """
        SELECT l_partkey AS disposition_code, CAST(l_shipdate AS DATE) AS call_date, l_linenumber AS queue_id,
               CAST(l_quantity AS BIGINT) AS talk_seconds
        FROM {lineitem}""",
    "agg_agent_daily": """
        SELECT l_suppkey AS agent_sk, 'S' || CAST(s_nationkey AS STRING) AS site_code, [key:l_shipdate] AS date_key,
               COUNT(*) AS interactions_handled, MAX(CAST(l_quantity AS BIGINT)) AS avg_handle_seconds,
               MIN(CAST(floor(l_discount * 100 + 0.5) AS BIGINT)) AS adherence_pct, MAX(CAST(floor(l_tax * 100 + 0.5) AS BIGINT)) AS occupancy_pct
        FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey
        GROUP BY 1, 2, 3""",
    "fact_qa_evaluation": """
        SELECT l_suppkey AS agent_sk, CAST(l_quantity AS BIGINT) AS overall_pct
        FROM {lineitem} WHERE l_returnflag = 'R'""",
    "ods_agent_skill_scd2": """
        SELECT p_partkey % 50 + 10000 AS agent_id, p_size % 2 = 0 AS is_current, p_size % 3 = 0 AS certified
        FROM {part}""",
    "fact_adherence_daily": """
        SELECT l_suppkey AS agent_sk, [key:l_shipdate] AS date_key, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS scheduled_minutes,
               CAST(SUM(CAST(l_linenumber AS BIGINT)) AS BIGINT) AS worked_minutes, COUNT(*) AS exception_minutes,
               CAST(MAX(l_linenumber) AS BIGINT) AS timeoff_minutes, MAX(CAST(floor(l_tax * 100 + 0.5) AS BIGINT)) AS adherence_pct
        FROM {lineitem} GROUP BY 1, 2""",
    "ods_attrition_event": """
        SELECT o_custkey + 10000 AS agent_id FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
    "fact_queue_interval": """
        SELECT l_partkey AS queue_sk, [key:l_shipdate] AS date_key, CAST(l_quantity AS BIGINT) AS answered,
               CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS answered_in_sl
        FROM {lineitem}""",
    "stg_crm_sla_target": """
        SELECT p_partkey + 500 AS queue_id, CASE WHEN p_size % 4 = 0 THEN 'AHT' ELSE 'SL_20_80' END AS metric_code,
               CAST(60 + p_size AS DECIMAL(10,4)) AS target_value
        FROM {part}""",
    "fact_agent_activity": """
        SELECT user_id AS agent_sk, [key:ts] AS date_key, CAST(floor(value) AS BIGINT) AS state_seconds,
               CASE event_type WHEN 'view' THEN 'TALK' WHEN 'click' THEN 'READY' WHEN 'signup' THEN 'AUX_BREAK'
                               WHEN 'error' THEN 'HOLD' ELSE 'ACW' END AS state_code
        FROM {events}""",
    "ods_schedule": """
        SELECT o_orderkey AS schedule_id, o_custkey + 10000 AS agent_id, CAST(o_orderdate AS DATE) AS sched_date,
               o_orderkey % 25 AS shift_id
        FROM {orders}""",
    "agg_billing_monthly": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_month, o_custkey % 25 AS program_sk,
               o_custkey % 25 % 5 AS client_sk, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(24,2)) AS billed_amount,
               CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(14,2)) ELSE 0 END) AS DECIMAL(24,2)) AS sla_credit_amount,
               CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(14,2)) END) AS DECIMAL(24,2)) AS net_revenue
        FROM {orders} GROUP BY 1, 2, 3""",
    "ods_timesheet": """
        SELECT l_suppkey % 5 AS program_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS work_month,
               CAST(l_quantity AS BIGINT) AS billable_minutes
        FROM {lineitem}""",
    "ods_payroll_adjustment": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_month, CAST(o_totalprice AS DECIMAL(12,2)) AS amount
        FROM {orders} WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'""",
    "ods_contract_line": """
        SELECT p_size AS contract_id, CAST(p_retailprice AS DECIMAL(12,2)) AS min_commit FROM {part}""",
    "agg_program_monthly": """
        SELECT CAST(c_nationkey AS BIGINT) AS program_sk, CAST(date_trunc('month', o_orderdate) AS DATE) AS period_month,
               COUNT(*) AS interactions, MAX(CAST(o_totalprice AS DECIMAL(14,2))) AS avg_handle_seconds,
               MIN(CAST(o_totalprice AS DECIMAL(14,2))) AS avg_csat, 0 AS grouping_level
        FROM {orders} JOIN {customer} ON c_custkey = o_custkey GROUP BY 1, 2
        UNION ALL
        SELECT CAST(c_nationkey AS BIGINT), CAST(NULL AS DATE), COUNT(*), CAST(NULL AS DECIMAL(14,2)), CAST(NULL AS DECIMAL(14,2)), 1
        FROM {orders} JOIN {customer} ON c_custkey = o_custkey GROUP BY 1""",
    "agg_csat_rollup_monthly": """
        SELECT o_custkey % 25 AS program_sk, CAST(date_trunc('month', o_orderdate) AS DATE) AS period_month,
               CAST(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100 AS pct_promoters,
               CAST(SUM(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100 AS pct_detractors
        FROM {orders} WHERE o_orderstatus <> 'O' GROUP BY 1, 2""",
    "fact_ticket": """
        SELECT o_custkey % 25 AS program_sk,
               CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'P' THEN 'PENDING' ELSE 'CLOSED' END AS status,
               o_orderpriority = '1-URGENT' AS sla_breached_flag
        FROM {orders}""",
    "ods_org_unit": """
        SELECT conv_id * 1000 + turn AS org_unit_id, CASE WHEN turn > 0 THEN conv_id * 1000 + turn - 1 END AS parent_unit_id,
               'U' || CAST(turn AS STRING) AS unit_code, role || CAST(turn AS STRING) AS unit_name, role AS unit_type,
               'S' || CAST(conv_id % 3 AS STRING) AS site_code
        FROM {conversations}""",
    "ods_agent_scd2": """
        SELECT o_custkey AS agent_id, o_orderkey AS version_id, 'E' || CAST(o_custkey AS STRING) AS employee_no,
               o_orderkey % 130 AS org_unit_id, o_orderpriority AS job_grade, o_orderstatus AS employment_type,
               o_orderstatus AS status, o_orderdate AS eff_from_ts
        FROM {orders}""",
    "ods_agent_assignment_scd2": """
        SELECT c_custkey AS agent_id, CAST(c_nationkey AS BIGINT) AS program_id, c_custkey % 60 AS queue_id,
               c_mktsegment AS role_on_program, c_acctbal > 0 AS is_current
        FROM {customer}""",
    "stg_fin_invoice": """
        SELECT o_orderkey AS invoice_id, 'INV' || CAST(o_orderkey AS STRING) AS invoice_no,
               CAST(o_totalprice AS DECIMAL(14,2)) AS total_amount, [ms:o_orderdate] AS issued_ts_sec
        FROM {orders}""",
    "ods_invoice_acid": """
        SELECT o_orderkey AS invoice_id,
               CAST(CAST(o_totalprice AS DECIMAL(14,2)) + CASE WHEN o_orderkey % 997 = 5 THEN 0.02 ELSE 0.00 END AS DECIMAL(14,2)) AS total_amount,
               o_orderdate + CASE WHEN o_orderkey % 991 = 6 THEN INTERVAL '60' SECOND ELSE INTERVAL '0' SECOND END AS issued_ts
        FROM {orders}""",
    # -- pairs of copies
    "orders_source": """
        SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(14,2)) AS amount, o_orderdate, o_orderpriority
        FROM {orders}""",
    "orders_target": """
        SELECT CASE WHEN o_orderkey % 1013 = 7 THEN o_orderkey + 100000000 ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus,
               CAST(CAST(o_totalprice AS DECIMAL(14,2)) + CASE WHEN o_orderkey % 997 = 5 THEN 0.01 ELSE 0.00 END AS DECIMAL(14,2)) AS amount,
               o_orderdate, o_orderpriority
        FROM {orders} WHERE o_orderkey % 1009 <> 3""",
    "orders_ruined": """
        SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN amount ELSE CAST(amount + 1 AS DECIMAL(14,2)) END AS amount,
               o_orderdate, o_orderpriority
        FROM {orders_source} WHERE o_orderkey % 5 <> 1""",
    "nation_left": """
        SELECT n_nationkey, concat(n_name, chr(31), 'x') AS a, CAST(n_regionkey AS STRING) AS b FROM {nation}""",
    "nation_right": """
        SELECT n_nationkey, n_name AS a, concat('x', chr(31), CAST(n_regionkey AS STRING)) AS b FROM {nation}""",
    "small_numbers": """
        SELECT event_id, CAST(event_id % 7 AS DECIMAL(30,15)) / 10000000000000.0 AS v FROM {events}""",
    "epoch_source": """
        SELECT event_id, CASE event_id % 500 WHEN 7 THEN [ms:ts] * 1000 WHEN 11 THEN -5 WHEN 13 THEN NULL
                              WHEN 17 THEN CAST(floor([ms:ts] / 1000) AS BIGINT) ELSE [ms:ts] END AS raw_ms
        FROM {events}""",
    "epoch_target": """
        SELECT event_id, CASE WHEN event_id % 1000 = 11 THEN ts WHEN event_id % 500 IN (7, 11, 13) THEN NULL
                              WHEN event_id % 701 = 3 THEN ts + INTERVAL '1' SECOND ELSE ts END AS converted_ts
        FROM {events} WHERE event_id % 907 <> 4""",
    "faulty_export": """
        SELECT o_orderkey, o_custkey, o_orderstatus, amount,
               CASE WHEN o_orderkey % 499 = 2 THEN o_orderdate + INTERVAL '1' DAY ELSE o_orderdate END AS o_orderdate, o_orderpriority
        FROM {orders_target}""",
    "orders_repeated": """
        SELECT o_orderkey, o_custkey, o_orderstatus, amount, o_orderdate, o_orderpriority FROM {orders_target}
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderstatus, amount, o_orderdate, o_orderpriority FROM {orders_target} WHERE o_orderkey % 503 = 1""",
    "orders_doubled": """
        SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(14,2)) AS amount FROM {orders}
        UNION ALL
        SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(14,2)) - CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS DECIMAL(14,2))
        FROM {orders} WHERE o_orderkey % 211 IN (5, 6)""",
    "epoch_doubled": """
        SELECT event_id, converted_ts FROM {epoch_target}
        UNION ALL
        SELECT event_id, converted_ts + INTERVAL '1' HOUR FROM {epoch_target} WHERE event_id % 307 = 9""",
    "invoices": """
        SELECT o_orderkey AS invoice_id, o_custkey AS contact_id, CAST(o_totalprice AS DECIMAL(14,2)) AS amount
        FROM {orders}""",
    "invoice_changes": """
        SELECT CASE WHEN o_orderkey % 10 = 3 THEN o_orderkey + 10000000 ELSE o_orderkey END AS invoice_id, o_custkey AS contact_id,
               CAST(CAST(o_totalprice AS DECIMAL(14,2)) + 1 AS DECIMAL(14,2)) AS amount,
               CASE o_orderkey % 10 WHEN 1 THEN 'U' WHEN 2 THEN 'D' ELSE 'I' END AS op, [ms:o_orderdate] AS change_ms, 'a' AS extract_ts
        FROM {orders} WHERE o_orderkey % 10 IN (1, 2, 3)
        UNION ALL
        SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(14,2)) + 2 AS DECIMAL(14,2)),
               CASE WHEN o_orderkey % 20 = 1 THEN 'D' ELSE 'U' END, [ms:o_orderdate] + 1000, 'b'
        FROM {orders} WHERE o_orderkey % 10 = 1""",
    "invoice_last_changes": """
        SELECT invoice_id, contact_id, amount, op, change_ms, extract_ts FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY invoice_id ORDER BY change_ms DESC, extract_ts DESC) AS rn FROM {invoice_changes}
        ) x WHERE rn = 1""",
    "history": """
        SELECT contact_id, version_id, segment, eff_from,
               COALESCE(LEAD(eff_from) OVER (PARTITION BY contact_id ORDER BY eff_from), TIMESTAMP '9999-12-31 00:00:00') AS eff_to,
               LEAD(eff_from) OVER (PARTITION BY contact_id ORDER BY eff_from) IS NULL AS is_current,
               md5(concat_ws('|', CAST(contact_id AS STRING), CAST(version_id AS STRING), segment)) AS row_hash
        FROM (SELECT o_custkey AS contact_id, CAST(o_orderdate AS TIMESTAMP) AS eff_from, MAX(o_orderkey) AS version_id,
                     MAX(o_orderpriority) AS segment
              FROM {orders} GROUP BY 1, 2) v""",
    "history_broken": """
        SELECT contact_id, version_id, segment, eff_from,
               CASE WHEN version_id % 37 = 0 AND NOT is_current THEN eff_to + INTERVAL '1' DAY
                    WHEN version_id % 43 = 0 THEN TIMESTAMP '9999-12-31 00:00:00'
                    WHEN version_id % 47 = 0 AND is_current THEN TIMESTAMP '2050-01-01 00:00:00' ELSE eff_to END AS eff_to,
               CASE WHEN version_id % 41 = 0 THEN NOT is_current ELSE is_current END AS is_current,
               CASE WHEN version_id % 53 = 0 THEN 'wrong' ELSE row_hash END AS row_hash
        FROM {history}""",
    "orders_partial": "SELECT * FROM {orders} WHERE o_orderkey % 50 <> 0",
    "ods_invoice_raw": """
        SELECT o_orderkey AS invoice_id, [ms:o_orderdate] AS issued_ms, CAST(o_totalprice AS DECIMAL(14,2)) AS amount,
               CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'P' THEN 'u' ELSE 'D' END AS op
        FROM {orders}""",
    "elt_staging": """
        SELECT event_id AS id, event_type AS channel, CAST(value AS DECIMAL(12,2)) AS amount, ts AS event_ts,
               CASE WHEN user_id % 3 = 0 THEN 'done' ELSE 'raw' END AS status
        FROM {events}""",
    "run_metrics": """
        SELECT 'q' || CAST(l_linenumber AS STRING) AS query, l_orderkey AS run,
               CASE WHEN l_returnflag = 'A' THEN 'elapsed_ms' WHEN l_returnflag = 'N' THEN 'bytes_scanned' ELSE 'rows' END AS metric,
               l_extendedprice AS value
        FROM {lineitem}""",
}
