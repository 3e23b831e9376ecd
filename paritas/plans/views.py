"""Mart views over the stand-ins, with the SQL of each view as its restatement."""

from __future__ import annotations

from pyspark.sql import functions as F

from paritas.plans import marts
from paritas.plans.registry import query


@query(
    "vw_org_hierarchy",
    """
    -- From every unit upwards: one row per ancestor, the last of which is the root.
    WITH RECURSIVE climb AS (
      SELECT org_unit_id AS unit, org_unit_id AS here, parent_unit_id AS above, 0 AS steps, unit_name AS names FROM {ods_org_unit}
      UNION ALL
      SELECT unit, up.org_unit_id, up.parent_unit_id, steps + 1, concat(up.unit_name, ' > ', names)
      FROM {ods_org_unit} AS up, climb WHERE up.org_unit_id = above
    )
    SELECT o.org_unit_id, o.unit_code, o.unit_name, o.unit_type, o.site_code, at_root.here AS root_unit_id,
           at_root.steps AS depth, at_root.names AS path_names
    FROM {ods_org_unit} AS o, (FROM climb WHERE above IS NULL) AS at_root WHERE at_root.unit = o.org_unit_id""",
)
def vw_org_hierarchy(t):
    return marts.org_hierarchy(t.ods_org_unit)


@query(
    "vw_active_agents",
    """
    WITH days AS (SELECT date_key, site_code FROM {contacts} SEMI JOIN {dim_agent} USING (agent_sk) JOIN {dim_agent} USING (agent_sk))
    SELECT date_key, site_code, count(*) AS interactions, count(*) > 0 AS agents_close, count(*) > 0 AS pairs_close
    FROM days GROUP BY date_key, site_code""",
)
def vw_active_agents(t):
    """The view, and whether its estimates lie within 5 % of the exact counts."""
    view = marts.active_agents(t.contacts, t.dim_agent)
    # Folded to one row per day, agent and channel: counting needs no distinct of wide rows.
    pairs = t.contacts.select("date_key", "agent_sk", "channel").distinct().join(t.dim_agent.select("agent_sk", "site_code"), "agent_sk")
    agents = pairs.groupBy("date_key", "site_code", "agent_sk").agg(F.count(F.lit(1)).alias("channels"))
    exact = agents.groupBy("date_key", "site_code").agg(F.count(F.lit(1)).alias("agents"), F.sum("channels").alias("pairs"))
    close = lambda approx, true: F.abs(F.col(approx) - F.col(true)) <= F.col(true) * 0.05
    return view.join(exact, ["date_key", "site_code"]).select(
        "date_key", "site_code", "interactions",
        close("approx_active_agents", "agents").alias("agents_close"),
        close("approx_agent_channel_pairs", "pairs").alias("pairs_close"),
    )


@query(
    "vw_csat_rollup",
    """
    -- Three levels side by side; 0 keeps both keys, 1 the client, 3 none.
    WITH levels(level) AS (VALUES (0), (1), (3)),
    rated AS (
      SELECT level, CASE WHEN level < 3 THEN client_id END AS client, CASE WHEN level = 0 THEN program_code END AS program,
             csat_score, nps_score
      FROM {fact_csat_survey} NATURAL JOIN (SELECT program_sk, client_id, program_code FROM {dim_program}) CROSS JOIN levels)
    SELECT client AS client_id, program AS program_code, count(*) AS surveys,
           CAST(sum(csat_score) AS DOUBLE) / count(csat_score) AS avg_csat,
           CAST(count(*) FILTER (nps_score >= 9) AS DOUBLE) / count(*) * 100 AS pct_promoters,
           CAST(level AS BIGINT) AS grouping_level
    FROM rated GROUP BY level, client, program""",
)
def vw_csat_rollup(t):
    return marts.csat_rollup(t.fact_csat_survey, t.dim_program)


def _driver_sql(text: str) -> str:
    """The class of a disposition text, from the fixed table of classes."""
    classes = " ".join(f"WHEN regexp_matches({text}, '{pattern}') THEN '{name}'" for name, pattern in marts.CALL_DRIVERS)
    return f"CASE {classes} ELSE coalesce(nullif(regexp_extract({text}, '{marts.CALL_TAG}', 1), ''), 'OTHER') END"


@query(
    "vw_call_driver",
    f"""
    WITH classed AS (
      SELECT disposition_code, {_driver_sql("disposition_desc")} AS driver,
             nullif(regexp_extract(disposition_desc, '{marts.CALL_REFERENCE}', 1), '') AS reference
      FROM {{dim_disposition}})
    SELECT CAST(call_date AS STRING) AS call_date, queue_id, driver AS call_driver, reference AS embedded_ref_no, count(*) AS calls,
           CAST(sum(talk_seconds) AS DOUBLE) / count(talk_seconds) AS avg_talk_seconds
    FROM {{ods_call}} JOIN classed USING (disposition_code) GROUP BY call_date, queue_id, driver, reference""",
)
def vw_call_driver(t):
    return marts.call_drivers(t.ods_call, t.dim_disposition)


_REPEAT = """
    -- Each customer's contacts as one list in order; a contact's predecessor is the element before it.
    WITH lists AS (
      SELECT customer_ref, list({'at': start_ts, 'id': interaction_id, 'ch': channel} ORDER BY start_ts, interaction_id) AS contacts
      FROM {fact_interaction} WHERE customer_ref <> '' GROUP BY customer_ref),
    turns AS (SELECT customer_ref, unnest(contacts) AS c, unnest(list_concat([NULL], contacts[:-2])) AS p FROM lists)
    SELECT c.id AS interaction_id, customer_ref, c.ch AS channel, strftime(c.at, '%Y-%m-%d %H:%M:%S') AS start_ts,
           strftime(p.at, '%Y-%m-%d %H:%M:%S') AS prev_contact_ts,
           CASE WHEN [sec:c.at] - [sec:p.at] <= 259200 THEN 1 ELSE 0 END AS repeat_within_72h
    FROM turns"""


@query("vw_repeat_contact", _REPEAT)
def vw_repeat_contact(t):
    return marts.repeat_contact(t.fact_interaction)


@query(
    "repeat_contact",
    """
    SELECT contact_id, version_id, CAST(gap_seconds AS BIGINT) AS gap_seconds, CASE WHEN gap_seconds <= 259200 THEN 1 ELSE 0 END AS repeat_within_72h
    FROM (SELECT contact_id, version_id,
                 [sec:eff_from] - LAG([sec:eff_from]) OVER (PARTITION BY contact_id ORDER BY eff_from, version_id) AS gap_seconds
          FROM {history}) x""",
)
def repeat_contact(t):
    visits = t.history.select(
        F.col("version_id").alias("interaction_id"), F.col("contact_id").alias("customer_ref"),
        F.col("segment").alias("channel"), F.col("eff_from").alias("start_ts"),
    )
    gap = F.unix_seconds("start_ts") - F.unix_seconds("prev_contact_ts")
    return marts.repeat_contact(visits).select(
        F.col("customer_ref").alias("contact_id"), F.col("interaction_id").alias("version_id"), gap.alias("gap_seconds"), "repeat_within_72h"
    )


@query(
    "vw_billing_reconciliation",
    """
    WITH both_books AS (
      SELECT invoice_no, staged.total_amount AS claimed, booked.total_amount AS kept, staged.issued_ts_sec AS claimed_ms, booked.issued_ts AS kept_at,
             [sec:booked.issued_ts] - (staged.issued_ts_sec // 1000) AS late
      FROM {stg_fin_invoice} staged INNER JOIN {ods_invoice_acid} booked USING (invoice_id))
    SELECT invoice_no, CAST(claimed AS DOUBLE) AS staged_amount, CAST(kept AS DOUBLE) AS ods_amount,
           strftime(make_timestamp(1000 * claimed_ms), '%Y-%m-%d %H:%M:%S') AS staged_issued_ts, strftime(kept_at, '%Y-%m-%d %H:%M:%S') AS ods_issued_ts,
           late AS drift_seconds, ['OK', 'TS_MISMATCH', 'AMOUNT_MISMATCH'][1 + greatest(CAST(late <> 0 AS INTEGER), 2 * CAST(kept NOT BETWEEN claimed - 0.01 AND claimed + 0.01 AS INTEGER))] AS recon_status
    FROM both_books""",
)
def vw_billing_reconciliation(t):
    return marts.billing_reconciliation(t.stg_fin_invoice, t.ods_invoice_acid)


@query(
    "vw_roster_current",
    """
    -- The version no other version of the agent follows.
    SELECT v.agent_id, v.employee_no, v.org_unit_id, v.job_grade, v.employment_type, v.status,
           strftime(v.eff_from_ts, '%Y-%m-%d %H:%M:%S') AS eff_from_ts, now.program_id AS current_program_id,
           now.queue_id AS current_queue_id, now.role_on_program
    FROM {ods_agent_scd2} AS v
    LEFT JOIN (SELECT agent_id, program_id, queue_id, role_on_program FROM {ods_agent_assignment_scd2} WHERE is_current) AS now
      ON now.agent_id = v.agent_id
    WHERE NOT EXISTS (
      SELECT 1 FROM {ods_agent_scd2} AS later
      WHERE later.agent_id = v.agent_id AND (later.eff_from_ts > v.eff_from_ts
        OR later.eff_from_ts = v.eff_from_ts AND later.version_id > v.version_id))""",
)
def vw_roster_current(t):
    return marts.roster_current(t.ods_agent_scd2, t.ods_agent_assignment_scd2, tiebreak="version_id")


@query(
    "vw_agent_scorecard",
    """
    -- Means per agent from one stacked list of measures; ranks from how many agents stand before.
    WITH measures AS (
      SELECT agent_sk, 'aht' AS measure, avg_handle_seconds AS value FROM {agg_agent_daily}
      UNION ALL SELECT agent_sk, 'adherence', adherence_pct FROM {agg_agent_daily}
      UNION ALL SELECT agent_sk, 'qa', overall_pct FROM {fact_qa_evaluation}),
    per_agent AS (
      SELECT agent_sk, CAST(sum(value) FILTER (measure = 'aht') AS DOUBLE) / count(*) FILTER (measure = 'aht') AS handling,
             CAST(sum(value) FILTER (measure = 'adherence') AS DOUBLE) / count(*) FILTER (measure = 'adherence') AS adhering,
             CAST(sum(value) FILTER (measure = 'qa') AS DOUBLE) / count(*) FILTER (measure = 'qa') AS quality
      FROM measures GROUP BY agent_sk HAVING count(*) FILTER (measure = 'aht') > 0),
    board AS (
      SELECT agent_sk, agent_id, full_name, site_code, job_grade, handling, adhering, quality, count(*) OVER () AS agents,
             count(*) OVER (ORDER BY handling ASC NULLS FIRST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             count(*) OVER (PARTITION BY handling) AS tied,
             count(*) OVER (ORDER BY quality DESC NULLS LAST, agent_sk ROWS UNBOUNDED PRECEDING) AS place
      FROM per_agent NATURAL JOIN (FROM {dim_agent} WHERE is_current))
    SELECT agent_sk, full_name, site_code, job_grade, handling AS aht, adhering AS adherence,
           (SELECT CAST(sum(interactions_handled) AS BIGINT) FROM {agg_agent_daily} d WHERE d.agent_sk = board.agent_sk) AS volume,
           quality AS avg_qa_pct,
           (SELECT count(*) FROM {ods_agent_skill_scd2} k WHERE k.agent_id = board.agent_id AND k.is_current AND k.certified) AS certified_skills,
           CASE WHEN agents > 1 THEN CAST(upto - tied AS DOUBLE) / (agents - 1) ELSE 0 END AS aht_pctile,
           CASE WHEN place <= agents % 4 * (agents // 4 + 1) THEN (place - 1) // (agents // 4 + 1) + 1
                ELSE (place - 1 - agents % 4) // greatest(agents // 4, 1) + 1 END AS qa_quartile
    FROM board""",
)
def vw_agent_scorecard(t):
    return marts.agent_scorecard(t.dim_agent, t.agg_agent_daily, t.fact_qa_evaluation, t.ods_agent_skill_scd2)


@query(
    "vw_attrition_risk",
    """
    -- The band is the place among active agents, cut into five runs, the first ones longer by one.
    WITH active AS (
      SELECT a.agent_sk, a.agent_id, a.full_name, a.site_code,
             (SELECT CAST(sum(d.adherence_pct) AS DOUBLE) / count(*) FROM {fact_adherence_daily} d WHERE d.agent_sk = a.agent_sk) AS kept,
             (SELECT count(*) FROM {ods_attrition_event} e WHERE e.agent_id = a.agent_id) AS events
      FROM {dim_agent} a
      WHERE a.status = 'ACTIVE' AND a.is_current AND a.agent_sk IN (SELECT agent_sk FROM {fact_adherence_daily})),
    numbered AS (
      SELECT *, count(*) OVER (ORDER BY kept ASC NULLS FIRST, agent_sk ROWS UNBOUNDED PRECEDING) AS place, count(*) OVER () AS n FROM active),
    runs AS (SELECT *, n // 5 + CASE WHEN n % 5 > 0 THEN 1 ELSE 0 END AS first_run, n // 5 + CASE WHEN n % 5 > 1 THEN 1 ELSE 0 END AS second_run FROM numbered)
    SELECT agent_sk, agent_id, full_name, site_code, kept AS adherence_90d, events AS notice_events,
           CASE WHEN events > 0 OR place <= first_run THEN 'HIGH' WHEN place <= first_run + second_run THEN 'MEDIUM' ELSE 'LOW' END AS attrition_risk
    FROM runs""",
)
def vw_attrition_risk(t):
    return marts.attrition_risk(t.dim_agent, t.fact_adherence_daily, t.ods_attrition_event)


@query(
    "vw_queue_sla",
    """
    -- Goals per queue and calls per queue and day first; a queue with k goals counts its calls k times.
    WITH goals AS (SELECT queue_id, count(*) AS k, CAST(max(target_value) AS DOUBLE) AS goal FROM {stg_crm_sla_target} WHERE metric_code = 'SL_20_80' GROUP BY ALL),
         calls AS (SELECT queue_sk, date_key, sum(answered) AS taken, sum(answered_in_sl) AS quick FROM {fact_queue_interval} GROUP BY ALL),
         shares AS (
           SELECT queue_code, media_type, date_key, max(goal) AS goal, CAST(sum(quick * ifnull(k, 1)) AS DOUBLE) AS quick, CAST(sum(taken * ifnull(k, 1)) AS DOUBLE) AS taken
           FROM calls INNER JOIN {dim_queue} USING (queue_sk) LEFT JOIN goals USING (queue_id) GROUP BY ALL),
         percent AS (SELECT *, CASE WHEN taken <> 0 THEN quick / taken * 100 END AS reached FROM shares)
    SELECT queue_code, media_type, date_key, reached AS sl_pct, goal AS sl_target, if(ifnull(reached >= goal, FALSE), 'MET', 'MISSED') AS attainment FROM percent""",
)
def vw_queue_sla(t):
    return marts.queue_sla(t.fact_queue_interval, t.dim_queue, t.stg_crm_sla_target)


@query(
    "vw_first_contact_resolution",
    """
    -- A resolved contact weighs as many rows as it has repeats, one at least.
    WITH starts AS (SELECT customer_ref, list(start_ts) AS all_starts FROM {fact_interaction} GROUP BY customer_ref),
    weighed AS (
      SELECT date_key, program_sk,
             len(list_filter(coalesce(all_starts, []), lambda s: s > end_ts AND s <= end_ts + INTERVAL '168' HOUR)) AS repeats
      FROM (FROM {fact_interaction} WHERE resolved_flag) LEFT JOIN starts USING (customer_ref))
    SELECT date_key, program_sk, CAST(sum(greatest(repeats, 1)) AS BIGINT) AS resolved_interactions, count(*) FILTER (repeats = 0) AS fcr_count,
           CAST(count(*) FILTER (repeats = 0) AS DOUBLE) / sum(greatest(repeats, 1)) * 100 AS fcr_pct
    FROM weighed GROUP BY date_key, program_sk""",
)
def vw_first_contact_resolution(t):
    return marts.first_contact_resolution(t.fact_interaction)


@query(
    "interval_self_join",
    """
    WITH starts AS (SELECT customer_ref, list(start_ts) AS all_starts FROM {fact_interaction} GROUP BY customer_ref)
    SELECT interaction_id, customer_ref,
           len(list_filter(coalesce(all_starts, []), lambda s: s > end_ts AND s <= end_ts + INTERVAL '168' HOUR)) AS n_repeats
    FROM (FROM {fact_interaction} WHERE resolved_flag) LEFT JOIN starts USING (customer_ref)""",
)
def interval_self_join(t):
    return marts.repeats_after(t.fact_interaction)


@query(
    "vw_occupancy",
    """
    -- States fall into classes first; classes become columns after.
    WITH classes AS (
      SELECT date_key, agent_sk, state_seconds,
             CASE WHEN state_code IN ('TALK', 'HOLD', 'ACW') THEN 'busy' WHEN state_code = 'READY' THEN 'free'
                  WHEN starts_with(state_code, 'AUX') THEN 'away' ELSE 'other' END AS class
      FROM {fact_agent_activity}),
    summed AS (
      SELECT date_key, agent_sk, coalesce(CAST(sum(state_seconds) FILTER (class = 'busy') AS BIGINT), 0) AS busy,
             coalesce(CAST(sum(state_seconds) FILTER (class = 'free') AS BIGINT), 0) AS free,
             coalesce(CAST(sum(state_seconds) FILTER (class = 'away') AS BIGINT), 0) AS away
      FROM classes GROUP BY date_key, agent_sk)
    SELECT date_key, site_code, agent_sk, busy AS handle_seconds, free AS ready_seconds, away AS aux_seconds,
           CASE WHEN busy + free > 0 THEN CAST(busy AS DOUBLE) / (busy + free) * 100 END AS occupancy_pct
    FROM summed NATURAL JOIN (SELECT agent_sk, site_code FROM {dim_agent})""",
)
def vw_occupancy(t):
    return marts.occupancy(t.fact_agent_activity, t.dim_agent)


@query(
    "vw_shrinkage",
    """
    -- What an agent's day is planned as, folded to one row: how often the day counts, and which schedules and shifts it names.
    WITH nights AS (SELECT shift_id, count(*) AS n, list(shift_sk) AS names FROM {dim_shift} WHERE overnight_flag GROUP BY ALL),
         plans AS (
           SELECT agent_id, CAST(strftime(sched_date, '%Y%m%d') AS BIGINT) AS date_key, sum(ifnull(n, 1)) AS times, list(schedule_id) AS planned, flatten(list(ifnull(names, []))) AS nightly
           FROM {ods_schedule} LEFT JOIN nights USING (shift_id) GROUP BY ALL),
         days AS (
           SELECT date_key, site_code, ifnull(times, 1) AS times, scheduled_minutes AS due, worked_minutes AS done, exception_minutes + timeoff_minutes AS lost, planned, nightly
           FROM {fact_adherence_daily} INNER JOIN {dim_agent} USING (agent_sk) LEFT JOIN plans USING (agent_id, date_key)),
         sums AS (
           SELECT date_key, site_code, sum(times * due) AS due, sum(times * done) AS done, sum(times * lost) AS lost,
                  flatten(list(ifnull(planned, []))) AS planned, flatten(list(ifnull(nightly, []))) AS nightly
           FROM days GROUP BY ALL)
    SELECT date_key, site_code, CAST(due AS BIGINT) AS scheduled_minutes, CAST(done AS BIGINT) AS worked_minutes, CAST(lost AS BIGINT) AS shrinkage_minutes,
           CASE WHEN due <> 0 THEN CAST(lost AS DOUBLE) / CAST(due AS DOUBLE) * 100 END AS shrinkage_pct,
           CAST(list_unique(planned) AS BIGINT) AS schedules, CAST(list_unique(nightly) AS BIGINT) AS overnight_shifts
    FROM sums""",
)
def vw_shrinkage(t):
    return marts.shrinkage(t.fact_adherence_daily, t.dim_agent, t.ods_schedule, t.dim_shift)


@query(
    "vw_program_margin",
    """
    -- Every amount a billing row needs, looked up; a month with work in k programs gives k rows.
    WITH costs AS (
      SELECT work_month AS month, CAST(sum(billable_minutes) * 18.50 AS DOUBLE) / 60 AS cost
      FROM {ods_timesheet} GROUP BY program_id, work_month),
    months AS (SELECT DISTINCT period_month FROM {agg_billing_monthly}),
    known AS (
      SELECT period_month, cost,
             (SELECT CAST(sum(amount) AS DOUBLE) FROM {ods_payroll_adjustment} p WHERE p.period_month = months.period_month) AS adjusted
      FROM months LEFT JOIN costs ON costs.month = months.period_month)
    SELECT CAST(period_month AS STRING) AS period_month, client_sk, program_sk, CAST(billed_amount AS DOUBLE) AS billed_amount,
           CAST(net_revenue AS DOUBLE) AS net_revenue, cost AS est_labor_cost, adjusted AS total_adjustments,
           CAST(net_revenue AS DOUBLE) - cost - coalesce(adjusted, 0) AS est_margin,
           (SELECT count(DISTINCT contract_id) FROM {ods_contract_line}) AS contracts,
           (SELECT CAST(sum(min_commit) AS DOUBLE) FROM {ods_contract_line}) AS committed_min
    FROM {agg_billing_monthly} JOIN known USING (period_month)""",
)
def vw_program_margin(t):
    return marts.program_margin(t.agg_billing_monthly, t.ods_timesheet, t.ods_payroll_adjustment, t.ods_contract_line)


@query(
    "vw_executive_summary",
    """
    -- Month by month from the program totals outwards.
    WITH tickets AS (
      SELECT program_sk, count(*) FILTER (status = 'OPEN' OR status = 'PENDING') AS waiting, count(*) FILTER (sla_breached_flag) AS late
      FROM {fact_ticket} GROUP BY program_sk),
    money AS (SELECT program_sk, period_month, CAST(billed_amount AS DOUBLE) AS billed, CAST(sla_credit_amount AS DOUBLE) AS credit,
                     CAST(net_revenue AS DOUBLE) AS net FROM {agg_billing_monthly}),
    mood AS (SELECT program_sk, period_month, pct_promoters, pct_detractors FROM {agg_csat_rollup_monthly}),
    totals AS (SELECT program_sk, period_month, interactions, avg_handle_seconds, avg_csat FROM {agg_program_monthly} WHERE grouping_level = 0),
    owners AS (SELECT program_sk, program_code, client_code, client_name FROM {dim_program} JOIN {dim_client} USING (client_id))
    SELECT client_code, client_name, CAST(period_month AS STRING) AS period_month, program_code, interactions,
           CAST(avg_handle_seconds AS DOUBLE) AS avg_handle_seconds, CAST(avg_csat AS DOUBLE) AS avg_csat, pct_promoters, pct_detractors,
           billed AS billed_amount, credit AS sla_credit_amount, net AS net_revenue, waiting AS open_tickets, late AS sla_breached_tickets
    FROM totals JOIN owners USING (program_sk) LEFT JOIN mood USING (program_sk, period_month)
    LEFT JOIN money USING (program_sk, period_month) LEFT JOIN tickets USING (program_sk)""",
)
def vw_executive_summary(t):
    return marts.executive_summary(
        t.dim_client, t.dim_program, t.agg_program_monthly, t.agg_csat_rollup_monthly, t.agg_billing_monthly, t.fact_ticket
    )


@query(
    "mv_agent_weekly",
    """
    WITH dated AS (SELECT *, make_date(date_key // 10000, date_key // 100 % 100, date_key % 100) AS d FROM {agg_agent_daily}),
         weeks AS (SELECT *, year(monday) * 10000 + month(monday) * 100 + day(monday) AS monday_key FROM (SELECT *, d - CAST(isodow(d) - 1 AS INTEGER) AS monday FROM dated))
    SELECT CAST(monday_key AS BIGINT) AS week_start_key, site_code, agent_sk, CAST(sum(interactions_handled) AS BIGINT) AS interactions_handled, count(d) AS days_worked,
           avg(occupancy_pct) AS occupancy_pct, avg(adherence_pct) AS adherence_pct, avg(avg_handle_seconds) AS avg_handle_seconds
    FROM weeks GROUP BY ALL""",
)
def mv_agent_weekly(t):
    return marts.agent_weekly(t.agg_agent_daily)


@query(
    "mv_site_daily",
    """
    -- One row per agent, site and day first: agents are then rows, and means are sums of sums over sums of counts.
    WITH agents AS (
      SELECT site_code, date_key, agent_sk, count(*) AS n, sum(interactions_handled) AS handled, sum(avg_handle_seconds) AS seconds, sum(adherence_pct) AS kept
      FROM {agg_agent_daily} GROUP BY ALL)
    SELECT site_code, date_key, count(agent_sk) AS agents_active, CAST(sum(handled) AS BIGINT) AS interactions, CAST(sum(seconds) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS avg_handle_seconds,
           CAST(sum(kept) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS adherence_pct, CAST(NULL AS DOUBLE) AS sl_pct
    FROM agents GROUP BY site_code, date_key""",
)
def mv_site_daily(t):
    return marts.site_daily(t.agg_agent_daily)
