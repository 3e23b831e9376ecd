"""The mart views, each a function of the tables it reads.

Column names are those of the warehouse tables, so a view runs on real tables
or on stand-ins of the same shape.  Facts are aggregated as early as the view's
meaning allows, and where a view's join multiplies rows only to count or sum
them, the multiplication is done arithmetically.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paritas.operators.history import latest_version
from paritas.operators.ordering import neighbour, ntile, percent_rank, running_total, table_rank
from paritas.session import durable

REPEAT_WINDOW_SECONDS = 259_200
FCR_WINDOW_DAYS = 7
LABOUR_RATE = "18.50"

# Call-driver classes in order of precedence.
CALL_DRIVERS = (
    ("BILLING", "(?i)(bill|invoice|charge|refund)"),
    ("ACCESS", "(?i)(password|login|locked|reset)"),
    ("RETENTION", "(?i)(cancel|churn|retention)"),
)
CALL_TAG = r"^\[([A-Z]{2,5})\]"
CALL_REFERENCE = r"ref#(\d+)"


def mean(c: str | Column) -> Column:
    """Average whose value does not depend on the order of addition: exact sum over count."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col).cast("double") / F.count(col)


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, NULL when whole is 0."""
    return F.try_divide(part.cast("double"), F.nullif(whole.cast("double"), F.lit(0.0))) * 100.0


def date_key_to_date(c: str) -> Column:
    return F.to_date(F.col(c).cast("string"), "yyyyMMdd")


def org_hierarchy(ods_org_unit: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Every unit below a root (no parent), with depth and name path.

    Units climb by doubling: after round r a unit knows its ancestor 2**r steps
    up, or its root, so a tree of depth d takes log2(d) rounds; each is written.
    Units below a missing parent drop out, and a cycle ends the climb when no
    path of its length is left in the table.  ``max_depth`` leaves out deeper
    units, as the legacy view does at 6.
    """
    kept = ["org_unit_id", "unit_code", "unit_name", "unit_type", "site_code"]
    tops = ods_org_unit.where("parent_unit_id IS NULL").select(
        *kept, F.col("org_unit_id").alias("root_unit_id"), F.lit(0).alias("depth"), F.col("unit_name").alias("path_names")
    )
    # A jump leads from a unit to an ancestor: its id, the steps, the names passed on the way, and whether it is a root.
    up = ods_org_unit.select(
        F.col("org_unit_id").alias("_to"), F.lit(1).alias("_steps"), F.col("unit_name").alias("_names"),
        F.col("parent_unit_id").isNull().alias("_top"),
    )
    own = ods_org_unit.select(*kept, F.col("parent_unit_id").alias("_to")).where("_to IS NOT NULL")
    jumps = durable(own.join(up, "_to").select(*kept, "_to", "_steps", "_names", "_top"), "org-jumps")
    units, reach = ods_org_unit.count(), 1
    while reach <= units and not jumps.where("NOT _top").isEmpty():
        further = jumps.select(
            F.col("org_unit_id").alias("_to"), F.col("_to").alias("_to2"), F.col("_steps").alias("_more"),
            F.col("_names").alias("_above"), F.col("_top").alias("_ends"),
        )
        climbed = jumps.where("NOT _top").join(further, "_to").select(
            *kept, F.col("_to2").alias("_to"), (F.col("_steps") + F.col("_more")).alias("_steps"),
            F.concat("_above", F.lit(" > "), "_names").alias("_names"), F.col("_ends").alias("_top"),
        )
        jumps, reach = durable(jumps.where("_top").unionByName(climbed), "org-jumps"), reach * 2
    below = jumps.where("_top").select(
        *kept, F.col("_to").alias("root_unit_id"), F.col("_steps").alias("depth"),
        F.concat("_names", F.lit(" > "), "unit_name").alias("path_names"),
    )
    tree = tops.unionByName(below)
    return tree if max_depth is None else tree.where(F.col("depth") <= max_depth)


def active_agents(fact_interaction: DataFrame, dim_agent: DataFrame, lg_k: int = 14) -> DataFrame:
    """Approximate active agents and agent-channel pairs per day and site.

    Sketches hold the few values of a small group as they are and grow to
    2**lg_k registers (0.8 % standard error at 14).
    """
    # Folded to one row per day, agent and channel before the join; distinct
    # agents and pairs are the same at that grain.
    folded = fact_interaction.groupBy("date_key", "agent_sk", "channel").agg(F.count(F.lit(1)).alias("_n"))
    pair = F.concat(F.col("agent_sk").cast("string"), F.lit("|"), "channel")
    return (
        folded.join(dim_agent.select("agent_sk", "site_code"), "agent_sk")
        .groupBy("date_key", "site_code")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg(F.col("agent_sk").cast("bigint"), lg_k)).alias("approx_active_agents"),
            F.hll_sketch_estimate(F.hll_sketch_agg(pair, lg_k)).alias("approx_agent_channel_pairs"),
            F.sum("_n").alias("interactions"),
        )
    )


def csat_rollup(fact_csat_survey: DataFrame, dim_program: DataFrame) -> DataFrame:
    """Survey scores rolled up program -> client -> all; ``grouping_level`` 0, 1, 3."""
    # Programs are folded first: rollup's three copies of each row then apply to
    # one row per program instead of one per survey.
    per_program = fact_csat_survey.groupBy("program_sk").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("csat_score").alias("_csat"),
        F.count("csat_score").alias("_n_csat"),
        F.count_if(F.col("nps_score") >= 9).alias("_promoters"),
    )
    joined = per_program.join(dim_program.select("program_sk", "program_code", "client_id"), "program_sk")
    return joined.rollup("client_id", "program_code").agg(
        F.sum("_n").alias("surveys"),
        (F.sum("_csat").cast("double") / F.sum("_n_csat")).alias("avg_csat"),
        percent(F.sum("_promoters"), F.sum("_n")).alias("pct_promoters"),
        F.grouping_id().cast("bigint").alias("grouping_level"),
    )


def call_driver(disposition_desc: Column) -> Column:
    """Class of a disposition text: keyword class, else its leading tag, else OTHER."""
    tag = F.nullif(F.regexp_extract(disposition_desc, CALL_TAG, 1), F.lit(""))
    keyword = reduce(
        lambda acc, item: F.when(disposition_desc.rlike(item[1]), item[0]).otherwise(acc), reversed(CALL_DRIVERS), F.lit(None)
    )
    return F.coalesce(keyword, tag, F.lit("OTHER"))


def call_drivers(ods_call: DataFrame, dim_disposition: DataFrame) -> DataFrame:
    """Calls per day, queue, driver and embedded reference number.

    Texts are classified once per disposition, and calls are folded per
    disposition before the join.
    """
    classified = dim_disposition.select(
        "disposition_code",
        call_driver(F.col("disposition_desc")).alias("call_driver"),
        F.nullif(F.regexp_extract("disposition_desc", CALL_REFERENCE, 1), F.lit("")).alias("embedded_ref_no"),
    )
    folded = ods_call.groupBy("call_date", "queue_id", "disposition_code").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("talk_seconds").alias("_talk"), F.count("talk_seconds").alias("_n_talk")
    )
    return (
        folded.join(classified, "disposition_code")
        .groupBy("call_date", "queue_id", "call_driver", "embedded_ref_no")
        .agg(F.sum("_n").alias("calls"), F.try_divide(F.sum("_talk").cast("double"), F.sum("_n_talk")).alias("avg_talk_seconds"))
    )


def repeat_contact(ods_interaction: DataFrame) -> DataFrame:
    """Each interaction with the customer's previous contact and whether it was within 72 hours."""
    known = ods_interaction.where(F.col("customer_ref").isNotNull() & (F.col("customer_ref").cast("string") != ""))
    narrow = known.select("interaction_id", "customer_ref", "channel", "start_ts")
    previous = neighbour(
        narrow, ["customer_ref"], ["start_ts", "interaction_id"], {"prev_contact_ts": "start_ts"}
    )
    gap = F.unix_seconds(F.col("start_ts").cast("timestamp")) - F.unix_seconds(F.col("prev_contact_ts").cast("timestamp"))
    return previous.withColumn("repeat_within_72h", F.when(gap <= REPEAT_WINDOW_SECONDS, 1).otherwise(0))


def billing_reconciliation(stg_fin_invoice: DataFrame, ods_invoice_acid: DataFrame) -> DataFrame:
    """Staged against loaded invoices.  ``issued_ts_sec`` holds milliseconds despite its name."""
    s = stg_fin_invoice.select("invoice_id", "invoice_no", F.col("total_amount").alias("staged_amount"), "issued_ts_sec")
    a = ods_invoice_acid.select("invoice_id", F.col("total_amount").alias("ods_amount"), F.col("issued_ts").alias("ods_issued_ts"))
    staged_second = F.expr("issued_ts_sec div 1000")
    ods_second = F.unix_seconds(F.col("ods_issued_ts").cast("timestamp"))
    status = (
        F.when(F.abs(F.col("staged_amount") - F.col("ods_amount")) > F.lit("0.01").cast("decimal(3,2)"), "AMOUNT_MISMATCH")
        .when(ods_second != staged_second, "TS_MISMATCH")
        .otherwise("OK")
    )
    return s.join(a, "invoice_id").select(
        "invoice_no",
        "staged_amount",
        "ods_amount",
        F.timestamp_millis("issued_ts_sec").alias("staged_issued_ts"),
        "ods_issued_ts",
        (ods_second - staged_second).alias("drift_seconds"),
        status.alias("recon_status"),
    )


def roster_current(ods_agent_scd2: DataFrame, ods_agent_assignment_scd2: DataFrame, tiebreak: str) -> DataFrame:
    """Latest history row per agent with the current assignment, if any."""
    latest = latest_version(ods_agent_scd2, ["agent_id"], ["eff_from_ts", tiebreak])
    current = ods_agent_assignment_scd2.where("is_current").select(
        "agent_id", F.col("program_id").alias("current_program_id"), F.col("queue_id").alias("current_queue_id"), "role_on_program"
    )
    return latest.join(current, "agent_id", "left").select(
        "agent_id", "employee_no", "org_unit_id", "job_grade", "employment_type", "status", "eff_from_ts",
        "current_program_id", "current_queue_id", "role_on_program",
    )


def agent_scorecard(
    dim_agent: DataFrame, agg_agent_daily: DataFrame, fact_qa_evaluation: DataFrame, ods_agent_skill_scd2: DataFrame
) -> DataFrame:
    """Handling time, adherence, quality and skills per agent, ranked over all agents."""
    perf = agg_agent_daily.groupBy("agent_sk").agg(
        mean("avg_handle_seconds").alias("aht"),
        mean("adherence_pct").alias("adherence"),
        F.sum("interactions_handled").alias("volume"),
    )
    qa = fact_qa_evaluation.groupBy("agent_sk").agg(mean("overall_pct").alias("avg_qa_pct"))
    skills = ods_agent_skill_scd2.where("is_current AND certified").groupBy("agent_id").agg(F.count(F.lit(1)).alias("_skills"))
    base = (
        dim_agent.where("is_current")
        .select("agent_sk", "agent_id", "full_name", "site_code", "job_grade")
        .join(perf, "agent_sk")
        .join(qa, "agent_sk", "left")
        .join(skills, "agent_id", "left")
        .withColumn("certified_skills", F.coalesce("_skills", F.lit(0)))
        .drop("_skills", "agent_id")
    )
    by_aht = table_rank(base, "aht", ["agent_sk"], prefix="_a_")
    both = table_rank(by_aht, "avg_qa_pct", ["agent_sk"], descending=True, prefix="_q_")
    return both.select(
        *base.columns,
        percent_rank(F.col("_a_rank"), F.col("_a_total")).alias("aht_pctile"),
        ntile(F.col("_q_row"), F.col("_q_total"), 4).alias("qa_quartile"),
    )


def attrition_risk(
    dim_agent: DataFrame, fact_adherence_daily: DataFrame, ods_attrition_event: DataFrame
) -> DataFrame:
    """Risk band of active agents from adherence quintile and notice events.

    The legacy view also joins a weekly volume it never uses; one row per agent
    on that side leaves the result unchanged, so it is not read.
    """
    adherence = fact_adherence_daily.groupBy("agent_sk").agg(mean("adherence_pct").alias("adherence_90d"))
    notices = ods_attrition_event.groupBy("agent_id").agg(F.count(F.lit(1)).alias("_notices"))
    base = (
        dim_agent.where("is_current AND status = 'ACTIVE'")
        .select("agent_sk", "agent_id", "full_name", "site_code")
        .join(adherence, "agent_sk")
        .join(notices, "agent_id", "left")
        .withColumn("notice_events", F.coalesce("_notices", F.lit(0)))
        .drop("_notices")
    )
    ranked = table_rank(base, "adherence_90d", ["agent_sk"])
    band = ntile(F.col("_row"), F.col("_total"), 5)
    risk = F.when((band == 1) | (F.col("notice_events") > 0), "HIGH").when(band == 2, "MEDIUM").otherwise("LOW")
    return ranked.select(
        "agent_sk", "agent_id", "full_name", "site_code", "adherence_90d", "notice_events", risk.alias("attrition_risk")
    )


def queue_sla(fact_queue_interval: DataFrame, dim_queue: DataFrame, stg_crm_sla_target: DataFrame) -> DataFrame:
    """Service level per queue and day against the SL_20_80 target."""
    targets = stg_crm_sla_target.where("metric_code = 'SL_20_80'").select("queue_id", "target_value")
    # Several targets per queue repeat the fact rows alike in both sums, so the
    # ratio needs only their maximum.
    targets = targets.groupBy("queue_id").agg(F.max("target_value").alias("sl_target"))
    facts = fact_queue_interval.groupBy("queue_sk", "date_key").agg(
        F.sum("answered_in_sl").alias("_in_sl"), F.sum("answered").alias("_answered")
    )
    joined = facts.join(dim_queue.select("queue_sk", "queue_id", "queue_code", "media_type"), "queue_sk").join(
        targets, "queue_id", "left"
    )
    out = joined.groupBy("queue_code", "media_type", "date_key").agg(
        percent(F.sum("_in_sl"), F.sum("_answered")).alias("sl_pct"), F.max("sl_target").alias("sl_target")
    )
    met = F.col("sl_pct") >= F.col("sl_target").cast("double")
    return out.withColumn("attainment", F.when(met, "MET").otherwise("MISSED"))


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def _contacts_after(fact_interaction: DataFrame, days: int) -> DataFrame:
    """``customer_ref, _end, n_repeats`` for every instant a resolved interaction of the customer ended.

    Counts pairs without forming them: with C(t) the customer's contacts up to
    t, the count is C(end + days) - C(end).  Contacts and the two instants asked
    about are merged on one time line, on which C is a running total.
    """
    known = fact_interaction.where(F.col("customer_ref").isNotNull())
    points = known.groupBy("customer_ref", _micros("start_ts").alias("_at")).agg(F.count(F.lit(1)).alias("_w"))
    # Interactions that end at one instant share their count: ask once.
    asked = known.where("resolved_flag").select("customer_ref", _micros("end_ts").alias("_end")).distinct()
    ends = F.array(
        F.struct(F.col("_end").alias("_at"), F.lit(-1).alias("_sign")),
        F.struct((F.col("_end") + days * 86_400 * 1_000_000).alias("_at"), F.lit(1).alias("_sign")),
    )
    questions = asked.select("customer_ref", "_end", F.inline(ends))
    line = points.select(
        "customer_ref", "_at", F.lit(0).alias("_kind"), "_w", F.lit(None).cast("bigint").alias("_end"), F.lit(0).alias("_sign")
    ).unionByName(
        questions.select("customer_ref", "_at", F.lit(1).alias("_kind"), F.lit(0).cast("bigint").alias("_w"), "_end", "_sign")
    )
    # _kind puts a contact before a question at the same instant: "up to and including".
    counted = running_total(line, ["customer_ref"], ["_at", "_kind", "_end", "_sign"], "_w", "_upto")
    return counted.where("_kind = 1").groupBy("customer_ref", "_end").agg(
        F.sum(F.col("_upto") * F.col("_sign")).cast("bigint").alias("n_repeats")
    )


def repeats_after(
    fact_interaction: DataFrame, days: int = FCR_WINDOW_DAYS
) -> DataFrame:
    """Per resolved interaction, ``n_repeats``: contacts of the same customer that
    start after its end and within ``days``."""
    resolved = fact_interaction.where("resolved_flag").select("interaction_id", "customer_ref", _micros("end_ts").alias("_end"))
    joined = resolved.join(_contacts_after(fact_interaction, days), ["customer_ref", "_end"], "left")
    return joined.select("interaction_id", "customer_ref", F.coalesce("n_repeats", F.lit(0)).alias("n_repeats"))


def first_contact_resolution(fact_interaction: DataFrame) -> DataFrame:
    """First-contact resolution per day and program.

    ``resolved_interactions`` keeps the view's arithmetic: an interaction with k
    repeats counts k times, one without counts once.
    """
    resolved = fact_interaction.where("resolved_flag").groupBy(
        "customer_ref", _micros("end_ts").alias("_end"), "date_key", "program_sk"
    ).agg(F.count(F.lit(1)).alias("_n"))
    repeats = _contacts_after(fact_interaction, FCR_WINDOW_DAYS)
    joined = resolved.join(repeats, ["customer_ref", "_end"], "left").withColumn("_k", F.coalesce("n_repeats", F.lit(0)))
    first = F.sum(F.when(F.col("_k") == 0, F.col("_n")).otherwise(0))
    total = F.sum(F.col("_n") * F.greatest("_k", F.lit(1)))
    return joined.groupBy("date_key", "program_sk").agg(
        total.alias("resolved_interactions"), first.alias("fcr_count"), percent(first, total).alias("fcr_pct")
    )


def occupancy(fact_agent_activity: DataFrame, dim_agent: DataFrame) -> DataFrame:
    """Seconds handling, ready and auxiliary per agent and day, and occupancy."""
    state, seconds = F.col("state_code"), F.col("state_seconds")
    total = lambda condition: F.sum(F.when(condition, seconds).otherwise(0))
    handling = state.isin("TALK", "HOLD", "ACW")
    per_agent = fact_agent_activity.groupBy("date_key", "agent_sk").agg(
        total(handling).alias("handle_seconds"),
        total(state == "READY").alias("ready_seconds"),
        total(state.like("AUX%")).alias("aux_seconds"),
        percent(total(handling), total(handling | (state == "READY"))).alias("occupancy_pct"),
    )
    return per_agent.join(dim_agent.select("agent_sk", "site_code"), "agent_sk").select(
        "date_key", "site_code", "agent_sk", "handle_seconds", "ready_seconds", "aux_seconds", "occupancy_pct"
    )


def shrinkage(
    fact_adherence_daily: DataFrame, dim_agent: DataFrame, ods_schedule: DataFrame, dim_shift: DataFrame
) -> DataFrame:
    """Lost minutes per day and site.

    Minutes count once per schedule (and overnight shift) of the agent and day,
    as the view's joins have it.  Facts are folded to one row per day and agent
    first, so the join yields one row per schedule and nothing multiplies.
    """
    minutes = ["scheduled_minutes", "worked_minutes", "exception_minutes", "timeoff_minutes"]
    facts = fact_adherence_daily.groupBy("date_key", "agent_sk").agg(*[F.sum(m).alias(m) for m in minutes])
    facts = facts.join(dim_agent.select("agent_sk", "agent_id", "site_code"), "agent_sk")
    facts = facts.withColumn("sched_date", date_key_to_date("date_key"))
    overnight = dim_shift.where("overnight_flag").select("shift_id", "shift_sk")
    schedules = ods_schedule.select("agent_id", "sched_date", "schedule_id", "shift_id").join(overnight, "shift_id", "left")
    joined = facts.join(schedules, ["agent_id", "sched_date"], "left")
    lost = F.sum(F.col("exception_minutes") + F.col("timeoff_minutes"))
    keys = ["date_key", "site_code"]
    sums = joined.groupBy(*keys, "schedule_id", "shift_sk").agg(
        F.sum("scheduled_minutes").alias("scheduled_minutes"), F.sum("worked_minutes").alias("worked_minutes"),
        lost.alias("shrinkage_minutes"),
    )
    return sums.groupBy(*keys).agg(
        F.sum("scheduled_minutes").alias("scheduled_minutes"),
        F.sum("worked_minutes").alias("worked_minutes"),
        F.sum("shrinkage_minutes").alias("shrinkage_minutes"),
        percent(F.sum("shrinkage_minutes"), F.sum("scheduled_minutes")).alias("shrinkage_pct"),
        F.countDistinct("schedule_id").alias("schedules"),
        F.countDistinct("shift_sk").alias("overnight_shifts"),
    )


def program_margin(
    agg_billing_monthly: DataFrame, ods_timesheet: DataFrame, ods_payroll_adjustment: DataFrame, ods_contract_line: DataFrame
) -> DataFrame:
    """Revenue less estimated labour cost and adjustments per billing row.

    The legacy view repeats every row once per contract (``ON 1 = 1``).  No pair
    is formed here: ``contracts`` is the number of repetitions and
    ``committed_min`` the total over them.
    """
    labour = ods_timesheet.groupBy("program_id", "work_month").agg(F.sum("billable_minutes").alias("_minutes"))
    adjustments = ods_payroll_adjustment.groupBy("period_month").agg(F.sum("amount").alias("total_adjustments"))
    # One total row: read as scalar subqueries, no join.
    contracts = ods_contract_line.groupBy("contract_id").agg(F.sum("min_commit").alias("_m"))
    n_contracts = contracts.agg(F.count(F.lit(1))).scalar()
    committed = ods_contract_line.agg(F.sum("min_commit")).scalar()
    cost = (F.col("_minutes") * F.lit(LABOUR_RATE).cast("decimal(4,2)")).cast("double") / 60.0
    b = agg_billing_monthly.join(labour, F.col("period_month") == F.col("work_month"), "left").drop("work_month", "program_id")
    return b.join(adjustments, "period_month", "left").select(
        "period_month", "client_sk", "program_sk", "billed_amount", "net_revenue",
        cost.alias("est_labor_cost"),
        "total_adjustments",
        (
            F.col("net_revenue").cast("double") - cost
            - F.coalesce(F.col("total_adjustments").cast("double"), F.lit(0.0))
        ).alias("est_margin"),
        n_contracts.alias("contracts"),
        committed.alias("committed_min"),
    )


def executive_summary(
    dim_client: DataFrame,
    dim_program: DataFrame,
    agg_program_monthly: DataFrame,
    agg_csat_rollup_monthly: DataFrame,
    agg_billing_monthly: DataFrame,
    fact_ticket: DataFrame,
) -> DataFrame:
    """One row per client, program and month over four fact families."""
    tickets = fact_ticket.groupBy("program_sk").agg(
        F.count_if(F.col("status").isin("OPEN", "PENDING")).alias("open_tickets"),
        F.count_if("sla_breached_flag").alias("sla_breached_tickets"),
    )
    monthly = agg_program_monthly.where("grouping_level = 0").select(
        "program_sk", "period_month", "interactions", "avg_handle_seconds", "avg_csat"
    )
    return (
        dim_client.select("client_id", "client_code", "client_name")
        .join(dim_program.select("client_id", "program_sk", "program_code"), "client_id")
        .join(monthly, "program_sk")
        .join(agg_csat_rollup_monthly.select("program_sk", "period_month", "pct_promoters", "pct_detractors"),
              ["program_sk", "period_month"], "left")
        .join(agg_billing_monthly.select("program_sk", "period_month", "billed_amount", "sla_credit_amount", "net_revenue"),
              ["program_sk", "period_month"], "left")
        .join(tickets, "program_sk", "left")
        .select(
            "client_code", "client_name", "period_month", "program_code", "interactions", "avg_handle_seconds", "avg_csat",
            "pct_promoters", "pct_detractors", "billed_amount", "sla_credit_amount", "net_revenue",
            "open_tickets", "sla_breached_tickets",
        )
    )


def agent_weekly(agg_agent_daily: DataFrame) -> DataFrame:
    """Agent totals per ISO week, keyed by the week's Monday as yyyyMMdd."""
    monday = F.date_format(F.date_trunc("week", date_key_to_date("date_key")), "yyyyMMdd").cast("bigint")
    return agg_agent_daily.groupBy(monday.alias("week_start_key"), "agent_sk", "site_code").agg(
        F.count(F.lit(1)).alias("days_worked"),
        F.sum("interactions_handled").alias("interactions_handled"),
        *[mean(c).alias(c) for c in ("avg_handle_seconds", "adherence_pct", "occupancy_pct")],
    )


def site_daily(agg_agent_daily: DataFrame) -> DataFrame:
    """Site totals per day; ``sl_pct`` is a placeholder the service-level view fills."""
    return agg_agent_daily.groupBy("date_key", "site_code").agg(
        F.countDistinct("agent_sk").alias("agents_active"),
        F.sum("interactions_handled").alias("interactions"),
        mean("avg_handle_seconds").alias("avg_handle_seconds"),
        F.lit(None).cast("decimal(38,9)").alias("sl_pct"),
        mean("adherence_pct").alias("adherence_pct"),
    )
