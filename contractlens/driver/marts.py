"""Mart queries: base, performance, losses, risk, actions, executive."""

from __future__ import annotations

from pyspark.sql import functions as F

from contractlens import config
from contractlens.driver import facts
from contractlens.driver.facts import ratio_sql, with_marts
from contractlens.driver.registry import query
from contractlens.functions.scalar import money
from contractlens.operators.shape import pivot_max
from contractlens.plans import actions as actions_plan
from contractlens.plans import base as base_plan
from contractlens.plans import executive as executive_plan
from contractlens.plans import loss as loss_plan
from contractlens.plans import performance as performance_plan
from contractlens.plans import risk as risk_plan

KEYS = ["contract_key", "reference_month"]


def as_double(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


BASE_OUT = [
    "gross_revenue", "net_revenue", "total_cost", "budget_cost", "extraordinary_cost", "contribution_margin",
    "contribution_margin_pct", "margin_gap_pct", "commercial_discounts", "planned_positions", "filled_positions",
    "uncovered_positions", "coverage_rate", "planned_hours", "regular_hours", "overtime_hours", "overtime_rate",
    "absence_hours", "absenteeism_rate", "emergency_coverage_cost", "sla_compliance_rate", "target_margin_pct",
]
BASE_TEXT = [
    "contract_code", "client_code", "client_name", "business_segment", "service_code", "service_name",
    "manager_code", "manager_name", "complexity_level",
]


@query(
    "monthly_base",
    with_marts(
        "base",
        f"""
SELECT contract_key, reference_month, CAST(date_key AS BIGINT) AS date_key, {", ".join(BASE_TEXT)}, {as_double(*BASE_OUT)},
  CAST(open_positions AS BIGINT) AS open_positions, round(average_replacement_days, 4) AS average_replacement_days,
  CAST(incidents AS BIGINT) AS incident_count, CAST(critical_incidents AS BIGINT) AS critical_incident_count,
  CAST(recurrent_incidents AS BIGINT) AS recurrent_incident_count, CAST(sla_deduction AS DOUBLE) AS sla_deduction_amount,
  CAST(sla_penalty AS DOUBLE) AS sla_penalty_amount, CAST(open_adjustments AS BIGINT) AS open_adjustment_count,
  latest_open_adjustment_expected_date, CAST(approved_retroactive AS DOUBLE) AS approved_retroactive_amount
FROM base""",
    ),
)
def monthly_base(spark, sf):
    return facts.base(spark, sf).select(
        *KEYS, "date_key", *BASE_TEXT, *BASE_OUT, "open_positions",
        F.round(F.col("average_replacement_days").cast("double"), 4).alias("average_replacement_days"),
        "incident_count", "critical_incident_count", "recurrent_incident_count", "sla_deduction_amount",
        "sla_penalty_amount", "open_adjustment_count", "latest_open_adjustment_expected_date",
        "approved_retroactive_amount",
    )


PERFORMANCE_OUT = [
    "contracted_amount", "additional_services", "total_cost", "overtime_cost", "overtime_budget",
    "overtime_excess_cost", "emergency_coverage_cost_accounting", "emergency_coverage_budget",
    "emergency_coverage_excess_cost", "other_extraordinary_cost", "contribution_margin", "target_margin_amount",
    "margin_leakage_amount", "extraordinary_cost_rate", "commercial_discount_rate", "vacancy_rate",
    "execution_overrun_hours", "execution_overrun_rate", "sla_financial_loss", "recurrence_rate",
    "adjustment_delay_estimate", "latest_approved_retroactive_amount",
]


@query(
    "monthly_performance",
    with_marts(
        "performance",
        f"""
SELECT contract_key, reference_month, month_end AS reference_month_end, CAST(days_to_renewal AS BIGINT) AS days_to_renewal,
  {as_double(*PERFORMANCE_OUT)}, average_payment_days, CAST(CAST(CAST(unbilled_scope_estimate AS DECIMAL(30,6)) AS DECIMAL(18,2)) AS DOUBLE) AS unbilled_scope_estimate,
  CAST(adjustment_overdue_days AS BIGINT) AS adjustment_overdue_days, open_adjustment_number,
  latest_approved_adjustment_number, CAST(latest_approved_adjustment_delay_days AS BIGINT) AS latest_approved_adjustment_delay_days
FROM performance""",
    ),
)
def monthly_performance(spark, sf):
    return facts.performance(spark, sf).select(
        *KEYS, "reference_month_end", "days_to_renewal", *PERFORMANCE_OUT,
        F.round(F.col("average_payment_days").cast("double"), 4).alias("average_payment_days"),
        money("unbilled_scope_estimate").alias("unbilled_scope_estimate"),
        "adjustment_overdue_days", "open_adjustment_number", "latest_approved_adjustment_number",
        "latest_approved_adjustment_delay_days",
    )


@query(
    "unbilled_scope",
    with_marts(
        "line",
        f"""
SELECT contract_key, reference_month,
  CASE WHEN SUM(regular_hours) > SUM(planned_hours) AND SUM(additional_services) = 0
       THEN {ratio_sql('CAST(SUM(regular_hours) - SUM(planned_hours) AS DECIMAL(16,2)) * CAST(SUM(contracted_amount) AS DECIMAL(16,2))','SUM(planned_hours)', 2, 4)}
       ELSE 0 END AS unbilled_scope_estimate
FROM entry GROUP BY 1, 2""",
    ),
)
def unbilled_scope(spark, sf):
    line = facts.with_entry(facts.lines(spark, sf), facts.REVENUE_ENTRY, facts.OPERATION_ENTRY)
    measures = ("planned_hours", "regular_hours", "contracted_amount", "additional_services")
    months = base_plan.roll_up(line.select(*KEYS, *measures))
    return months.select(
        *KEYS, money(performance_plan.unbilled_scope()).alias("unbilled_scope_estimate")
    )


def order_months(spark, sf):
    """Contract-months of the orders, without the line facts."""
    return facts.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("contract_key"), F.trunc("o_orderdate", "MM").alias("reference_month")
    ).distinct()


MONTH_CTE = """
months AS (SELECT DISTINCT o_custkey AS contract_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS reference_month FROM orders)"""


@query(
    "asof_first",
    "WITH" + facts.ADJUSTMENT_CTE + "," + MONTH_CTE + """,
ranked AS (
  SELECT m.*, a.adjustment_number, a.expected_date, a.process_type, a.previous_amount,
    ROW_NUMBER() OVER (PARTITION BY m.contract_key, m.reference_month ORDER BY a.expected_date, a.adjustment_key) AS rn
  FROM months m JOIN adjustment a ON a.contract_key = m.contract_key AND a.process_status IN ('PENDING', 'REQUESTED')
   AND a.expected_date <= last_day(m.reference_month))
SELECT m.contract_key, m.reference_month, adjustment_number AS open_adjustment_number, process_type AS open_adjustment_type,
  CAST(previous_amount AS DOUBLE) AS open_adjustment_previous_amount, expected_date AS open_adjustment_expected_date
FROM months m LEFT JOIN ranked r ON r.rn = 1 AND r.contract_key = m.contract_key AND r.reference_month = m.reference_month""",
)
def asof_first(spark, sf):
    return performance_plan.with_open_adjustment(order_months(spark, sf), facts.adjustments(spark, sf)).drop(
        "open_adjustment_requested_pct"
    )


@query(
    "asof_last",
    "WITH" + facts.ADJUSTMENT_CTE + "," + MONTH_CTE + """,
ranked AS (
  SELECT m.*, a.adjustment_number, a.retroactive_amount, date_diff('day', a.expected_date, a.approved_date) AS delay_days,
    ROW_NUMBER() OVER (PARTITION BY m.contract_key, m.reference_month ORDER BY a.approved_date DESC, a.adjustment_key DESC) AS rn
  FROM months m JOIN adjustment a ON a.contract_key = m.contract_key AND a.process_status = 'APPROVED'
   AND a.approved_date <= last_day(m.reference_month))
SELECT m.contract_key, m.reference_month, adjustment_number AS latest_approved_adjustment_number,
  CAST(delay_days AS BIGINT) AS latest_approved_adjustment_delay_days, CAST(retroactive_amount AS DOUBLE) AS latest_approved_retroactive_amount
FROM months m LEFT JOIN ranked r ON r.rn = 1 AND r.contract_key = m.contract_key AND r.reference_month = m.reference_month""",
)
def asof_last(spark, sf):
    return base_plan.with_approved_adjustment(order_months(spark, sf), facts.adjustments(spark, sf))


@query(
    "delay_exposure",
    "WITH" + facts.ADJUSTMENT_CTE + "," + MONTH_CTE + """,
ranked AS (
  SELECT m.*, a.expected_date, a.requested_pct, a.previous_amount,
    ROW_NUMBER() OVER (PARTITION BY m.contract_key, m.reference_month ORDER BY a.expected_date, a.adjustment_key) AS rn
  FROM months m JOIN adjustment a ON a.contract_key = m.contract_key AND a.process_status IN ('PENDING', 'REQUESTED')
   AND a.expected_date <= last_day(m.reference_month))
SELECT m.contract_key, m.reference_month,
  CAST(COALESCE(previous_amount * requested_pct * (date_diff('month', expected_date, last_day(m.reference_month)) + 1), 0) AS DOUBLE) AS adjustment_delay_estimate,
  CAST(COALESCE(date_diff('month', expected_date, last_day(m.reference_month)) + 1, 0) AS BIGINT) AS months_open
FROM months m LEFT JOIN ranked r ON r.rn = 1 AND r.contract_key = m.contract_key AND r.reference_month = m.reference_month""",
)
def delay_exposure(spark, sf):
    months = performance_plan.with_open_adjustment(order_months(spark, sf), facts.adjustments(spark, sf))
    end = F.last_day("reference_month")
    months_open = performance_plan.calendar_months_between("open_adjustment_expected_date", end) + 1
    return months.select(
        *KEYS, performance_plan.delay_exposure(end).alias("adjustment_delay_estimate"),
        F.coalesce(months_open, F.lit(0)).alias("months_open"),
    )


@query(
    "loss_bridge",
    with_marts(
        "loss",
        """
SELECT contract_key, reference_month, contract_code, loss_code, nature AS loss_nature, CAST(is_estimate AS BIGINT) AS is_estimate,
  CAST(recovery_rate AS DOUBLE) AS recovery_rate, CAST(loss_amount AS DOUBLE) AS loss_amount, CAST(recoverable_amount AS DOUBLE) AS recoverable_amount
FROM loss""",
    ),
)
def loss_bridge(spark, sf):
    return loss_plan.loss_bridge(facts.performance(spark, sf)).select(
        *KEYS, "contract_code", "loss_code", "loss_nature", "is_estimate", "recovery_rate", "loss_amount",
        "recoverable_amount",
    )


LOSS_COLUMNS = {
    "OVERTIME_EXCESS": "overtime_loss", "EMERGENCY_COVERAGE_EXCESS": "coverage_loss",
    "SLA_FINANCIAL_LOSS": "sla_loss", "COMMERCIAL_DISCOUNT": "discount_loss",
    "ADJUSTMENT_DELAY_ESTIMATE": "adjustment_loss", "UNBILLED_SCOPE_ESTIMATE": "scope_loss",
}


@query(
    "pivot_losses",
    with_marts(
        "loss",
        f"SELECT contract_key, reference_month, {as_double(*LOSS_COLUMNS.values())} FROM loss_month",
    ),
)
def pivot_losses(spark, sf):
    bridge = loss_plan.loss_bridge(facts.performance(spark, sf))
    wide = pivot_max(bridge, KEYS, "loss_code", "loss_amount", list(config.LOSS_AMOUNT_COLUMNS), fill=0)
    return wide.select(*KEYS, *[F.col(c).alias(n) for c, n in LOSS_COLUMNS.items()])


SCORES = [f"score_{name}" for name in (
    "margin_gap", "extraordinary_cost", "overtime", "coverage", "scope_overrun", "sla_compliance", "critical_incidents",
    "recurrence", "adjustment_delay", "renewal_proximity", "commercial_discount", "absenteeism", "vacancies",
    "replacement_time",
)]
PILLAR_COLUMNS = [f"{p}_risk_score" for p in config.PILLARS]


@query(
    "risk_scores",
    with_marts(
        "risk",
        "SELECT contract_key, reference_month, " + ", ".join(f"CAST({s} AS BIGINT) AS {s}" for s in SCORES) + " FROM risk",
    ),
)
def risk_scores(spark, sf):
    return facts.risk(spark, sf).select(*KEYS, *SCORES)


@query("pillar_scores", with_marts("risk", f"SELECT contract_key, reference_month, {as_double(*PILLAR_COLUMNS)} FROM risk"))
def pillar_scores(spark, sf):
    return facts.risk(spark, sf).select(*KEYS, *PILLAR_COLUMNS)


@query("composite_score", with_marts("risk", f"SELECT contract_key, reference_month, {as_double('contract_risk_score')} FROM risk"))
def composite_score(spark, sf):
    return facts.risk(spark, sf).select(*KEYS, "contract_risk_score")


@query("risk_class", with_marts("risk", "SELECT contract_key, reference_month, risk_class FROM risk"))
def risk_class(spark, sf):
    return facts.risk(spark, sf).select(*KEYS, "risk_class")


@query(
    "margin_trend",
    with_marts(
        "risk",
        "SELECT contract_key, reference_month, margin_trend, CAST(months_in_history AS BIGINT) AS months_in_history, margin_change_3m FROM risk",
    ),
)
def margin_trend(spark, sf):
    return facts.risk(spark, sf).select(*KEYS, "margin_trend", "months_in_history", "margin_change_3m")


DRIVER_SQL = """SELECT contract_key, reference_month, risk_pillar, driver_code, observed_value, reference_value,
  CAST(driver_score AS BIGINT) AS driver_score, CAST(impact AS DOUBLE) AS estimated_impact_amount, CAST(driver_rank AS BIGINT) AS driver_rank"""
DRIVER_OUT = [
    *KEYS, "risk_pillar", "driver_code", "observed_value", "reference_value", "driver_score",
    "estimated_impact_amount", "driver_rank",
]


@query("driver_rank", with_marts("driver", DRIVER_SQL + " FROM driver"))
def driver_rank(spark, sf):
    return risk_plan.risk_drivers(facts.risk(spark, sf)).select(*DRIVER_OUT)


@query(
    "top_k_group",
    with_marts(
        "driver",
        DRIVER_SQL + " FROM driver WHERE driver_rank <= 3 AND reference_month = (SELECT MAX(reference_month) FROM driver)",
    ),
)
def top_k_group(spark, sf):
    """Three main drivers per contract at the latest month."""
    latest = facts.latest(spark, sf, facts.risk)
    return risk_plan.risk_drivers(latest).filter("driver_rank <= 3").select(*DRIVER_OUT)


@query("recommend_action", with_marts("action", "SELECT contract_key, reference_month, code AS recommended_action_code FROM action"))
def recommend_action(spark, sf):
    return facts.recommended(spark, sf).select(*KEYS, "recommended_action_code")


@query(
    "action_values",
    with_marts(
        "action",
        """SELECT contract_key, reference_month, code AS recommended_action_code, CAST(action_impact_amount AS DOUBLE) AS action_impact_amount,
  CAST(recoverability AS DOUBLE) AS action_recoverability_rate, CAST(action_recoverable_amount AS DOUBLE) AS action_recoverable_amount,
  CAST(urgency AS DOUBLE) AS action_urgency_score FROM action""",
    ),
)
def action_values(spark, sf):
    return facts.recommended(spark, sf).select(
        *KEYS, "recommended_action_code", "action_impact_amount", "action_recoverability_rate",
        "action_recoverable_amount", "action_urgency_score",
    )


@query(
    "priority_score",
    with_marts("action", "SELECT contract_key, reference_month, code AS recommended_action_code, CAST(priority AS DOUBLE) AS action_priority_score FROM action"),
)
def priority_score(spark, sf):
    scored = actions_plan.with_priority(facts.stored_recommended(spark, sf))
    return scored.select(*KEYS, "recommended_action_code", "action_priority_score")


QUEUE_SQL = """
queue AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY priority DESC, action_impact_amount DESC, contract_code) AS portfolio_priority_rank
  FROM action WHERE reference_month = (SELECT MAX(reference_month) FROM action)
)"""


@query(
    "current_queue",
    with_marts(
        "action",
        """
SELECT contract_key, reference_month, contract_code, risk_class, code AS recommended_action_code,
  CAST(action_impact_amount AS DOUBLE) AS action_impact_amount, CAST(priority AS DOUBLE) AS action_priority_score,
  CAST(portfolio_priority_rank AS BIGINT) AS portfolio_priority_rank FROM queue""",
        QUEUE_SQL,
    ),
)
def current_queue(spark, sf):
    queue = actions_plan.current_queue(actions_plan.monthly_queue(facts.stored_latest(spark, sf)))
    return queue.select(
        *KEYS, "contract_code", "risk_class", "recommended_action_code", "action_impact_amount",
        "action_priority_score", "portfolio_priority_rank",
    )


EXEC_DOUBLE = [
    "net_revenue", "total_cost", "contribution_margin", "margin_leakage_amount", "identified_loss_amount",
    "direct_loss_amount", "estimated_exposure_amount", "recoverable_amount", "action_impact_amount",
    "action_recoverable_amount",
]
EXEC_SQL = f"""
SELECT reference_month, COUNT(*) AS active_contract_count, {", ".join(f"CAST(SUM({c}) AS DOUBLE) AS {c}" for c in EXEC_DOUBLE)},
  {ratio_sql('SUM(contribution_margin)', 'SUM(net_revenue)')} AS contribution_margin_pct,
  CAST(SUM(CASE WHEN contract_risk_score >= 60 THEN net_revenue ELSE 0 END) AS DOUBLE) AS revenue_at_risk,
  COUNT(*) FILTER (WHERE risk_class = 'CRITICAL') AS critical_contract_count,
  COUNT(*) FILTER (WHERE risk_class = 'HIGH') AS high_risk_contract_count,
  COUNT(*) FILTER (WHERE risk_class = 'ATTENTION') AS attention_contract_count,
  COUNT(*) FILTER (WHERE risk_class = 'LOW') AS low_risk_contract_count,
  COUNT(*) FILTER (WHERE code NOT IN ('MAINTAIN', 'EXPAND')) AS contracts_requiring_action
FROM action GROUP BY 1"""


@query("executive_summary", with_marts("action", EXEC_SQL))
def executive_summary(spark, sf):
    return executive_plan.executive_summary(facts.recommended(spark, sf))


def portfolio(spark, sf):
    inputs = dict.fromkeys([*facts.QUEUE_INPUTS, *executive_plan.PORTFOLIO_RISK_COLUMNS, *risk_plan.DRIVER_INPUTS])
    latest = facts.stored_latest(spark, sf, inputs)
    queue = actions_plan.current_queue(actions_plan.monthly_queue(latest))
    return executive_plan.portfolio_snapshot(latest, risk_plan.risk_drivers(latest), queue)


PORTFOLIO_SQL = """
snapshot AS (
  SELECT q.*, d.driver_code AS main_driver, d.driver_score AS main_score, d.impact AS main_impact
  FROM queue q LEFT JOIN driver d ON d.driver_rank = 1 AND d.contract_key = q.contract_key AND d.reference_month = q.reference_month
)"""
PORTFOLIO_DOUBLE = [
    "net_revenue", "contribution_margin", "contribution_margin_pct", "target_margin_pct", "margin_gap_pct",
    "margin_leakage_amount", "contract_risk_score", *PILLAR_COLUMNS,
]


@query(
    "portfolio_snapshot",
    with_marts(
        "driver",
        f"""
SELECT contract_key, reference_month, contract_code, client_name, business_segment, service_name, manager_name, complexity_level,
  {as_double(*PORTFOLIO_DOUBLE)}, risk_class, margin_trend, renewal_date, CAST(days_to_renewal AS BIGINT) AS days_to_renewal,
  CAST(main_score AS BIGINT) AS main_risk_driver_score, CAST(main_impact AS DOUBLE) AS main_risk_driver_impact,
  code AS recommended_action_code, CAST(action_impact_amount AS DOUBLE) AS action_impact_amount,
  CAST(action_recoverable_amount AS DOUBLE) AS action_recoverable_amount, CAST(priority AS DOUBLE) AS action_priority_score,
  CAST(portfolio_priority_rank AS BIGINT) AS portfolio_priority_rank
FROM snapshot""",
        QUEUE_SQL,
        PORTFOLIO_SQL,
    ),
)
def portfolio_snapshot(spark, sf):
    return portfolio(spark, sf).select(
        *KEYS, "contract_code", "client_name", "business_segment", "service_name", "manager_name",
        "complexity_level", *PORTFOLIO_DOUBLE, "risk_class", "margin_trend", "renewal_date", "days_to_renewal",
        "main_risk_driver_score", "main_risk_driver_impact", "recommended_action_code", "action_impact_amount",
        "action_recoverable_amount", "action_priority_score", "portfolio_priority_rank",
    )


@query(
    "revenue_at_risk_90d",
    with_marts(
        "action",
        """
SELECT CAST(3 * SUM(CASE WHEN contract_risk_score >= 60 THEN net_revenue ELSE 0 END) AS DOUBLE) AS revenue_at_risk_90d,
  CAST(SUM(CASE WHEN contract_risk_score >= 60 THEN action_recoverable_amount ELSE 0 END) AS DOUBLE) AS recoverable_at_risk
FROM action WHERE reference_month = (SELECT MAX(reference_month) FROM action)""",
    ),
)
def revenue_at_risk_90d(spark, sf):
    return executive_plan.revenue_at_risk_90d(facts.latest(spark, sf))


@query(
    "override_closed",
    with_marts(
        "action",
        """
SELECT a.contract_key, a.reference_month, CASE WHEN closed THEN 'MAINTAIN' ELSE code END AS recommended_action_code,
  CASE WHEN closed THEN 0 ELSE CAST(action_impact_amount AS DOUBLE) END AS action_impact_amount,
  CASE WHEN closed THEN 0.1 ELSE CAST(recoverability AS DOUBLE) END AS action_recoverability_rate,
  CASE WHEN closed THEN 10 ELSE CAST(urgency AS DOUBLE) END AS action_urgency_score,
  CASE WHEN closed THEN 10 ELSE CAST(priority AS DOUBLE) END AS action_priority_score
FROM (SELECT a.*, code = 'REVIEW_RETROACTIVE' AND EXISTS (
        SELECT 1 FROM management m WHERE m.contract_key = a.contract_key AND m.action_code = 'REVIEW_RETROACTIVE'
          AND m.action_status = 'COMPLETED' AND m.completion_date <= last_day(a.reference_month)) AS closed
      FROM action a) a""",
        facts.MANAGEMENT_CTE,
    ),
)
def override_closed(spark, sf):
    queue = actions_plan.with_priority(facts.stored_recommended(spark, sf))
    closed = actions_plan.close_completed(queue, facts.management_actions(spark, sf))
    return closed.select(
        *KEYS, "recommended_action_code", "action_impact_amount", "action_recoverability_rate",
        "action_urgency_score", "action_priority_score",
    )
