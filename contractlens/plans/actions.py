"""Recommended action, its value and its place in the queue."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens import config
from contractlens.functions.scalar import money
from contractlens.operators.shape import dense_number
from contractlens.operators.temporal import latest_period


def action_rules(params: dict) -> list[tuple[str, Column]]:
    """Rules in precedence order; the first that holds decides.

    A NULL comparison does not hold, so such a row falls to the next rule.
    """
    c = F.col
    return [
        (
            "ASSESS_NON_RENEWAL",
            (c("contribution_margin_pct") < 0)
            & (c("contract_risk_score") >= config.NON_RENEWAL_SCORE)
            & (c("days_to_renewal").isNull() | (c("days_to_renewal") <= params["non_renewal_review_days"])),
        ),
        ("REQUEST_ADJUSTMENT", c("adjustment_overdue_days") >= params["adjustment_warn_days"]),
        (
            "REVIEW_RETROACTIVE",
            (c("latest_approved_adjustment_delay_days") >= params["adjustment_high_days"])
            & (c("latest_approved_retroactive_amount") > 0),
        ),
        ("REINFORCE_COVERAGE", (c("coverage_rate") < params["coverage_critical"]) & (c("open_positions") > 0)),
        (
            "FORMALIZE_SCOPE",
            (c("execution_overrun_rate") >= params["scope_overrun_warn"]) & (c("unbilled_scope_estimate") > 0),
        ),
        (
            "SLA_RECOVERY_PLAN",
            (c("quality_risk_score") >= config.QUALITY_PLAN_SCORE) & (c("incident_count") > 0),
        ),
        ("REVIEW_SCHEDULE", c("overtime_rate") >= params["overtime_high"]),
        ("RENEGOTIATE_PRICE", c("margin_gap_pct") <= -params["margin_gap_high"]),
        ("EXPAND", (c("contract_risk_score") < params["risk_attention_min"]) & (c("margin_gap_pct") >= 0)),
    ]


def first_rule(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    chain = F
    for code, holds in rules:
        chain = chain.when(holds, code)
    return chain.otherwise(otherwise)


def by_action(values: dict, otherwise) -> Column:
    """Pick a value by the recommended action."""
    chain = F
    for code, value in values.items():
        chain = chain.when(F.col("recommended_action_code") == code, value)
    return chain.otherwise(otherwise)


def action_impact() -> Column:
    c = F.col
    yearly = F.when(c("contribution_margin") < 0, F.abs("contribution_margin")).otherwise(c("margin_leakage_amount"))
    exact = "decimal(28,6)"
    return by_action(
        {
            "ASSESS_NON_RENEWAL": (yearly * 12).cast(exact),
            "REQUEST_ADJUSTMENT": c("loss_ADJUSTMENT_DELAY_ESTIMATE").cast(exact),
            "REVIEW_RETROACTIVE": c("latest_approved_retroactive_amount").cast(exact),
            "REINFORCE_COVERAGE": (c("loss_EMERGENCY_COVERAGE_EXCESS") + c("loss_OVERTIME_EXCESS")).cast(exact),
            "SLA_RECOVERY_PLAN": c("loss_SLA_FINANCIAL_LOSS").cast(exact),
            "FORMALIZE_SCOPE": c("loss_UNBILLED_SCOPE_ESTIMATE").cast(exact),
            "REVIEW_SCHEDULE": c("loss_OVERTIME_EXCESS").cast(exact),
            "RENEGOTIATE_PRICE": c("margin_leakage_amount").cast(exact),
        },
        F.lit(Decimal(0)).cast(exact),
    )


def action_urgency() -> Column:
    overdue = F.col("adjustment_overdue_days")
    points = "decimal(9,2)"
    # Urgency points per action.
    return by_action(
        {
            "ASSESS_NON_RENEWAL": F.lit(95).cast(points),
            "REQUEST_ADJUSTMENT": F.when(overdue >= 180, 100).when(overdue >= 90, 80).otherwise(60).cast(points),
            "REVIEW_RETROACTIVE": F.lit(75).cast(points),
            "REINFORCE_COVERAGE": F.col("operational_risk_score"),
            "FORMALIZE_SCOPE": F.lit(70).cast(points),
            "SLA_RECOVERY_PLAN": F.col("quality_risk_score"),
            "REVIEW_SCHEDULE": F.col("operational_risk_score"),
            "RENEGOTIATE_PRICE": F.col("financial_risk_score"),
            "EXPAND": F.lit(30).cast(points),
        },
        F.lit(10).cast(points),
    )


def recommend(risk: DataFrame, params: dict | None = None) -> DataFrame:
    """Recommended action with impact, recoverability and urgency (row level)."""
    params = params or config.parameter_values()
    rates = {code: F.lit(Decimal(r)).cast("decimal(9,4)") for code, r in config.ACTION_RECOVERABILITY.items()}
    return (
        risk.withColumn("recommended_action_code", first_rule(action_rules(params), "MAINTAIN"))
        .withColumns(
            {
                "exact_impact": action_impact(),
                "action_recoverability_rate": by_action(rates, rates["MAINTAIN"]),
                "action_urgency_score": action_urgency(),
            }
        )
        .withColumns(
            {
                "action_impact_amount": money("exact_impact"),
                "action_recoverable_amount": money(F.col("exact_impact") * F.col("action_recoverability_rate")),
            }
        )
    )


def with_priority(actions: DataFrame) -> DataFrame:
    """Priority score, with impact normalized by the month's largest impact.

    The maxima are one row per month (partial aggregation), so they can be
    broadcast; a window over the month would pull a whole month into one task.
    """
    largest = actions.groupBy("reference_month").agg(F.max("exact_impact").alias("max_impact"))
    w = {k: F.lit(Decimal(v)) for k, v in config.PRIORITY_WEIGHTS.items()}
    share = (F.col("exact_impact") * 100 / F.nullif(F.col("max_impact"), F.lit(0))).cast("decimal(18,8)")
    score = (
        F.coalesce(share, F.lit(0)) * w["impact"]
        + F.col("contract_risk_score") * w["risk"]
        + F.col("action_urgency_score") * w["urgency"]
        + F.col("action_recoverability_rate") * 100 * w["recoverability"]
    )
    return (
        actions.join(F.broadcast(largest), "reference_month")  # one row per calendar month
        .withColumn("action_priority_score", score.cast("decimal(9,2)"))
        .drop("max_impact")
    )


def with_action_labels(queue: DataFrame, actions=config.ACTIONS) -> DataFrame:
    names = {code: F.lit(name) for code, name, *_ in actions}
    owners = {code: F.lit(owner) for code, _, _, owner in actions}
    reasons = {code: F.lit(text) for code, text in config.ACTION_REASONS.items()}
    return queue.withColumns(
        {
            "recommended_action_name_pt": by_action(names, F.lit(None)),
            "owner_area": by_action(owners, F.lit(None)),
            "action_reason_pt": by_action(reasons, F.lit(None)),
        }
    ).filter(F.col("recommended_action_name_pt").isNotNull())


QUEUE_COLUMNS = [
    "reference_month", "date_key", "contract_key", "contract_code", "client_code", "client_name", "service_name",
    "manager_name", "net_revenue", "contribution_margin", "contribution_margin_pct", "target_margin_pct",
    "margin_gap_pct", "margin_leakage_amount", "contract_risk_score", "risk_class", "days_to_renewal",
    "identified_loss_amount", "recoverable_amount", "recommended_action_code", "recommended_action_name_pt",
    "owner_area", "action_impact_amount", "action_recoverability_rate", "action_recoverable_amount",
    "action_urgency_score", "action_priority_score", "action_reason_pt",
]
# Added by monthly_queue; the rest comes with the recommended rows.
QUEUE_ADDED = ("recommended_action_name_pt", "owner_area", "action_priority_score", "action_reason_pt")


def monthly_queue(actions: DataFrame) -> DataFrame:
    """Action queue per month from recommended rows (see :func:`recommend`)."""
    return with_action_labels(with_priority(actions)).select(*QUEUE_COLUMNS)


def close_completed(queue: DataFrame, management_actions: DataFrame, code: str = "REVIEW_RETROACTIVE") -> DataFrame:
    """Turn a recommendation into MAINTAIN once the same action was completed.

    Only the first completion per contract matters, so the actions are cut to
    one row per contract before the join.
    """
    done = (
        management_actions.filter((F.col("action_code") == code) & (F.col("action_status") == "COMPLETED"))
        .groupBy("contract_key")
        .agg(F.min("completion_date").alias("_done"))
    )
    maintain = {c: (name, owner) for c, name, _, owner in config.ACTIONS}["MAINTAIN"]
    closed = (F.col("recommended_action_code") == code) & (F.col("_done") <= F.last_day("reference_month"))
    rewritten = {
        "recommended_action_name_pt": F.lit(maintain[0]),
        "owner_area": F.lit(maintain[1]),
        "action_impact_amount": money(F.lit(0)),
        "action_recoverability_rate": F.lit(Decimal(config.ACTION_RECOVERABILITY["MAINTAIN"])).cast("decimal(9,4)"),
        "action_recoverable_amount": money(F.lit(0)),
        "action_urgency_score": F.lit(10).cast("decimal(9,2)"),
        "action_priority_score": F.lit(10).cast("decimal(9,2)"),
        "action_reason_pt": F.lit(config.CLOSED_RETROACTIVE_REASON),
        "recommended_action_code": F.lit("MAINTAIN"),
    }
    present = {c: v for c, v in rewritten.items() if c in queue.columns}
    return (
        queue.join(done, "contract_key", "left")
        .withColumn("_closed", F.coalesce(closed, F.lit(False)))
        .withColumns({c: F.when(F.col("_closed"), v).otherwise(F.col(c)) for c, v in present.items()})
        .select(*queue.columns)
    )


def current_queue(queue: DataFrame) -> DataFrame:
    """Latest month of the queue with the portfolio-wide priority rank."""
    order = [F.desc("action_priority_score"), F.desc("action_impact_amount"), F.asc("contract_code")]
    return dense_number(latest_period(queue, "reference_month"), "portfolio_priority_rank", order)
