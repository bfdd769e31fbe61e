"""Month totals, the latest-month portfolio and revenue at risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractlens import config
from contractlens.functions.scalar import rate
from contractlens.operators.temporal import latest_period


def executive_summary(actions: DataFrame) -> DataFrame:
    """One row per month.

    Losses and actions sit on the contract-month row, so the summary is one
    aggregation and needs no pre-aggregates to join.
    """
    total = lambda c: F.sum(c).alias(c)
    contracts_in = lambda cls: F.count_if(F.col("risk_class") == cls)
    at_risk = F.when(F.col("contract_risk_score") >= config.AT_RISK_SCORE, F.col("net_revenue")).otherwise(F.lit(0))
    needs_action = ~F.col("recommended_action_code").isin(*config.NO_INTERVENTION)
    return (
        actions.groupBy("reference_month")
        .agg(
            F.count("*").alias("active_contract_count"),
            total("net_revenue"),
            total("total_cost"),
            total("contribution_margin"),
            total("margin_leakage_amount"),
            total("identified_loss_amount"),
            total("direct_loss_amount"),
            total("estimated_exposure_amount"),
            total("recoverable_amount"),
            F.sum(at_risk).alias("revenue_at_risk"),
            contracts_in("CRITICAL").alias("critical_contract_count"),
            contracts_in("HIGH").alias("high_risk_contract_count"),
            contracts_in("ATTENTION").alias("attention_contract_count"),
            contracts_in("LOW").alias("low_risk_contract_count"),
            F.count_if(needs_action).alias("contracts_requiring_action"),
            total("action_impact_amount"),
            total("action_recoverable_amount"),
        )
        .withColumn("contribution_margin_pct", rate("contribution_margin", "net_revenue"))
    )


PORTFOLIO_RISK_COLUMNS = [
    "reference_month", "contract_key", "contract_code", "client_code", "client_name", "business_segment",
    "service_code", "service_name", "manager_code", "manager_name", "complexity_level", "net_revenue",
    "contribution_margin", "contribution_margin_pct", "target_margin_pct", "margin_gap_pct",
    "margin_leakage_amount", "contract_risk_score", "risk_class", "financial_risk_score",
    "operational_risk_score", "quality_risk_score", "contractual_risk_score", "people_risk_score",
    "margin_trend", "renewal_date", "days_to_renewal",
]
PORTFOLIO_QUEUE_COLUMNS = [
    "recommended_action_code", "recommended_action_name_pt", "action_impact_amount", "action_recoverable_amount",
    "action_priority_score", "portfolio_priority_rank",
]


def portfolio_snapshot(risk: DataFrame, drivers: DataFrame, queue: DataFrame) -> DataFrame:
    """Latest month of every contract with its main driver and queue place."""
    keys = ["reference_month", "contract_key"]
    main = drivers.filter("driver_rank = 1").select(
        *keys,
        F.col("driver_name_pt").alias("main_risk_driver_pt"),
        F.col("driver_score").alias("main_risk_driver_score"),
        F.col("estimated_impact_amount").alias("main_risk_driver_impact"),
    )
    return (
        latest_period(risk.select(*PORTFOLIO_RISK_COLUMNS), "reference_month")
        .join(main, keys, "left")
        .join(queue.select(*keys, *PORTFOLIO_QUEUE_COLUMNS), keys, "left")
    )


def revenue_at_risk_90d(portfolio: DataFrame) -> DataFrame:
    """Three months of at-risk revenue and what is recoverable of it, latest month."""
    at_risk = F.col("contract_risk_score") >= config.AT_RISK_SCORE
    picked = lambda c: F.sum(F.when(at_risk, F.col(c)).otherwise(F.lit(0)))
    return portfolio.agg(
        (picked("net_revenue") * 3).alias("revenue_at_risk_90d"),
        picked("action_recoverable_amount").alias("recoverable_at_risk"),
    )
