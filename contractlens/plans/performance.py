"""Contract-month performance: exposures, rates and as-of adjustment state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractlens import config
from contractlens.functions.scalar import (
    calendar_months_between, exposure, money, positive_part, rate, whole_ratio,
)
from contractlens.operators.temporal import asof_first


def with_open_adjustment(months: DataFrame, adjustments: DataFrame) -> DataFrame:
    """Earliest open process due by month end."""
    open_ = adjustments.filter(F.col("process_status").isin(*config.OPEN_PROCESS_STATUSES))
    return asof_first(
        months, open_, ["contract_key"], F.last_day("reference_month"), "expected_date", "adjustment_key",
        {
            "adjustment_number": "open_adjustment_number",
            "process_type": "open_adjustment_type",
            "requested_pct": "open_adjustment_requested_pct",
            "previous_amount": "open_adjustment_previous_amount",
            "expected_date": "open_adjustment_expected_date",
        },
    )


def unbilled_scope(planned_hours="planned_hours", regular_hours="regular_hours"):
    """Hours above plan at the contracted hourly price, only if nothing extra was billed.

    Multiplied before dividing, so the hourly price is never rounded.
    """
    planned, regular = F.col(planned_hours), F.col(regular_hours)
    value = (regular - planned) * F.col("contracted_amount") / F.nullif(planned, F.lit(0))
    billed_nothing = F.coalesce(F.col("additional_services"), F.lit(0)) == 0
    return F.when((regular > planned) & billed_nothing, value).otherwise(F.lit(0)).cast("decimal(28,6)")


def delay_exposure(month_end):
    """Cumulative exposure of the open process: one more share per month begun."""
    expected = F.col("open_adjustment_expected_date")
    months_open = calendar_months_between(expected, month_end) + 1
    amount = (
        F.col("open_adjustment_previous_amount")
        * F.coalesce(F.col("open_adjustment_requested_pct"), F.lit(0))
        * months_open
    )
    return exposure(F.when(expected.isNotNull(), amount).otherwise(F.lit(0)))


def monthly_performance(base: DataFrame, adjustments: DataFrame, exact_ratio: bool = False) -> DataFrame:
    """Performance mart: base rows plus exposures and as-of adjustments."""
    months = with_open_adjustment(base, adjustments)
    month_end = F.last_day("reference_month")
    overrun = money(F.greatest(F.col("regular_hours") - F.col("planned_hours"), F.lit(0)))
    target = exposure(F.col("net_revenue") * F.col("target_margin_pct"))
    expected = F.col("open_adjustment_expected_date")
    return months.withColumns(
        {
            "reference_month_end": month_end,
            "days_to_renewal": F.datediff("renewal_date", month_end),
            "overtime_excess_cost": money(positive_part(F.col("overtime_cost") - F.col("overtime_budget"))),
            "emergency_coverage_excess_cost": money(
                positive_part(F.col("emergency_coverage_cost_accounting") - F.col("emergency_coverage_budget"))
            ),
            "target_margin_amount": target,
            "margin_leakage_amount": exposure(positive_part(target - F.col("contribution_margin"))),
            "extraordinary_cost_rate": rate("extraordinary_cost", "net_revenue"),
            "commercial_discount_rate": rate("commercial_discounts", "gross_revenue"),
            "vacancy_rate": rate(F.col("open_positions").cast("decimal(18,0)"), "planned_positions"),
            "execution_overrun_hours": overrun,
            # no hours planned and none worked is no overrun, hours without a plan have no rate
            "execution_overrun_rate": F.when(overrun > 0, rate(overrun, "planned_hours")).otherwise(
                F.lit(0).cast("decimal(18,4)")
            ),
            "unbilled_scope_estimate": unbilled_scope(),
            "recurrence_rate": whole_ratio("recurrent_incident_count", "incident_count", exact_ratio),
            "sla_financial_loss": money(F.col("sla_deduction_amount") + F.col("sla_penalty_amount")),
            "adjustment_overdue_days": F.coalesce(F.datediff(month_end, expected), F.lit(0)),
            "adjustment_delay_estimate": delay_exposure(month_end),
        }
    )
