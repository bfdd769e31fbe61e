"""Planned months and the facts that follow from them.

A plan row (contract and month) holds amounts, factors and rates; revenue,
cost, operation and incident facts are derived from plan rows and templates.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens import config
from contractlens.functions.scalar import money
from contractlens.operators.shape import expand_by_count, grid_by_month

# Yearly price and cost factors, from the first plan year on.
PRICE_FACTORS = ("0.9600", "1.0000", "1.0450")
COST_FACTORS = ("0.9650", "1.0000", "1.0450")
SEASONAL_MATERIALS = {1: "1.0400", 12: "1.0400"}

# A routine plan month.
ROUTINE_MONTH = {
    "additional_services": ("0", "decimal(18,2)"),
    "reimbursements": ("0", "decimal(18,2)"),
    "commercial_discount_rate": ("0", "decimal(9,4)"),
    "labor_factor": ("1", "decimal(9,4)"),
    "overtime_factor": ("1", "decimal(9,4)"),
    "coverage_factor": ("1", "decimal(9,4)"),
    "other_cost_factor": ("1", "decimal(9,4)"),
    "position_factor": ("1", "decimal(9,4)"),
    "coverage_rate": ("0.99", "decimal(9,4)"),
    "overtime_rate": ("0.015", "decimal(9,4)"),
    "absenteeism_rate": ("0.01", "decimal(9,4)"),
    "vacancy_rate": ("0", "decimal(9,4)"),
    "replacement_days": ("10", "decimal(10,2)"),
    "execution_overrun_rate": ("0", "decimal(9,4)"),
    "critical_incident_count": ("0", "int"),
    "recurrent_incident_count": ("0", "int"),
    "sla_miss_count": ("0", "int"),
    "sla_financial_loss": ("0", "decimal(18,2)"),
    "one_time_extra_cost": ("0", "decimal(18,2)"),
    "event_code": ("ROUTINE", "string"),
    "event_note": ("Operação dentro do comportamento esperado.", "string"),
}
INCIDENT_MONTHS = (3, 9)
# How facts follow from a plan month.
DEDUCTED_SHARE = "0.4000"  # of the SLA loss; the rest is a penalty
PAYMENT_SPREAD, PAYMENT_LEAST = 18, 24  # days until payment
MONTH_HOURS = 160
HIRED_SHARE, LEFT_SHARE = "0.5", "0.45"  # of vacant positions
DAY_STEP, DAY_FIRST = 6, 2  # incident days in the month
MISSED_STEP, MISSED_HOURS = 4, 18  # hours to close where the agreement is missed
EMERGENCY_COST = "750.00"


def by_year(month: Column, first_year: Column, factors) -> Column:
    """Factor of the plan year; the last one holds from then on."""
    last = F.lit(Decimal(factors[-1]))
    chain = F
    for i, factor in enumerate(factors[:-1]):
        chain = chain.when(F.year(month) - first_year == i, F.lit(Decimal(factor)))
    return chain.otherwise(last).cast("decimal(9,4)")


def month_grid(contracts: DataFrame, first: Column, months: int) -> DataFrame:
    """Contract x month grid with routine values, yearly price and seasonality."""
    grid = grid_by_month(contracts, first, F.add_months(first, months - 1))
    month = F.col("reference_month")
    seasonal = F
    for number, factor in SEASONAL_MATERIALS.items():
        seasonal = seasonal.when(F.month(month) == number, F.lit(Decimal(factor)))
    routine = {name: F.lit(value).cast(kind) for name, (value, kind) in ROUTINE_MONTH.items()}
    return grid.withColumns(
        routine
        | {
            "contracted_amount": money(F.col("base_monthly_amount") * by_year(month, F.year(first), PRICE_FACTORS)),
            "material_factor": seasonal.otherwise(F.lit(Decimal("1.0000"))).cast("decimal(9,4)"),
            "incident_count": F.when(F.month(month).isin(*INCIDENT_MONTHS), 1).otherwise(0),
        }
    )


def revenue_amounts(plan: DataFrame) -> DataFrame:
    """Revenue of a plan month, each step from the one before.

    The penalty is what the deduction leaves, so both add up to the loss.
    """
    month_end = F.last_day("reference_month")
    return (
        plan.withColumn("gross_revenue", money(F.col("contracted_amount") + F.col("additional_services") + F.col("reimbursements")))
        .withColumns(
            {
                "commercial_discounts": money(F.col("gross_revenue") * F.col("commercial_discount_rate")),
                "deductions": money(F.col("sla_financial_loss") * F.lit(Decimal(DEDUCTED_SHARE))),
            }
        )
        .withColumns(
            {
                "penalties": money(F.col("sla_financial_loss") - F.col("deductions")),
                "net_revenue": money(F.col("gross_revenue") - F.col("commercial_discounts") - F.col("sla_financial_loss")),
                "invoice_date": month_end,
                "payment_days": (F.col("contract_number") % PAYMENT_SPREAD + PAYMENT_LEAST).cast("int"),
            }
        )
        .withColumn("payment_date", F.date_add(month_end, F.col("payment_days")))
    )


def category_factor() -> Column:
    sub = F.col("cost_subcategory")
    return (
        F.when(sub == config.OVERTIME_SUBCATEGORY, F.col("overtime_factor"))
        .when(sub == config.COVERAGE_SUBCATEGORY, F.col("coverage_factor"))
        .when(sub.isin(*config.LABOR_SUBCATEGORIES), F.col("labor_factor"))
        .when(F.col("cost_category") == config.MATERIALS_CATEGORY, F.col("material_factor"))
        .otherwise(F.col("other_cost_factor"))
    )


def cost_from_template(plan: DataFrame, template: DataFrame, first_year: Column) -> DataFrame:
    """Plan month x template line -> budgeted and actual cost.

    Labor follows the number of positions; the actual amount follows the base
    and category factors.
    """
    positions = F.when(F.col("is_labor_cost"), F.col("position_factor")).otherwise(F.lit(1).cast("decimal(9,4)"))
    year = by_year(F.col("reference_month"), first_year, COST_FACTORS)
    return (
        plan.join(template, "contract_code")
        .withColumn("budget_amount", money(F.col("baseline_budget_amount") * year * positions))
        .withColumn("actual_amount", money(F.col("budget_amount") * F.col("base_cost_factor") * category_factor()))
    )


def one_off_costs(plan: DataFrame) -> DataFrame:
    """Planned one-off amounts as extraordinary cost lines without budget."""
    return plan.filter("one_time_extra_cost > 0").withColumns(
        {
            "actual_amount": F.col("one_time_extra_cost"),
            "budget_amount": money(F.lit(0)),
            "cost_subcategory": F.lit(config.ONE_OFF_SUBCATEGORY),
            "is_extraordinary": F.lit(True),
        }
    )


def operation_from_template(plan: DataFrame, template: DataFrame, first_year: Column) -> DataFrame:
    """Plan month x role template -> positions, hours and people movements."""
    days = lambda c: F.ceil(c).cast("int")
    positions, hours = F.col("planned_positions"), F.col("planned_hours")
    vacant = positions * F.col("vacancy_rate")
    return (
        plan.join(template, "contract_code")
        .withColumns(
            {
                "planned_positions": (F.col("baseline_planned_positions") * F.col("position_factor")).cast("decimal(10,2)"),
                "planned_hours": money(F.col("baseline_planned_hours") * F.col("position_factor")),
            }
        )
        .withColumns(
            {
                "filled_positions": (positions * F.col("coverage_rate")).cast("decimal(10,2)"),
                "regular_hours": money(hours * (1 + F.col("execution_overrun_rate"))),
            }
        )
        .withColumns(
            {
                "uncovered_positions": positions - F.col("filled_positions"),
                "average_headcount": F.col("filled_positions"),
                "overtime_hours": money(F.col("regular_hours") * F.col("overtime_rate")),
                "absence_hours": money(hours * F.col("absenteeism_rate")),
                "leave_days": days(hours * F.col("absenteeism_rate") / MONTH_HOURS),
                "hires": days(vacant * F.lit(Decimal(HIRED_SHARE))),
                "terminations": days(vacant * F.lit(Decimal(LEFT_SHARE))),
                "open_positions": days(vacant),
                "average_replacement_days": F.col("replacement_days"),
                "emergency_coverage_cost": money(
                    F.col("baseline_emergency_coverage_cost")
                    * by_year(F.col("reference_month"), first_year, COST_FACTORS)
                    * F.col("coverage_factor")
                ),
            }
        )
    )


def expand_incidents(plan: DataFrame) -> DataFrame:
    """One incident per 1..count with deterministic times; the first k missed."""
    n = F.col("incident_sequence")
    missed = n <= F.col("sla_miss_count")
    opened = F.timestamp_add("MINUTE", n * 30, F.timestamp_add("DAY", n * DAY_STEP + DAY_FIRST, F.col("reference_month").cast("timestamp_ntz")))
    hours = F.when(missed, n * MISSED_STEP + MISSED_HOURS).otherwise(n + 4)
    return expand_by_count(plan, "incident_count", "incident_sequence").withColumns(
        {
            "opened_at": opened,
            "resolution_hours": hours,
            "closed_at": F.timestamp_add("HOUR", hours, opened),
            "agreed_deadline_hours": F.lit(8),
            "resolved_within_sla": ~missed,
        }
    )


def incident_amounts(incidents: DataFrame) -> DataFrame:
    """Severity, recurrence and money of expanded incidents."""
    n, count, loss = F.col("incident_sequence"), F.col("incident_count"), F.col("sla_financial_loss")
    critical = n <= F.col("critical_incident_count")
    return incidents.withColumns(
        {
            "severity": F.when(critical, "CRITICAL").when(count >= 2, "HIGH").when(count == 1, "MEDIUM").otherwise("LOW"),
            "is_recurrence": n <= F.col("recurrent_incident_count"),
            "deduction_amount": money(loss * F.lit(Decimal("0.4")) / count),
            "penalty_amount": money(loss * F.lit(Decimal("0.6")) / count),
            "emergency_cost": F.when(critical, F.lit(Decimal(EMERGENCY_COST))).otherwise(F.lit(Decimal("0.00"))),
        }
    )


def earliest_month(facts: DataFrame) -> DataFrame:
    """Facts of the first month present: the baseline of the templates."""
    return facts.filter(F.col("reference_month") == facts.agg(F.min("reference_month")).scalar())


def cost_template(costs: DataFrame) -> DataFrame:
    """Baseline budget per contract and category from the earliest month."""
    baseline = F.coalesce(F.col("budget_amount"), F.abs("actual_amount"))
    return earliest_month(costs).withColumn("baseline_budget_amount", baseline).drop(
        "reference_month", "date_key", "actual_amount", "budget_amount"
    )


def operation_template(operations: DataFrame) -> DataFrame:
    return earliest_month(operations).select(
        "contract_code", "unit_code", "role_code",
        F.col("planned_positions").alias("baseline_planned_positions"),
        F.col("planned_hours").alias("baseline_planned_hours"),
        F.col("emergency_coverage_cost").alias("baseline_emergency_coverage_cost"),
    )


def contract_profile(profile: DataFrame, incident_types: DataFrame) -> DataFrame:
    """Resolve the primary and secondary incident type of each contract.

    Types are named by category, subcategory and cause; a contract whose names
    are not registered is left out.
    """
    names = ("incident_category", "incident_subcategory", "root_cause")
    out = profile
    for role in ("primary", "secondary"):
        side = incident_types.select(
            *[F.col(n).alias(f"{role}_{n}") for n in names], F.col("incident_type_key").alias(f"{role}_incident_type_key")
        )
        out = out.join(side, [f"{role}_{n}" for n in names])
    return out.drop(*[f"{role}_{n}" for role in ("primary", "secondary") for n in names])
