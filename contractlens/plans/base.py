"""Contract-month base: every fact folded into one row per contract and month.

The facts are projected to one ledger and aggregated together: one shuffle
with map-side combine instead of one aggregation and one join per fact.  A
month exists only where revenue exists.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens import config
from contractlens.functions.scalar import date_key, money, month_of, quotient, rate, whole_ratio
from contractlens.operators.temporal import asof_last_by_month

KEYS = ["contract_key", "reference_month"]

REVENUE_MEASURES = [
    "contracted_amount", "additional_services", "reimbursements", "commercial_discounts", "deductions",
    "penalties", "gross_revenue", "net_revenue", "invoiced_amount", "received_amount",
]
OPERATION_MEASURES = [
    "planned_positions", "filled_positions", "uncovered_positions", "planned_hours", "regular_hours",
    "overtime_hours", "absence_hours", "open_positions", "emergency_coverage_cost",
]
COST_MEASURES = [
    "total_cost", "budget_cost", "extraordinary_cost", "overtime_cost", "overtime_budget",
    "emergency_coverage_cost_accounting", "emergency_coverage_budget", "other_extraordinary_cost",
]
INCIDENT_MEASURES = [
    "incident_count", "critical_incident_count", "incidents_within_sla", "recurrent_incident_count",
    "sla_deduction_amount", "sla_penalty_amount", "sla_emergency_cost",
]
AVERAGES = {"payment_days": "average_payment_days", "average_replacement_days": "average_replacement_days"}
COUNTS = {
    "revenue_rows", "open_positions", "incident_count", "critical_incident_count", "incidents_within_sla",
    "recurrent_incident_count",
}


def hundredths(c) -> Column:
    """Two-decimal amount as a whole number of hundredths, exact for every amount of the type.

    Whole numbers add up exactly and much faster than wide decimals.
    """
    return ((F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)") * 100).cast("long")


def amount_if(condition, amount):
    return F.when(condition, F.coalesce(amount, F.lit(0))).otherwise(F.lit(0))


def revenue_columns():
    return [F.lit(1).alias("revenue_rows"), *map(F.col, REVENUE_MEASURES), F.col("payment_days")]


def cost_columns():
    """Cost measures of one entry line, split by the subcategories that matter."""
    actual, budget = F.col("actual_amount"), F.col("budget_amount")
    overtime = F.col("cost_subcategory") == config.OVERTIME_SUBCATEGORY
    coverage = F.col("cost_subcategory") == config.COVERAGE_SUBCATEGORY
    extraordinary = F.col("is_extraordinary")
    return [
        actual.alias("total_cost"),
        budget.alias("budget_cost"),
        amount_if(extraordinary, actual).alias("extraordinary_cost"),
        amount_if(overtime, actual).alias("overtime_cost"),
        amount_if(overtime, budget).alias("overtime_budget"),
        amount_if(coverage, actual).alias("emergency_coverage_cost_accounting"),
        amount_if(coverage, budget).alias("emergency_coverage_budget"),
        amount_if(extraordinary & ~overtime & ~coverage, actual).alias("other_extraordinary_cost"),
    ]


def operation_columns():
    return [*map(F.col, OPERATION_MEASURES), F.col("average_replacement_days")]


def incident_columns():
    one = lambda condition: F.when(condition, 1).otherwise(0)
    return [
        F.lit(1).alias("incident_count"),
        one(F.col("severity") == "CRITICAL").alias("critical_incident_count"),
        one(F.col("resolved_within_sla")).alias("incidents_within_sla"),
        one(F.col("is_recurrence")).alias("recurrent_incident_count"),
        F.col("deduction_amount").alias("sla_deduction_amount"),
        F.col("penalty_amount").alias("sla_penalty_amount"),
        F.col("emergency_cost").alias("sla_emergency_cost"),
    ]


def as_entries(df: DataFrame) -> DataFrame:
    """Entry measures as whole numbers: counts as they are, amounts in hundredths."""
    measures = [c for c in df.columns if c not in KEYS]
    return df.select(
        *KEYS, *[(F.col(c).cast("long") if c in COUNTS else hundredths(c)).alias(c) for c in measures]
    )


def incident_entries(incidents: DataFrame) -> DataFrame:
    """Incidents count in the month they were opened."""
    month = month_of("opened_at").alias("reference_month")
    return as_entries(incidents.select("contract_key", month, *incident_columns()))


def ledger(revenue: DataFrame, cost: DataFrame, operation: DataFrame, incidents: DataFrame) -> DataFrame:
    """All facts as entries of one wide, sparse ledger."""
    entries = [
        as_entries(revenue.select(*KEYS, *revenue_columns())),
        as_entries(cost.select(*KEYS, *cost_columns())),
        as_entries(operation.select(*KEYS, *operation_columns())),
        incident_entries(incidents),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), entries)


def sum_up(entries: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Ledger -> one row per contract and month (all facts, one aggregation); amounts still in hundredths."""
    present = set(entries.columns)
    sums = ["revenue_rows", *REVENUE_MEASURES, *COST_MEASURES, *OPERATION_MEASURES, *INCIDENT_MEASURES]
    averages = [src for src in AVERAGES if src in present]
    return entries.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums if c in present],
        *[agg(src).alias(f"{name}_{src}") for src in averages for name, agg in (("sum", F.sum), ("n", F.count))],
    )


def amount(c: str) -> Column:
    """Whole hundredths as an amount; a product, as decimals multiply much faster than they divide."""
    return (F.col(c).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def amounts(summed: DataFrame) -> DataFrame:
    """Amounts of `sum_up` as decimals, and the averages."""
    averages = {src: dst for src, dst in AVERAGES.items() if f"sum_{src}" in summed.columns}
    parts = {f"{name}_{src}" for src in averages for name in ("sum", "n")}
    sums = [c for c in summed.columns if c not in KEYS and c not in parts]
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    return summed.select(
        *KEYS,
        *[(F.col(c) if c in COUNTS else amount(c)).alias(c) for c in sums],
        *[
            (whole(f"sum_{src}") / (F.nullif(F.col(f"n_{src}"), F.lit(0)) * 100)).cast("decimal(14,6)").alias(dst)
            for src, dst in averages.items()
        ],
    )


def roll_up(entries: DataFrame) -> DataFrame:
    """Ledger -> one row per contract and month, amounts as decimals."""
    return amounts(sum_up(entries))


def adjustment_summary(adjustments: DataFrame) -> DataFrame:
    """Adjustment position per contract over all time (not bounded by month)."""
    is_open = F.col("process_status").isin(*config.OPEN_PROCESS_STATUSES)
    return adjustments.groupBy("contract_key").agg(
        F.count_if(is_open).alias("open_adjustment_count"),
        F.max(F.when(is_open, F.col("expected_date"))).alias("latest_open_adjustment_expected_date"),
        money(F.sum(amount_if(F.col("process_status") == "APPROVED", F.col("retroactive_amount")))).alias(
            "approved_retroactive_amount"
        ),
    )


def with_approved_adjustment(months: DataFrame, adjustments: DataFrame) -> DataFrame:
    """Latest process approved by month end."""
    approved = adjustments.filter(F.col("process_status") == "APPROVED").withColumn(
        "approval_delay_days", F.datediff("approved_date", "expected_date")
    )
    return asof_last_by_month(
        months, approved, ["contract_key"], "reference_month", "approved_date", "adjustment_key",
        {
            "adjustment_number": "latest_approved_adjustment_number",
            "approval_delay_days": "latest_approved_adjustment_delay_days",
            "retroactive_amount": "latest_approved_retroactive_amount",
        },
    )


def monthly_base(
    entries: DataFrame, contracts: DataFrame, adjustments: DataFrame, exact_ratio: bool = False
) -> DataFrame:
    """Monthly base mart.

    ``contracts`` is the contract directory: one row per contract key with its
    client, service and manager attributes.  The approved-process state is
    attached first: its window brings the rows together by contract once, and
    the joins and windows that follow keep that partitioning.
    """
    return complete(roll_up(entries).filter("revenue_rows > 0"), contracts, adjustments, exact_ratio)


def margin_amount() -> Column:
    """Contribution margin; amounts stay decimal(18,2): wider decimals are copied as byte arrays, row by row."""
    return money(F.col("net_revenue") - F.coalesce(F.col("total_cost"), F.lit(0)))


def margin_pct() -> Column:
    return quotient(margin_amount(), "net_revenue")


def margin_pct_of_sums() -> Column:
    """Margin of `sum_up` rows with four decimals, as `margin_pct` of their amounts has them.

    Up to sums of 4e13 the quotient is rounded in whole numbers: the twenty decimals of
    a decimal quotient tell every tie there, so both round alike.  Others go by decimals.
    """
    net, cost = F.col("net_revenue"), F.coalesce(F.col("total_cost"), F.lit(0))
    margin, limit = net - cost, 4 * 10**13
    near = F.call_function("div", F.abs(margin) * 20000 + F.abs(net), F.nullif(F.abs(net) * 2, F.lit(0)))
    signed = F.when((margin < 0) != (net < 0), -near).otherwise(near)
    decimals = quotient(money(amount("net_revenue") - F.coalesce(amount("total_cost"), F.lit(0))), amount("net_revenue"))
    small = net.between(-limit, limit) & cost.between(-limit, limit)
    return F.when(small, (signed.cast("decimal(18,0)") * F.lit(Decimal("0.0001"))).cast("decimal(18,4)")).otherwise(decimals.cast("decimal(18,4)"))


def complete(rolled: DataFrame, contracts: DataFrame, adjustments: DataFrame, exact_ratio: bool = False) -> DataFrame:
    """Base mart of some rolled-up months: every row depends on its own month and the processes alone."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    months = with_approved_adjustment(rolled, adjustments)
    joined = months.join(contracts, "contract_key").join(
        adjustment_summary(adjustments), "contract_key", "left"
    )
    zero_filled = [
        "total_cost", "budget_cost", "extraordinary_cost", *OPERATION_MEASURES, *INCIDENT_MEASURES,
        "open_adjustment_count", "approved_retroactive_amount",
    ]
    return (
        joined.withColumns({c: zero(c) for c in zero_filled})
        .withColumnRenamed("penalties", "revenue_penalties")
        .withColumns(
            {
                "date_key": date_key("reference_month"),
                "contribution_margin": margin_amount(),
                "contribution_margin_pct": margin_pct().cast("decimal(18,4)"),
                "margin_gap_pct": (margin_pct() - F.col("target_margin_pct")).cast("decimal(18,4)"),
                "coverage_rate": rate("filled_positions", "planned_positions"),
                "overtime_rate": rate("overtime_hours", "regular_hours"),
                "absenteeism_rate": rate("absence_hours", "planned_hours"),
                "sla_compliance_rate": whole_ratio("incidents_within_sla", "incident_count", exact_ratio),
            }
        )
        .drop("revenue_rows")
    )
