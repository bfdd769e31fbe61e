"""Report measures: a measure is an expression over contract-months.

``measure(rows, names, by, where)`` filters, groups and evaluates.  Ratios are
ratios of sums and weighted means are weighted by revenue, so a measure is
right at every level it is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlens.functions.scalar import month_index, quotient, rate
from contractlens.operators.temporal import latest_period

WEIGHT = "net_revenue"


def _sum(c: str) -> Column:
    return F.sum(c)


def _weighted(c: str) -> Column:
    # narrow operands leave the quotient enough decimals before it is rounded
    weighted = F.sum(F.col(c) * F.col(WEIGHT)).cast("decimal(28,6)")
    return rate(weighted, F.sum(WEIGHT).cast("decimal(20,2)"))



def _last_month(c: str) -> Column:
    """Sum at the last month in context, of a figure that counts all time up to now."""
    return F.sum(F.when(F.col("reference_month") == F.col("_last_month"), F.col(c)))


def _contracts(condition: Column) -> Column:
    """Contracts, not contract-months, for which the condition holds somewhere in context."""
    return F.count_distinct(F.when(condition, F.col("contract_key")))


def _define() -> dict[str, Column]:
    kept = F.when(F.col("incident_count") == 0, F.lit(1)).otherwise(F.col("sla_compliance_rate")).cast("decimal(18,4)")
    margin_pct, target = rate(_sum("contribution_margin"), _sum("net_revenue")), _weighted("target_margin_pct")
    return {
        "Receita Líquida": _sum("net_revenue"),
        "Custo Total": _sum("total_cost"),
        "Margem de Contribuição": _sum("contribution_margin"),
        "Vazamento de Margem": _sum("margin_leakage_amount"),
        "Perda Identificada": _sum("identified_loss_amount"),
        "Valor Recuperável": _sum("recoverable_amount"),
        "Reajustes Abertos": _last_month("open_adjustment_count"),
        "Margem %": margin_pct,
        "Cobertura %": rate(_sum("filled_positions"), _sum("planned_positions")),
        "Horas Extras %": rate(_sum("overtime_hours"), _sum("regular_hours")),
        "Absenteísmo %": rate(_sum("absence_hours"), _sum("planned_hours")),
        "SLA %": F.avg(kept).cast("decimal(18,4)"),
        "Meta Margem Ponderada": target,
        "Score de Risco Ponderado": _weighted("contract_risk_score"),
        "Gap de Margem p.p.": ((margin_pct - target) * 100).cast("decimal(18,2)"),
        "Receita em Risco": F.sum(F.when(F.col("contract_risk_score") >= 60, F.col("net_revenue")).otherwise(F.lit(0))),
        "Contratos Críticos": _contracts(F.col("risk_class") == "CRITICAL"),
        "Contratos com Ação": _contracts(~F.col("recommended_action_code").isin("MAINTAIN", "EXPAND")),
        "Postos Descobertos": _sum("uncovered_positions"),
        "Vagas Abertas": _sum("open_positions"),
        "Ocorrências": _sum("incident_count"),
        "Ocorrências Críticas": _sum("critical_incident_count"),
        "Ocorrências Reincidentes": _sum("recurrent_incident_count"),
        "Risco Qualidade": _weighted("quality_risk_score"),
        "Contratos com Reajuste Aberto": _contracts(F.col("open_adjustment_count") > 0),
    }


LAST_MONTH = {"Reajustes Abertos"}


def with_last_month(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds `_last_month` of every group; months are aggregated and joined, not windowed."""
    last = rows.groupBy(*by).agg(F.max("reference_month").alias("_last_month"))
    if not by:
        return rows.crossJoin(F.broadcast(last))  # one row
    last = last.withColumnsRenamed({c: f"_by_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    return rows.join(last, same).drop(*[f"_by_{c}" for c in by])


def measure(
    rows: DataFrame, names: dict[str, str], by: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """Evaluate measures (output column -> measure name) in a filter context."""
    defined = _define()
    if where is not None:
        rows = rows.filter(where)
    if any(m in LAST_MONTH for m in names.values()):
        rows = with_last_month(rows, by)
    return rows.groupBy(*by).agg(*[defined[m].alias(out) for out, m in names.items()])


def latest_measure(
    rows: DataFrame,
    names: dict[str, str],
    by: Sequence[str] = (),
    where: Column | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """The same measures at the latest month present (``source``: cheaper frame with the same months)."""
    return measure(latest_period(rows, "reference_month", source), names, by, where)


def with_prior_month(months: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Value of the calendar month before, and the change in points."""
    prior = months.select(*by, F.add_months("reference_month", 1).alias("reference_month"), F.col(value).alias("prior_value"))
    return months.join(prior, [*by, "reference_month"], "left").withColumn(
        "change_pp", ((F.col(value) - F.col("prior_value")) * 100).cast("decimal(18,2)")
    )


def rolling_12_months(months: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Sum over the twelve calendar months up to each month.

    ``months`` is already one row per month and group.
    """
    w = Window.partitionBy(*by).orderBy(month_index("reference_month")).rangeBetween(-11, 0)
    return months.withColumn(f"{value}_12m", F.sum(value).over(w))


def selected_period(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First and last month in context as text."""
    text = F.concat(
        F.date_format(F.min("reference_month"), "MM/yyyy"), F.lit(" a "), F.date_format(F.max("reference_month"), "MM/yyyy")
    )
    return rows.groupBy(*by).agg(text.alias("period"))


def renewal_within(rows: DataFrame, days: int = 90, source: DataFrame | None = None) -> DataFrame:
    """Latest-month contracts due for renewal; expired ones stay visible."""
    due = latest_period(rows, "reference_month", source).filter(F.col("days_to_renewal") <= days)
    return due.agg(
        F.count("*").alias("contracts"),
        F.coalesce(F.sum("net_revenue"), F.lit(0)).alias("net_revenue"),
        F.coalesce(F.sum("recoverable_amount"), F.lit(0)).alias("recoverable_amount"),
    )


def event_impact(timeline: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Impacto Evento: the impact of the events in context; events without one count nothing."""
    return timeline.groupBy(*by).agg(F.sum("impact_amount").alias("event_impact"))


def effect_measures(effect: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Completed actions: count, realized impact, mean indicators and gains."""
    exact = lambda c: quotient(F.sum(c), F.count(c).cast("decimal(18,0)"))
    mean = lambda c: exact(c).cast("decimal(18,4)")
    gain = lambda a, b: ((exact(a) - exact(b)) * 100).cast("decimal(18,2)")
    return effect.groupBy(*by).agg(
        F.count("*").alias("completed_actions"),
        F.sum("actual_impact_amount").alias("realized_impact"),
        mean("margin_before_pct").alias("margin_before"),
        mean("margin_after_pct").alias("margin_after"),
        gain("margin_after_pct", "margin_before_pct").alias("margin_gain_pp"),
        gain("sla_after_pct", "sla_before_pct").alias("sla_gain_pp"),
        gain("coverage_after_pct", "coverage_before_pct").alias("coverage_gain_pp"),
        gain("overtime_before_pct", "overtime_after_pct").alias("overtime_reduction_pp"),
    )
