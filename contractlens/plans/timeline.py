"""Event timeline of a contract from five kinds of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens import config
from contractlens.functions.scalar import join_text
from contractlens.operators.shape import change_rows

# Words of a plan event that raise its severity, worst first.
EVENT_WORDS = (
    ("CRITICAL", ("CRITICAL",)),
    ("HIGH", ("DETERIORATION", "HIGH", "DEFICIT")),
    ("ATTENTION", ("ACTION", "PENDING", "WARNING")),
)
ADJUSTMENT_SEVERITY = {"APPROVED": "INFORMATION", "REQUESTED": "ATTENTION", "PENDING": "HIGH"}
ACTION_SEVERITY = {"COMPLETED": "INFORMATION", "IN_PROGRESS": "ATTENTION"}
ROUTINE = "ROUTINE"

COLUMNS = [
    "reference_date", "reference_month", "contract_key", "contract_code", "event_type", "event_severity",
    "event_title", "event_detail", "impact_amount", "source_key",
]


def word_severity(text: Column, words=EVENT_WORDS, otherwise: str = "INFORMATION") -> Column:
    chain = F
    for severity, parts in words:
        found = F.contains(text, F.lit(parts[0]))
        for part in parts[1:]:
            found = found | F.contains(text, F.lit(part))
        chain = chain.when(found, severity)
    return chain.otherwise(otherwise)


def lookup(c: str, values: dict[str, str], otherwise: str) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(c)), F.lit(otherwise))


def _event(df: DataFrame, day: Column, kind: str, severity: Column, title: Column, detail: Column, impact: Column, key: Column):
    return df.select(
        day.cast("date").alias("reference_date"), F.trunc(day, "MM").alias("reference_month"), "contract_key",
        "contract_code", F.lit(kind).alias("event_type"), severity.alias("event_severity"), title.alias("event_title"),
        detail.alias("event_detail"), impact.cast("decimal(18,2)").alias("impact_amount"), key.alias("source_key"),
    )


def plan_events(plan: DataFrame) -> DataFrame:
    """Months in which the planned situation changes to something not routine."""
    changed = change_rows(plan, ["contract_code"], "reference_month", "event_code").filter(F.col("event_code") != ROUTINE)
    month = F.col("reference_month")
    key = join_text(F.lit("PLAN-"), F.col("contract_code"), F.lit("-"), F.date_format(month, "yyyyMM"))
    title = F.replace(F.col("event_code"), F.lit("_"), F.lit(" "))
    return _event(
        changed, month, "BUSINESS_EVENT", word_severity(F.col("event_code")), title, F.col("event_note"), F.lit(None), key
    )


def adjustment_events(adjustments: DataFrame) -> DataFrame:
    status = F.col("process_status")
    exposure = F.col("previous_amount") * F.coalesce(F.col("requested_pct"), F.lit(0))
    wording = F.coalesce(lookup("process_status", config.PROCESS_STATUS_LABELS, ""), F.lower(status))
    title = F.concat(
        lookup("process_type", config.PROCESS_TYPE_LABELS, config.PROCESS_TYPE_OTHER),
        F.lit(" — "),
        F.when(wording == "", F.lower(status)).otherwise(wording),
    )
    return _event(
        adjustments, F.coalesce("approved_date", "requested_date", "expected_date"), "ADJUSTMENT",
        lookup("process_status", ADJUSTMENT_SEVERITY, "INFORMATION"), title, F.col("pending_reason"),
        F.when(status == "APPROVED", F.col("retroactive_amount").cast("decimal(38,6)")).otherwise(exposure),
        F.col("adjustment_number"),
    )


def action_events(actions: DataFrame) -> DataFrame:
    names = {code: name for code, name, *_ in config.ACTIONS}
    detail = join_text(
        F.lit("Status: "), F.col("action_status"), F.lit(". Resultado: "),
        F.coalesce(F.col("standardized_result"), F.lit("não informado")), F.lit("."),
    )
    return _event(
        actions, F.col("recommendation_date"), "MANAGEMENT_ACTION",
        lookup("action_status", ACTION_SEVERITY, "INFORMATION"), lookup("action_code", names, ""), detail,
        F.coalesce("actual_impact_amount", "estimated_impact_amount"),
        join_text(F.lit("ACTION-"), F.col("management_action_key")),
    )


def incident_events(incidents: DataFrame) -> DataFrame:
    critical = incidents.filter(F.col("severity") == "CRITICAL")
    return _event(
        critical, F.col("opened_at"), "SLA", F.col("severity"),
        join_text(F.lit("Ocorrência crítica — "), F.col("incident_subcategory")), F.col("root_cause"),
        F.col("deduction_amount") + F.col("penalty_amount") + F.col("emergency_cost"), F.col("incident_number"),
    )


def risk_events(risk: DataFrame) -> DataFrame:
    """Months in which a contract enters the high or critical class."""
    changed = change_rows(risk, ["contract_key"], "reference_month", "risk_class").filter(
        F.col("risk_class").isin("HIGH", "CRITICAL")
    )
    month = F.col("reference_month")
    detail = join_text(
        F.lit("Índice: "), F.col("contract_risk_score"), F.lit(". Margem: "),
        F.col("contribution_margin_pct") * 100, F.lit("%."),
    )
    return _event(
        changed, month, "RISK_CHANGE", F.col("risk_class"), join_text(F.lit("Risco alterado para "), F.col("risk_class")),
        detail, F.col("margin_leakage_amount"),
        join_text(F.lit("RISK-"), F.col("contract_code"), F.lit("-"), F.date_format(month, "yyyyMM")),
    )


def timeline(*events: DataFrame) -> DataFrame:
    out = events[0]
    for more in events[1:]:
        out = out.unionByName(more)
    return out.select(*COLUMNS)


def event_annotations(plan: DataFrame, contracts: DataFrame) -> DataFrame:
    """Planned event of every contract-month, for chart annotations."""
    return plan.select("reference_month", "contract_code", "event_code", "event_note").join(
        contracts.select("contract_code", "contract_key"), "contract_code"
    )
