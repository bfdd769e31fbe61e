"""Business configuration: parameters, rates, bands, rules and labels.

Everything here is data.  The jobs under ``contractlens.plans`` read these
tables, so a limit, weight or rule is changed here and nowhere else.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# Risk parameters (code, value, unit, group).
# ---------------------------------------------------------------------------
RISK_PARAMETERS = [
    ("WEIGHT_FINANCIAL", "0.35", "PERCENT", "WEIGHT"),
    ("WEIGHT_OPERATIONAL", "0.25", "PERCENT", "WEIGHT"),
    ("WEIGHT_QUALITY", "0.15", "PERCENT", "WEIGHT"),
    ("WEIGHT_CONTRACTUAL", "0.15", "PERCENT", "WEIGHT"),
    ("WEIGHT_PEOPLE", "0.10", "PERCENT", "WEIGHT"),
    ("MARGIN_GAP_WARN", "0.02", "PERCENT", "FINANCIAL"),
    ("MARGIN_GAP_HIGH", "0.06", "PERCENT", "FINANCIAL"),
    ("MARGIN_GAP_CRITICAL", "0.10", "PERCENT", "FINANCIAL"),
    ("EXTRA_COST_WARN", "0.02", "PERCENT", "FINANCIAL"),
    ("EXTRA_COST_HIGH", "0.05", "PERCENT", "FINANCIAL"),
    ("EXTRA_COST_CRITICAL", "0.08", "PERCENT", "FINANCIAL"),
    ("OVERTIME_WARN", "0.03", "PERCENT", "OPERATIONAL"),
    ("OVERTIME_HIGH", "0.06", "PERCENT", "OPERATIONAL"),
    ("OVERTIME_CRITICAL", "0.10", "PERCENT", "OPERATIONAL"),
    ("COVERAGE_WARN", "0.98", "PERCENT", "OPERATIONAL"),
    ("COVERAGE_HIGH", "0.95", "PERCENT", "OPERATIONAL"),
    ("COVERAGE_CRITICAL", "0.90", "PERCENT", "OPERATIONAL"),
    ("SCOPE_OVERRUN_WARN", "0.02", "PERCENT", "OPERATIONAL"),
    ("SCOPE_OVERRUN_HIGH", "0.05", "PERCENT", "OPERATIONAL"),
    ("SCOPE_OVERRUN_CRITICAL", "0.10", "PERCENT", "OPERATIONAL"),
    ("SLA_TARGET", "0.95", "PERCENT", "QUALITY"),
    ("SLA_HIGH", "0.85", "PERCENT", "QUALITY"),
    ("SLA_CRITICAL", "0.70", "PERCENT", "QUALITY"),
    ("ADJUSTMENT_WARN_DAYS", "30", "DAYS", "CONTRACTUAL"),
    ("ADJUSTMENT_HIGH_DAYS", "90", "DAYS", "CONTRACTUAL"),
    ("ADJUSTMENT_CRITICAL_DAYS", "180", "DAYS", "CONTRACTUAL"),
    ("RENEWAL_WARN_DAYS", "180", "DAYS", "CONTRACTUAL"),
    ("RENEWAL_HIGH_DAYS", "120", "DAYS", "CONTRACTUAL"),
    ("RENEWAL_CRITICAL_DAYS", "60", "DAYS", "CONTRACTUAL"),
    ("NON_RENEWAL_REVIEW_DAYS", "365", "DAYS", "CONTRACTUAL"),
    ("ABSENCE_WARN", "0.02", "PERCENT", "PEOPLE"),
    ("ABSENCE_HIGH", "0.04", "PERCENT", "PEOPLE"),
    ("ABSENCE_CRITICAL", "0.06", "PERCENT", "PEOPLE"),
    ("VACANCY_WARN", "0.01", "PERCENT", "PEOPLE"),
    ("VACANCY_HIGH", "0.05", "PERCENT", "PEOPLE"),
    ("VACANCY_CRITICAL", "0.10", "PERCENT", "PEOPLE"),
    ("REPLACEMENT_WARN_DAYS", "15", "DAYS", "PEOPLE"),
    ("REPLACEMENT_HIGH_DAYS", "25", "DAYS", "PEOPLE"),
    ("REPLACEMENT_CRITICAL_DAYS", "35", "DAYS", "PEOPLE"),
    ("RISK_ATTENTION_MIN", "30", "POINTS", "CLASSIFICATION"),
    ("RISK_HIGH_MIN", "60", "POINTS", "CLASSIFICATION"),
    ("RISK_CRITICAL_MIN", "80", "POINTS", "CLASSIFICATION"),
]

# Loss causes (code, label, recovery rate, nature, estimate?, note).
LOSS_CAUSES = [
    ("OVERTIME_EXCESS", "Horas adicionais acima do orçamento", "0.50", "DIRECT", False,
     "Custo realizado de horas adicionais menos o orçamento da mesma categoria."),
    ("EMERGENCY_COVERAGE_EXCESS", "Cobertura emergencial acima do orçamento", "0.45", "DIRECT", False,
     "Custo realizado de cobertura emergencial menos o orçamento da mesma categoria."),
    ("SLA_FINANCIAL_LOSS", "Multas e glosas de SLA", "0.35", "DIRECT", False,
     "Soma das glosas e multas ligadas às ocorrências de SLA do período."),
    ("COMMERCIAL_DISCOUNT", "Descontos comerciais", "0.20", "DIRECT", False,
     "Descontos comerciais concedidos na medição mensal."),
    ("OTHER_EXTRAORDINARY_COST", "Outros custos extraordinários", "0.30", "DIRECT", False,
     "Custos extraordinários diferentes de horas adicionais e cobertura emergencial."),
    ("ADJUSTMENT_DELAY_ESTIMATE", "Exposição por reajuste atrasado", "0.70", "ESTIMATE", True,
     "Percentual solicitado aplicado ao valor anterior e multiplicado pelos meses vencidos."),
    ("UNBILLED_SCOPE_ESTIMATE", "Execução acima do escopo sem faturamento adicional", "0.60", "ESTIMATE", True,
     "Horas executadas acima do previsto, valorizadas pela receita contratada por hora. "
     "Só é calculado sem faturamento adicional."),
]

# Where each cause's amount sits on the monthly performance row.
LOSS_AMOUNT_COLUMNS = {
    "OVERTIME_EXCESS": "overtime_excess_cost",
    "EMERGENCY_COVERAGE_EXCESS": "emergency_coverage_excess_cost",
    "SLA_FINANCIAL_LOSS": "sla_financial_loss",
    "COMMERCIAL_DISCOUNT": "commercial_discounts",
    "OTHER_EXTRAORDINARY_COST": "other_extraordinary_cost",
    "ADJUSTMENT_DELAY_ESTIMATE": "adjustment_delay_estimate",
    "UNBILLED_SCOPE_ESTIMATE": "unbilled_scope_estimate",
}

# Subcategories that have a loss cause of their own.
OVERTIME_SUBCATEGORY = "Horas adicionais"
COVERAGE_SUBCATEGORY = "Cobertura emergencial"
LABOR_SUBCATEGORIES = ("Salários", "Encargos sociais", "Benefícios")
MATERIALS_CATEGORY = "Materiais"
ONE_OFF_SUBCATEGORY = "Manutenção de equipamentos"

# Management actions (code, label, category, owner area).
ACTIONS = [
    ("RENEGOTIATE_PRICE", "Renegociar preço", "COMMERCIAL", "COMMERCIAL"),
    ("REQUEST_ADJUSTMENT", "Solicitar reajuste", "COMMERCIAL", "COMMERCIAL"),
    ("FORMALIZE_SCOPE", "Formalizar alteração de escopo", "COMMERCIAL", "COMMERCIAL"),
    ("REVIEW_SCHEDULE", "Revisar escala", "OPERATIONS", "OPERATIONS"),
    ("REINFORCE_COVERAGE", "Reforçar cobertura", "OPERATIONS", "OPERATIONS"),
    ("REDUCE_OVERTIME", "Reduzir horas adicionais", "OPERATIONS", "OPERATIONS"),
    ("SLA_RECOVERY_PLAN", "Implantar plano de recuperação de SLA", "QUALITY", "OPERATIONS"),
    ("REVIEW_SUPERVISION", "Revisar supervisão", "OPERATIONS", "OPERATIONS"),
    ("REVIEW_SUPPLIER", "Revisar fornecedor", "PROCUREMENT", "PROCUREMENT"),
    ("ASSESS_NON_RENEWAL", "Avaliar não renovação", "CONTRACT", "EXECUTIVE"),
    ("MAINTAIN", "Manter contrato", "CONTRACT", "CONTRACT_MANAGEMENT"),
    ("EXPAND", "Avaliar expansão", "COMMERCIAL", "COMMERCIAL"),
    ("REVIEW_RETROACTIVE", "Cobrar retroatividade do reajuste", "COMMERCIAL", "COMMERCIAL"),
]

# Recommendation reason per action.
ACTION_REASONS = {
    "ASSESS_NON_RENEWAL": "Margem negativa e risco elevado. O contrato precisa ser reprecificado ou retirado da carteira.",
    "REQUEST_ADJUSTMENT": "Existe reajuste pendente com atraso e exposição financeira estimada.",
    "REVIEW_RETROACTIVE": "O reajuste foi aprovado com atraso. A retroatividade precisa ser conferida e cobrada.",
    "REINFORCE_COVERAGE": "A cobertura de postos está abaixo do limite e há vagas abertas.",
    "SLA_RECOVERY_PLAN": "Falhas de SLA, reincidência ou ocorrências críticas estão pressionando o resultado.",
    "FORMALIZE_SCOPE": "As horas executadas superam o previsto sem faturamento adicional registrado.",
    "REVIEW_SCHEDULE": "As horas adicionais estão acima do limite definido para a operação.",
    "RENEGOTIATE_PRICE": "A margem permanece distante da meta mesmo sem um evento operacional dominante.",
    "EXPAND": "O contrato está acima da meta e apresenta baixo risco operacional e financeiro.",
    "MAINTAIN": "Não há desvio material que justifique intervenção imediata.",
}
CLOSED_RETROACTIVE_REASON = (
    "A retroatividade já foi conferida e recebida. Não há nova pendência no período."
)

# Recoverability rate per action.
ACTION_RECOVERABILITY = {
    "ASSESS_NON_RENEWAL": "0.85",
    "REQUEST_ADJUSTMENT": "0.70",
    "REVIEW_RETROACTIVE": "0.80",
    "REINFORCE_COVERAGE": "0.45",
    "FORMALIZE_SCOPE": "0.60",
    "SLA_RECOVERY_PLAN": "0.35",
    "REVIEW_SCHEDULE": "0.50",
    "RENEGOTIATE_PRICE": "0.55",
    "EXPAND": "0.30",
    "MAINTAIN": "0.10",
}

# Literals of the scoring and action rules that are not parameters.
NON_RENEWAL_SCORE = 65
AT_RISK_SCORE = 60
QUALITY_PLAN_SCORE = 60
NO_INTERVENTION = ("MAINTAIN", "EXPAND")
TREND_LIMITS = {"fast": "0.03", "slow": "0.01"}
PRIORITY_WEIGHTS = {"impact": "0.40", "risk": "0.30", "urgency": "0.20", "recoverability": "0.10"}

# Share of each sub-score in its pillar.
PILLARS = {
    "financial": [("margin_gap", "0.75"), ("extraordinary_cost", "0.25")],
    "operational": [("overtime", "0.45"), ("coverage", "0.35"), ("scope_overrun", "0.20")],
    "quality": [("sla_compliance", "0.50"), ("critical_incidents", "0.30"), ("recurrence", "0.20")],
    "contractual": [("adjustment_delay", "0.50"), ("renewal_proximity", "0.30"), ("commercial_discount", "0.20")],
    "people": [("absenteeism", "0.50"), ("vacancies", "0.30"), ("replacement_time", "0.20")],
}


@dataclass(frozen=True)
class Band:
    """Banded score of one observed column.

    ``limits`` lists (limit, points), worst first.  A limit is a parameter
    name or a literal.  ``direction`` says how a value falls into a band.
    """

    column: str
    limits: tuple
    direction: str = ">="
    floor: int = 0


def _warn_high_critical(prefix: str, suffix: str = "") -> tuple:
    return (
        (f"{prefix}_critical{suffix}", 100),
        (f"{prefix}_high{suffix}", 75),
        (f"{prefix}_warn{suffix}", 40),
    )


# Sub-scores that are plain bands; margin gap and SLA add a guard in plans.risk.
BANDS = {
    "extraordinary_cost": Band("extraordinary_cost_rate", _warn_high_critical("extra_cost")),
    "overtime": Band("overtime_rate", _warn_high_critical("overtime")),
    "coverage": Band("coverage_rate", _warn_high_critical("coverage"), direction="<"),
    "scope_overrun": Band("execution_overrun_rate", _warn_high_critical("scope_overrun")),
    "critical_incidents": Band("critical_incident_count", ((2, 100), (1, 70))),
    "recurrence": Band("recurrence_rate", (("0.50", 100), ("0.25", 60), ("> 0", 30))),
    "adjustment_delay": Band("adjustment_overdue_days", _warn_high_critical("adjustment", "_days")),
    "renewal_proximity": Band("days_to_renewal", _warn_high_critical("renewal", "_days"), direction="<="),
    "commercial_discount": Band("commercial_discount_rate", (("0.05", 100), ("0.02", 60), ("> 0", 25))),
    "absenteeism": Band("absenteeism_rate", _warn_high_critical("absence")),
    "vacancies": Band("vacancy_rate", _warn_high_critical("vacancy")),
    "replacement_time": Band("average_replacement_days", _warn_high_critical("replacement", "_days")),
}

# Risk drivers
# (pillar, code, label, observed column, reference, score, impact column).
DRIVERS = [
    ("FINANCIAL", "MARGIN_GAP", "Desvio da margem", "margin_gap_pct", "-margin_gap_warn", "margin_gap", "margin_leakage_amount"),
    ("FINANCIAL", "EXTRAORDINARY_COST", "Custos extraordinários", "extraordinary_cost_rate", "extra_cost_warn", "extraordinary_cost", "extraordinary_cost"),
    ("OPERATIONAL", "OVERTIME", "Horas adicionais", "overtime_rate", "overtime_warn", "overtime", "OVERTIME_EXCESS"),
    ("OPERATIONAL", "COVERAGE", "Cobertura de postos", "coverage_rate", "coverage_warn", "coverage", "EMERGENCY_COVERAGE_EXCESS"),
    ("OPERATIONAL", "SCOPE_OVERRUN", "Execução acima do contratado", "execution_overrun_rate", "scope_overrun_warn", "scope_overrun", "UNBILLED_SCOPE_ESTIMATE"),
    ("QUALITY", "SLA_COMPLIANCE", "Cumprimento de SLA", "sla_compliance_rate", "sla_target", "sla_compliance", "SLA_FINANCIAL_LOSS"),
    ("QUALITY", "CRITICAL_INCIDENTS", "Ocorrências críticas", "critical_incident_count", None, "critical_incidents", "SLA_FINANCIAL_LOSS"),
    ("QUALITY", "RECURRENCE", "Reincidência de ocorrências", "recurrence_rate", None, "recurrence", "SLA_FINANCIAL_LOSS"),
    ("CONTRACTUAL", "ADJUSTMENT_DELAY", "Reajuste pendente", "adjustment_overdue_days", "adjustment_warn_days", "adjustment_delay", "ADJUSTMENT_DELAY_ESTIMATE"),
    ("CONTRACTUAL", "RENEWAL_PROXIMITY", "Renovação próxima", "days_to_renewal", "renewal_warn_days", "renewal_proximity", None),
    ("CONTRACTUAL", "COMMERCIAL_DISCOUNT", "Descontos comerciais", "commercial_discount_rate", None, "commercial_discount", "COMMERCIAL_DISCOUNT"),
    ("PEOPLE", "ABSENTEEISM", "Absenteísmo", "absenteeism_rate", "absence_warn", "absenteeism", "EMERGENCY_COVERAGE_EXCESS"),
    ("PEOPLE", "VACANCIES", "Vagas abertas", "vacancy_rate", "vacancy_warn", "vacancies", "EMERGENCY_COVERAGE_EXCESS"),
    ("PEOPLE", "REPLACEMENT_TIME", "Tempo de reposição", "average_replacement_days", "replacement_warn_days", "replacement_time", "EMERGENCY_COVERAGE_EXCESS"),
]

# Accepted domain words (folded to upper case, no accents).
CODE_MAPS = {
    "contract_status": {
        "ATIVO": "ACTIVE", "ACTIVE": "ACTIVE", "INATIVO": "INACTIVE", "INACTIVE": "INACTIVE",
        "ENCERRADO": "CLOSED", "CLOSED": "CLOSED",
    },
    "billing_model": {
        "MENSAL FIXO": "FIXED_MONTHLY", "FIXED MONTHLY": "FIXED_MONTHLY", "FIXED_MONTHLY": "FIXED_MONTHLY",
        "POR POSTO": "POSITION_BASED", "POSITION BASED": "POSITION_BASED", "POSITION_BASED": "POSITION_BASED",
        "POR HORA": "HOURLY", "HOURLY": "HOURLY",
    },
    "complexity_level": {
        "BAIXA": "LOW", "LOW": "LOW", "MEDIA": "MEDIUM", "MEDIUM": "MEDIUM", "ALTA": "HIGH", "HIGH": "HIGH",
    },
    "severity": {
        "BAIXA": "LOW", "LOW": "LOW", "MEDIA": "MEDIUM", "MEDIUM": "MEDIUM", "ALTA": "HIGH", "HIGH": "HIGH",
        "CRITICA": "CRITICAL", "CRITICAL": "CRITICAL",
    },
    "incident_status": {
        "ABERTA": "OPEN", "OPEN": "OPEN", "EM ANDAMENTO": "IN_PROGRESS", "IN_PROGRESS": "IN_PROGRESS",
        "FECHADA": "CLOSED", "CLOSED": "CLOSED", "CANCELADA": "CANCELLED", "CANCELLED": "CANCELLED",
    },
    "process_type": {
        "REAJUSTE": "ADJUSTMENT", "ADJUSTMENT": "ADJUSTMENT", "REPACTUACAO": "REPACTUATION",
        "REPACTUATION": "REPACTUATION", "RENEGOCIACAO": "RENEGOTIATION", "RENEGOTIATION": "RENEGOTIATION",
    },
    "process_status": {
        "PENDENTE": "PENDING", "PENDING": "PENDING", "SOLICITADO": "REQUESTED", "REQUESTED": "REQUESTED",
        "APROVADO": "APPROVED", "APPROVED": "APPROVED", "REJEITADO": "REJECTED", "REJECTED": "REJECTED",
        "CANCELADO": "CANCELLED", "CANCELLED": "CANCELLED",
    },
}
OPEN_PROCESS_STATUSES = ("PENDING", "REQUESTED")

# Portuguese month names and report labels.
MONTH_NAMES_PT = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
RISK_CLASS_LABELS = {"LOW": "Baixo", "ATTENTION": "Atenção", "HIGH": "Alto", "CRITICAL": "Crítico"}
# DETERIORATING_FAST and IMPROVING_FAST have no label and pass through.
TREND_LABELS = {
    "IMPROVING": "Melhorando", "STABLE": "Estável", "DETERIORATING": "Deteriorando",
    "RAPIDLY_DETERIORATING": "Deterioração rápida", "INSUFFICIENT_HISTORY": "Histórico insuficiente",
}
PROCESS_TYPE_LABELS = {"ADJUSTMENT": "Reajuste", "REPACTUATION": "Repactuação"}
PROCESS_TYPE_OTHER = "Renegociação"
PROCESS_STATUS_LABELS = {"APPROVED": "aprovado", "REQUESTED": "solicitado", "PENDING": "pendente"}

# Calendar range.
CALENDAR_START, CALENDAR_END = "2023-01-01", "2027-12-31"


def parameter_values(rows=RISK_PARAMETERS) -> dict[str, Decimal]:
    """Parameters as ``{lower-case code: value}``, ready to use as literals."""
    return {code.lower(): Decimal(value) for code, value, *_ in rows}


def risk_parameter_table(spark: SparkSession) -> DataFrame:
    rows = [(c, Decimal(v), u, g) for c, v, u, g in RISK_PARAMETERS]
    return spark.createDataFrame(
        rows,
        "parameter_code string, parameter_value decimal(18,6), parameter_unit string, parameter_group string",
    )


def loss_recovery_table(spark: SparkSession) -> DataFrame:
    rows = [(c, n, Decimal(r), nature) for c, n, r, nature, *_ in LOSS_CAUSES]
    return spark.createDataFrame(
        rows, "loss_code string, loss_name_pt string, recovery_rate decimal(9,4), loss_nature string"
    )


def action_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, *row, "ACTIVE") for i, row in enumerate(ACTIONS, start=1)],
        "action_key long, action_code string, action_name_pt string, action_category string, "
        "default_owner_area string, action_status string",
    )
