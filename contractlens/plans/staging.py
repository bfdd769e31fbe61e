"""Staging of the six raw files: type, look up, judge, split.

Each job is a declaration: how columns are typed, which references must
exist, and which conditions reject a row.  The valid set is the complement of
the rejected set because both come from the same reasons.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens import config
from contractlens.functions.parse import parse_localized
from contractlens.functions.scalar import fold, minutes_between, money, row_hash
from contractlens.operators.quarantine import with_reasons
from contractlens.operators.shape import duplicate_count

LINEAGE = ["batch_id", "source_row_number"]
MONEY, HOURS, POSITIONS = "decimal(18,2)", "decimal(18,2)", "decimal(10,2)"


@dataclass(frozen=True)
class StagedSource:
    """Declaration of one raw file."""

    name: str
    typing: dict
    rules: Callable[[], list[tuple[Column, str]]]
    references: tuple = ()
    duplicate_key: tuple = ()
    derived: Callable[[], dict[str, Column]] = field(default=lambda: {})

    @property
    def columns(self) -> list[str]:
        return list(self.typing)


def missing(*names: str) -> Column:
    out = F.col(names[0]).isNull()
    for name in names[1:]:
        out = out | F.col(name).isNull()
    return out


def missing_or_negative(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) < 0)


def missing_or_not_positive(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) <= 0)


def outside(name: str, low, high) -> Column:
    return ~F.col(name).between(low, high)


def before(later: str, earlier: str) -> Column:
    return F.col(later) < F.col(earlier)


def repeated() -> Column:
    return F.col("duplicate_count") > 1


# Attributes that make a new contract version (client name, unit and state do not).
CONTRACT_HASH = [
    "client_code", "manager_code", "service_code", "contract_status", "billing_model", "complexity_level",
    "start_date", "end_date", "renewal_date", "base_monthly_amount", "contracted_positions", "contracted_hours",
    "target_margin_pct", "adjustment_base_month", "adjustment_index",
]

CONTRACTS = StagedSource(
    "contract_register",
    {
        "contract_code": "code", "client_code": "code", "client_name": "text", "unit_code": "code",
        "service_code": "code", "manager_code": "code", "contract_status": config.CODE_MAPS["contract_status"],
        "billing_model": config.CODE_MAPS["billing_model"], "complexity_level": config.CODE_MAPS["complexity_level"],
        "start_date": "date", "end_date": "date", "renewal_date": "date", "base_monthly_amount": MONEY,
        "contracted_positions": POSITIONS, "contracted_hours": HOURS, "target_margin_pct": "percent",
        "adjustment_base_month": "smallint", "adjustment_index": "code", "state_code": "code",
    },
    # Rejection reasons.
    lambda: [
        (missing("contract_code"), "Código do contrato ausente"),
        (missing("found_client"), "Cliente não encontrado"),
        (missing("client_name"), "Nome do cliente ausente"),
        (missing("found_unit"), "Unidade não encontrada para o cliente"),
        (missing("found_service"), "Serviço não cadastrado"),
        (missing("found_manager"), "Gestor não cadastrado"),
        (missing("contract_status"), "Status do contrato inválido"),
        (missing("billing_model"), "Modelo de cobrança inválido"),
        (missing("complexity_level"), "Complexidade inválida"),
        (missing("start_date"), "Data de início inválida"),
        (before("end_date", "start_date"), "Data final anterior à data inicial"),
        (before("renewal_date", "start_date"), "Data de renovação anterior à data inicial"),
        (missing_or_not_positive("base_monthly_amount"), "Valor mensal inválido"),
        (missing_or_negative("contracted_positions"), "Quantidade de postos inválida"),
        (missing_or_negative("contracted_hours"), "Horas contratadas inválidas"),
        (missing("target_margin_pct") | outside("target_margin_pct", 0, 1), "Margem-alvo inválida"),
        (outside("adjustment_base_month", 1, 12), "Mês-base de reajuste inválido"),
        (missing("state_code") | (F.length("state_code") != 2), "UF inválida"),
        (missing("valid_from"), "Data de vigência da versão não definida"),
    ],
    references=("client", "unit_of_client", "service", "manager", "known_contract"),
    derived=lambda: {
        "valid_from": F.when(F.col("found_contract").isNull(), F.col("start_date")).otherwise(
            F.coalesce("reference_period", "start_date")
        ),
        "adjustment_base_month": F.when(F.col("adjustment_base_month").between(0, 255), F.col("adjustment_base_month")),
    },
)

MEASUREMENTS = StagedSource(
    "monthly_measurements",
    {
        "contract_code": "code", "reference_month": ("month", "reference_period"), "measurement_number": "code",
        "contracted_amount": MONEY, "additional_services": MONEY, "reimbursements": MONEY,
        "commercial_discounts": MONEY, "deductions": MONEY, "penalties": MONEY, "invoiced_amount": MONEY,
        "received_amount": MONEY, "invoice_date": "date", "payment_date": "date",
    },
    # Rejection reasons.
    lambda: [
        (missing("found_contract"), "Contrato não encontrado"),
        (missing("reference_month"), "Competência inválida"),
        (missing("measurement_number"), "Número da medição ausente"),
        (missing_or_negative("contracted_amount"), "Valor contratado inválido"),
        (missing_or_negative("additional_services"), "Serviços adicionais inválidos"),
        (missing_or_negative("reimbursements"), "Reembolsos inválidos"),
        (missing_or_negative("commercial_discounts"), "Descontos inválidos"),
        (missing_or_negative("deductions"), "Glosas inválidas"),
        (missing_or_negative("penalties"), "Multas inválidas"),
        (missing_or_negative("invoiced_amount"), "Valor faturado inválido"),
        (F.col("received_amount") < 0, "Valor recebido inválido"),
        (F.col("payment_date").isNotNull() & missing("invoice_date"), "Data de pagamento sem data de emissão válida"),
        (before("payment_date", "invoice_date"), "Pagamento anterior à emissão"),
        (repeated(), "Medição duplicada no arquivo"),
    ],
    references=("known_contract",),
    duplicate_key=("contract_code", "reference_month", "measurement_number"),
)

COSTS = StagedSource(
    "operational_costs",
    {
        "contract_code": "code", "unit_code": "code", "reference_month": ("month", "reference_period"),
        "cost_group": "text", "cost_category": "text", "cost_subcategory": "text", "actual_amount": MONEY,
        "budget_amount": MONEY, "source_system": "code", "is_recurring": ("flag", "recurring_flag"),
        "is_extraordinary": ("flag", "extraordinary_flag"), "is_allocation": ("flag", "allocation_flag"),
        "entry_type": "entry_type",
    },
    # Rejection reasons.
    lambda: [
        (missing("found_contract"), "Contrato não encontrado"),
        (missing("found_unit"), "Unidade não encontrada para o contrato"),
        (missing("reference_month"), "Competência inválida"),
        (missing("found_category"), "Categoria de custo não cadastrada"),
        (missing("actual_amount"), "Valor realizado inválido"),
        (missing("budget_amount"), "Valor orçado inválido"),
        (missing("source_system"), "Origem do lançamento ausente"),
        (missing("is_recurring"), "Indicador de recorrência inválido"),
        (missing("is_extraordinary"), "Indicador de custo extraordinário inválido"),
        (missing("is_allocation"), "Indicador de rateio inválido"),
        (missing("entry_type"), "Tipo de lançamento inválido"),
        ((F.col("entry_type") == "DEBIT") & (F.col("actual_amount") < 0), "Débito com valor negativo"),
        ((F.col("entry_type") == "REVERSAL") & (F.col("actual_amount") > 0), "Estorno com valor positivo"),
    ],
    references=("known_contract", "unit_of_client", "category"),
)

OPERATIONS = StagedSource(
    "workforce_control",
    {
        "contract_code": "code", "unit_code": "code", "role_code": "code",
        "reference_month": ("month", "reference_period"), "planned_positions": POSITIONS,
        "filled_positions": POSITIONS, "average_headcount": POSITIONS, "planned_hours": HOURS, "regular_hours": HOURS,
        "overtime_hours": HOURS, "absence_hours": HOURS, "leave_days": "int", "hires": "int", "terminations": "int",
        "open_positions": "int", "average_replacement_days": POSITIONS, "emergency_coverage_cost": MONEY,
    },
    # Rejection reasons.
    lambda: [
        (missing("found_contract"), "Contrato não encontrado"),
        (missing("found_unit"), "Unidade não encontrada para o contrato"),
        (missing("found_role"), "Função não cadastrada"),
        (missing("reference_month"), "Competência inválida"),
        (missing_or_negative("planned_positions"), "Postos previstos inválidos"),
        (missing_or_negative("filled_positions"), "Postos ocupados inválidos"),
        (missing_or_negative("average_headcount"), "Headcount médio inválido"),
        (missing_or_negative("planned_hours"), "Horas previstas inválidas"),
        (missing_or_negative("regular_hours"), "Horas regulares inválidas"),
        (missing_or_negative("overtime_hours"), "Horas adicionais inválidas"),
        (missing_or_negative("absence_hours"), "Horas de ausência inválidas"),
        (missing_or_negative("leave_days"), "Dias de afastamento inválidos"),
        (missing_or_negative("hires"), "Admissões inválidas"),
        (missing_or_negative("terminations"), "Desligamentos inválidos"),
        (missing_or_negative("open_positions"), "Vagas abertas inválidas"),
        (missing_or_negative("average_replacement_days"), "Tempo de reposição inválido"),
        (missing_or_negative("emergency_coverage_cost"), "Custo de cobertura inválido"),
        (repeated(), "Registro operacional duplicado no arquivo"),
    ],
    references=("known_contract", "unit_of_client", "role"),
    duplicate_key=("contract_code", "unit_code", "role_code", "reference_month"),
)

INCIDENTS = StagedSource(
    "sla_incidents",
    {
        "incident_number": "code", "contract_code": "code", "unit_code": "code", "incident_category": "text",
        "incident_subcategory": "text", "root_cause": "text", "opened_at": "timestamp", "closed_at": "timestamp",
        "agreed_deadline_hours": POSITIONS, "severity": config.CODE_MAPS["severity"],
        "incident_status": config.CODE_MAPS["incident_status"], "is_recurrence": ("flag", "recurrence_flag"),
        "deduction_amount": MONEY, "penalty_amount": MONEY, "emergency_cost": MONEY,
    },
    # Rejection reasons.
    lambda: [
        (missing("incident_number"), "Número da ocorrência ausente"),
        (missing("found_contract"), "Contrato não encontrado"),
        (missing("found_unit"), "Unidade não encontrada para o contrato"),
        (missing("found_incident_type"), "Tipo de ocorrência não cadastrado"),
        (missing("opened_at"), "Data de abertura inválida"),
        (before("closed_at", "opened_at"), "Encerramento anterior à abertura"),
        (missing_or_negative("agreed_deadline_hours"), "Prazo de SLA inválido"),
        (missing("severity"), "Gravidade inválida"),
        (missing("incident_status"), "Status da ocorrência inválido"),
        ((F.col("incident_status") == "CLOSED") & missing("closed_at"), "Ocorrência fechada sem data de encerramento"),
        (missing("is_recurrence"), "Indicador de reincidência inválido"),
        (missing_or_negative("deduction_amount"), "Glosa inválida"),
        (missing_or_negative("penalty_amount"), "Multa inválida"),
        (missing_or_negative("emergency_cost"), "Custo emergencial inválido"),
        (repeated(), "Ocorrência duplicada no arquivo"),
    ],
    references=("known_contract", "unit_of_client", "incident_type"),
    duplicate_key=("incident_number",),
)

ADJUSTMENTS = StagedSource(
    "contract_adjustments",
    {
        "adjustment_number": "code", "contract_code": "code", "process_type": config.CODE_MAPS["process_type"],
        "expected_date": "date", "requested_date": "date", "approved_date": "date", "requested_pct": "percent",
        "approved_pct": "percent", "previous_amount": MONEY, "approved_amount": MONEY,
        "is_retroactive": ("flag", "retroactive_flag"), "retroactive_amount": MONEY,
        "process_status": config.CODE_MAPS["process_status"], "pending_reason": "text",
    },
    # Rejection reasons.
    lambda: [
        (missing("adjustment_number"), "Número do processo ausente"),
        (missing("found_contract"), "Contrato não encontrado"),
        (missing("process_type"), "Tipo de processo inválido"),
        (missing("expected_date"), "Data prevista inválida"),
        (before("approved_date", "requested_date"), "Aprovação anterior à solicitação"),
        (outside("requested_pct", 0, 1), "Percentual solicitado inválido"),
        (outside("approved_pct", 0, 1), "Percentual aprovado inválido"),
        (missing_or_not_positive("previous_amount"), "Valor anterior inválido"),
        (F.col("approved_amount") <= 0, "Valor aprovado inválido"),
        (missing("is_retroactive"), "Indicador de retroatividade inválido"),
        (missing_or_negative("retroactive_amount"), "Valor retroativo inválido"),
        (missing("process_status"), "Status do processo inválido"),
        ((F.col("process_status") == "APPROVED") & missing("approved_date"), "Processo aprovado sem data de aprovação"),
        (repeated(), "Processo duplicado no arquivo"),
    ],
    references=("known_contract",),
    duplicate_key=("adjustment_number",),
)

SOURCES = {s.name: s for s in (CONTRACTS, MEASUREMENTS, COSTS, OPERATIONS, INCIDENTS, ADJUSTMENTS)}


def _find(df: DataFrame, reference: DataFrame, on: dict[str, Column | str], flag: str, carry: dict[str, str] | None = None):
    """Left join to a reference; ``flag`` is NULL where nothing was found."""
    side = reference.select(
        *[(F.col(k) if isinstance(v, str) else v).alias(f"_{flag}_{k}") for k, v in on.items()],
        *[F.col(src).alias(dst) for src, dst in (carry or {}).items()],
        F.lit(True).alias(flag),
    )
    same = None
    for k, v in on.items():
        left = F.col(v) if isinstance(v, str) else fold(k)
        test = left == F.col(f"_{flag}_{k}")
        same = test if same is None else same & test
    return df.join(side, same, "left").drop(*[f"_{flag}_{k}" for k in on])


def _attach_references(df: DataFrame, wanted, refs: dict[str, DataFrame]) -> DataFrame:
    """Look up the references a source names; text keys ignore case and accents."""
    for kind in wanted:
        if kind == "known_contract":
            current = refs["contracts"].filter("is_current")
            df = _find(df, current, {"contract_code": "contract_code"}, "found_contract", {"client_code": "_client"})
        elif kind == "unit_of_client":
            owner = "_client" if "_client" in df.columns else "client_code"
            df = _find(df, refs["units"], {"unit_code": "unit_code", "client_code": owner}, "found_unit")
        elif kind == "category":
            keys = ("cost_group", "cost_category", "cost_subcategory")
            df = _find(df, refs["categories"], {k: fold(k) for k in keys}, "found_category")
        elif kind == "incident_type":
            keys = ("incident_category", "incident_subcategory", "root_cause")
            df = _find(df, refs["incident_types"], {k: fold(k) for k in keys}, "found_incident_type")
        else:
            df = _find(df, refs[f"{kind}s"], {f"{kind}_code": f"{kind}_code"}, f"found_{kind}")
    return df


def judge(source: StagedSource, raw: DataFrame, refs: dict[str, DataFrame], reference_period: str | None = None) -> DataFrame:
    """All rows of one raw batch, typed and looked up, with the joined reasons against them (empty when valid).

    ``refs`` holds the dimensions: contracts, clients, units, services,
    managers, roles, categories, incident_types.
    """
    typed = parse_localized(raw, source.typing, keep=LINEAGE)
    typed = typed.withColumn("reference_period", F.lit(reference_period).cast("date"))
    if source.duplicate_key:
        typed = duplicate_count(typed, [F.col(k) for k in source.duplicate_key])
    found = _attach_references(typed, source.references, refs).withColumns(source.derived())
    return with_reasons(found, source.rules())


def parts(source: StagedSource, judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows): exact complements of the judged rows."""
    rejected = judged.filter(F.col("rejection_reason") != "").select(
        *LINEAGE, F.lit(source.name).alias("source_table"), F.col(source.columns[0]).alias("received_value"), "rejection_reason"
    )
    return _computed(source, judged.filter(F.col("rejection_reason") == "")), rejected


def stage(source: StagedSource, raw: DataFrame, refs: dict[str, DataFrame], reference_period: str | None = None):
    """(valid rows, rejected rows) of one raw batch; see `judge`."""
    return parts(source, judge(source, raw, refs, reference_period))


def _computed(source: StagedSource, valid: DataFrame) -> DataFrame:
    """Stored computed columns of each staging table."""
    keep = [*LINEAGE, *source.columns]
    if source is CONTRACTS:
        return valid.withColumn("row_hash", row_hash(CONTRACT_HASH)).select(*keep, "valid_from", "row_hash")
    if source is MEASUREMENTS:
        gross = F.col("contracted_amount") + F.col("additional_services") + F.col("reimbursements")
        net = gross - F.col("commercial_discounts") - F.col("deductions") - F.col("penalties")
        return valid.select(
            *keep, money(gross).alias("gross_revenue"), money(net).alias("net_revenue"),
            F.datediff("payment_date", "invoice_date").alias("payment_days"),
        )
    if source is OPERATIONS:
        uncovered = F.greatest(F.col("planned_positions") - F.col("filled_positions"), F.lit(0))
        return valid.select(*keep, uncovered.cast(POSITIONS).alias("uncovered_positions"))
    if source is INCIDENTS:
        hours = resolution_hours("opened_at", "closed_at")
        within = F.coalesce(hours <= F.col("agreed_deadline_hours"), F.lit(False))
        return valid.select(*keep, money(hours).alias("resolution_hours"), within.alias("resolved_within_sla"))
    return valid.select(*keep)


def resolution_hours(opened, closed) -> Column:
    """Hours between two moments by minute boundaries; NULL while open."""
    return minutes_between(opened, closed).cast("decimal(18,0)") / 60
