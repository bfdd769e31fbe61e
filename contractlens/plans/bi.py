"""Report views: column choice, Portuguese names and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens import config
from contractlens.functions.scalar import join_text, label

# Report column -> mart column, per view.
CALENDARIO = {
    "data": "full_date", "chave_data": "date_key", "inicio_mes": "month_start_date", "numero_mes": "month_number",
    "mes": "month_name_pt", "trimestre": "quarter_number", "ano": "year_number", "ano_mes": "year_month",
}
CONTRATOS = {
    "chave_contrato": "contract_key", "codigo_contrato": "contract_code", "cliente": "client_name",
    "segmento": "business_segment", "servico": "service_name", "gestor": "manager_name",
    "complexidade": "complexity_level", "data_renovacao": "renewal_date", "meta_margem_pct": "target_margin_pct",
}
RESUMO = {
    "mes_referencia": "reference_month", "contratos_ativos": "active_contract_count", "receita_liquida": "net_revenue",
    "custo_total": "total_cost", "margem_contribuicao": "contribution_margin", "margem_pct": "contribution_margin_pct",
    "vazamento_margem": "margin_leakage_amount", "perda_identificada": "identified_loss_amount",
    "valor_recuperavel": "recoverable_amount", "receita_em_risco": "revenue_at_risk",
    "contratos_criticos": "critical_contract_count", "contratos_alto_risco": "high_risk_contract_count",
    "contratos_com_acao": "contracts_requiring_action",
}
PORTFOLIO = {
    "mes_referencia": "reference_month", "chave_contrato": "contract_key", "codigo_contrato": "contract_code",
    "cliente": "client_name", "segmento": "business_segment", "servico": "service_name", "gestor": "manager_name",
    "complexidade": "complexity_level", "receita_liquida": "net_revenue", "margem_contribuicao": "contribution_margin",
    "margem_pct": "contribution_margin_pct", "meta_margem_pct": "target_margin_pct", "gap_margem_pct": "margin_gap_pct",
    "vazamento_margem": "margin_leakage_amount", "score_risco": "contract_risk_score", "classe_risco": "risk_class",
    "risco_financeiro": "financial_risk_score", "risco_operacional": "operational_risk_score",
    "risco_qualidade": "quality_risk_score", "risco_contratual": "contractual_risk_score",
    "risco_pessoas": "people_risk_score", "tendencia_margem": "margin_trend", "data_renovacao": "renewal_date",
    "dias_para_renovacao": "days_to_renewal", "principal_fator_risco": "main_risk_driver_pt",
    "impacto_principal_fator": "main_risk_driver_impact", "codigo_acao": "recommended_action_code",
    "acao_recomendada": "recommended_action_name_pt", "valor_recuperavel": "action_recoverable_amount",
    "prioridade": "portfolio_priority_rank",
}
DESEMPENHO = {
    "mes_referencia": "reference_month", "chave_data": "date_key", "chave_contrato": "contract_key",
    "codigo_contrato": "contract_code", "cliente": "client_name", "segmento": "business_segment",
    "servico": "service_name", "gestor": "manager_name", "complexidade": "complexity_level",
    "data_renovacao": "renewal_date", "dias_para_renovacao": "days_to_renewal", "meta_margem_pct": "target_margin_pct",
    "receita_bruta": "gross_revenue", "receita_liquida": "net_revenue", "custo_total": "total_cost",
    "margem_contribuicao": "contribution_margin", "margem_pct": "contribution_margin_pct",
    "gap_margem_pct": "margin_gap_pct", "vazamento_margem": "margin_leakage_amount",
    "postos_previstos": "planned_positions", "postos_ocupados": "filled_positions",
    "postos_descobertos": "uncovered_positions", "cobertura_pct": "coverage_rate", "horas_previstas": "planned_hours",
    "horas_regulares": "regular_hours", "horas_extras": "overtime_hours", "horas_extras_pct": "overtime_rate",
    "horas_ausencia": "absence_hours", "absenteismo_pct": "absenteeism_rate", "vagas_abertas": "open_positions",
    "dias_reposicao": "average_replacement_days", "quantidade_ocorrencias": "incident_count",
    "ocorrencias_criticas": "critical_incident_count", "ocorrencias_reincidentes": "recurrent_incident_count",
    "sla_pct": "sla_compliance_rate", "reajustes_abertos": "open_adjustment_count", "tendencia_margem": "margin_trend",
    "score_risco": "contract_risk_score", "classe_risco": "risk_class",
}
PERDAS = {
    "mes_referencia": "reference_month", "chave_contrato": "contract_key", "codigo_contrato": "contract_code",
    "codigo_perda": "loss_code", "causa_perda": "loss_name_pt", "natureza_perda": "loss_nature",
    "valor_perda": "loss_amount", "taxa_recuperacao": "recovery_rate", "valor_recuperavel": "recoverable_amount",
    "observacao_calculo": "calculation_note",
}
FATORES = {
    "mes_referencia": "reference_month", "chave_contrato": "contract_key", "codigo_contrato": "contract_code",
    "pilar_risco": "risk_pillar", "codigo_fator": "driver_code", "fator_risco": "driver_name_pt",
    "valor_observado": "observed_value", "valor_referencia": "reference_value", "pontuacao_fator": "driver_score",
    "impacto_estimado": "estimated_impact_amount", "ordem_fator": "driver_rank",
}
FILA = {
    "mes_referencia": "reference_month", "chave_contrato": "contract_key", "codigo_contrato": "contract_code",
    "cliente": "client_name", "margem_pct": "contribution_margin_pct", "score_risco": "contract_risk_score",
    "classe_risco": "risk_class", "codigo_acao": "recommended_action_code", "justificativa": "action_reason_pt",
    "impacto_acao": "action_impact_amount", "valor_recuperavel": "action_recoverable_amount",
    "score_prioridade": "action_priority_score", "prioridade": "portfolio_priority_rank",
}
EFEITO = {
    "chave_acao": "management_action_key", "chave_contrato": "contract_key", "codigo_contrato": "contract_code",
    "codigo_acao": "action_code", "acao": "action_name_pt", "data_inicio": "start_date",
    "data_conclusao": "completion_date", "margem_antes_pct": "margin_before_pct", "margem_depois_pct": "margin_after_pct",
    "variacao_margem_pp": "margin_delta_pp", "horas_extras_antes_pct": "overtime_before_pct",
    "horas_extras_depois_pct": "overtime_after_pct", "cobertura_antes_pct": "coverage_before_pct",
    "cobertura_depois_pct": "coverage_after_pct", "sla_antes_pct": "sla_before_pct", "sla_depois_pct": "sla_after_pct",
    "impacto_realizado": "actual_impact_amount",
}
LINHA_TEMPO = {
    "data_evento": "reference_date", "mes_referencia": "reference_month", "chave_contrato": "contract_key",
    "codigo_contrato": "contract_code", "tipo_evento": "event_type", "gravidade": "event_severity",
    "titulo_evento": "event_title", "detalhe_evento": "event_detail", "impacto_financeiro": "impact_amount",
    "chave_origem": "source_key",
}
LABELED = {"risk_class": config.RISK_CLASS_LABELS, "margin_trend": config.TREND_LABELS}


def view(df: DataFrame, columns: dict[str, str], **extra: Column) -> DataFrame:
    """Select and rename; risk class and trend are shown by their label."""
    picked = [
        (label(source, LABELED[source]) if source in LABELED else F.col(source)).alias(name)
        for name, source in columns.items()
    ]
    return df.select(*picked, *[c.alias(n) for n, c in extra.items()])


def vw_calendario(calendar: DataFrame) -> DataFrame:
    return view(calendar, CALENDARIO, dia_util=~F.col("is_weekend"))


def vw_contratos(portfolio: DataFrame) -> DataFrame:
    return view(portfolio, CONTRATOS)


def vw_resumo_executivo(summary: DataFrame) -> DataFrame:
    return view(summary, RESUMO)


def vw_portfolio_atual(portfolio: DataFrame) -> DataFrame:
    return view(portfolio, PORTFOLIO)


def vw_desempenho_mensal(risk: DataFrame) -> DataFrame:
    """Performance and risk live on the same contract-month row: no join."""
    return view(risk, DESEMPENHO)


def vw_perdas_margem(bridge: DataFrame) -> DataFrame:
    return view(bridge, PERDAS)


def vw_fatores_risco(drivers: DataFrame) -> DataFrame:
    return view(drivers, FATORES)


def vw_fila_acoes(queue: DataFrame) -> DataFrame:
    title = join_text(
        F.col("contract_code"), F.lit(" · "), F.col("client_name"), F.lit(" — "), F.col("recommended_action_name_pt")
    )
    return view(queue, FILA, acao_recomendada=title)


def vw_efeito_acoes(effect: DataFrame) -> DataFrame:
    return view(effect, EFEITO)


def vw_linha_tempo(events: DataFrame) -> DataFrame:
    """Timeline with a one-line summary; the detail is left out when blank."""
    detail = F.nullif(F.trim("event_detail"), F.lit(""))
    summary = join_text(
        F.date_format("reference_date", "dd/MM/yyyy"), F.lit(" · "), F.col("event_title"),
        F.when(detail.isNotNull(), F.concat(F.lit(" — "), F.col("event_detail"))),
    )
    return view(events, LINHA_TEMPO, evento_resumo=summary)
