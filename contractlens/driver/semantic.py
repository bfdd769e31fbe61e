"""Effect, timeline, report views and measures over the stand-in facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from contractlens import config
from contractlens.driver import facts, marts
from contractlens.driver.facts import ratio_sql, with_marts
from contractlens.driver.registry import query, table
from contractlens.functions.scalar import money, month_of, rate
from contractlens.plans import actions as actions_plan
from contractlens.plans import bi, drill, measures
from contractlens.plans import effect as effect_plan
from contractlens.plans import executive as executive_plan
from contractlens.plans import loss as loss_plan
from contractlens.plans import timeline as timeline_plan
from contractlens.plans.risk import risk_drivers
from contractlens.session import materialize

LATEST = "WHERE reference_month = (SELECT MAX(reference_month) FROM action)"


def case_sql(column: str, values: dict[str, str], otherwise: str | None = None) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"CASE {column} {whens} ELSE {otherwise or column} END"


# --- effect ------------------------------------------------------------------

EFFECT_SQL = """
slot AS (
  SELECT m.*, 'before' AS side, CAST(date_trunc('month', start_date) - to_months(k) AS DATE) AS reference_month FROM management m, (VALUES (1), (2), (3)) v(k) WHERE action_status = 'COMPLETED' AND completion_date IS NOT NULL
  UNION ALL SELECT m.*, 'after', CAST(date_trunc('month', completion_date) + to_months(k) AS DATE) FROM management m, (VALUES (1), (2), (3)) v(k) WHERE action_status = 'COMPLETED' AND completion_date IS NOT NULL),
matched AS (SELECT s.*, contribution_margin_pct AS margin, overtime_rate AS overtime, coverage_rate AS coverage, CASE WHEN incidents = 0 THEN 1 ELSE CAST(sla_compliance_rate AS DOUBLE) END AS sla
  FROM slot s JOIN performance p ON p.contract_key = s.contract_key AND p.reference_month = s.reference_month),
effect AS (SELECT management_action_key, contract_key, action_code, start_date, completion_date, actual_impact_amount,
    COUNT(*) FILTER (WHERE side = 'before') AS months_before, COUNT(*) FILTER (WHERE side = 'after') AS months_after,
    """ + ",\n    ".join(
    f"CAST(SUM(CAST(round({c} * 10000) AS BIGINT)) FILTER (WHERE side = '{s}') AS BIGINT) AS {c}_{s}_sum"
    for c in ("margin", "overtime", "coverage", "sla") for s in ("before", "after")
) + """
  FROM matched GROUP BY ALL HAVING COUNT(*) FILTER (WHERE side = 'before') > 0 AND COUNT(*) FILTER (WHERE side = 'after') > 0),
action_effect AS (SELECT *, """ + ", ".join(
    f"sign({c}_{s}_sum) * ((2 * abs({c}_{s}_sum) + months_{s}) // (2 * months_{s})) / 10000.0 AS {c}_{s}_pct"
    for c in ("margin", "overtime", "coverage", "sla") for s in ("before", "after")
) + """,
  CAST(margin_after_sum * months_before - margin_before_sum * months_after AS HUGEINT) AS dn, months_before * months_after AS dd FROM effect)"""
EFFECT_COLUMNS = [f"{c}_{s}_pct" for c in ("margin", "overtime", "coverage", "sla") for s in ("before", "after")]
DELTA_SQL = "sign(dn) * ((2 * abs(dn) + dd) // (2 * dd)) / 100.0"


def mean_sql(column: str, n: str = "COUNT(*)") -> str:
    """Mean of a four-decimal column, rounded half-up to four decimals."""
    s = f"CAST(SUM(CAST(round({column} * 10000) AS BIGINT)) AS BIGINT)"
    return f"sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n})) / 10000.0"


def gain_sql(after: str, before: str) -> str:
    """Difference of two means in percentage points, rounded half-up to two decimals."""
    s = f"CAST(SUM(CAST(round({after} * 10000) AS BIGINT) - CAST(round({before} * 10000) AS BIGINT)) AS BIGINT)"
    return f"sign({s}) * ((2 * abs({s}) + COUNT(*)) // (2 * COUNT(*))) / 100.0"


def action_effects(spark, sf):
    return effect_plan.action_effect(facts.management_actions(spark, sf), facts.performance(spark, sf))


@query(
    "before_after",
    with_marts(
        "performance",
        f"""
SELECT management_action_key, contract_key, action_code, start_date, completion_date, CAST(actual_impact_amount AS DOUBLE) AS actual_impact_amount,
  CAST(months_before AS BIGINT) AS months_before, CAST(months_after AS BIGINT) AS months_after, {", ".join(EFFECT_COLUMNS)}, {DELTA_SQL} AS margin_delta_pp FROM action_effect""",
        facts.MANAGEMENT_CTE,
        EFFECT_SQL,
    ),
)
def before_after(spark, sf):
    return action_effects(spark, sf).select(
        "management_action_key", "contract_key", "action_code", "start_date", "completion_date", "actual_impact_amount",
        "months_before", "months_after", *EFFECT_COLUMNS, "margin_delta_pp",
    )


@query(
    "measure_effect",
    with_marts(
        "performance",
        f"""
SELECT action_code, COUNT(*) AS completed_actions, CAST(SUM(actual_impact_amount) AS DOUBLE) AS realized_impact,
  {mean_sql('margin_before_pct')} AS margin_before, {mean_sql('margin_after_pct')} AS margin_after,
  {gain_sql('margin_after_pct', 'margin_before_pct')} AS margin_gain_pp, {gain_sql('sla_after_pct', 'sla_before_pct')} AS sla_gain_pp,
  {gain_sql('coverage_after_pct', 'coverage_before_pct')} AS coverage_gain_pp, {gain_sql('overtime_before_pct', 'overtime_after_pct')} AS overtime_reduction_pp
FROM action_effect GROUP BY 1""",
        facts.MANAGEMENT_CTE,
        EFFECT_SQL,
    ),
)
def measure_effect(spark, sf):
    return measures.effect_measures(action_effects(spark, sf), ["action_code"])


# --- timeline ----------------------------------------------------------------

def plan_months(spark, sf):
    """Planned situation of a customer's month: the largest priority text."""
    words = {"1-URGENT": "COVERAGE_CRITICAL", "2-HIGH": "SLA_DEFICIT", "3-MEDIUM": "ADJUSTMENT_PENDING", "4-NOT SPECIFIED": "SCOPE_FORMALIZED"}
    months = table(spark, sf, "orders").groupBy(
        F.col("o_custkey").alias("contract_key"), month_of("o_orderdate").alias("reference_month")
    ).agg(F.max("o_orderpriority").alias("priority"))
    return months.join(facts.contracts(spark, sf).select("contract_key", "contract_code"), "contract_key").select(
        "contract_key", "contract_code", "reference_month",
        timeline_plan.lookup("priority", words, "ROUTINE").alias("event_code"), F.col("priority").alias("event_note"),
    )


def coded(df, spark, sf):
    return df.join(facts.contracts(spark, sf).select("contract_key", "contract_code"), "contract_key")


def events(spark, sf):
    incidents = facts.incidents(spark, sf).withColumns({"incident_subcategory": F.lit("Pedido urgente"), "root_cause": F.lit("Prioridade")})
    return timeline_plan.timeline(
        timeline_plan.plan_events(plan_months(spark, sf)),
        timeline_plan.adjustment_events(coded(facts.adjustments(spark, sf), spark, sf)),
        timeline_plan.action_events(coded(facts.management_actions(spark, sf), spark, sf)),
        timeline_plan.incident_events(coded(incidents, spark, sf)),
        timeline_plan.risk_events(facts.risk(spark, sf)),
    )


ACTION_NAMES = {c: n for c, n, *_ in config.ACTIONS if c in ("REVIEW_RETROACTIVE", "REINFORCE_COVERAGE", "SLA_RECOVERY_PLAN")}
TIMELINE_SQL = f"""
plan AS (SELECT contract_key, contract_code, reference_month, CASE priority WHEN '1-URGENT' THEN 'COVERAGE_CRITICAL' WHEN '2-HIGH' THEN 'SLA_DEFICIT' WHEN '3-MEDIUM' THEN 'ADJUSTMENT_PENDING'
    WHEN '4-NOT SPECIFIED' THEN 'SCOPE_FORMALIZED' ELSE 'ROUTINE' END AS event_code, priority AS event_note
  FROM (SELECT o_custkey AS contract_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS reference_month, MAX(o_orderpriority) AS priority FROM orders GROUP BY 1, 2) JOIN contract USING (contract_key)),
plan_lag AS (SELECT *, LAG(event_code) OVER (PARTITION BY contract_code ORDER BY reference_month) AS prev FROM plan),
risk_lag AS (SELECT *, LAG(risk_class) OVER (PARTITION BY contract_key ORDER BY reference_month) AS prev FROM risk),
event AS (
  SELECT reference_month AS reference_date, contract_key, contract_code, 'BUSINESS_EVENT' AS event_type,
    CASE event_code WHEN 'COVERAGE_CRITICAL' THEN 'CRITICAL' WHEN 'SLA_DEFICIT' THEN 'HIGH' WHEN 'ADJUSTMENT_PENDING' THEN 'ATTENTION' ELSE 'INFORMATION' END AS event_severity,
    replace(event_code, '_', ' ') AS event_title, event_note AS event_detail, CAST(NULL AS DOUBLE) AS impact_amount, 'PLAN-' || contract_code || '-' || strftime(reference_month, '%Y%m') AS source_key
  FROM plan_lag WHERE event_code <> 'ROUTINE' AND (prev IS NULL OR prev <> event_code)
  UNION ALL
  SELECT COALESCE(approved_date, requested_date, expected_date), a.contract_key, contract_code, 'ADJUSTMENT',
    CASE process_status WHEN 'REQUESTED' THEN 'ATTENTION' WHEN 'PENDING' THEN 'HIGH' ELSE 'INFORMATION' END,
    {case_sql('process_type', config.PROCESS_TYPE_LABELS, "'" + config.PROCESS_TYPE_OTHER + "'")} || ' — ' || {case_sql('process_status', config.PROCESS_STATUS_LABELS, 'lower(process_status)')},
    pending_reason, CAST(CASE WHEN process_status = 'APPROVED' THEN retroactive_amount ELSE CAST(previous_amount * requested_pct AS DECIMAL(18,2)) END AS DOUBLE), adjustment_number
  FROM adjustment a JOIN contract c ON c.contract_key = a.contract_key
  UNION ALL
  SELECT recommendation_date, m.contract_key, contract_code, 'MANAGEMENT_ACTION', CASE action_status WHEN 'IN_PROGRESS' THEN 'ATTENTION' ELSE 'INFORMATION' END,
    {case_sql('action_code', ACTION_NAMES)}, 'Status: ' || action_status || '. Resultado: ' || COALESCE(standardized_result, 'não informado') || '.',
    CAST(COALESCE(actual_impact_amount, estimated_impact_amount) AS DOUBLE), 'ACTION-' || management_action_key
  FROM management m JOIN contract c ON c.contract_key = m.contract_key
  UNION ALL
  SELECT CAST(opened_at AS DATE), i.contract_key, contract_code, 'SLA', severity, 'Ocorrência crítica — Pedido urgente', 'Prioridade', CAST(deduction_amount + penalty_amount AS DOUBLE), incident_number
  FROM incident i JOIN contract c ON c.contract_key = i.contract_key WHERE severity = 'CRITICAL'
  UNION ALL
  SELECT reference_month, contract_key, contract_code, 'RISK_CHANGE', risk_class, 'Risco alterado para ' || risk_class,
    'Índice: ' || contract_risk_score || '. Margem: ' || CAST(CAST(round(contribution_margin_pct * 10000) AS DECIMAL(18,0)) * 0.0100 AS DECIMAL(18,4)) || '%.',
    CAST(CAST(margin_leakage_amount AS DECIMAL(18,2)) AS DOUBLE), 'RISK-' || contract_code || '-' || strftime(reference_month, '%Y%m')
  FROM risk_lag WHERE risk_class IN ('HIGH', 'CRITICAL') AND (prev IS NULL OR prev <> risk_class))"""


@query(
    "timeline",
    with_marts(
        "risk",
        "SELECT reference_date, CAST(date_trunc('month', reference_date) AS DATE) AS reference_month, contract_key, contract_code, event_type, event_severity, event_title, event_detail, impact_amount, source_key FROM event",
        facts.MANAGEMENT_CTE,
        TIMELINE_SQL,
    ),
)
def timeline(spark, sf):
    return events(spark, sf)


@query(
    "bi_timeline",
    with_marts(
        "risk",
        """SELECT reference_date AS data_evento, CAST(date_trunc('month', reference_date) AS DATE) AS mes_referencia, contract_key AS chave_contrato, contract_code AS codigo_contrato, event_type AS tipo_evento,
  event_severity AS gravidade, event_title AS titulo_evento, event_detail AS detalhe_evento, impact_amount AS impacto_financeiro, source_key AS chave_origem,
  strftime(reference_date, '%d/%m/%Y') || ' · ' || event_title || CASE WHEN COALESCE(trim(event_detail), '') = '' THEN '' ELSE ' — ' || event_detail END AS evento_resumo FROM event""",
        facts.MANAGEMENT_CTE,
        TIMELINE_SQL,
    ),
)
def bi_timeline(spark, sf):
    return bi.vw_linha_tempo(events(spark, sf))


DRILL_FROM = "1996-07-01"


@query(
    "measure_drill_across",
    with_marts(
        "risk",
        f"""
SELECT manager_name, reference_month, {{columns}} FROM (
  SELECT c.manager_name, reference_month, CAST(SUM(net_revenue) AS DOUBLE) AS net_revenue, CAST(SUM(contribution_margin) AS DOUBLE) AS margin, {{ratio}} AS margin_pct
  FROM risk r JOIN contract c ON c.contract_key = r.contract_key WHERE reference_month >= DATE '{DRILL_FROM}' GROUP BY ALL)
FULL JOIN (
  SELECT manager_name, CAST(date_trunc('month', completion_date) AS DATE) AS reference_month, COUNT(*) AS completed_actions, CAST(SUM(CAST(actual_impact_amount AS DECIMAL(18,2))) AS DOUBLE) AS realized_impact
  FROM action_effect JOIN (SELECT contract_key, manager_name FROM contract) USING (contract_key) WHERE date_trunc('month', completion_date) >= DATE '{DRILL_FROM}' GROUP BY ALL) USING (manager_name, reference_month)
FULL JOIN (
  SELECT manager_name, CAST(date_trunc('month', reference_date) AS DATE) AS reference_month, COUNT(*) AS events, CAST(SUM(CAST(impact_amount AS DECIMAL(18,2))) AS DOUBLE) AS event_impact
  FROM event JOIN (SELECT contract_key, manager_name FROM contract) USING (contract_key) WHERE date_trunc('month', reference_date) >= DATE '{DRILL_FROM}' GROUP BY ALL) USING (manager_name, reference_month)""".replace(
            "{columns}", "net_revenue, margin, margin_pct, completed_actions, realized_impact, events, event_impact"
        ).replace("{ratio}", ratio_sql("SUM(contribution_margin)", "SUM(net_revenue)")),
        facts.MANAGEMENT_CTE,
        EFFECT_SQL,
        TIMELINE_SQL,
    ),
)
def measure_drill_across(spark, sf):
    """Margin, completed actions and event impact by manager and month."""
    names = {"net_revenue": "Receita Líquida", "margin": "Margem de Contribuição", "margin_pct": "Margem %"}
    grains = [
        drill.contract_months(facts.risk(spark, sf).drop("manager_name"), names),
        drill.effects(action_effects(spark, sf)), drill.events(events(spark, sf)),
    ]
    recent = {"reference_month": F.col("reference_month") >= F.lit(DRILL_FROM).cast("date")}
    return drill.drill_across(grains, facts.contracts(spark, sf), ["manager_name", "reference_month"], recent)


@query("event_annotations", with_marts("risk", "SELECT reference_month, contract_code, event_code, event_note, contract_key FROM plan", facts.MANAGEMENT_CTE, TIMELINE_SQL))
def event_annotations(spark, sf):
    return timeline_plan.event_annotations(plan_months(spark, sf).drop("contract_key"), facts.contracts(spark, sf))


# --- report views ------------------------------------------------------------

LABEL_SQL = f"{case_sql('risk_class', config.RISK_CLASS_LABELS)} AS classe_risco"
TREND_SQL = f"{case_sql('margin_trend', config.TREND_LABELS)} AS tendencia_margem"
VIEW_SQL = {  # report columns whose SQL stand-in has another name
    "incident_count": "CAST(incidents AS BIGINT)", "critical_incident_count": "CAST(critical_incidents AS BIGINT)",
    "recurrent_incident_count": "CAST(recurrent_incidents AS BIGINT)", "open_adjustment_count": "CAST(open_adjustments AS BIGINT)",
    "open_positions": "CAST(open_positions AS BIGINT)", "days_to_renewal": "CAST(days_to_renewal AS BIGINT)",
    "date_key": "CAST(date_key AS BIGINT)",
}
VIEW_PLAIN = {
    "reference_month", "contract_key", "contract_code", "client_name", "business_segment", "service_name", "manager_name",
    "complexity_level", "renewal_date", "average_replacement_days",
}


def view_sql(columns: dict[str, str]) -> str:
    out = []
    for name, source in columns.items():
        if source == "risk_class":
            out.append(LABEL_SQL)
        elif source == "margin_trend":
            out.append(TREND_SQL)
        elif source in VIEW_SQL:
            out.append(f"{VIEW_SQL[source]} AS {name}")
        elif source in VIEW_PLAIN:
            out.append(f"{source} AS {name}")
        else:
            out.append(f"CAST({source} AS DOUBLE) AS {name}")
    return ", ".join(out)


@query("one_to_one_join", with_marts("risk", f"SELECT {view_sql(bi.DESEMPENHO)} FROM risk"))
def one_to_one_join(spark, sf):
    """Monthly performance with its score: one row per contract-month, checked by key."""
    return bi.vw_desempenho_mensal(facts.risk(spark, sf))


@query(
    "bi_queue",
    with_marts(
        "action",
        f"""
SELECT reference_month AS mes_referencia, contract_key AS chave_contrato, contract_code AS codigo_contrato, client_name AS cliente, CAST(contribution_margin_pct AS DOUBLE) AS margem_pct,
  CAST(contract_risk_score AS DOUBLE) AS score_risco, {LABEL_SQL}, code AS codigo_acao, {case_sql('code', config.ACTION_REASONS)} AS justificativa, CAST(action_impact_amount AS DOUBLE) AS impacto_acao,
  CAST(action_recoverable_amount AS DOUBLE) AS valor_recuperavel, CAST(priority AS DOUBLE) AS score_prioridade, CAST(portfolio_priority_rank AS BIGINT) AS prioridade,
  contract_code || ' · ' || client_name || ' — ' || {case_sql('code', {c: n for c, n, *_ in config.ACTIONS})} AS acao_recomendada FROM queue""",
        marts.QUEUE_SQL,
    ),
)
def bi_queue(spark, sf):
    return bi.vw_fila_acoes(actions_plan.current_queue(actions_plan.monthly_queue(facts.stored_latest(spark, sf))))


# --- measures ----------------------------------------------------------------

def total(*columns: str) -> str:
    return ", ".join(f"CAST(SUM({c}) AS DOUBLE) AS {n}" for c, n in (x.split(":") for x in columns))


def weighted_sql(column: str) -> str:
    """Revenue-weighted mean of a four-decimal column."""
    exact = f"SUM(CAST({column} AS DECIMAL(9,4)) * CAST(net_revenue AS DECIMAL(18,2)))"
    return ratio_sql(exact, "SUM(net_revenue)", scale=6)


SUMS = {
    "net_revenue": "Receita Líquida", "total_cost": "Custo Total", "contribution_margin": "Margem de Contribuição",
    "margin_leakage": "Vazamento de Margem", "identified_loss": "Perda Identificada", "recoverable": "Valor Recuperável",
    "open_adjustments": "Reajustes Abertos",
}


@query(
    "measure_sum",
    with_marts(
        "action",
        f"""SELECT manager_name, reference_month, {total('net_revenue:net_revenue', 'total_cost:total_cost', 'contribution_margin:contribution_margin', 'margin_leakage_amount:margin_leakage',
    'identified_loss_amount:identified_loss', 'recoverable_amount:recoverable')}, CAST(SUM(open_adjustments) AS BIGINT) AS open_adjustments FROM action GROUP BY 1, 2""",
    ),
)
def measure_sum(spark, sf):
    return measures.measure(facts.recommended(spark, sf), SUMS, ["manager_name", "reference_month"])


RATIOS = {
    "margin_pct": "Margem %", "coverage_pct": "Cobertura %", "overtime_pct": "Horas Extras %", "absenteeism_pct": "Absenteísmo %", "sla_pct": "SLA %",
}
SLA_SQL = "((2 * SUM(CASE WHEN incidents = 0 THEN 1 ELSE sla_compliance_rate END) * 10000 + COUNT(*)) // (2 * COUNT(*))) / 10000.0 AS sla_pct"


@query(
    "measure_ratio",
    with_marts(
        "risk",
        f"""SELECT service_name, reference_month, {ratio_sql('SUM(contribution_margin)', 'SUM(net_revenue)')} AS margin_pct, {ratio_sql('SUM(filled_positions)', 'SUM(planned_positions)')} AS coverage_pct,
  {ratio_sql('SUM(overtime_hours)', 'SUM(regular_hours)')} AS overtime_pct, {ratio_sql('SUM(absence_hours)', 'SUM(planned_hours)')} AS absenteeism_pct, {SLA_SQL} FROM risk GROUP BY 1, 2""",
    ),
)
def measure_ratio(spark, sf):
    return measures.measure(facts.recommended(spark, sf), RATIOS, ["service_name", "reference_month"])


@query(
    "measure_weighted",
    with_marts("risk", f"SELECT manager_name, {weighted_sql('target_margin_pct')} AS target_margin, {weighted_sql('contract_risk_score')} AS risk_score FROM risk GROUP BY 1"),
)
def measure_weighted(spark, sf):
    names = {"target_margin": "Meta Margem Ponderada", "risk_score": "Score de Risco Ponderado"}
    return measures.measure(facts.recommended(spark, sf), names, ["manager_name"])


@query(
    "measure_gap",
    with_marts(
        "risk",
        f"SELECT reference_month, round((m - t) * 10000) / 100.0 AS gap_pp FROM (SELECT reference_month, {ratio_sql('SUM(contribution_margin)', 'SUM(net_revenue)')} AS m, {weighted_sql('target_margin_pct')} AS t FROM risk GROUP BY 1)",
    ),
)
def measure_gap(spark, sf):
    return measures.measure(facts.recommended(spark, sf), {"gap_pp": "Gap de Margem p.p."}, ["reference_month"])


@query(
    "measure_latest",
    with_marts(
        "action",
        f"""SELECT {total('net_revenue:net_revenue', 'recoverable_amount:recoverable')}, {ratio_sql('SUM(contribution_margin)', 'SUM(net_revenue)')} AS margin_pct,
  CAST(SUM(CASE WHEN contract_risk_score >= 60 THEN net_revenue ELSE 0 END) AS DOUBLE) AS revenue_at_risk, COUNT(*) FILTER (WHERE risk_class = 'CRITICAL') AS critical_contracts,
  COUNT(*) FILTER (WHERE code NOT IN ('MAINTAIN', 'EXPAND')) AS contracts_with_action FROM action {LATEST}""",
    ),
)
def measure_latest(spark, sf):
    names = {
        "net_revenue": "Receita Líquida", "recoverable": "Valor Recuperável", "margin_pct": "Margem %",
        "revenue_at_risk": "Receita em Risco", "critical_contracts": "Contratos Críticos", "contracts_with_action": "Contratos com Ação",
    }
    return _latest(spark, sf, names)


@query(
    "measure_prior_month",
    with_marts(
        "base",
        f"""SELECT reference_month, margin_pct, prior_value, round((margin_pct - prior_value) * 10000) / 100.0 AS change_pp FROM (
  SELECT a.reference_month, a.margin_pct, b.margin_pct AS prior_value FROM m a LEFT JOIN m b ON b.reference_month = CAST(a.reference_month - INTERVAL 1 MONTH AS DATE))""",
        f"m AS (SELECT reference_month, {ratio_sql('SUM(contribution_margin)', 'SUM(net_revenue)')} AS margin_pct FROM base GROUP BY 1)",
    ),
)
def measure_prior_month(spark, sf):
    months = facts.base(spark, sf).groupBy("reference_month").agg(
        rate(F.sum("contribution_margin"), F.sum("net_revenue")).alias("margin_pct")
    )
    return measures.with_prior_month(materialize(months, "margin_by_month"), "margin_pct")


@query(
    "measure_rolling_12m",
    """WITH m AS (SELECT c_mktsegment AS segment, CAST(date_trunc('month', o_orderdate) AS DATE) AS reference_month, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS net_revenue FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT segment, reference_month, CAST(net_revenue AS DOUBLE) AS net_revenue,
  CAST(SUM(net_revenue) OVER (PARTITION BY segment ORDER BY year(reference_month) * 12 + month(reference_month) RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS DOUBLE) AS net_revenue_12m FROM m""",
)
def measure_rolling_12m(spark, sf):
    months = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("segment"), month_of("o_orderdate").alias("reference_month"))
        .agg(F.sum(money("o_totalprice")).alias("net_revenue"))
    )
    return measures.rolling_12_months(months, "net_revenue", ["segment"])


@query(
    "measure_period",
    """SELECT c_mktsegment AS segment, strftime(MIN(o_orderdate), '%m/%Y') || ' a ' || strftime(MAX(o_orderdate), '%m/%Y') AS period FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def measure_period(spark, sf):
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    months = rows.select(F.col("c_mktsegment").alias("segment"), month_of("o_orderdate").alias("reference_month"))
    return measures.selected_period(months, ["segment"])


@query(
    "measure_contract360",
    with_marts(
        "driver",
        """SELECT d.contract_key, MAX(CAST(a.days_to_renewal AS BIGINT)) AS days_to_renewal, CAST(SUM(d.driver_score) AS BIGINT) AS driver_points, CAST(MAX(d.impact) AS DOUBLE) AS largest_impact
FROM driver d JOIN action a ON a.contract_key = d.contract_key AND a.reference_month = d.reference_month WHERE d.reference_month = (SELECT MAX(reference_month) FROM action) GROUP BY 1""",
    ),
)
def measure_contract360(spark, sf):
    """Latest renewal distance and driver points; impacts repeat across drivers, so never their sum."""
    latest = facts.latest(spark, sf, facts.risk)
    return risk_drivers(latest, keep=["days_to_renewal"]).groupBy("contract_key").agg(
        F.max("days_to_renewal").alias("days_to_renewal"), F.sum("driver_score").alias("driver_points"),
        F.max("estimated_impact_amount").alias("largest_impact"),
    )


@query(
    "measure_latest_ops",
    with_marts(
        "action",
        f"""SELECT {ratio_sql('SUM(filled_positions)', 'SUM(planned_positions)')} AS coverage_pct, {ratio_sql('SUM(overtime_hours)', 'SUM(regular_hours)')} AS overtime_pct,
  {ratio_sql('SUM(absence_hours)', 'SUM(planned_hours)')} AS absenteeism_pct, CAST(SUM(uncovered_positions) AS DOUBLE) AS uncovered_positions, CAST(SUM(open_positions) AS BIGINT) AS open_positions FROM action {LATEST}""",
    ),
)
def measure_latest_ops(spark, sf):
    names = {
        "coverage_pct": "Cobertura %", "overtime_pct": "Horas Extras %", "absenteeism_pct": "Absenteísmo %",
        "uncovered_positions": "Postos Descobertos", "open_positions": "Vagas Abertas",
    }
    return _latest(spark, sf, names)


def _latest(spark, sf, names):
    stored = facts.stored_sums(spark, sf)
    return measures.latest_measure(facts.latest(spark, sf, stored=stored), names, source=stored[1])


@query(
    "measure_latest_sla",
    with_marts(
        "action",
        f"""SELECT {SLA_SQL}, CAST(SUM(incidents) AS BIGINT) AS incidents, CAST(SUM(critical_incidents) AS BIGINT) AS critical_incidents, CAST(SUM(recurrent_incidents) AS BIGINT) AS recurrent_incidents,
  {weighted_sql('quality_risk_score')} AS quality_risk, 0.95 AS sla_target FROM action {LATEST}""".replace("0.95 AS", "CAST(0.95 AS DOUBLE) AS"),
    ),
)
def measure_latest_sla(spark, sf):
    names = {
        "sla_pct": "SLA %", "incidents": "Ocorrências", "critical_incidents": "Ocorrências Críticas",
        "recurrent_incidents": "Ocorrências Reincidentes", "quality_risk": "Risco Qualidade",
    }
    return _latest(spark, sf, names).withColumn("sla_target", F.lit(config.parameter_values()["sla_target"]))


@query(
    "measure_renewal_90d",
    with_marts(
        "action",
        f"""SELECT COUNT(*) AS contracts, CAST(COALESCE(SUM(net_revenue), 0) AS DOUBLE) AS net_revenue, CAST(COALESCE(SUM(recoverable_amount), 0) AS DOUBLE) AS recoverable_amount
FROM action {LATEST} AND days_to_renewal <= 90""",
    ),
)
def measure_renewal_90d(spark, sf):
    stored = facts.stored_sums(spark, sf)
    return measures.renewal_within(facts.latest(spark, sf, stored=stored), source=stored[1])


@query(
    "measure_open_items",
    with_marts(
        "action",
        """SELECT reference_month, CAST(SUM(open_adjustments) AS BIGINT) AS open_adjustments, COUNT(DISTINCT contract_key) FILTER (WHERE open_adjustments > 0) AS contracts_with_open_adjustment,
  CAST(SUM(recoverable_amount) AS DOUBLE) AS recoverable FROM action GROUP BY 1""",
    ),
)
def measure_open_items(spark, sf):
    names = {
        "open_adjustments": "Reajustes Abertos", "contracts_with_open_adjustment": "Contratos com Reajuste Aberto",
        "recoverable": "Valor Recuperável",
    }
    return measures.measure(facts.recommended(spark, sf), names, ["reference_month"])


@query(
    "measure_by_manager",
    with_marts(
        "action",
        """SELECT a.manager_name, CAST(SUM(open_adjustments) FILTER (WHERE reference_month = last_month) AS BIGINT) AS open_adjustments,
  COUNT(DISTINCT contract_key) FILTER (WHERE open_adjustments > 0) AS contracts_with_open_adjustment,
  COUNT(DISTINCT contract_key) FILTER (WHERE code NOT IN ('MAINTAIN', 'EXPAND')) AS contracts_with_action,
  COUNT(DISTINCT contract_key) FILTER (WHERE risk_class = 'CRITICAL') AS critical_contracts
FROM action a JOIN (SELECT manager_name, MAX(reference_month) AS last_month FROM action GROUP BY 1) l ON l.manager_name = a.manager_name GROUP BY 1""",
    ),
)
def measure_by_manager(spark, sf):
    """Contracts over all months of a manager are counted once; open processes are those of the last month."""
    names = {
        "open_adjustments": "Reajustes Abertos", "contracts_with_open_adjustment": "Contratos com Reajuste Aberto",
        "contracts_with_action": "Contratos com Ação", "critical_contracts": "Contratos Críticos",
    }
    return measures.measure(facts.recommended(spark, sf), names, ["manager_name"])


# --- report views with all their columns ---------------------------------------

COUNTS = ["active_contract_count", "critical_contract_count", "high_risk_contract_count", "contracts_requiring_action"]


def columns_sql(columns: dict[str, str], plain: Sequence[str], given: dict[str, str] | None = None) -> str:
    """Report columns in SQL: ``plain`` as they are, ``given`` by expression, the rest as floating point."""
    given = given or {}
    pick = lambda c: given[c] if c in given else c if c in plain else f"CAST({c} AS DOUBLE)"
    return ", ".join(f"{pick(source)} AS {name}" for name, source in columns.items())


@query("bi_summary", with_marts("action", f"SELECT {columns_sql(bi.RESUMO, ['reference_month', *COUNTS])} FROM ({marts.EXEC_SQL})"))
def bi_summary(spark, sf):
    return bi.vw_resumo_executivo(executive_plan.executive_summary(facts.recommended(spark, sf)))


LOSS_TEXT = {
    "loss_name_pt": case_sql("loss_code", {c: n for c, n, *_ in config.LOSS_CAUSES}),
    "calculation_note": case_sql("loss_code", {c: note for c, *_, note in config.LOSS_CAUSES}),
    "loss_nature": "nature",
}


@query("bi_losses", with_marts("loss", f"SELECT {columns_sql(bi.PERDAS, ['reference_month', 'contract_key', 'contract_code', 'loss_code'], LOSS_TEXT)} FROM loss"))
def bi_losses(spark, sf):
    return bi.vw_perdas_margem(loss_plan.loss_bridge(facts.performance(spark, sf)))


DRIVER_TEXT = {
    "driver_name_pt": case_sql("driver_code", {code: name for _, code, name, *_ in config.DRIVERS}),
    "driver_score": "CAST(driver_score AS BIGINT)", "driver_rank": "CAST(driver_rank AS BIGINT)", "estimated_impact_amount": "CAST(impact AS DOUBLE)",
}


@query("bi_drivers", with_marts("driver", f"SELECT {columns_sql(bi.FATORES, ['reference_month', 'contract_key', 'contract_code', 'risk_pillar', 'driver_code'], DRIVER_TEXT)} FROM driver"))
def bi_drivers(spark, sf):
    return bi.vw_fatores_risco(risk_drivers(facts.risk(spark, sf)))


ACTION_TEXT = {"action_name_pt": case_sql("action_code", {c: n for c, n, *_ in config.ACTIONS}), "margin_delta_pp": DELTA_SQL}
EFFECT_PLAIN = ["management_action_key", "contract_key", "contract_code", "action_code", "start_date", "completion_date", *EFFECT_COLUMNS]


@query(
    "bi_effect",
    with_marts(
        "performance",
        f"SELECT {columns_sql(bi.EFEITO, EFFECT_PLAIN, ACTION_TEXT)} FROM action_effect JOIN (SELECT DISTINCT contract_key, contract_code FROM performance) USING (contract_key)",
        facts.MANAGEMENT_CTE,
        EFFECT_SQL,
    ),
)
def bi_effect(spark, sf):
    codes = facts.performance(spark, sf).select("contract_key", "contract_code").distinct()
    return bi.vw_efeito_acoes(action_effects(spark, sf).join(codes, "contract_key"))


SNAPSHOT_TEXT = {
    "risk_class": case_sql("risk_class", config.RISK_CLASS_LABELS), "margin_trend": case_sql("margin_trend", config.TREND_LABELS),
    "main_risk_driver_pt": case_sql("main_driver", {code: name for _, code, name, *_ in config.DRIVERS}),
    "main_risk_driver_impact": "CAST(main_impact AS DOUBLE)", "recommended_action_code": "code",
    "recommended_action_name_pt": case_sql("code", {c: n for c, n, *_ in config.ACTIONS}),
    "days_to_renewal": "CAST(days_to_renewal AS BIGINT)", "portfolio_priority_rank": "CAST(portfolio_priority_rank AS BIGINT)",
}


@query("bi_portfolio", with_marts("driver", f"SELECT {columns_sql(bi.PORTFOLIO, VIEW_PLAIN, SNAPSHOT_TEXT)} FROM snapshot", marts.QUEUE_SQL, marts.PORTFOLIO_SQL))
def bi_portfolio(spark, sf):
    return bi.vw_portfolio_atual(marts.portfolio(spark, sf))


@query("bi_contracts", with_marts("driver", f"SELECT {columns_sql(bi.CONTRATOS, VIEW_PLAIN)} FROM snapshot", marts.QUEUE_SQL, marts.PORTFOLIO_SQL))
def bi_contracts(spark, sf):
    """Contracts of the latest month only, as the report filters by them."""
    return bi.vw_contratos(marts.portfolio(spark, sf))
