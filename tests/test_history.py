"""Plan months to facts to 24 months of marts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from contractlens.functions.scalar import money
from contractlens.operators import checks, expectations, overlay
from contractlens.plans import bi, history, marts
from tests import company
from tests.conftest import rows


def key_of(c):
    return F.substring(c, 4, 3).cast("int")


@pytest.fixture(scope="module")
def plan(spark):
    factors = [(company.code(n), n, float(a), f) for (n, *_, a, _, _, _, _), f in ((c, company.NORMAL_COST[c[0]]) for c in company.CONTRACTS)]
    contracts = spark.createDataFrame(factors, "contract_code string, contract_number int, amount double, factor string").select(
        "contract_code", "contract_number", money("amount").alias("base_monthly_amount"), F.col("factor").cast("decimal(9,4)").alias("base_cost_factor")
    )
    grid = history.month_grid(contracts, F.lit(company.FIRST_MONTH).cast("date"), company.MONTHS)
    return overlay.overlay_rules(grid, company.plan_rules(spark), "contract_code", "reference_month", list(company.RULE_COLUMNS)).cache()


@pytest.fixture(scope="module")
def facts(spark, plan):
    year = F.lit(2024)
    cost_lines = [(company.code(n), *company.CATEGORIES[k][1:], float(b), bool(e)) for n, lines in company.COSTS.items() for k, _, b, e in lines]
    template = spark.createDataFrame(cost_lines, "contract_code string, cost_category string, cost_subcategory string, is_labor_cost boolean, b double, is_extraordinary boolean").withColumn("baseline_budget_amount", money("b"))
    roles = [(company.code(w[0]), w[1], float(w[2]), float(w[5]), float(w[14])) for w in company.WORKFORCE]
    positions = spark.createDataFrame(roles, "contract_code string, role_code string, p double, h double, c double").select(
        "contract_code", "role_code", F.col("p").cast("decimal(10,2)").alias("baseline_planned_positions"),
        money("h").alias("baseline_planned_hours"), money("c").alias("baseline_emergency_coverage_cost"),
    )
    keyed = lambda df: df.withColumn("contract_key", key_of("contract_code"))
    revenue = keyed(history.revenue_amounts(plan)).withColumns({"invoiced_amount": F.col("net_revenue"), "received_amount": F.col("net_revenue")})
    columns = ["contract_key", "contract_code", "reference_month", "actual_amount", "budget_amount", "cost_subcategory", "is_extraordinary"]
    cost = keyed(history.cost_from_template(plan, template, year)).select(*columns).unionByName(keyed(history.one_off_costs(plan)).select(*columns))
    operation = keyed(history.operation_from_template(plan, positions, year))
    incidents = keyed(history.incident_amounts(history.expand_incidents(plan))).withColumns(
        {"incident_number": F.concat_ws("-", F.lit("INC"), "contract_code", F.date_format("reference_month", "yyyyMM"), "incident_sequence"),
         "incident_subcategory": F.lit("Posto descoberto"), "root_cause": F.lit("Ausência")}
    )
    directory = spark.createDataFrame(
        [(n, company.code(n), f"C{c:03d}", f"Cliente {c}", "SEG", s, s, f"G{g:03d}", f"Gestor {g}", cx, ren, t) for n, c, _, s, g, _, cx, _, ren, _, _, _, t, _ in company.CONTRACTS],
        "contract_key int, contract_code string, client_code string, client_name string, business_segment string, service_code string, service_name string, manager_code string, manager_name string, complexity_level string, ren string, t string",
    )
    from contractlens.functions.parse import parse_date, parse_percent

    directory = directory.withColumns({"renewal_date": parse_date("ren"), "target_margin_pct": parse_percent("t")}).drop("ren", "t")
    process = [
        ("AJ-2", 2, "APPROVED", "2024-05-15", "2025-01-20", "0.0650", "198113.21", "71320.74"),
        ("AJ-8", 8, "REQUESTED", "2024-09-01", None, "0.0710", "410000", "0"),
        ("AJ-5", 5, "PENDING", "2025-09-10", None, "0.1800", "128000", "0"),
    ]
    adjustments = spark.createDataFrame([(i, *p) for i, p in enumerate(process)], "adjustment_key int, adjustment_number string, contract_key int, process_status string, e string, a string, p string, prev string, retro string").selectExpr(
        "adjustment_key", "adjustment_number", "contract_key", "process_status", "'ADJUSTMENT' process_type", "cast(e as date) expected_date", "cast(null as date) requested_date",
        "cast(a as date) approved_date", "cast(p as decimal(9,4)) requested_pct", "cast(prev as decimal(18,2)) previous_amount", "cast(retro as decimal(18,2)) retroactive_amount", "'x' pending_reason",
    )
    actions = spark.createDataFrame([(i, *e) for i, e in enumerate(company.ACTION_EVENTS)], "management_action_key int, contract_key int, action_code string, r string, s string, c string, action_status string, est string, act string, standardized_result string").selectExpr(
        "management_action_key", "contract_key", "action_code", "cast(r as date) recommendation_date", "cast(s as date) start_date", "cast(c as date) completion_date",
        "action_status", "cast(est as decimal(18,2)) estimated_impact_amount", "cast(act as decimal(18,2)) actual_impact_amount", "standardized_result",
    )
    return marts.Facts(directory, *[f.cache() for f in (revenue, cost, operation, incidents)], adjustments, actions, plan.withColumn("contract_key", key_of("contract_code")))


@pytest.fixture(scope="module")
def built(facts):
    return marts.build_marts(facts)


def test_fact_counts(facts):
    assert (facts.revenue.count(), facts.cost.count(), facts.operation.count()) == (240, 56 * 24 + 1, 21 * 24)


def test_deduction_and_penalty_add_up(facts):
    assert facts.revenue.filter("deductions + penalties <> sla_financial_loss").count() == 0
    assert facts.revenue.filter("net_revenue <> gross_revenue - commercial_discounts - deductions - penalties").count() == 0


def test_mart_counts(built):
    counts = {n: built[n].count() for n in ("contract_month", "executive_summary", "action_queue", "portfolio")}
    assert counts == {"contract_month": 240, "executive_summary": 24, "action_queue": 10, "portfolio": 10}
    assert built["timeline"].count() > 20


def test_last_month(built):
    queue = {r.contract_code: r.recommended_action_code for r in built["action_queue"].collect()}
    assert {c: queue[c] for c in company.EXPECTED_LAST_ACTIONS} == company.EXPECTED_LAST_ACTIONS
    assert built["portfolio"].filter("margin_trend = 'INSUFFICIENT_HISTORY'").count() == 0
    assert str(built["portfolio"].first().reference_month) == "2026-06-01"


def test_expected_movements(spark, built):
    """Contract, measure before and after, the two periods, relation."""
    asked = [
        ("improves after the action", "CT-001", "margin", "margin", "2025-12-01", "2025-12-01", "2026-06-01", "2026-06-01", "rises"),
        ("recovers the service level", "CT-004", "sla", "sla", "2025-01-01", "2025-06-01", "2026-01-01", "2026-06-01", "rises"),
        ("formalises the scope", "CT-003", "unbilled", "additional", "2025-07-01", "2025-11-01", "2025-12-01", "2026-06-01", "both_positive"),
        ("one-off recovers", "CT-006", "margin", "margin", "2024-11-01", "2024-11-01", "2024-12-01", "2024-12-01", "rises"),
    ]
    days = ["before_from", "before_to", "after_from", "after_to"]
    expected = spark.createDataFrame(asked, ["check_name", "contract_code", "measure_before", "measure_after", *days, "relation"])
    expected = expected.withColumns({d: F.col(d).cast("date") for d in days})
    measures = {
        "margin": F.col("contribution_margin_pct"), "sla": F.when(F.col("incident_count") == 0, 1).otherwise(F.col("sla_compliance_rate")),
        "unbilled": F.col("unbilled_scope_estimate"), "additional": F.col("additional_services"),
    }
    moved = expectations.directions(built["contract_month"], expected, "contract_code", "reference_month", measures)
    assert rows(moved.filter("not passed")) == [] and moved.count() == len(asked)
    back = expected.withColumns({"relation": F.lit("falls"), "contract_code": F.lit("CT-001")}).filter("measure_before = 'margin'")
    again = expectations.directions(built["contract_month"], back, "contract_code", "reference_month", measures)
    assert again.count() == 2 and again.filter("check_name like 'improves%' and passed").count() == 0


def test_expected_actions_as_a_table(spark, built):
    expected = spark.createDataFrame([*company.EXPECTED_LAST_ACTIONS.items(), ("CT-404", "EXPAND")], "contract_code string, recommended_action_code string")
    found = expectations.differences(built["action_queue"], expected, ["contract_code"], "recommended_action_code")
    assert rows(found.filter("not passed")) == [("CT-404", "EXPAND", None, False)] and found.count() == len(company.EXPECTED_LAST_ACTIONS) + 1
    twice = expectations.differences(built["action_queue"].unionByName(built["action_queue"]), expected, ["contract_code"], "recommended_action_code")
    assert twice.filter("passed").count() == 0
    assert expectations.differences(built["action_queue"], expected.limit(0), ["contract_code"], "recommended_action_code").count() == 0


def test_actions_have_an_effect(built):
    effect = {r.action_code: r for r in built["action_effect"].collect()}
    assert set(effect) == {"REVIEW_RETROACTIVE", "SLA_RECOVERY_PLAN", "REINFORCE_COVERAGE"}
    sla = effect["SLA_RECOVERY_PLAN"]
    assert (sla.months_before, sla.months_after) == (3, 3) and sla.sla_after_pct > sla.sla_before_pct
    assert effect["REINFORCE_COVERAGE"].margin_delta_pp > 0


def test_layers_agree(built):
    gap = checks.reconcile(built["contract_month"], built["executive_summary"], ["reference_month"], "identified_loss_amount")
    assert gap.filter("not passed").count() == 0


def test_report_views(built):
    assert bi.vw_portfolio_atual(built["portfolio"]).count() == 10
    assert bi.vw_fila_acoes(built["action_queue"]).filter("acao_recomendada like 'CT-% · % — %'").count() == 10
    assert bi.vw_linha_tempo(built["timeline"]).filter("evento_resumo like '__/__/____ · %'").count() == built["timeline"].count()
    effect = bi.vw_efeito_acoes(built["action_effect"])
    assert effect.count() == 3 and effect.filter("acao is null or acao = codigo_acao").count() == 0
    shown = {r[0] for r in rows(bi.vw_desempenho_mensal(built["contract_month"]).select("classe_risco").distinct())}
    assert shown and shown <= {"Baixo", "Atenção", "Alto", "Crítico"}
    assert bi.vw_perdas_margem(built["margin_loss_bridge"]).count() > 0 and bi.vw_fatores_risco(built["risk_drivers"]).count() > 0
    assert bi.vw_resumo_executivo(built["executive_summary"]).count() == 24


def test_exact_ratio_is_opt_in(facts):
    plain = marts.build_marts(facts)["contract_month"].filter("sla_compliance_rate > 0 and sla_compliance_rate < 1").count()
    exact = marts.build_marts(facts, exact_ratio=True)["contract_month"].filter("sla_compliance_rate > 0 and sla_compliance_rate < 1").count()
    assert plain == 0 and exact > 0
