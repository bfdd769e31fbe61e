"""All marts from facts, and their published refresh."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from contractlens import config
from contractlens.plans import actions, base, effect, executive, loss, parameters, performance, risk, timeline
from contractlens.session import materialize
from contractlens.sources.store import publish


@dataclass
class Facts:
    """Loaded facts and the contract directory.

    ``contracts`` has one row per contract key with client, service and
    manager attributes; cost rows carry their subcategory, incidents their
    subcategory and cause, management actions their action code.
    """

    contracts: DataFrame
    revenue: DataFrame
    cost: DataFrame
    operation: DataFrame
    incidents: DataFrame
    adjustments: DataFrame
    management_actions: DataFrame | None = None
    plan: DataFrame | None = None


def contract_directory(
    contracts: DataFrame, clients: DataFrame, services: DataFrame, managers: DataFrame
) -> DataFrame:
    """Contract versions with the names of their client, service and manager."""
    names = [
        (clients.select("client_code", "client_name", "business_segment"), "client_code"),
        (services.select("service_code", "service_name"), "service_code"),
        (managers.select("manager_code", "manager_name"), "manager_code"),
    ]
    out = contracts.select(
        "contract_key", "contract_code", "client_code", "service_code", "manager_code", "complexity_level",
        "contract_status", "billing_model", "start_date", "end_date", "renewal_date", "target_margin_pct",
    )
    for side, key in names:
        out = out.join(side, key)
    return out


def build_marts(
    facts: Facts, params: dict | None = None, exact_ratio: bool = False, stored_parameters: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Marts in dependency order.

    With ``stored_parameters`` every month is scored with the parameters and rates
    that held in it, and its rows carry them; else ``params`` holds for all months.

    The contract-month row is written once after scoring; every other mart is
    a projection, an explosion or a small aggregation of it, so the facts are
    read a single time.
    """
    params, rates = params or config.parameter_values(), None
    entries = base.ledger(facts.revenue, facts.cost, facts.operation, facts.incidents)
    months = base.monthly_base(entries, facts.contracts, facts.adjustments, exact_ratio)
    if stored_parameters is not None:
        months = materialize(months, "contract_months")
    measured = performance.monthly_performance(months, facts.adjustments, exact_ratio)
    if stored_parameters is not None:
        measured = parameters.attach(measured, stored_parameters, months)
        params, rates = parameters.params(), parameters.rates()
    scored = risk.risk_scores(loss.with_loss_columns(measured, rates=rates), params)
    row = materialize(actions.recommend(scored, params), "contract_month")

    queue = actions.monthly_queue(row)
    recommended = row
    if facts.management_actions is not None:
        # the override comes before the queue, summary and portfolio are built
        queue = actions.close_completed(queue, facts.management_actions)
        recommended = actions.close_completed(row, facts.management_actions)
    queue = materialize(queue, "monthly_queue")
    drivers = risk.risk_drivers(row, params)
    current = materialize(actions.current_queue(queue), "current_queue")
    marts = {
        "contract_month": row,
        "margin_loss_bridge": loss.loss_bridge(row, rates=rates),
        "risk_drivers": drivers,
        "action_queue_monthly": queue,
        "action_queue": current,
        "executive_summary": executive.executive_summary(recommended),
        "portfolio": executive.portfolio_snapshot(row, drivers, current),
    }
    events = [timeline.adjustment_events(_coded(facts.adjustments, facts)), timeline.incident_events(_coded(facts.incidents, facts)), timeline.risk_events(row)]
    if facts.management_actions is not None:
        coded = _coded(facts.management_actions, facts)
        marts["action_effect"] = effect.action_effect(coded, row)
        events.append(timeline.action_events(coded))
    if facts.plan is not None:
        events.append(timeline.plan_events(facts.plan))
    marts["timeline"] = timeline.timeline(*events)
    return marts


def _coded(df: DataFrame, facts: Facts) -> DataFrame:
    if "contract_code" in df.columns:
        return df
    return df.join(facts.contracts.select("contract_key", "contract_code"), "contract_key")


def refresh(facts: Facts, root: str, version: str, stored_parameters: DataFrame | None = None) -> dict[str, DataFrame]:
    """Rebuild every mart and publish them together."""
    marts = build_marts(facts, stored_parameters=stored_parameters)
    publish(facts.revenue.sparkSession, root, version, marts, {"contract_month": ["reference_month"]})
    return marts
