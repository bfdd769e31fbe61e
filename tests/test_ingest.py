"""Raw files to facts to marts, end to end on the small company."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from contractlens.operators import checks
from contractlens.plans import loading, marts, staging
from contractlens.plans.loading import batch_audit
from contractlens.sources.calendar import calendar
from contractlens.sources.delimited import raw_columns, read_delimited
from contractlens.sources.store import current_version, read_table
from tests import company
from tests.conftest import rows


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    paths = company.write_files(str(tmp_path_factory.mktemp("raw")))
    dims = company.dimensions(spark)
    days = calendar(spark).cache()
    empty = spark.createDataFrame([], loading.CONTRACT_DIMENSION)
    raw, valid, rejected = {}, {}, {}

    def stage(i, name, refs):
        source = staging.SOURCES[name]
        raw[name] = read_delimited(spark, paths[name], raw_columns(source), i).cache()
        ok, bad = staging.stage(source, raw[name], refs, company.PERIOD)
        valid[name], rejected[name] = ok.cache(), bad.cache()

    stage(1, "contract_register", dims | {"contracts": empty})
    contracts = loading.load_contracts(empty, valid["contract_register"]).cache()
    refs = dims | {"contracts": contracts}
    for i, name in enumerate(list(staging.SOURCES)[1:], 2):
        stage(i, name, refs)
    facts = {
        "revenue": loading.load_revenue(None, valid["monthly_measurements"], contracts, days),
        "cost": loading.load_cost(None, valid["operational_costs"], contracts, days, dims["units"], dims["categories"]),
        "operation": loading.load_operation(None, valid["workforce_control"], contracts, days, dims["units"]),
        "incidents": loading.load_incidents(None, valid["sla_incidents"], contracts, days, dims["units"], dims["incident_types"]),
        "adjustments": loading.load_adjustments(None, valid["contract_adjustments"], contracts, days).withColumn(
            "adjustment_key", F.hash("adjustment_number")
        ),
    }
    facts = {k: v.cache() for k, v in facts.items()}
    return {"raw": raw, "valid": valid, "rejected": rejected, "contracts": contracts, "facts": facts, "dims": dims, "days": days}


def test_raw_file_is_text_with_lineage(loaded):
    raw = loaded["raw"]["contract_register"]
    assert rows(raw, "source_row_number") == sorted([(i,) for i in range(1, 13)], key=lambda t: str(t[0]))
    first = raw.filter("source_row_number = 1").first()
    assert (first.contract_code, first.end_date, first.target_margin_pct) == ("CT-001", None, "14,5%")


def test_counts_of_staged_and_rejected_rows(loaded):
    counts = {n: (loaded["valid"][n].count(), loaded["rejected"][n].count()) for n in staging.SOURCES}
    assert counts == {
        "contract_register": (10, 2), "monthly_measurements": (10, 2), "operational_costs": (56, 2),
        "workforce_control": (21, 2), "sla_incidents": (15, 2), "contract_adjustments": (5, 2),
    }


def test_rejection_reasons(loaded):
    reasons = lambda n: dict(rows(loaded["rejected"][n], "source_row_number", "rejection_reason"))
    assert reasons("contract_register") == {
        11: "Código do contrato ausente",
        12: "Cliente não encontrado; Unidade não encontrada para o cliente; Gestor não cadastrado; Data de início inválida; "
        "Valor mensal inválido; Quantidade de postos inválida; Horas contratadas inválidas; Margem-alvo inválida; "
        "Mês-base de reajuste inválido; Data de vigência da versão não definida",
    }
    assert reasons("monthly_measurements") == {11: "Contrato não encontrado", 12: "Competência inválida; Valor contratado inválido"}
    assert reasons("operational_costs") == {
        57: "Contrato não encontrado; Unidade não encontrada para o contrato", 58: "Competência inválida; Valor realizado inválido",
    }
    assert reasons("workforce_control") == {
        22: "Contrato não encontrado; Unidade não encontrada para o contrato", 23: "Competência inválida; Horas previstas inválidas",
    }
    assert reasons("sla_incidents") == {
        16: "Contrato não encontrado; Unidade não encontrada para o contrato", 17: "Encerramento anterior à abertura",
    }
    assert reasons("contract_adjustments") == {6: "Contrato não encontrado", 7: "Data prevista inválida"}


def test_batch_audit(loaded):
    n = "workforce_control"
    audit = batch_audit(4, n, loaded["raw"][n], loaded["valid"][n], loaded["rejected"][n]).first()
    assert (audit.rows_received, audit.rows_loaded, audit.rows_rejected, audit.status) == (23, 21, 2, "PARTIAL")


def test_facts_are_loaded(loaded):
    assert {k: v.count() for k, v in loaded["facts"].items()} == {
        "revenue": 10, "cost": 56, "operation": 21, "incidents": 15, "adjustments": 5,
    }
    assert loaded["contracts"].filter("is_current").count() == 10
    assert loaded["facts"]["incidents"].filter("resolved_within_sla").count() == 6


def test_reload_replaces_the_slice(loaded, spark):
    again = loading.load_revenue(loaded["facts"]["revenue"], loaded["valid"]["monthly_measurements"], loaded["contracts"], loaded["days"])
    assert rows(again, "contract_code", "net_revenue") == rows(loaded["facts"]["revenue"], "contract_code", "net_revenue")


def test_missing_file_fails(spark):
    with pytest.raises(Exception):
        read_delimited(spark, "/nonexistent/raw.csv", ["a"], 1).count()


@pytest.fixture(scope="module")
def january(loaded):
    dims, f = loaded["dims"], loaded["facts"]
    directory = marts.contract_directory(loaded["contracts"], dims["clients"], dims["services"], dims["managers"])
    facts = marts.Facts(directory, f["revenue"], f["cost"], f["operation"], f["incidents"], f["adjustments"])
    return facts, marts.build_marts(facts)


def test_january_actions(january):
    _, built = january
    queue = {r.contract_code: r for r in built["action_queue"].collect()}
    assert len(queue) == 10
    assert {c: queue[c].recommended_action_code for c in company.EXPECTED_ACTIONS} == company.EXPECTED_ACTIONS
    assert sorted(r.portfolio_priority_rank for r in queue.values()) == list(range(1, 11))
    margins = {c: float(r.contribution_margin_pct) for c, r in queue.items()}
    assert margins["CT-001"] < 0.03 and margins["CT-005"] < 0 and margins["CT-007"] > 0.20


def test_january_checks(january):
    _, built = january
    row = built["contract_month"]
    assert row.filter("contract_code = 'CT-004'").first().revenue_penalties == 22000
    assert float(row.filter("contract_code = 'CT-009'").first().overtime_rate) > 0.05
    checks.require(
        checks.report(
            checks.row_count(row, "months", 10),
            checks.unique_grain(row, "grain", ["date_key", "contract_key"]),
            checks.no_row_breaks(row, "score", F.col("contract_risk_score").between(0, 100)),
            checks.no_row_breaks(built["margin_loss_bridge"], "recoverable", F.col("recoverable_amount") <= F.col("loss_amount")),
            checks.row_count(built["portfolio"], "portfolio", 10),
            checks.row_count(built["executive_summary"], "executive", 1),
        )
    )
    with pytest.raises(AssertionError):
        checks.require(checks.row_count(row, "wrong", 9))


def test_wide_losses_equal_the_bridge(january):
    _, built = january
    total = built["margin_loss_bridge"].agg(F.sum("loss_amount"), F.sum("recoverable_amount")).first()
    wide = built["contract_month"].agg(F.sum("identified_loss_amount"), F.sum("recoverable_amount")).first()
    assert tuple(total) == tuple(wide)
    gap = checks.reconcile(built["executive_summary"], built["contract_month"], ["reference_month"], "net_revenue")
    assert gap.filter("not passed").count() == 0


def test_refresh_publishes_a_version(january, spark, tmp_path):
    facts, built = january
    root = str(tmp_path / "marts")
    marts.refresh(facts, root, "v1")
    assert current_version(spark, root) == "v1"
    assert read_table(spark, root, "action_queue").count() == 10
    assert rows(read_table(spark, root, "portfolio"), "contract_code") == rows(built["portfolio"], "contract_code")


def test_new_contract_version(loaded, spark):
    """A changed attribute in a later batch closes the version and opens a new one."""
    staged = loaded["valid"]["contract_register"]
    changed = staged.withColumn("valid_from", F.lit("2025-02-01").cast("date")).withColumn(
        "row_hash", F.when(F.col("contract_code") == "CT-001", F.unhex(F.lit("AA"))).otherwise(F.col("row_hash"))
    )
    merged = loading.load_contracts(loaded["contracts"], changed)
    first = rows(merged.filter("contract_code = 'CT-001'"), "valid_from", "valid_to", "is_current")
    assert [(str(a), str(b), c) for a, b, c in first] == [("2024-01-01", "2025-01-31", False), ("2025-02-01", "None", True)]
    assert merged.count() == 11 and merged.select("contract_key").distinct().count() == 11
    bridge = loading.load_bridge(
        spark.createDataFrame(
            [], "contract_key long, service_code string, revenue_share_pct decimal(9,4), cost_share_pct decimal(9,4), "
            "is_primary_service boolean, valid_from date, valid_to date"
        ),
        merged, staged,
    )
    assert bridge.count() == 10
