import pytest

from contractlens import config
from contractlens.plans import marts, parameters
from tests.conftest import rows
from tests.test_history import facts, plan  # noqa: F401


def delivery(spark, *versions):
    return spark.createDataFrame(versions, "parameter_code string, parameter_value string, day string").selectExpr("parameter_code", "parameter_value", "cast(day as date) valid_from")


def test_versions_are_only_added(spark, tmp_path):
    root = str(tmp_path / "parameters")
    parameters.run_parameters(spark, root)
    first = parameters.read_parameters(spark, root)
    assert first.count() == len(config.RISK_PARAMETERS) + len(config.LOSS_CAUSES)
    parameters.run_parameters(spark, root, delivery(spark, ("SLA_TARGET", "0.97", "2025-03-10")))
    after = parameters.read_parameters(spark, root)
    added = after.exceptAll(spark.read.schema(after.schema).parquet(f"{root}/run-1/parameter"))
    assert rows(added.selectExpr("parameter_code", "cast(valid_from as string)", "parameter_group")) == [("SLA_TARGET", "2025-03-01", "QUALITY")]
    parameters.run_parameters(spark, root)
    assert rows(parameters.read_parameters(spark, root)) == rows(after)


@pytest.mark.parametrize(
    "versions",
    [[("NO_SUCH", "1", "2025-01-01")], [("SLA_TARGET", None, "2025-01-01")], [("SLA_TARGET", "1", None)], [("SLA_TARGET", "1", parameters.START)],
     [("SLA_TARGET", "1", "2025-01-01"), ("SLA_TARGET", "2", "2025-01-31")]],
)
def test_wrong_versions_are_errors(spark, versions):
    with pytest.raises(Exception, match="parameter (unknown|without value|given twice)"):
        parameters.with_versions(parameters.seed(spark), delivery(spark, *versions)).collect()


def test_month_without_parameter_is_an_error(spark):
    months = spark.sql("select date'1999-12-01' reference_month")
    with pytest.raises(Exception, match="no parameter"):
        parameters.attach(months, parameters.seed(spark), months).collect()
    none = months.limit(0)
    assert parameters.attach(none, parameters.seed(spark), none).count() == 0


def test_old_months_keep_their_scores(spark, facts):  # noqa: F811
    keep = ["contract_code", "reference_month", "contract_risk_score", "risk_class", "recoverable_amount", "recommended_action_code", "exact_impact"]
    plain = marts.build_marts(facts)
    seeded = marts.build_marts(facts, stored_parameters=parameters.seed(spark))
    assert rows(seeded["contract_month"], *keep) == rows(plain["contract_month"], *keep)
    drivers = ["contract_code", "reference_month", "driver_code", "reference_value", "driver_rank"]
    assert rows(seeded["risk_drivers"], *drivers) == rows(plain["risk_drivers"], *drivers)
    stricter = parameters.with_versions(parameters.seed(spark), delivery(spark, ("OVERTIME_WARN", "0.001", "2026-01-01"), ("RECOVERY_OVERTIME_EXCESS", "0.90", "2026-01-01")))
    changed = marts.build_marts(facts, stored_parameters=stricter)["contract_month"]
    before = "reference_month < '2026-01-01'"
    assert rows(changed.filter(before), *keep) == rows(plain["contract_month"].filter(before), *keep)
    later = "reference_month >= '2026-01-01'"
    assert rows(changed.filter(later), "score_overtime") != rows(plain["contract_month"].filter(later), "score_overtime")
    bridge = lambda m: m["margin_loss_bridge"].selectExpr("sum(recoverable_amount) s").first().s
    assert bridge(seeded) == bridge(plain)

