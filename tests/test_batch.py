"""Batch audit outcomes and profile lookup."""

from __future__ import annotations

import pytest

from contractlens.plans.batch import run_batches
from contractlens.plans.history import contract_profile, cost_template
from tests.conftest import rows


def test_batches_stop_at_the_first_failure(spark):
    data = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    ok = lambda: (data, data.filter("v < 3"), data.filter("v = 3"))
    clean = lambda: (data, data, data.filter("v > 9"))

    def broken():
        raise ValueError("no rows in file")

    seen = []
    with pytest.raises(ValueError):
        run_batches(spark, [(1, "a", ok), (2, "b", clean), (3, "c", broken), (4, "d", ok)], lambda df: seen.append(df.first()))
    assert [(r.batch_id, r.rows_received, r.rows_loaded, r.rows_rejected, r.status) for r in seen] == [
        (1, 3, 2, 1, "PARTIAL"), (2, 3, 3, 0, "SUCCESS"), (3, None, None, None, "FAILED"),
    ]
    assert seen[2].error_message == "no rows in file"


def test_profile_needs_both_types(spark):
    names = "incident_category string, incident_subcategory string, root_cause string"
    types = spark.createDataFrame([("c", "s", "r", 1), ("c", "s", "q", 2)], f"{names}, incident_type_key int")
    columns = ", ".join(f"{role}_{n}" for role in ("primary", "secondary") for n in names.split(", "))
    profile = spark.createDataFrame([("CT-1", "c", "s", "r", "c", "s", "q"), ("CT-2", "c", "s", "r", "x", "y", "z")], f"contract_code string, {columns}")
    assert rows(contract_profile(profile, types)) == [("CT-1", 1, 2)]


def test_cost_template_uses_the_earliest_month(spark):
    costs = spark.createDataFrame(
        [("CT-1", "2025-01-01", 10, 12), ("CT-1", "2025-01-01", -7, None), ("CT-1", "2025-02-01", 99, 99)],
        "contract_code string, m string, actual_amount int, budget_amount int",
    ).selectExpr("contract_code", "cast(m as date) reference_month", "actual_amount", "budget_amount")
    assert rows(cost_template(costs), "baseline_budget_amount") == [(12,), (7,)]
