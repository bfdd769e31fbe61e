"""Dimensions with lasting keys, and measures across grains."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from contractlens.plans import drill
from contractlens.plans.dimensions import Dimension, run_dimensions
from contractlens.sources.store import read_table
from tests.conftest import rows

D = dt.date
KINDS = {"unit": Dimension(("unit_code",), "unit_key"), "action": Dimension(("group", "action_code"), "action_key", update=False)}


def unit(spark, data):
    return spark.createDataFrame(data, "unit_code string, name string")


def test_keys_last_over_two_runs(spark, tmp_path):
    root = str(tmp_path)
    seed = spark.createDataFrame([("g", "A", "first"), ("g", "B", "second")], "group string, action_code string, label string")
    run_dimensions(spark, root, {"unit": unit(spark, [("u2", "two"), ("u1", "one"), ("u9", "nine")])}, KINDS)
    assert rows(read_table(spark, root, "unit"), "unit_code", "unit_key", "name") == [("u1", 1, "one"), ("u2", 2, "two"), ("u9", 3, "nine")]
    run_dimensions(spark, root, {"unit": unit(spark, [("u0", "zero"), ("u2", None)]), "action": seed}, KINDS)
    run_dimensions(spark, root, {"action": seed.withColumn("label", F.lit("renamed")).unionByName(
        spark.createDataFrame([("a", "C", "third")], "group string, action_code string, label string"))}, KINDS)
    assert rows(read_table(spark, root, "unit"), "unit_code", "unit_key", "name") == [
        ("u0", 4, "zero"), ("u1", 1, "one"), ("u2", 2, None), ("u9", 3, "nine")]
    assert rows(read_table(spark, root, "action"), "action_code", "action_key", "label") == [("A", 1, "first"), ("B", 2, "second"), ("C", 3, "third")]


def test_bad_deliveries_leave_the_published_version(spark, tmp_path):
    root = str(tmp_path)
    run_dimensions(spark, root, {"unit": unit(spark, [("u1", "one")])}, KINDS)
    for bad, message in (([("u2", "a"), ("u2", "b")], "delivered twice: u2"), ([(None, "a")], "a code is missing")):
        with pytest.raises(Exception, match=message):
            run_dimensions(spark, root, {"unit": unit(spark, bad)}, KINDS)
    with pytest.raises(ValueError, match="unknown"):
        run_dimensions(spark, root, {"place": unit(spark, [])}, KINDS)
    assert rows(read_table(spark, root, "unit"), "unit_key", "unit_code") == [(1, "u1")]


def test_drill_across_keeps_groups_of_every_grain(spark):
    contracts = spark.createDataFrame([(1, "ann"), (2, "bob"), (3, None)], "contract_key long, manager_name string")
    months = spark.createDataFrame([(1, D(2024, 1, 1), 10), (2, D(2024, 1, 1), 5), (1, D(2023, 12, 1), 99)], "contract_key long, reference_month date, net_revenue int")
    happened = spark.createDataFrame([(1, D(2024, 1, 20), 7), (3, D(2024, 1, 3), None), (3, D(2024, 2, 3), 2)], "contract_key long, reference_date date, impact_amount int")
    grains = [drill.Grain(months, {"revenue": F.sum("net_revenue")}), drill.events(happened)]
    since = {"reference_month": F.col("reference_month") >= F.lit("2024-01-01").cast("date")}
    by = ["manager_name", "reference_month"]
    assert rows(drill.drill_across(grains, contracts, by, since)) == [
        (None, D(2024, 1, 1), None, 1, None), (None, D(2024, 2, 1), None, 1, 2), ("ann", D(2024, 1, 1), 10, 1, 7), ("bob", D(2024, 1, 1), 5, None, None)]
    only = since | {"manager_name": F.col("manager_name") == "ann"}
    assert rows(drill.drill_across(grains, contracts, ["reference_month"], only)) == [(D(2024, 1, 1), 10, 1, 7)]
