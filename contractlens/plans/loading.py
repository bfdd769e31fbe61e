"""Loading staged rows into dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractlens.functions.scalar import date_key
from contractlens.operators.changes import replace_slice, scd2_merge
from contractlens.operators.temporal import effective_dated_join
from contractlens.plans.staging import CONTRACT_HASH

# The attributes of a contract version, in the order its hash takes them.
CONTRACT_ATTRIBUTES = [
    "client_code", "manager_code", "service_code", "contract_status", "billing_model", "complexity_level",
    "start_date", "end_date", "renewal_date", "base_monthly_amount", "contracted_positions", "contracted_hours",
    "target_margin_pct", "adjustment_base_month", "adjustment_index",
]
CONTRACT_DIMENSION = (
    "contract_key long, contract_code string, client_code string, manager_code string, service_code string, "
    "contract_status string, billing_model string, complexity_level string, start_date date, end_date date, "
    "renewal_date date, base_monthly_amount decimal(18,2), contracted_positions decimal(10,2), "
    "contracted_hours decimal(18,2), target_margin_pct decimal(9,4), adjustment_base_month short, "
    "adjustment_index string, valid_from date, valid_to date, is_current boolean, row_hash binary"
)
BRIDGE = (
    "contract_key long, service_code string, revenue_share_pct decimal(9,4), cost_share_pct decimal(9,4), "
    "is_primary_service boolean, valid_from date, valid_to date"
)
assert CONTRACT_HASH == CONTRACT_ATTRIBUTES


def load_contracts(dimension: DataFrame, staged: DataFrame) -> DataFrame:
    return scd2_merge(dimension, staged, "contract_code", "contract_key", CONTRACT_ATTRIBUTES)


def load_bridge(bridge: DataFrame, contracts: DataFrame, staged: DataFrame) -> DataFrame:
    """One full share per current contract delivered in the batch.

    Bridges of closed versions stay as they were.
    """
    current = contracts.filter("is_current").join(staged.select("contract_code"), "contract_code", "left_semi")
    rows = current.select(
        "contract_key", "service_code", F.lit(1).cast("decimal(9,4)").alias("revenue_share_pct"),
        F.lit(1).cast("decimal(9,4)").alias("cost_share_pct"), F.lit(True).alias("is_primary_service"),
        "valid_from", "valid_to",
    )
    return replace_slice(bridge, rows, ["contract_key"])


def _with_contract(staged: DataFrame, contracts: DataFrame, day: str) -> DataFrame:
    return effective_dated_join(
        staged, contracts.withColumnRenamed("client_code", "_client"), ["contract_code"], day,
        columns=["contract_key", "_client"],
    )


def _in_calendar(df: DataFrame, calendar: DataFrame, day: str) -> DataFrame:
    """Facts outside the calendar are not loaded."""
    known = calendar.select(F.col("full_date").alias(day))
    return df.join(known, day, "left_semi")


def _own_unit(df: DataFrame, units: DataFrame) -> DataFrame:
    return df.join(
        units.select("unit_code", F.col("client_code").alias("_client")), ["unit_code", "_client"], "left_semi"
    )


def load_revenue(fact: DataFrame, staged: DataFrame, contracts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Replace the delivered (contract, month) slices."""
    rows = _with_contract(_in_calendar(staged, calendar, "reference_month"), contracts, "reference_month")
    rows = rows.drop("_client").withColumn("date_key", date_key("reference_month"))
    return _replace(fact, rows, staged, ["contract_code", "reference_month"])


def load_cost(fact, staged, contracts, calendar, units, categories) -> DataFrame:
    """Replace (contract, month); categories match by plain equality here."""
    rows = _with_contract(_in_calendar(staged, calendar, "reference_month"), contracts, "reference_month")
    known = categories.select("cost_group", "cost_category", "cost_subcategory")
    rows = _own_unit(rows, units).join(known, ["cost_group", "cost_category", "cost_subcategory"], "left_semi")
    rows = rows.drop("_client").withColumn("date_key", date_key("reference_month"))
    return _replace(fact, rows, staged, ["contract_code", "reference_month"])


def load_operation(fact, staged, contracts, calendar, units) -> DataFrame:
    """Replace (contract, unit, role, month)."""
    rows = _with_contract(_in_calendar(staged, calendar, "reference_month"), contracts, "reference_month")
    rows = _own_unit(rows, units).drop("_client").withColumn("date_key", date_key("reference_month"))
    return _replace(fact, rows, staged, ["contract_code", "unit_code", "role_code", "reference_month"])


def load_incidents(fact, staged, contracts, calendar, units, incident_types) -> DataFrame:
    """Replace by incident number; the version is the one valid when it opened."""
    dated = staged.withColumn("_opened", F.to_date("opened_at"))
    rows = _with_contract(_in_calendar(dated, calendar, "_opened"), contracts, "_opened")
    kinds = ["incident_category", "incident_subcategory", "root_cause"]
    rows = _own_unit(rows, units).join(incident_types.select(*kinds), kinds, "left_semi")
    rows = rows.withColumns({"opened_date_key": date_key("_opened"), "closed_date_key": date_key(F.to_date("closed_at"))})
    return _replace(fact, rows.drop("_client", "_opened"), staged, ["incident_number"])


def load_adjustments(fact, staged, contracts, calendar) -> DataFrame:
    """Replace by process number; three dates play three roles."""
    roles = {"expected": ("expected_date", "inner"), "requested": ("requested_date", "left"), "approved": ("approved_date", "left")}
    dated = join_role_dates(staged, calendar, roles, "date_key", "date_key")
    rows = _with_contract(dated, contracts, "expected_date").drop("_client")
    return _replace(fact, rows, staged, ["adjustment_number"])


def join_role_dates(df: DataFrame, calendar: DataFrame, roles: dict, column: str, suffix: str) -> DataFrame:
    """Attach one calendar column per date role (role -> (date column, join type))."""
    for role, (day, how) in roles.items():
        side = calendar.select(F.col("full_date").alias(day), F.col(column).alias(f"{role}_{suffix}"))
        df = df.join(side, day, how)
    return df


def _replace(fact: DataFrame | None, rows: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """Slices of every staged row are cleared, also of rows that found no version."""
    if fact is None:
        return rows
    kept = fact.join(staged.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


def batch_audit(batch_id: int, source: str, received: DataFrame, staged: DataFrame, rejected: DataFrame) -> DataFrame:
    """Audit row: rows received, staged and rejected; PARTIAL when any was rejected."""
    n = lambda df: F.coalesce(df.agg(F.count("*")).scalar(), F.lit(0))
    spark = received.sparkSession
    counts = spark.range(1).select(
        F.lit(batch_id).alias("batch_id"), F.lit(source).alias("source_name"), n(received).alias("rows_received"),
        n(staged).alias("rows_loaded"), n(rejected).alias("rows_rejected"),
    )
    return counts.withColumn("status", F.when(F.col("rows_rejected") > 0, "PARTIAL").otherwise("SUCCESS"))
