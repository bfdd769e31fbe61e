"""The monthly load: a raw file becomes judged rows, stored facts and one audit row.

    raw/<source>/batch_id=N        the file as it came
    rejected/<source>/batch_id=N   rows with their reasons
    staged/<source>/batch_id=N     valid typed rows
    dw/contract/<version>          contract versions and service bridge, published together
    dw/<fact>/                     facts by month under a manifest, replaced by delivered slice
    audit/                         one row per batch

Running a batch again replaces what it left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.functions.scalar import month_of
from contractlens.operators.shape import dense_number
from contractlens.plans import batch, loading, staging
from contractlens.session import cut_points, materialize
from contractlens.sources.delimited import raw_columns, read_delimited, store_batch
from contractlens.sources import slices
from contractlens.sources.slices import MONTH, exists
from contractlens.sources.store import publish, read_table


@dataclass
class FactTable:
    name: str
    keys: list[str]  # what a delivery replaces
    day: str  # the day whose month stores the row
    load: Callable[[DataFrame, dict[str, DataFrame]], DataFrame]


FACTS = {
    "monthly_measurements": FactTable(
        "revenue", ["contract_code", "reference_month"], "reference_month",
        lambda staged, d: loading.load_revenue(None, staged, d["contracts"], d["calendar"]),
    ),
    "operational_costs": FactTable(
        "cost", ["contract_code", "reference_month"], "reference_month",
        lambda staged, d: loading.load_cost(None, staged, d["contracts"], d["calendar"], d["units"], d["categories"]),
    ),
    "workforce_control": FactTable(
        "operation", ["contract_code", "unit_code", "role_code", "reference_month"], "reference_month",
        lambda staged, d: loading.load_operation(None, staged, d["contracts"], d["calendar"], d["units"]),
    ),
    "sla_incidents": FactTable(
        "incidents", ["incident_number"], "opened_at",
        lambda staged, d: loading.load_incidents(None, staged, d["contracts"], d["calendar"], d["units"], d["incident_types"]),
    ),
    "contract_adjustments": FactTable(
        "adjustments", ["adjustment_number"], "expected_date",
        lambda staged, d: loading.load_adjustments(None, staged, d["contracts"], d["calendar"]),
    ),
}


def contracts(spark: SparkSession, root: str) -> DataFrame:
    """Contract versions as the last load left them."""
    if not exists(spark, f"{root}/dw/contract"):
        return spark.createDataFrame([], loading.CONTRACT_DIMENSION)
    return read_table(spark, f"{root}/dw/contract", "contract")


def bridge(spark: SparkSession, root: str) -> DataFrame:
    """Service shares of the contract versions, of the same load as `contracts`."""
    if not exists(spark, f"{root}/dw/contract"):
        return spark.createDataFrame([], loading.BRIDGE)
    return read_table(spark, f"{root}/dw/contract", "bridge")


def fact(spark: SparkSession, root: str, name: str, months=None) -> DataFrame:
    return slices.read(spark, f"{root}/dw/{name}", months)


def latest_month(spark: SparkSession, root: str, name: str) -> int | None:
    """yyyymm of the newest facts, from the manifest."""
    return slices.state(spark, f"{root}/dw/{name}").latest_month


def keyed_adjustments(spark: SparkSession, root: str, rows: DataFrame, now: slices.State, months: set[int]) -> tuple[DataFrame, int]:
    """Gives every process its `adjustment_key`: a stored one keeps it, new ones are numbered on by number.

    Keys are looked up in ``months``, those that hold a delivered number; the last
    key given is in the manifest, so a key is never used twice.
    """
    if months:
        known = slices.read(spark, f"{root}/dw/adjustments", months, now).select("adjustment_number", "adjustment_key")
        rows = rows.join(known, "adjustment_number", "left")
    else:
        rows = rows.withColumn("adjustment_key", F.lit(None).cast("long"))
    rows = materialize(rows, "adjustments")
    new = rows.filter("adjustment_key is null")
    added = dense_number(new, "_n", [F.asc("adjustment_number")])  # written in order
    added = added.withColumn("adjustment_key", (F.col("_n") + now.last_key).cast("long")).drop("_n")
    return rows.filter("adjustment_key is not null").unionByName(added), now.last_key + new.count()


def run_load(
    spark: SparkSession, root: str, batch_id: int, source_name: str, path: str, dims: dict[str, DataFrame], period: str
) -> None:
    """Load one file and leave its audit row; a failure is recorded and goes on.

    ``dims`` holds clients, units, services, managers, roles, categories,
    incident_types and the calendar.
    """
    source = staging.SOURCES[source_name]
    try:
        with cut_points(spark):
            _load(spark, root, batch_id, source, path, dims, period)
    except Exception as error:
        _record(batch.failed_audit(spark, batch_id, source_name, error), root, batch_id)
        raise


def _load(spark: SparkSession, root: str, batch_id: int, source, path: str, dims: dict[str, DataFrame], period: str) -> None:
    source_name = source.name
    raw = store_batch(read_delimited(spark, path, raw_columns(source), batch_id), f"{root}/raw/{source_name}", batch_id)
    refs = dims | {"contracts": contracts(spark, root)}
    judged = materialize(staging.judge(source, raw, refs, period), "judged")  # parsed and looked up once
    bad = F.count_if(F.col("rejection_reason") != "")
    received, rejected = judged.agg(F.count("*"), bad).first()
    valid, refused = staging.parts(source, judged)
    staged = store_batch(valid, f"{root}/staged/{source_name}", batch_id)
    store_batch(refused, f"{root}/rejected/{source_name}", batch_id)
    if source_name == "contract_register":
        _load_contracts(spark, root, staged, batch_id)
    else:
        load_facts(spark, root, FACTS[source_name], staged, refs)
    status = "PARTIAL" if rejected else "SUCCESS"
    row = (batch_id, source_name, received, received - rejected, rejected, status, None)
    _record(spark.createDataFrame([row], batch.AUDIT), root, batch_id)


def _record(audit: DataFrame, root: str, batch_id: int) -> None:
    audit.coalesce(1).write.mode("overwrite").parquet(f"{root}/audit/batch={batch_id}")


def _load_contracts(spark: SparkSession, root: str, staged: DataFrame, batch_id: int) -> None:
    repeated = staged.groupBy("contract_code").count().filter("count > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"contract codes delivered twice: {', '.join(r.contract_code for r in repeated)}")
    folder = f"{root}/dw/contract"
    merged = materialize(loading.load_contracts(contracts(spark, root), staged), "contract")
    shares = loading.load_bridge(bridge(spark, root), merged, staged)
    runs = spark.read.parquet(f"{folder}/current").count() if exists(spark, folder) else 0
    publish(spark, folder, f"batch-{batch_id}-{runs}", {"contract": merged, "bridge": shares})


def month_number(day: str):
    return F.date_format(month_of(F.col(day).cast("date")), "yyyyMM").cast("int").alias(MONTH)


def load_facts(spark: SparkSession, root: str, table: FactTable, staged: DataFrame, dims: dict[str, DataFrame]) -> None:
    path = f"{root}/dw/{table.name}"
    rows, known = table.load(staged, dims), {}
    numbered = len(table.keys) == 1
    delivered = staged if numbered else staged.withColumn(MONTH, month_number(table.day))
    if table.name == "adjustments":
        now = slices.state(spark, path)
        months = slices.months_of(slices.known_months(spark, path, now, delivered, table.keys[0]))
        rows, last_key = keyed_adjustments(spark, root, rows, now, months)
        known = {"of": now, "cleared": months, "last_key": last_key, "stored": True}
    slices.replace_slices(spark, path, rows.withColumn(MONTH, month_number(table.day)), delivered, table.keys, numbered=numbered, **known)
