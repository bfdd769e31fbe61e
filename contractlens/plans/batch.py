"""Batches: what a run of one raw file leaves in the audit."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.plans.loading import batch_audit

AUDIT = (
    "batch_id int, source_name string, rows_received long, rows_loaded long, rows_rejected long, status string, "
    "error_message string"
)

Job = Callable[[], tuple[DataFrame, DataFrame, DataFrame]]


def failed_audit(spark: SparkSession, batch_id: int, source: str, error: Exception) -> DataFrame:
    row = (batch_id, source, None, None, None, "FAILED", str(error))
    return spark.createDataFrame([row], AUDIT)


def run_batch(spark: SparkSession, batch_id: int, source: str, job: Job, record: Callable[[DataFrame], None]) -> None:
    """Run one batch and record its audit row.

    ``job`` loads the file and returns (received, staged, rejected).  A failing
    job is recorded as FAILED with its message, and the error goes on.
    """
    try:
        received, staged, rejected = job()
        audit = batch_audit(batch_id, source, received, staged, rejected)
        record(audit.withColumn("error_message", F.lit(None).cast("string")))
    except Exception as error:
        record(failed_audit(spark, batch_id, source, error))
        raise


def run_batches(spark: SparkSession, batches: Iterable[tuple[int, str, Job]], record: Callable[[DataFrame], None]) -> None:
    """Run batches in order; the first failure stops the run."""
    for batch_id, source, job in batches:
        run_batch(spark, batch_id, source, job, record)
