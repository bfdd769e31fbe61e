"""Versioned mart storage: a refresh appears whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.sources.slices import ROWS_PER_FILE, exists

POINTER = "current"


def publish(spark: SparkSession, root: str, version: str, tables: dict[str, DataFrame], partitions: dict[str, list[str]] | None = None) -> None:
    """Write every table under a new version, then point readers to it.

    A failure before the pointer is written leaves the earlier version in use.
    A version that readers may be using is not overwritten: its name is refused.
    """
    if exists(spark, f"{root}/{POINTER}") and not spark.read.parquet(f"{root}/{POINTER}").filter(F.col("version") == version).isEmpty():
        raise ValueError(f"version {version} is already published")
    partitions = partitions or {}
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if name in partitions:
            writer = df.hint("rebalance", *partitions[name]).write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
            writer = writer.partitionBy(*partitions[name])
        writer.parquet(f"{root}/{version}/{name}")
    pointer = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at"))
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/{POINTER}")


def current_version(spark: SparkSession, root: str) -> str:
    """Version published last (one pointer row per refresh)."""
    newest = spark.read.parquet(f"{root}/{POINTER}").agg(F.max_by("version", "published_at").alias("version"))
    return newest.first().version


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{current_version(spark, root)}/{name}")
