"""Stored parameters and recovery rates, each valid from a month on.

A version of a parameter holds until the next version of its code.  A refresh
scores every month with the versions of that month, so old months keep their
scores when a limit changes.  Versions are only added: what a month was scored
with can always be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contractlens import config
from contractlens.functions.scalar import month_of
from contractlens.session import cut_points, materialize
from contractlens.sources.slices import exists
from contractlens.sources.store import publish, read_table

TABLE = "parameter"
RATE = "RECOVERY_"  # prefix of the recovery rate of a loss cause
START = "2000-01-01"
KEYS = ["parameter_code", "valid_from"]
SCHEMA = "parameter_code string, parameter_value decimal(18,6), parameter_unit string, parameter_group string, valid_from date"


def seed(spark: SparkSession, first_day: str = START) -> DataFrame:
    """The first version of every parameter and rate."""
    start = F.lit(first_day).cast("date").alias("valid_from")
    rates = config.loss_recovery_table(spark).select(
        F.concat(F.lit(RATE), "loss_code").alias("parameter_code"),
        F.col("recovery_rate").cast("decimal(18,6)").alias("parameter_value"),
        F.lit("PERCENT").alias("parameter_unit"),
        F.lit("RECOVERY").alias("parameter_group"),
        start,
    )
    return config.risk_parameter_table(spark).select("*", start).unionByName(rates)


def with_versions(stored: DataFrame, delivered: DataFrame) -> DataFrame:
    """Stored versions and those delivered (parameter_code, parameter_value, valid_from).

    Unknown codes, missing values or days, a version that is there already and one
    delivered twice are errors.  A version starts with the month of its day; unit and
    group are those of its code.
    """
    known = stored.groupBy("parameter_code").agg(
        F.first("parameter_unit").alias("parameter_unit"), F.first("parameter_group").alias("parameter_group"), F.collect_set("valid_from").alias("_taken")
    )
    named = F.concat_ws(" from ", "parameter_code", F.col("valid_from").cast("string"))
    wrong = lambda text: F.raise_error(F.concat(F.lit(f"parameter {text}: "), named)).cast("boolean")
    new = delivered.select("parameter_code", F.col("parameter_value").cast("decimal(18,6)").alias("parameter_value"), month_of("valid_from").alias("valid_from"))
    new = new.groupBy(*KEYS).agg(F.first("parameter_value").alias("parameter_value"), F.count("*").alias("_n"))
    new = new.join(known, "parameter_code", "left").filter(
        F.when(F.col("parameter_unit").isNull(), wrong("unknown"))
        .when(F.col("parameter_value").isNull() | F.col("valid_from").isNull(), wrong("without value or day"))
        .when((F.col("_n") > 1) | F.array_contains("_taken", F.col("valid_from")), wrong("given twice"))
        .otherwise(F.lit(True))
    )
    return stored.unionByName(new.select(*stored.columns))


def run_parameters(spark: SparkSession, root: str, delivered: DataFrame | None = None, first_day: str = START) -> None:
    """Seed the stored table if there is none, add what is delivered, and publish it as one version."""
    with cut_points(spark):
        runs = spark.read.parquet(f"{root}/current").count() if exists(spark, f"{root}/current") else 0
        table = read_table(spark, root, TABLE) if runs else seed(spark, first_day)
        if delivered is not None:
            table = with_versions(table, delivered)
        publish(spark, root, f"run-{runs + 1}", {TABLE: materialize(table, "parameters")})


def read_parameters(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, TABLE)


def names(codes=None) -> dict[str, str]:
    """Parameter code -> its column beside the rows that it scores."""
    codes = codes or [*(code for code, *_ in config.RISK_PARAMETERS), *(RATE + code for code, *_ in config.LOSS_CAUSES)]
    return {code: f"parameter_{code.lower()}" for code in codes}


def by_month(stored: DataFrame, last_month: Column) -> DataFrame:
    """One wide row per month from the first version to ``last_month`` (a scalar), a column per parameter.

    Versions are expanded to the months they hold in, so months are found by equality.
    """
    following = F.lead("valid_from").over(Window.partitionBy("parameter_code").orderBy("valid_from"))
    versions = stored.withColumn("_following", following)
    end = F.coalesce(F.add_months("_following", -1), F.greatest(last_month, F.col("valid_from")))
    month = F.explode(F.sequence("valid_from", end, F.expr("interval 1 month"))).alias("reference_month")
    months = versions.select("parameter_code", "parameter_value", month)
    value = lambda code: F.max(F.when(F.col("parameter_code") == code, F.col("parameter_value")))
    return months.groupBy("reference_month").agg(*[value(code).alias(column) for code, column in names().items()])


def attach(rows: DataFrame, stored: DataFrame, months: DataFrame) -> DataFrame:
    """Rows with the parameters of their month; a month without some parameter is an error.

    ``months`` is a cheap frame that holds the last month of the rows.
    """
    last = months.agg(F.max("reference_month")).scalar()
    wide = by_month(stored, last)
    joined = rows.join(F.broadcast(wide), "reference_month", "left")  # one row per calendar month
    missing = lambda code: F.raise_error(F.concat(F.lit(f"no parameter {code} for "), F.col("reference_month").cast("string")))
    held = {column: F.coalesce(column, missing(code).cast("decimal(18,6)")) for code, column in names().items()}
    return joined.withColumns(held)


def params() -> dict[str, Column]:
    """The parameters of a row, for the jobs that take them by lower-case code."""
    return {code.lower(): F.col(column) for code, column in names([code for code, *_ in config.RISK_PARAMETERS]).items()}


def rates() -> dict[str, Column]:
    """The recovery rate of every loss cause of a row."""
    return {code: F.col(f"parameter_{(RATE + code).lower()}").cast("decimal(5,4)") for code, *_ in config.LOSS_CAUSES}

