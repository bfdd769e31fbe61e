"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens import config
from contractlens.functions.scalar import date_key


def day_attributes(day: Column) -> list[Column]:
    names = F.array(*[F.lit(n) for n in config.MONTH_NAMES_PT])
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.dayofmonth(day).alias("day_number"),
        F.month(day).alias("month_number"),
        F.element_at(names, F.month(day)).alias("month_name_pt"),
        F.quarter(day).alias("quarter_number"),
        F.year(day).alias("year_number"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.trunc(day, "MM").alias("month_start_date"),
        F.last_day(day).alias("month_end_date"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    ]


def calendar_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last`` of a one-row frame."""
    days = bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("_day"))
    return days.select(*day_attributes(F.col("_day")))


def calendar(spark: SparkSession, first: str = config.CALENDAR_START, last: str = config.CALENDAR_END) -> DataFrame:
    bounds = spark.range(1).select(F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last"))
    return calendar_between(bounds, "first", "last")
