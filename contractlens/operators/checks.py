"""Data tests as rows: (check_name, expected, actual, passed)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_row(df: DataFrame, name: str, actual: Column, expected) -> DataFrame:
    """One aggregate compared with an expectation."""
    want = F.lit(expected).cast("double")
    got = actual.cast("double")
    return df.agg(got.alias("actual")).select(
        F.lit(name).alias("check_name"),
        want.alias("expected"),
        F.coalesce("actual", F.lit(0.0)).alias("actual"),
        (F.coalesce("actual", F.lit(0.0)) == want).alias("passed"),
    )


def row_count(df: DataFrame, name: str, expected: int) -> DataFrame:
    return check_row(df, name, F.count("*"), expected)


def preflight(required: dict[str, int], tables: dict[str, DataFrame]) -> None:
    """Stop before a run: every required table is there and holds at least its number of rows."""
    absent = sorted(set(required) - set(tables))
    if absent:
        raise ValueError(f"missing tables: {', '.join(absent)}")
    short = [f"{name} (needs {n})" for name, n in required.items() if tables[name].limit(n).count() < n]
    if short:
        raise ValueError(f"too few rows: {', '.join(short)}")


def no_row_breaks(df: DataFrame, name: str, rule: Column) -> DataFrame:
    """Rows for which the rule is false; an unknown result does not break it."""
    return check_row(df, name, F.count_if(~rule), 0)


def many_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Many rules over one scan, one result row per rule."""
    counts = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    rows = [
        F.struct(F.lit(n).alias("check_name"), F.lit(0.0).alias("expected"), F.col(n).cast("double").alias("actual"), (F.col(n) == 0).alias("passed"))
        for n in rules
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def unique_grain(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    repeated = df.groupBy(*keys).count().filter("count > 1")
    return check_row(repeated, name, F.count("*"), 0)


def no_orphans(df: DataFrame, parent: DataFrame, name: str, on: Sequence[str]) -> DataFrame:
    return check_row(df.join(parent, list(on), "left_anti"), name, F.count("*"), 0)


def columns_present(df: DataFrame, name: str, expected: Sequence[str]) -> DataFrame:
    missing = len(set(expected) - set(df.columns))
    one = df.sparkSession.range(1)
    return check_row(one, name, F.max(F.lit(missing)), 0)


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], amount: str, tolerance: float = 0.01) -> DataFrame:
    """Totals of two layers per key, with their difference and verdict."""
    a = left.groupBy(*keys).agg(F.sum(amount).alias("left_total"))
    b = right.groupBy(*keys).agg(F.sum(amount).alias("right_total"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    gap = F.abs(zero("left_total") - zero("right_total"))
    return a.join(b, list(keys), "full_outer").select(
        *keys, zero("left_total").alias("left_total"), zero("right_total").alias("right_total"),
        gap.alias("difference"), (gap <= tolerance).alias("passed"),
    )


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def require(checks: DataFrame) -> None:
    """Stop with the names of the checks that failed."""
    failed = [r.check_name for r in checks.filter("not passed").select("check_name").collect()]
    if failed:
        raise AssertionError("failed checks: " + ", ".join(sorted(failed)))
