"""Row validation: every failing rule becomes a reason, and reasons decide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "; "


def with_reasons(df: DataFrame, rules: Sequence[tuple[Column, str]], name: str = "rejection_reason") -> DataFrame:
    """Add the joined reasons of all failing rules (empty text when valid).

    A rule is (condition that makes the row invalid, reason).  Unknown
    conditions do not fail the row.
    """
    return df.withColumn(name, F.concat_ws(SEPARATOR, *[F.when(bad, F.lit(reason)) for bad, reason in rules]))


def split_valid(df: DataFrame, rules: Sequence[tuple[Column, str]]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with reasons): exact complements by construction."""
    judged = with_reasons(df, rules)
    valid = judged.filter(F.col("rejection_reason") == "").drop("rejection_reason")
    return valid, judged.filter(F.col("rejection_reason") != "")
