"""Planned rows: ordered rule overlay and allocation from templates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overlay_rules(
    grid: DataFrame,
    rules: DataFrame,
    entity: str,
    month: str,
    columns: Sequence[str],
    first: str = "first_month",
    last: str = "last_month",
    order: str = "rule_no",
) -> DataFrame:
    """Apply ordered rules to an entity x month grid.

    A rule sets some columns for an entity and a range of months; the later
    rule wins per column and a NULL leaves the earlier value.  Rules are
    expanded to their months and cut to one row per entity and month first,
    so the grid takes one equality join.
    """
    months = F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month"))
    winner = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_rule_{c}")
    settled = (
        rules.withColumn(month, F.explode(months)).groupBy(entity, month).agg(*[winner(c) for c in columns])
    )
    joined = grid.join(settled, [entity, month], "left")
    return joined.select(
        *[F.coalesce(f"_rule_{c}", c).alias(c) if c in columns else F.col(c) for c in grid.columns]
    )
