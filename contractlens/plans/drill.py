"""Measures of several fact grains side by side, by the dimensions they share.

Facts of different grains are never joined to each other: each takes the filters
on shared dimensions, is aggregated alone to the wanted level, and only these
results, one row per group, are put together.  A group that one fact does not
have is there with the others' measures.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.functions.scalar import month_of
from contractlens.plans.measures import _define

MONTH = "reference_month"
KEY = "contract_key"


@dataclass(frozen=True)
class Grain:
    """A fact and its measures; ``day`` is the date whose month the fact belongs to."""

    rows: DataFrame
    measures: Mapping[str, Column] = field(default_factory=dict)
    day: str = MONTH

    def monthly(self) -> DataFrame:
        return self.rows if self.day == MONTH else self.rows.withColumn(MONTH, month_of(self.day))


def contract_months(rows: DataFrame, names: Mapping[str, str]) -> Grain:
    """Contract-months with report measures (output column -> measure name)."""
    known = _define()
    return Grain(rows, {out: known[name] for out, name in names.items()})


def effects(rows: DataFrame) -> Grain:
    """Completed actions in the month of their completion."""
    return Grain(rows, {"completed_actions": F.count("*"), "realized_impact": F.sum("actual_impact_amount")}, "completion_date")


def events(rows: DataFrame) -> Grain:
    """Timeline events in their month; events without an impact count nothing."""
    return Grain(rows, {"events": F.count("*"), "event_impact": F.sum("impact_amount")}, "reference_date")


def losses(rows: DataFrame) -> Grain:
    return Grain(rows, {"loss_amount": F.sum("loss_amount"), "recoverable_amount": F.sum("recoverable_amount")})


def drill_across(
    grains: Sequence[Grain], contracts: DataFrame, by: Sequence[str] = (MONTH,), where: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per group of ``by`` with the measures of all grains.

    ``by`` and the columns of ``where`` (column -> condition on it) are the month
    or attributes of ``contracts``; attributes that a fact lacks are looked up by
    `contract_key`.  NULL is a group of its own.
    """
    where = where or {}
    parts = []
    for grain in grains:
        rows = grain.monthly()
        if MONTH in where:  # before the lookup
            rows = rows.filter(where[MONTH])
        absent = [c for c in dict.fromkeys([*by, *where]) if c not in rows.columns]
        if absent:
            rows = rows.join(contracts.select(KEY, *absent), KEY)
        for column, condition in where.items():
            rows = rows if column == MONTH else rows.filter(condition)
        parts.append(rows.groupBy(*by).agg(*[m.alias(out) for out, m in grain.measures.items()]))
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [out for grain in grains for out in grain.measures]
    return together.groupBy(*by).agg(*[F.max(n).alias(n) for n in names])
