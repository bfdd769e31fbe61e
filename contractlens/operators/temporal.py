"""Joins against dated rows: as-of, effective-dated and month windows.

None of them compares every pair of one key.  A hot key would make such a
pairing quadratic, so each join is reduced to an equality first: the dated
side is pre-aggregated, or expanded to the years or months it covers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlens.functions.scalar import month_of


def _sorted_first(date: str, tie: str, payload) -> list[str]:
    """Struct fields in comparison order: date, tie-breaker, then the payload."""
    return list(dict.fromkeys([date, tie, *payload]))


def asof_first(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_date: Column,
    right_date: str,
    tie: str,
    payload: dict[str, str],
) -> DataFrame:
    """Attach the earliest ``right`` row dated on or before ``left_date``.

    The earliest row of a key does not depend on ``left_date``: it is found
    once per key (partial aggregation) and only then compared.
    ``payload`` maps right column -> output column.
    """
    best = F.min(F.struct(*_sorted_first(right_date, tie, payload))).alias("_first")
    earliest = right.filter(F.col(right_date).isNotNull()).groupBy(*keys).agg(best)
    due = F.col(f"_first.{right_date}") <= left_date
    joined = left.join(earliest, list(keys), "left")
    picked = [F.when(due, F.col(f"_first.{src}")).alias(dst) for src, dst in payload.items()]
    return joined.select(*[F.col(c) for c in left.columns], *picked)


def asof_last_by_month(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_month: str,
    right_date: str,
    tie: str,
    payload: dict[str, str],
) -> DataFrame:
    """Attach the latest ``right`` row dated by the end of ``left_month``.

    The right side is cut to its last row per key and month, then carried
    forward with a running maximum.  A window partition holds at most two rows
    per month of one key, whatever the size of the inputs; ``left`` must have
    one row per key and month.
    """
    best = F.max(F.struct(*_sorted_first(right_date, tie, payload))).alias("_last")
    monthly = (
        right.filter(F.col(right_date).isNotNull())
        .groupBy(*keys, month_of(right_date).alias(left_month))
        .agg(best)
    )
    running = Window.partitionBy(*keys).orderBy(left_month).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    carried = (
        left.withColumn("_is_left", F.lit(True))
        .unionByName(monthly, allowMissingColumns=True)
        .withColumn("_last", F.max("_last").over(running))
        .filter("_is_left")
    )
    picked = [F.col(f"_last.{src}").alias(dst) for src, dst in payload.items()]
    return carried.select(*[F.col(c) for c in left.columns], *picked)


def version_years(versions: DataFrame, valid_from: str, valid_to: str, last: Column, year: str = "_year") -> DataFrame:
    """One row per version and calendar year it touches, up to the year of the day ``last``."""
    start, cap = F.year(valid_from), F.year(last)
    end = F.least(F.coalesce(F.year(valid_to), cap), cap)
    return versions.withColumn(year, F.explode(F.when(start <= end, F.sequence(start, end))))


def effective_dated_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    fact_date: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    columns: Sequence[str] = (),
) -> DataFrame:
    """Join each fact to the version valid on its date (inner).

    Versions are expanded to the years they touch, so the join is an equality on
    (key, year) with a date check left over; a hot key is spread over its years.
    Years, not months: a version that holds for many months would be shuffled once
    for each of them, and these rows, not the facts, would be most of the job.
    Years end with the one in which the last version starts: a version valid on a
    later day touches that year too, so later facts look there.  The facts are
    read once, and a version without an end, or one far away, costs no years that
    tell nothing new.
    """
    last = versions.agg(F.max(valid_from).alias("last")).scalar()
    side = version_years(
        versions.select(*keys, valid_from, valid_to, *columns).withColumnsRenamed(
            {valid_from: "_from", valid_to: "_to"}
        ),
        "_from", "_to", last,
    )
    day = F.col(fact_date)
    return (
        facts.withColumn("_year", F.least(F.year(fact_date), F.year(last)))
        .join(side, [*keys, "_year"])
        .filter((day >= F.col("_from")) & (F.col("_to").isNull() | (day <= F.col("_to"))))
        .drop("_year", "_from", "_to")
    )


def month_offsets(df: DataFrame, anchors: dict[str, tuple[Column, range]], side: str, month: str) -> DataFrame:
    """Expand each row to a fixed list of months around its anchor dates.

    ``anchors`` maps a side label -> (date column, month offsets).  The number
    of rows grows by a constant, so averaging a period becomes an equality
    join on (entity, month).
    """
    slots = [
        F.struct(F.lit(label).alias(side), F.add_months(month_of(anchor), n).alias(month))
        for label, (anchor, offsets) in anchors.items()
        for n in offsets
    ]
    return df.withColumn("_slot", F.explode(F.array(*slots))).select("*", f"_slot.{side}", f"_slot.{month}").drop("_slot")


def latest_period(df: DataFrame, period: str, source: DataFrame | None = None) -> DataFrame:
    """Rows of the most recent period present (a scalar subquery, not a join).

    ``source`` may name a cheaper frame with the same periods, so that the
    maximum is found without evaluating ``df`` twice.
    """
    newest = (df if source is None else source).agg(F.max(period)).scalar()
    return df.filter(F.col(period) == newest)
