"""Expectations as tables: what a row should hold, and how a measure should move."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.operators.shape import unpivot_structs

RELATIONS = ("rises", "falls", "both_positive")


def differences(actual: DataFrame, expected: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Every expected row with what is there: keys, expected, actual, passed.

    NULL equals NULL; an expected key that is not there, or that is there more than
    once, does not pass.  Rows that nobody expects something of play no part.
    """
    there = actual.join(expected.select(*keys).distinct(), list(keys), "left_semi")
    there = there.groupBy(*keys).agg(F.first(column).alias("_actual"), F.count("*").alias("_n"))
    joined = expected.select(*keys, F.col(column).alias("expected")).join(there, list(keys), "left")
    same = (F.col("_n") == 1) & F.col("expected").eqNullSafe(F.col("_actual"))
    return joined.select(*keys, "expected", F.col("_actual").alias("actual"), F.coalesce(same, F.lit(False)).alias("passed"))


def directions(rows: DataFrame, expected: DataFrame, entity: str, month: str, measures: Mapping[str, Column]) -> DataFrame:
    """Movements of measures between two periods, all in one pass over the rows.

    ``expected`` has check_name, the entity, measure_before, measure_after, the months
    before_from .. before_to and after_from .. after_to, and a relation: the mean
    `rises` or `falls`, or both periods hold something positive (`both_positive`).
    A period without a value does not pass.  Result: check_name, entity, relation,
    before, after (means), passed.
    """
    items = [F.struct(F.lit(name).alias("measure"), value.cast("decimal(28,6)").alias("value")) for name, value in measures.items()]
    values = unpivot_structs(rows, items, [entity, month]).filter("value is not null")
    side = lambda name: F.struct(
        F.lit(name).alias("side"), F.col(f"measure_{name}").alias("measure"), F.col(f"{name}_from").alias("_from"), F.col(f"{name}_to").alias("_to")
    )
    names = ["check_name", entity, "relation"]
    sides = unpivot_structs(expected, [side("before"), side("after")], names)
    inside = values.join(sides, [entity, "measure"]).filter(F.col(month).between(F.col("_from"), F.col("_to")))
    of = lambda name: F.when(F.col("side") == name, F.col("value"))
    found = inside.groupBy(*names).agg(F.avg(of("before")).alias("before"), F.avg(of("after")).alias("after"))
    holds = (
        F.when(F.col("relation") == "rises", F.col("after") > F.col("before"))
        .when(F.col("relation") == "falls", F.col("after") < F.col("before"))
        .when(F.col("relation") == "both_positive", (F.col("before") > 0) & (F.col("after") > 0))
        .otherwise(F.raise_error(F.concat(F.lit("unknown relation "), "relation")).cast("boolean"))
    )
    return expected.select(*names).join(found, names, "left").withColumn("passed", F.coalesce(holds, F.lit(False)))
