"""Reshaping and ranking without extra scans or single-task windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlens.session import materialize


def unpivot_structs(df: DataFrame, structs: Sequence[Column], keep: Sequence[str], alias: str = "_item") -> DataFrame:
    """Wide row -> one row per struct, in one scan."""
    return df.select(*keep, F.explode(F.array(*structs)).alias(alias)).select(*keep, f"{alias}.*")


def pivot_max(df: DataFrame, by: Sequence[str], code: str, value: str, codes: Sequence[str], fill=None) -> DataFrame:
    """Key/value rows -> one column per code (declared codes: no extra pass).

    One aggregate by key; `pivot` would first aggregate by key and code, and a task
    would hold the groups of both aggregates.
    """
    wide = df.groupBy(*by).agg(*[F.max(F.when(F.col(code) == c, F.col(value))).alias(c) for c in codes])
    return wide if fill is None else wide.fillna(fill, subset=list(codes))


def grid_by_month(df: DataFrame, first: Column, last: Column, month: str = "reference_month") -> DataFrame:
    """Entity x month grid: every entity gets the months ``first``..``last``."""
    return df.withColumn(month, F.explode(F.sequence(first, last, F.expr("interval 1 month"))))


def expand_by_count(df: DataFrame, count: str, sequence: str) -> DataFrame:
    """One row per 1..count; rows with a count of zero or NULL vanish."""
    return df.filter(F.col(count) > 0).withColumn(sequence, F.explode(F.sequence(F.lit(1), F.col(count).cast("int"))))


def change_rows(df: DataFrame, by: Sequence[str], order: str, value: str) -> DataFrame:
    """Rows whose value differs from the previous row of the entity (or has none)."""
    w = Window.partitionBy(*by).orderBy(order)
    previous = F.lag(value).over(w)
    return (
        df.withColumn("_previous", previous)
        .filter(F.col("_previous").isNull() | (F.col("_previous") != F.col(value)))
        .drop("_previous")
    )


def duplicate_count(df: DataFrame, keys: Sequence[Column], name: str = "duplicate_count") -> DataFrame:
    """Number of rows sharing the key, on every row.

    Counted with partial aggregation and joined back, so a key that holds a
    large part of the rows (blank keys in a bad file) never becomes one window
    partition.
    """
    key_names = [f"_k{i}" for i in range(len(keys))]
    keyed = df.select("*", *[k.alias(n) for k, n in zip(keys, key_names)])
    counts = keyed.groupBy(*key_names).agg(F.count("*").alias(name))
    repeated = counts.filter(F.col(name) > 1).withColumnsRenamed({n: f"{n}_r" for n in key_names})
    same = [F.col(n).eqNullSafe(F.col(f"{n}_r")) for n in key_names]
    joined = keyed.join(repeated, same, "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(1).cast("long"))).drop(
        *key_names, *[f"{n}_r" for n in key_names]
    )


def dense_number(df: DataFrame, name: str, order: Sequence[Column]) -> DataFrame:
    """1..n over the whole frame in ``order``, without a one-task window.

    The frame is range-sorted and written with its partition-local position;
    the partition sizes (one row per task) give each partition its offset.
    """
    position = F.monotonically_increasing_id()
    placed = materialize(df.orderBy(*order).withColumn("_at", position), "ranked")
    block, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(block.alias("_block")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.withColumn("_block", block)
        .join(F.broadcast(offsets), "_block")  # one row per task of the sort
        .withColumn(name, (F.col("_offset") + within + 1).cast("long"))
        .drop("_at", "_block", "_offset")
    )
