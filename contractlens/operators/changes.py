"""Changing stored rows: slice replacement, upserts and versioned dimensions.

Files are immutable, so each operator returns the new state of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.operators.shape import dense_number
from contractlens.session import materialize


def replace_slice(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the stored rows whose slice is re-delivered, then add the new rows.

    Running it twice with the same input gives the same table.
    """
    delivered = incoming.select(*keys).distinct()
    return existing.join(delivered, list(keys), "left_anti").unionByName(incoming, allowMissingColumns=True)


def upsert_type1(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Overwrite matched rows with the source's columns, add unmatched rows."""
    theirs = source.select(key, F.struct(*[c for c in source.columns if c != key]).alias("_new"))
    joined = target.join(theirs, key, "full_outer")
    found = F.col("_new").isNotNull()
    columns = [
        F.when(found, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in source.columns and c != key else F.col(c)
        for c in target.columns
    ]
    return joined.select(*columns)


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add source rows whose key is not stored; stored rows stay as they are."""
    return target.unionByName(
        source.join(target.select(*keys), list(keys), "left_anti"), allowMissingColumns=True
    )


def scd2_merge(
    dimension: DataFrame,
    staged: DataFrame,
    code: str,
    surrogate: str,
    attributes: Sequence[str],
    hash_column: str = "row_hash",
) -> DataFrame:
    """Versioned merge; a code staged twice is an error.

    Against the current version of a code: an equal hash keeps it; a changed
    hash with the same start rewrites it; a later start closes it the day
    before and opens a new version; an earlier start is ignored.  A code
    without a current version is opened.
    """
    carried = [*attributes, hash_column]
    current = dimension.filter("is_current")
    old = current.select(F.struct(*dimension.columns).alias("o"), F.col(code))
    # combined before the shuffle; the error is raised where the second row of a code shows up
    twice = F.raise_error(F.concat(F.lit("staged twice: "), F.col(code))).cast("boolean")
    new = (
        staged.groupBy(code)
        .agg(F.first(F.struct(code, *carried, "valid_from")).alias("n"), F.count("*").alias("_n"))
        .filter(F.when(F.col("_n") > 1, twice).otherwise(F.lit(True)))
        .select("n", code)
    )
    pair = old.join(new, code, "full_outer").select("o", "n")

    changed = F.col(f"o.{hash_column}") != F.col(f"n.{hash_column}")
    start_old, start_new = F.col("o.valid_from"), F.col("n.valid_from")
    rewrite = changed & (start_old == start_new)
    close = changed & (start_new > start_old)
    open_new = F.col("o").isNull() | F.coalesce(close, F.lit(False))

    def version(pick) -> Column:
        return F.struct(*[pick(f).cast(f.dataType).alias(f.name) for f in dimension.schema.fields])

    def kept(field):
        name = field.name
        if name in carried:
            return F.when(rewrite, F.col(f"n.{name}")).otherwise(F.col(f"o.{name}"))
        if name == "valid_to":
            return F.when(close, F.date_sub(start_new, 1)).otherwise(F.col("o.valid_to"))
        if name == "is_current":
            return F.coalesce(~close, F.lit(True))
        return F.col(f"o.{name}")

    def opened(field):
        name = field.name
        if name in (surrogate, "valid_to"):
            return F.lit(None)
        return F.lit(True) if name == "is_current" else F.col(f"n.{name}")

    versions = pair.select(
        F.explode(
            F.concat(
                F.when(F.col("o").isNotNull(), F.array(version(kept))).otherwise(F.array()),
                F.when(open_new, F.array(version(opened))).otherwise(F.array()),
            )
        ).alias("v")
    ).select("v.*")
    versions = materialize(versions, "versions")  # the outer join runs once for the kept and the numbered rows
    last_key = F.coalesce(dimension.agg(F.max(surrogate)).scalar(), F.lit(0))
    added = dense_number(versions.filter(F.col(surrogate).isNull()), "_n", [F.asc(code)])
    return (
        dimension.filter("not is_current")
        .unionByName(versions.filter(F.col(surrogate).isNotNull()))
        .unionByName(added.withColumn(surrogate, (last_key + F.col("_n")).cast("long")).drop("_n"))
    )
