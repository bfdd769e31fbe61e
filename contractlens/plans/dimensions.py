"""Type-1 dimensions with keys that last: upsert of all of them in one published version.

Rows are matched by code.  A known code takes the delivered attributes and keeps
its key; a new code gets the next one; a code that is not delivered stays as it
is.  Keys are never given twice: the map from code to key is stored with the
dimension and only grows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.operators.shape import dense_number
from contractlens.session import cut_points, materialize
from contractlens.sources.slices import exists
from contractlens.sources.store import current_version, publish, read_table


@dataclass(frozen=True)
class Dimension:
    codes: tuple[str, ...]  # what names a row
    key: str  # its surrogate
    update: bool = True  # False: a seed, known rows stay as they are


DIMENSIONS = {
    "client": Dimension(("client_code",), "client_key"),
    "unit": Dimension(("unit_code",), "unit_key"),
    "service": Dimension(("service_code",), "service_key"),
    "role": Dimension(("role_code",), "role_key"),
    "manager": Dimension(("manager_code",), "manager_key"),
    "cost_category": Dimension(("cost_group", "cost_category", "cost_subcategory"), "cost_category_key"),
    "incident_type": Dimension(("incident_category", "incident_subcategory", "root_cause"), "incident_type_key"),
    "action": Dimension(("action_code",), "action_key", update=False),
}


def upsert(stored: DataFrame | None, delivered: DataFrame, dimension: Dimension) -> DataFrame:
    """The dimension after a delivery.  A code delivered twice, or without value, is an error."""
    codes, key = list(dimension.codes), dimension.key
    held = F.concat_ws(" / ", *codes)
    blank = F.raise_error(F.lit(f"{key}: a code is missing")).cast("boolean")
    twice = F.raise_error(F.concat(F.lit(f"{key}: delivered twice: "), held)).cast("boolean")
    attributes = [c for c in delivered.columns if c not in codes]
    row = F.struct(*[F.col(c) for c in attributes]) if attributes else F.struct(F.lit(0))
    missing = F.lit(False)
    for c in codes:
        missing = missing | F.col(c).isNull()
    new = delivered.groupBy(*codes).agg(F.first(row).alias("_new"), F.count("*").alias("_n"))
    new = new.filter(F.when(missing, blank).when(F.col("_n") > 1, twice).otherwise(F.lit(True))).drop("_n")
    if stored is None:
        kinds = {f.name: f.dataType for f in delivered.schema.fields}
        empty = [F.lit(None).cast("long").alias(key), *[F.lit(None).cast(kinds[c]).alias(c) for c in [*codes, *attributes]]]
        stored = delivered.limit(0).select(*empty)
    columns = [c for c in stored.columns if c != key]
    found = F.col("_new").isNotNull()

    def value(c: str):
        if c in codes or c not in attributes:
            return F.col(c)
        theirs = F.col(f"_new.{c}")
        taken = found if dimension.update else found & F.col(key).isNull()
        return F.when(taken, theirs).otherwise(F.col(c)).alias(c)

    merged = materialize(stored.join(new, codes, "full_outer").select(key, *[value(c) for c in columns]), "dimension")  # the join runs once
    last = stored.agg(F.max(key)).first()[0] or 0
    added = dense_number(merged.filter(F.col(key).isNull()), "_n", [F.asc(c) for c in codes])
    added = added.withColumn(key, (F.col("_n") + last).cast("long")).drop("_n")
    return merged.filter(F.col(key).isNotNull()).unionByName(added)


def run_dimensions(
    spark: SparkSession, root: str, delivered: Mapping[str, DataFrame], dimensions: Mapping[str, Dimension] = DIMENSIONS
) -> None:
    """Upsert every delivered dimension and publish all of them as one version; the others go on as they are."""
    unknown = sorted(set(delivered) - set(dimensions))
    if unknown:
        raise ValueError(f"unknown dimensions: {', '.join(unknown)}")
    with cut_points(spark):
        runs = spark.read.parquet(f"{root}/current").count() if exists(spark, f"{root}/current") else 0
        tables = {}
        for name, dimension in dimensions.items():
            stored = _stored(spark, root, name) if runs else None
            if name in delivered:
                tables[name] = upsert(stored, delivered[name], dimension)
            elif stored is not None:
                tables[name] = stored
        publish(spark, root, f"run-{runs + 1}", tables)


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    there = exists(spark, f"{root}/{current_version(spark, root)}/{name}")
    return read_table(spark, root, name) if there else None
