"""Declared constraints of stored tables: row rules, keys, references.

A table's row rules are one aggregate over one scan.  A key or a reference is one
pass that counts rows per key before anything is shuffled, so a key held by a
third of all rows is one row per task.  NULL behaves as in a database: a rule
whose result is unknown is kept, a reference with a NULL part points nowhere and
is kept, and two NULLs in a key are the same value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT = ["table_name", "constraint_name", "kind", "broken_rows"]
ROWS = ["table_name", "constraint_name", "kind", "row_id"]


@dataclass(frozen=True)
class Reference:
    columns: Sequence[str]
    parent: str  # a table of the same set of tables
    parent_columns: Sequence[str] = ()  # the same names, if not given


@dataclass(frozen=True)
class Constraints:
    """``identity`` names a row in the output; rules are SQL conditions that no row may break."""

    identity: Sequence[str]
    checks: Mapping[str, str] = field(default_factory=dict)
    unique: Mapping[str, Sequence[str]] = field(default_factory=dict)
    references: Mapping[str, Reference] = field(default_factory=dict)
    required: Sequence[str] = ()  # columns without NULL

    def rules(self) -> dict[str, str]:
        return {**{f"{c} is set": f"{c} IS NOT NULL" for c in self.required}, **self.checks}


def broken(rule: str) -> Column:
    return F.coalesce(~F.expr(rule), F.lit(False))


def _labels(table: str, name: Column, kind: str) -> list[Column]:
    return [F.lit(table).alias("table_name"), name.alias("constraint_name"), F.lit(kind).alias("kind")]


def repeated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys held by several rows, with their number."""
    return df.groupBy(*columns).agg(F.count("*").alias("_n")).filter("_n > 1")


def orphans(df: DataFrame, ref: Reference, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Values of a reference without a parent row, with the number of rows that hold them."""
    held = df.dropna(subset=list(ref.columns)).groupBy(*ref.columns).agg(F.count("*").alias("_n"))
    names = list(ref.parent_columns or ref.columns)
    parent = tables[ref.parent].select(*[F.col(p).alias(c) for p, c in zip(names, ref.columns)])
    return held.join(parent, list(ref.columns), "left_anti")


def report(tables: Mapping[str, DataFrame], declared: Mapping[str, Constraints]) -> DataFrame:
    """One row per constraint: table_name, constraint_name, kind, broken_rows, passed."""
    parts = []
    for table, set_ in declared.items():
        df, rules = tables[table], set_.rules()
        if rules:
            counts = df.agg(*[F.count_if(broken(rule)).alias(f"r{i}") for i, rule in enumerate(rules.values())])
            rows = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.col(f"r{i}").alias("n")) for i, name in enumerate(rules)]))
            parts.append(counts.select(rows.alias("r")).select(*_labels(table, F.col("r.name"), "check"), F.col("r.n").alias("broken_rows")))
        found = [(name, "unique", repeated(df, columns)) for name, columns in set_.unique.items()]
        found += [(name, "reference", orphans(df, ref, tables)) for name, ref in set_.references.items()]
        for name, kind, keys in found:
            total = keys.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("broken_rows"))
            parts.append(total.select(*_labels(table, F.lit(name), kind), "broken_rows"))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("broken_rows") == 0)


def broken_rows(tables: Mapping[str, DataFrame], declared: Mapping[str, Constraints]) -> DataFrame:
    """The rows that break a constraint, once per constraint: table_name, constraint_name, kind, row_id."""
    parts = []
    for table, set_ in declared.items():
        df, rules = tables[table], set_.rules()
        row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in set_.identity]).alias("row_id")
        if rules:
            names = F.array_compact(F.array(*[F.when(broken(rule), F.lit(name)) for name, rule in rules.items()]))
            parts.append(df.select(F.explode(names).alias("_name"), row).select(*_labels(table, F.col("_name"), "check"), "row_id"))
        for name, columns in set_.unique.items():
            same = reduce(lambda a, b: a & b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns])
            hits = df.alias("a").join(repeated(df, columns).alias("b"), same, "left_semi")
            parts.append(hits.select(*_labels(table, F.lit(name), "unique"), row))
        for name, ref in set_.references.items():
            hits = df.join(orphans(df, ref, tables), list(ref.columns), "left_semi")
            parts.append(hits.select(*_labels(table, F.lit(name), "reference"), row))
    return reduce(DataFrame.unionByName, parts).select(*ROWS)


def enforce(tables: Mapping[str, DataFrame], declared: Mapping[str, Constraints]) -> None:
    """Stop with the constraints that are broken."""
    failed = report(tables, declared).filter("not passed").collect()  # one per constraint
    if failed:
        raise ValueError("broken constraints: " + "; ".join(f"{r.table_name}: {r.constraint_name} ({r.broken_rows} rows)" for r in failed))
