"""Delimited raw files: text in, text out, with lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contractlens.plans.staging import StagedSource
from contractlens.session import materialize
from contractlens.sources import quoted
from contractlens.sources.quoted import SEPARATOR

BOM = "﻿"


def raw_columns(source: StagedSource) -> list[str]:
    """Input column of every typed column."""
    return [entry[1] if isinstance(entry, tuple) else name for name, entry in source.typing.items()]


OPTIONS = {"sep": SEPARATOR, "encoding": "UTF-8", "quote": '"', "escape": '"'}


def read_delimited(
    spark: SparkSession, path: str, columns: list[str], batch_id: int, multi_line: bool = True, file_column: str | None = None
) -> DataFrame:
    """Semicolon-separated UTF-8 with header; every column text, blank = NULL.

    Columns are found by their name in the header: their order is free, further
    columns are left out, a missing one is an error.  All files of a folder need
    the header of the first.  Doubled quotes inside quotes are one quote.  A
    quoted value may hold line breaks; large files are read by many tasks all
    the same (see `quoted`).  ``multi_line=False`` saves that work for files
    known to have none.

    Adds ``batch_id`` and the 1-based ``source_row_number`` in record order, and
    the file's path where ``file_column`` names a column for it.  A missing file
    fails at once; one without records fails here.  The text is parsed once and
    kept as a cut point.
    """
    options = OPTIONS | {"header": True, "multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    named = {h.replace(BOM, "").strip(): h for h in header}
    absent = [c for c in columns if c not in named]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    schema = ", ".join(f"`{h}` string" for h in header)
    clean = [F.nullif(F.trim(F.col(f"`{named[c]}`")), F.lit("")).alias(c) for c in columns]
    if multi_line:
        rows = _spanning(spark, path, header, schema, clean)
    else:
        block = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
        parsed = spark.read.schema(schema).options(**options, enforceSchema=False).csv(path)
        parsed = parsed.select(*clean, block.alias("_block"), F.monotonically_increasing_id().alias("_at"))
        rows = number_rows(materialize(parsed, "raw")).withColumn("_path", F.col("_block.path"))
    if rows.isEmpty():
        raise ValueError(f"no rows in {path}")
    file = [F.col("_path").alias(file_column)] if file_column else []
    return rows.select(F.lit(batch_id).alias("batch_id"), "source_row_number", *file, *columns)


def _spanning(spark: SparkSession, path: str, header: list[str], schema: str, clean: list) -> DataFrame:
    """Parsed records that may span lines; the first of each file is its header."""
    found = quoted.records(spark, path)
    bare = F.when(F.col("number") == 1, F.ltrim("record", F.lit(BOM))).otherwise(F.col("record"))
    values = F.from_csv(bare, schema, {**OPTIONS, "multiLine": "true"})
    parsed = found.select(F.col("path").alias("_path"), "number", values.alias("v")).select("_path", "number", "v.*")
    head = F.when(F.col("number") == 1, F.array(*[F.coalesce(F.col(f"`{h}`"), F.lit("")) for h in header]))
    rows = parsed.select("_path", (F.col("number") - 1).alias("source_row_number"), head.alias("_head"), *clean)
    rows = materialize(rows, "raw")
    wanted = F.array(*[F.lit(h.replace(BOM, "")) for h in header])
    other = rows.filter(F.col("_head").isNotNull() & (F.col("_head") != wanted)).select("_path").head()
    if other:
        raise ValueError(f"the header of {other[0]} differs from the first file's")
    return rows.filter("source_row_number > 0").drop("_head")


def number_rows(rows: DataFrame) -> DataFrame:
    """Row number inside a file, counted per file block.

    Positions are consecutive inside a block, so only one row per block (its
    first position and size) is needed to place every row.
    """
    blocks = rows.groupBy("_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
    earlier = Window.partitionBy("_block.path").orderBy("_block.start").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.select("_block", "_first", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_at") - F.col("_first") + 1
    return rows.join(placed, "_block").withColumn("source_row_number", number.cast("long"))


def store_batch(df: DataFrame, folder: str, batch_id: int) -> DataFrame:
    """Store the rows of a batch whole; a re-run of the batch replaces them."""
    path = f"{folder}/batch_id={batch_id}"
    df.drop("batch_id").write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).withColumn("batch_id", F.lit(batch_id))
