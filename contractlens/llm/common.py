"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.session import materialize, settled, work_dir  # noqa: F401

# Fixed value: the white space that separates words.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
WORD_RE = re.compile(WORD)

TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn long, role string, text string",
}
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, whatever the length of its texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20))


def text_blocks(batch: pa.RecordBatch, column: str, size: int = 1 << 19) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) blocks of about ``size`` characters; NULL becomes ''."""
    block: list[str] = []
    held, first = 0, 0
    for at, text in enumerate(batch.column(column).to_pylist()):
        block.append(text or "")
        held += len(block[-1])
        if held >= size:
            yield first, block
            block, held, first = [], 0, at + 1
    if block:
        yield first, block

