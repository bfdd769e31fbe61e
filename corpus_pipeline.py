"""From raw documents to token ids: quality, near and exact copies, mix, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.llm import adaptive_quality, dart_minhash, fair_queue, parse_dedup, piece_codec
from contractlens.llm.common import DOCUMENT_COLUMNS, materialize, table, word_count
from contractlens.llm.queries import piece_model


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the rules reject go.

    NULL and empty texts go with them; texts of any length are judged whole;
    equal rows get equal verdicts; an empty table stays empty; columns beyond
    those of documents go.
    """
    return adaptive_quality.judge(docs).filter("kept").select(*DOCUMENT_COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of each class of near copies one row stays, that with the smallest id (NULL last).

    Every row is a document of its own, whatever its id: different texts under
    one id, or without id, all stay; equal texts are copies.  Rows without a word
    are copies of nothing and stay.
    """
    rows = materialize(docs.select(*DOCUMENT_COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")
    classes = dart_minhash.near_duplicates(rows.select("_row", "text"), doc_id="_row").select("_row", "class_id")
    classes = materialize(classes, "classes")
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("_row").alias("_row"))
    stay = classes.join(rows.select("_row", "doc_id"), "_row").groupBy("class_id").agg(F.min(order).alias("_first"))
    gone = materialize(classes.join(stay.select("_first._row"), "_row", "left_anti").select("_row"), "gone")
    return rows.join(gone, "_row", "left_anti").select(*DOCUMENT_COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: passages of more than fifty words that stand twice, within or across documents, are cut out.

    A word goes if 51 words in a row that hold it also start anywhere else; runs
    go with the white space inside.  All documents stay, NULL texts too.
    """
    cut = parse_dedup.without_repeats(docs, length=parse_dedup.PASSAGE_WORDS, unit=parse_dedup.WORDS)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: every document as often as the mix serves it.

    Documents without words (NULL, empty) are not served; a NULL source is a
    source; equal rows are served one by one; an empty table stays empty.
    """
    mixed = fair_queue.fair_mix(docs, word_count(F.col("text")))
    return fair_queue.repeat_taken(mixed, DOCUMENT_COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: ids and decoded text, the last stage.

    A NULL or empty text has no ids; whole texts are encoded; equal rows give
    equal ids; an empty table stays empty.
    """
    return piece_codec.encode(docs, piece_model(), keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality_rules", quality),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("mix_sources", mix),
    ("encode_pieces", encode),
]
ORACLE_SQL = None  # the stages on shingles, darts and pieces have no SQL form; tests hold them to brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
