"""Registered queries of the training-data operators, and their SQL where SQL can say it.

Every query applies its operator, with production parameters, to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.llm import (
    adaptive_quality, angle_negatives, dart_minhash, disclosure, fair_queue, language_mixture, licence_scan, norm_topk, parse_dedup, piece_codec,
    pivot_clusters, quote_threads, warc_index,
)
from contractlens.llm.common import table, word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DUCK_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


def query(name: str, sql: str | None = None):
    def register(job):
        QUERIES[name] = job
        if sql is not None:
            ORACLE[name] = sql
        return job

    return register


def piece_model() -> str:
    """Path of the public vocabulary, on every executor."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op1_language_mixture")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_mixture.is_held_out(F.col("doc_id"))
    model = language_mixture.learn(docs.filter(~held_out))
    found = language_mixture.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "langs", "shares")


@query("op2_dart_minhash", dart_minhash.oracle())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_parse_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = parse_dedup.with_passages(table(spark, sf_dir, "documents"))
    total = lambda spans: F.coalesce(F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]), F.lit(0))
    return found.select(
        "doc_id",
        "n_bytes",
        total("spans").cast("long").alias("n_removed"),
        F.greatest(F.coalesce(F.size("spans"), F.lit(0)), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce(F.sha2("kept", 256), F.col("whole_sha256")).alias("kept_sha256"),
        total("passages").cast("long").alias("n_passage_words"),
        (total("passages") > 0).alias("in_passage"),
    )


@query("op4_fair_queue_mix", fair_queue.oracle(DUCK_WORDS))
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return fair_queue.fair_mix(docs, F.col("size")).select("doc_id", "size", "source_size", "target", "taken")


@query("op5_piece_codec")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = piece_codec.encode(table(spark, sf_dir, "documents"), piece_model())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(piece_codec.ids_text(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op6_warc_index", warc_index.oracle())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc_index.archive(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_adaptive_quality", adaptive_quality.oracle())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    judged = adaptive_quality.judge(docs, keep_text=False)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op8_norm_topk", """
with usable as (
  select vec_id, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] as v from embeddings
  where embedding is not null and len([1 for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
  from usable q join usable c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from scored qualify rank <= 10""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query("op9_licence_scan", licence_scan.oracle())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan.by_document(table(spark, sf_dir, "documents"))


# The SQL says what remains of the operator where no message quotes; quotations are held to a brute-force version in the tests.
@query("op10_quote_threads", r"""
select conv_id, turn, role, case when turn is not null then conv_id end as root_conv,
  case when conv_id is not null and turn is not null then root end as root_turn, case when conv_id is not null and turn is not null then place - 1 end as depth,
  case when conv_id is not null and turn is not null then place - 1 end as position,
  case when before is not null then conv_id end as reply_conv, before as reply_turn, false as linked,
  cast(0 as bigint) as n_levels, cast(0 as bigint) as n_quoted, body, '<|' || coalesce(role, '') || '|>' || chr(10) || body as formatted
from (
  select *, min(turn) over (partition by conv_id) as root, dense_rank() over (partition by conv_id order by turn nulls last) as place,
    max(turn) over (partition by conv_id order by turn range between unbounded preceding and 1 preceding) as before,
    regexp_replace(regexp_replace(coalesce(text, ''), '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') as body
  from conversations)""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_threads.thread(table(spark, sf_dir, "conversations")).drop("links")


@query("op11_disclosure", disclosure.oracle())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@query("op12_angle_negatives", angle_negatives.oracle())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return angle_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


@query("op13_pivot_clusters", pivot_clusters.oracle())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_clusters.cluster(table(spark, sf_dir, "embeddings"))
