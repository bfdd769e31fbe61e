"""Near-duplicate classes with DartMinHash signatures.

A text is a weighted set: its five-word shingles with their counts.  Hashed
darts are thrown into the region of every element (its weight by a rank axis);
each dart belongs to one signature coordinate and a coordinate keeps the dart of
lowest rank.  Two texts agree in a coordinate with the probability of their
weighted Jaccard similarity, and the work follows the number of darts, not
elements times coordinates.  Bands of coordinates are join keys; candidates are
verified exactly, and classes are the connected components of verified links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractlens.llm.common import WORD, WORD_RE, materialize, small_batches, text_blocks
from contractlens.llm.hashing import U, mix, shingles_of

SHINGLE = 5
SIMILARITY = 0.8
ROWS, BANDS = 5, 24  # a pair at the threshold shares no band with probability below 1e-4
COORDINATES = ROWS * BANDS
BLOCK_TEXTS, BLOCK_CHARS = 192, 4_000_000
COLUMNS = 16_384  # of a matrix product at a time
DARTS = COORDINATES * (np.log(COORDINATES) + 2)  # expected below the first rank limit


def elements(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of the texts' distinct shingles, ordered by text."""
    shingle, text = shingles_of(texts, SHINGLE)
    order = np.lexsort((shingle, text))
    shingle, text = shingle[order], text[order]
    new = np.ones(len(text), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], shingle[at], np.diff(np.append(at, len(text)))


def throw(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, coordinate, rank, dart) of all darts below each text's rank ``limit``.

    The weight axis is cut at 1, 2, 4, ...; in each cell darts arrive along the
    rank axis as a Poisson process whose seed is shingle and cell, so texts see
    the same darts wherever their regions overlap.
    """
    levels = 1 + np.ceil(np.log2(weight)).astype(np.int64)  # cells that begin below the weight
    cell = np.arange(levels.sum()) - np.repeat(np.cumsum(levels) - levels, levels)
    owner, weight, key = np.repeat(owner, levels), np.repeat(weight, levels), np.repeat(shingle, levels)
    low = np.where(cell == 0, 0, 2.0 ** (cell - 1))
    width = np.where(cell == 0, 1, low)
    key = mix(key + cell.astype(np.uint64) * U(0x8CB92BA72F3D8DD7))
    rank, found, i = np.zeros(len(key)), [], 0
    unit = lambda h: ((h >> U(11)).astype(np.float64) + 0.5) * 2.0**-53
    while len(key):
        i += 1
        dart = mix(key + U(i * 0x9E3779B97F4A7C15 % (1 << 64)))
        rank = rank - np.log(unit(dart)) / width
        alive = rank < limit[owner]
        owner, weight, key, low, width, rank, dart = (x[alive] for x in (owner, weight, key, low, width, rank, dart))
        place = mix(dart ^ U(0x5851F42D4C957F2D))
        inside = low + width * unit(place) < weight
        found.append((owner[inside], (mix(place) % U(COORDINATES)).astype(np.int64)[inside], rank[inside], dart[inside]))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 4


def signatures(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(texts x coordinates) darts, and which texts have a signature (those with a word)."""
    owner, shingle, weight = elements(texts)
    total = np.bincount(owner, weight, minlength=len(texts))
    signed = total > 0
    sign = np.zeros((len(texts), COORDINATES), np.uint64)
    limit, open_ = DARTS / np.maximum(total, 1), signed.copy()
    while open_.any():
        own = open_[owner]
        who, where, rank, dart = throw(owner[own], shingle[own], weight[own], limit)
        order = np.argsort(-rank, kind="stable")
        sign[who[order], where[order]] = dart[order]  # the lowest rank is written last
        filled = np.zeros(sign.shape, bool)
        filled[who, where] = True
        open_ &= ~filled.all(1)
        limit = np.where(open_, limit * 2, limit)
    return sign, signed


def bands_of(sign: np.ndarray) -> np.ndarray:
    """One join key per band, texts x bands."""
    odd = mix(np.arange(1, ROWS + 1, dtype=np.uint64)) | U(1)
    key = (sign.reshape(len(sign), BANDS, ROWS) * odd).sum(2, dtype=np.uint64)
    return mix(key + np.arange(BANDS, dtype=np.uint64) * U(0xD6E8FEB86659FD93)).view(np.int64)


def sign_documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, size, `copy` (128-bit hash of the word sequence) and `bands`; the last two NULL for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_blocks(batch, "text"):
                sign, signed = signatures(texts)
                keys = bands_of(sign).tolist()
                copies = [xxhash.xxh3_128_digest(" ".join(WORD_RE.findall(t)).encode("utf-8", "surrogatepass")) if s else None for t, s in zip(texts, signed)]
                bands = [k if s else None for k, s in zip(keys, signed)]
                made = [pa.array(map(len, texts), pa.int64()), pa.array(copies, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, len(texts)), *made], ["id", "size", "copy", "bands"])

    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "id long, size long, copy binary, bands array<long>"
    )


def similarities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate rows with both texts -> exact weighted Jaccard similarity."""
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def bag(i: int, text: str) -> tuple[np.ndarray, np.ndarray]:
        if i not in known:
            if len(known) >= 64:
                known.clear()
            known[i] = elements([text])[1:]
        return known[i]

    for batch in batches:
        ids = [batch.column(c).to_pylist() for c in ("a", "b")]
        texts = [batch.column(c) for c in ("a_text", "b_text")]
        out = []
        for row, (a, b) in enumerate(zip(*ids)):
            (x, n), (y, m) = bag(a, texts[0][row].as_py()), bag(b, texts[1][row].as_py())
            _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
            common = np.minimum(n[i], m[j]).sum()
            out.append(common / (n.sum() + m.sum() - common))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], ["a", "b", "similarity"])


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose exact similarity reaches the threshold."""
    side = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"{c}_text"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_text", "b_text")
    return both.mapInArrow(similarities, "a long, b long, similarity double").filter(F.col("similarity") >= similarity)


def block_links(threshold: float):
    """(left block, right block) rows -> links between classes, no more than join them.

    All similarities of two blocks come from one matrix product: a text is a 0/1
    row over (shingle, occurrence), so a product of rows is the common weight.
    """

    def rows_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owner, shingle, count = elements(texts)
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(owner, count), mix(np.repeat(shingle, count) + nth.astype(np.uint64)), np.bincount(owner, count, minlength=len(texts))

    def links(left: list[dict], right: list[dict]) -> Iterator[tuple[int, int]]:
        (i, x, n), (j, y, m) = rows_of([r["text"] for r in left]), rows_of([r["text"] for r in right])
        both = np.intersect1d(x, y)
        common = np.zeros((len(left), len(right)))
        for at in range(0, len(both), COLUMNS):
            part = both[at : at + COLUMNS]
            dense = []
            for rows, keys, height in ((i, x, len(left)), (j, y, len(right))):
                column = np.minimum(np.searchsorted(part, keys), len(part) - 1)
                found = part[column] == keys
                matrix = np.zeros((height, len(part)), np.float32)
                matrix[rows[found], column[found]] = 1
                dense.append(matrix)
            common += dense[0] @ dense[1].T
        alike = common >= threshold * (n[:, None] + m[None, :] - common) - 1e-9
        group = {r["class_id"]: r["class_id"] for r in left + right}
        for a, b in zip(*np.nonzero(alike)):
            ends = []
            for c in (left[a]["class_id"], right[b]["class_id"]):
                while group[c] != c:
                    group[c] = c = group[group[c]]
                ends.append(c)
            if ends[0] != ends[1]:
                group[max(ends)] = min(ends)
                yield left[a]["id"], right[b]["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = list(links(batch.column("left")[row].as_py(), batch.column("right")[row].as_py()))
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def links_between_classes(open_: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links between different classes of one bucket, complete.

    ``open_`` has bucket, id, size, class_id.  A bucket is cut into blocks of
    about BLOCK_TEXTS texts or BLOCK_CHARS characters, and every two blocks meet
    in a row of their own, so that a large bucket is spread over many tasks.
    """
    parts = open_.groupBy("bucket").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_TEXTS, F.sum("size") / BLOCK_CHARS)).cast("int").alias("parts")
    )
    member = F.struct("id", "class_id", "text").alias("member")
    placed = open_.join(parts, "bucket").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    blocks = placed.join(texts, "id").groupBy("bucket", "part", "parts").agg(F.collect_list(member).alias("members"))
    blocks = materialize(blocks, "blocks")
    left = blocks.select("bucket", F.col("members").alias("left"), F.explode(F.sequence("part", F.col("parts") - 1)).alias("part"))
    pairs = left.join(blocks.select("bucket", "part", F.col("members").alias("right")), ["bucket", "part"])
    return pairs.select("left", "right").mapInArrow(block_links(similarity), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) -> (id, class_id): the smallest id each one is connected with.

    Alternating star contractions; every round is written, none is collected.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u <> v").distinct(), "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = materialize(small.select("e.*").filter("u <> v").distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("class_id"))
        mark = now


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """(doc_id, copy_id, class_id), one row per input row.

    `copy_id` is the smallest id with the same word sequence, `class_id` the
    smallest id of the near-duplicate class: the documents that links of the
    given weighted Jaccard similarity of five-word shingles connect.  NULL and
    empty texts and texts without words are classes of their own; rows with a
    NULL id have NULL classes.  Rows repeated under one id are one document; an
    empty table gives no rows.  Other columns play no part.

    Only one text of each group of copies is compared.  Each bucket first tries
    its members against its smallest id, which settles nearly all of them; in a
    bucket that then still holds different classes all texts are compared, block
    by block, and only links that join classes leave the task.
    """
    small_batches(docs.sparkSession)
    signed = materialize(sign_documents(docs, doc_id, text), "signed")
    copies = signed.filter("copy is not null and id is not null").groupBy("copy").agg(F.min("id").alias("copy_id"))
    copies = materialize(copies, "copies")
    kept = signed.join(copies.select("copy", F.col("copy_id").alias("id")), ["copy", "id"]).dropDuplicates(["id"])
    entries = kept.select("id", "size", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("leader")).filter("n > 1")
    buckets = materialize(entries.join(shared.drop("n"), "bucket"), "buckets")
    # A table of its own size, so that the join with all texts can see how small it is.
    wanted = materialize(buckets.select("id").distinct(), "wanted")
    sources = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(wanted, "id", "left_semi")
    texts = materialize(sources.dropDuplicates(["id"]), "texts")

    pairs = buckets.filter("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    first = materialize(verified(pairs, texts, similarity).select("a", "b"), "links")
    label = components(first)
    placed = buckets.select("bucket", "id", "size").join(label, "id", "left").withColumn("class_id", F.coalesce("class_id", "id"))
    mixed = placed.groupBy("bucket").agg(F.min("class_id").alias("_x"), F.max("class_id").alias("_y")).filter("_x <> _y")
    open_ = materialize(placed.join(mixed.select("bucket"), "bucket", "left_semi"), "open")
    second = materialize(links_between_classes(open_, texts, similarity), "links")
    label = components(first.unionByName(second)).withColumnRenamed("id", "copy_id")
    named = signed.join(copies, "copy", "left").withColumn("copy_id", F.coalesce("copy_id", "id"))
    return named.join(label, "copy_id", "left").select(
        F.col("id").alias(doc_id), "copy_id", F.coalesce("class_id", "copy_id").alias("class_id")
    )


def oracle() -> str:
    """The same classes from all pairs that share a shingle, linked by the exact similarity."""
    tenths = round(SIMILARITY * 10)
    return f"""
with recursive texts as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
copies as (select doc_id, case when len(w) = 0 then doc_id else min(doc_id) over (partition by w) end as copy_id from texts),
runs as (
  select doc_id, unnest([w[i : i + {SHINGLE - 1}] for i in range(1, greatest(len(w) - {SHINGLE - 2}, 2))]) as shingle from texts where len(w) > 0),
bags as (select doc_id, shingle, count(*) as n from runs group by all),
sizes as (select doc_id, sum(n) as size from bags group by doc_id),
meet as (select a.doc_id as x, b.doc_id as y, sum(least(a.n, b.n)) as shared from bags a join bags b using (shingle) where a.doc_id <> b.doc_id group by all),
links as (
  select x, y from meet join sizes p on p.doc_id = x join sizes q on q.doc_id = y
  where 10 * shared >= {tenths} * (p.size + q.size - shared)),
reach(doc_id, other) as (select doc_id, doc_id from texts union select r.doc_id, l.y from reach r join links l on l.x = r.other),
classes as (select doc_id, min(other) as class_id from reach group by doc_id)
select doc_id, copy_id, class_id from copies join classes using (doc_id)"""
