"""Hard negatives of anchors, found through stored angles to reference directions.

Vectors become whole numbers.  Their lengths and their angles to a few reference
directions are stored once.  On the sphere the angle between two vectors is at
least the difference of their angles to any reference, and at most the sum (or
what the sum lacks to the full circle), so the stored angles give an interval of
the cosine; times both lengths, widened by more than any rounding, this bounds
the integer score.  An anchor asks for scores inside windows: its positives for
the highest of its own label, its negatives for a band below each positive's
score.  Only vectors whose interval overlaps a window get their integer score.

Vectors lie in blocks sorted by label and angles.  Blocks carry the ranges of
their angles and lengths, so the same interval rules out pairs of blocks before
any vector is sent.  Block pairs are taken in rounds, the promising ones first;
the k-th score found so far raises the window's lower end, and eight times as
many blocks follow in the next round, so few rows leave a task that cannot win.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlens.llm.common import materialize, small_batches
from contractlens.llm.norm_topk import gram, matrix_of

SCALE = 256
REFERENCES = 16
BLOCK_ROWS = 4096  # vectors per block, about
ANCHOR_ROWS = 256  # anchors per block, at most
GROWTH = 8  # block pairs of a round against those of all rounds before it
ANGLE_SLACK = 1e-6  # above the rounding of an arc cosine, also next to 0 and pi
SCORE_SLACK = 1e-9  # share of both lengths, above the rounding of the products
MOST_LENGTH = 2.0**31  # scores of longer vectors could leave 63 bits
LOWEST, HIGHEST = -(1 << 62), 1 << 62
ORDER = ["label", "home", "near", "row"]
BLOCK = (
    "rows array<long>, ids array<long>, labels array<long>, whole binary, lengths binary, angles binary, "
    "least_length double, most_length double, least_angles array<double>, most_angles array<double>"
)
HITS = "a_block long, place int, w int, vec_id long, row long, score long"


def whole_vectors(vectors: DataFrame, is_anchor: Column, vec_id: str, label: str, embedding: str) -> DataFrame:
    """Usable vectors as whole numbers, each under a row number of its own."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    usable = vectors.filter(F.col(embedding).isNotNull() & F.col(label).isNotNull()).filter(~bad)
    return usable.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        whole.alias("x"),
    )


def with_angles(whole: DataFrame, references: np.ndarray, dim: int) -> DataFrame:
    """Adds length, angles to the references, and the nearest reference with its angle; written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column("x"), dim).astype(np.float64)
            length = np.sqrt((x**2).sum(1))
            if length.max() > MOST_LENGTH:
                raise ValueError(f"a vector is longer than {MOST_LENGTH:.0f} after scaling: scores would not fit 64 bits")
            cosine = (x @ references) / np.maximum(length, 1e-300)[:, None]
            angles = np.arccos(np.clip(cosine, -1, 1))  # vectors of length zero: a right angle; their scores are zero
            home = angles.argmin(1)
            offsets = np.arange(0, angles.size + 1, angles.shape[1], dtype=np.int32)
            columns = [batch.column(c) for c in ("row", "vec_id", "label", "is_anchor", "x")]
            columns += [pa.array(length), pa.ListArray.from_arrays(pa.array(offsets), pa.array(angles.ravel()))]
            columns += [pa.array(home, pa.int32()), pa.array(angles[np.arange(len(home)), home])]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["row", "vec_id", "label", "is_anchor", "x", "length", "angles", "home", "near"]
    schema = "row long, vec_id long, label long, is_anchor boolean, x array<long>, length double, angles array<double>, home int, near double"
    return materialize(whole.mapInArrow(run, schema), "angles")


def packer(dim: int, most: int | None):
    """Sorted rows of a partition -> blocks of at most ``most`` vectors (None: one block)."""

    def block(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        x = matrix_of(rows["x"].chunk(0), dim)
        length = rows["length"].to_numpy()
        angles = rows["angles"].chunk(0).flatten().to_numpy().reshape(len(length), -1)
        lists = [pa.array([rows[c].combine_chunks().to_pylist()], pa.list_(pa.int64())) for c in ("row", "vec_id", "label")]
        payload = [pa.array([v.tobytes()], pa.binary()) for v in (x, length, angles)]
        ranges = [pa.array([length.min()]), pa.array([length.max()]), pa.array([angles.min(0)]), pa.array([angles.max(0)])]
        return pa.RecordBatch.from_arrays(lists + payload + ranges, [f.split()[0] for f in BLOCK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while most and sum(b.num_rows for b in held) >= most:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, most))
                held = table.slice(most).to_batches()
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    return run


def interval(a: np.ndarray, a_length: float, x: np.ndarray, x_length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and highest possible score of one anchor with every vector, from their angles and lengths."""
    least = np.abs(x - a).max(1) - ANGLE_SLACK
    both = x + a
    most = np.minimum(both, 2 * np.pi - both).min(1) + ANGLE_SLACK
    size = a_length * x_length
    slack = SCORE_SLACK * size + 1
    return size * np.cos(np.minimum(most, np.pi)) - slack, size * np.cos(np.maximum(least, 0)) + slack


def scorer(dim: int, same: bool, k: int):
    """(anchor block, vector block) rows -> per anchor and window the block's best k that can still count."""

    def best(row: dict) -> Iterator[tuple[np.ndarray, ...]]:
        x, a = (np.frombuffer(row[n], np.int64).reshape(-1, dim) for n in ("whole", "a_whole"))
        length, a_length = np.frombuffer(row["lengths"]), np.frombuffer(row["a_lengths"])
        angles, a_angles = (np.frombuffer(row[n]).reshape(len(r), -1) for n, r in (("angles", length), ("a_angles", a_length)))
        labels, a_labels = np.array(row["labels"]), np.array(row["a_labels"])
        rows, a_rows = np.array(row["rows"]), np.array(row["a_rows"])
        ids = np.array([HIGHEST if i is None else i for i in row["ids"]])
        exact = length.max() * a_length.max() < 2**52  # then products add exactly in floating point
        number = x.astype(np.float64) if exact else x
        asked: dict[int, list[tuple[int, int, int]]] = {}
        for ask in row["asked"]:
            asked.setdefault(ask["place"], []).append((ask["w"], ask["least"], ask["most"]))
        for place, windows in asked.items():
            low, high = interval(a_angles[place], a_length[place], angles, length)
            open_ = np.zeros(len(x), bool)
            for _, least, most in windows:
                open_ |= (high >= least) & (low <= most)
            open_ &= ((labels == a_labels[place]) & (rows != a_rows[place])) if same else (labels != a_labels[place])
            near = np.flatnonzero(open_)
            if not len(near):
                continue
            score = (number[near] @ a[place].astype(number.dtype)).astype(np.int64)
            for w, least, most in windows:
                inside = np.flatnonzero((score >= least) & (score <= most))
                if len(inside) > k:  # those below the k-th score cannot win
                    inside = inside[score[inside] >= np.partition(score[inside], -k)[-k]]
                at = near[inside]
                first = np.lexsort((rows[at], ids[at], -score[inside]))[:k]
                at, scores = at[first], score[inside][first]
                yield np.full(len(at), place), np.full(len(at), w), at, scores

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n].as_py() for c in batch.schema.names}
                found = list(best(row))
                if not found:
                    continue
                place, w, at, score = (np.concatenate(c) for c in zip(*found))
                columns = [pa.array(np.full(len(at), row["a_block"])), pa.array(place, pa.int32()), pa.array(w, pa.int32())]
                columns += [pa.array([row["ids"][i] for i in at], pa.int64()), pa.array([row["rows"][i] for i in at], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], [f.split()[0] for f in HITS.split(", ")])

    return run


def block_pairs(anchors: DataFrame, blocks: DataFrame, same: bool) -> DataFrame:
    """(a_block, block, low, high, turn): block pairs that share a label (or hold two), with their score interval.

    Each anchor block meets the numbers of all blocks (the stated anchors against
    all rows, in blocks); these rows are small, and vectors are sent for pairs
    that stay only.
    """
    span = lambda c: [F.array_min(c), F.array_max(c)]
    edges = ["least_length", "most_length", "least_angles", "most_angles"]
    theirs = blocks.select("block", *edges, *[f.alias(n) for f, n in zip(span("labels"), ("least_label", "most_label"))])
    numbers = F.sequence(F.lit(0), F.lit(blocks.agg(F.max("block")).scalar()))
    ours = anchors.select("a_block", *[F.col(f"a_{e}") for e in edges], *[f.alias(n) for f, n in zip(span("a_labels"), ("a_least_label", "a_most_label"))])
    pairs = ours.withColumn("block", F.explode(numbers)).join(theirs, "block")
    if same:
        pairs = pairs.filter("a_least_label <= most_label and least_label <= a_most_label")
    else:
        pairs = pairs.filter("a_least_label <> a_most_label or least_label <> most_label or least_label <> a_least_label")
    each = F.sequence(F.lit(0), F.size("least_angles") - 1)
    at = lambda c, i: F.get(F.col(c), i)
    gap = F.array_max(F.transform(each, lambda i: F.greatest(at("a_least_angles", i) - at("most_angles", i), at("least_angles", i) - at("a_most_angles", i))))
    reach = F.array_min(F.transform(each, lambda i: F.least(
        at("a_most_angles", i) + at("most_angles", i), 2 * np.pi - at("a_least_angles", i) - at("least_angles", i))))
    highest, lowest = F.cos(F.greatest(gap - ANGLE_SLACK, F.lit(0.0))), F.cos(F.least(reach + ANGLE_SLACK, F.lit(float(np.pi))))
    short, long_ = F.col("a_least_length") * F.col("least_length"), F.col("a_most_length") * F.col("most_length")
    slack = long_ * SCORE_SLACK + 1
    bounded = pairs.select(
        "a_block", "block",
        (F.when(lowest < 0, long_).otherwise(short) * lowest - slack).alias("low"),
        (F.when(highest > 0, long_).otherwise(short) * highest + slack).alias("high"),
    )
    turn = Window.partitionBy("a_block").orderBy(F.desc("high"), "block")
    return materialize(bounded.withColumn("turn", F.row_number().over(turn)), "block_pairs")


def best_of(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("a_block", "place", "w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(anchors: DataFrame, blocks: DataFrame, windows: DataFrame, dim: int, same: bool, k: int) -> DataFrame:
    """The k highest scores inside every window (a_block, place, w, least, most): adds vec_id, row, score, rank."""
    spark = blocks.sparkSession
    pairs = block_pairs(anchors, blocks, same)
    turns = pairs.agg(F.max("turn")).first()[0] or 0
    hits, done, upto = spark.createDataFrame([], f"{HITS}, rank int"), 0, 1
    while done < turns:
        full = hits.filter(F.col("rank") == k).select("a_block", "place", "w", F.col("score").alias("floor"))
        raised = windows.join(full, ["a_block", "place", "w"], "left").withColumn("least", F.greatest("least", "floor"))
        asked = raised.filter("least <= most").groupBy("a_block").agg(
            F.min("least").alias("need"), F.max("most").alias("top"), F.collect_list(F.struct("place", "w", "least", "most")).alias("asked")
        )  # a block's anchors times their windows
        todo = pairs.filter(F.col("turn").between(done + 1, upto)).join(asked, "a_block")
        todo = todo.filter("high >= need and low <= top").select("a_block", "block", "asked")
        sent = todo.join(anchors, "a_block").join(blocks, "block")
        payload = ["whole", "lengths", "angles", "rows", "ids", "labels", "a_block", "a_whole", "a_lengths", "a_angles", "a_rows", "a_labels", "asked"]
        found = sent.select(*payload).mapInArrow(scorer(dim, same, k), HITS)
        hits = materialize(best_of(hits.drop("rank").unionByName(found), k), "hits")
        done, upto = upto, upto * GROWTH
    return hits


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    positives: int = 5,
    negatives: int = 10,
    band: tuple[int, int] = (30, 90),
    vec_id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor (a usable row for which ``is_anchor`` holds) has as positives its
    ``positives`` other rows of the same label with the highest integer inner
    product of floor(256 * x); for each positive, the ``negatives`` highest rows
    of other labels follow whose score lies between ``band[0]`` and ``band[1]``
    percent of the positive's.  Ties go to the smaller id.  Fewer rows give
    fewer pairs; anchors without a positive, and positives without a negative,
    give none.  Rows with a NULL label, a NULL vector, or NULL or non-finite
    components take no part; shorter vectors count as zero beyond their end.
    Repeated ids are rows of their own, each the other's candidate; a NULL id is
    a candidate that loses ties.  An empty table gives no rows; other columns play
    no part.  Vectors whose scores could leave 63 bits are an error.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    whole = materialize(whole_vectors(vectors, is_anchor, vec_id, label, embedding), "vectors")
    n, asking, dim = whole.agg(F.count("*"), F.count_if("is_anchor"), F.max(F.size("x"))).first()
    if not asking or not dim:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    references = np.linalg.eigh(gram(whole, dim))[1][:, ::-1][:, :REFERENCES]  # directions that hold most of all lengths
    table = with_angles(whole, np.ascontiguousarray(references), dim)
    dealt = table.repartitionByRange(max(1, n // BLOCK_ROWS), *ORDER).sortWithinPartitions(*ORDER)
    packed = dealt.drop("is_anchor").mapInArrow(packer(dim, None), BLOCK)
    blocks = materialize(packed.withColumn("block", F.spark_partition_id()), "blocks")
    own = table.filter("is_anchor").drop("is_anchor").repartition(-(-asking // (8 * ANCHOR_ROWS))).sortWithinPartitions(*ORDER)
    own = own.mapInArrow(packer(dim, ANCHOR_ROWS), BLOCK)
    own = own.withColumnsRenamed({c: f"a_{c}" for c in own.columns}).withColumn("a_block", F.monotonically_increasing_id())
    anchors = materialize(own, "anchors")

    members = anchors.select("a_block", F.posexplode(F.arrays_zip("a_rows", "a_ids")).alias("place", "_m"))
    everything = members.select("a_block", "place", F.lit(0).alias("w"), F.lit(LOWEST).alias("least"), F.lit(HIGHEST).alias("most"))
    liked = search(anchors, blocks, everything, dim, True, positives)
    hundredths = F.col("score").cast("decimal(20,0)")
    bands = liked.select(
        "a_block", "place", F.col("rank").alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.ceil(hundredths * band[0] / 100).cast("long").alias("least"), F.floor(hundredths * band[1] / 100).cast("long").alias("most"),
    )
    bands = materialize(bands, "bands")
    refused = search(anchors, blocks, bands.select("a_block", "place", "w", "least", "most"), dim, False, negatives)
    named = bands.join(members.select("a_block", "place", F.col("_m.a_ids").alias("anchor_id")), ["a_block", "place"])
    return refused.join(named, ["a_block", "place", "w"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def oracle(positives: int = 5, negatives: int = 10, band: tuple[int, int] = (30, 90)) -> str:
    return f"""
with usable as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [cast(floor({SCALE} * cast(x as double)) as double) for x in embedding] as v
  from embeddings where label is not null and embedding is not null and len([1 for x in embedding if x is null or not isfinite(x)]) = 0),
scored as materialized (
  select a.r as a, a.vec_id as anchor_id, c.r, c.vec_id, c.label = a.label as same, cast(list_dot_product(a.v, c.v) as bigint) as score
  from usable a join usable c on a.vec_id % 100 = 0 and a.r <> c.r),
positive as (
  select *, row_number() over (partition by a order by score desc, vec_id nulls last, r) as p from scored where same
  qualify p <= {positives})
select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
  cast(row_number() over (partition by p.a, p.p order by n.score desc, n.vec_id nulls last, n.r) as int) as rank
from positive p join scored n on n.a = p.a and not n.same and {band[0]} * p.score <= 100 * n.score and 100 * n.score <= {band[1]} * p.score
qualify rank <= {negatives}"""
