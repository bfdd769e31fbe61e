"""Exact top-k by integer inner product over norm-sorted vectors.

Vectors become whole numbers and are rotated by the singular vectors of the
whole table, so that the first rotated coordinates carry most of every product.
Candidates are range-sorted by descending length and dealt into blocks.  Rounds
of blocks follow, the longest candidates first; after each, every query's k-th
score so far is a floor.  Queries are sent only to the blocks long enough to
reach their floor.  There, tile by tile, the partial product over the first
rotated coordinates plus the Cauchy-Schwarz bound of the rest drops what cannot
reach it, and the rest is scored exactly; where the head would hold more than
half of the coordinates, the whole product is formed at once.  Scores found
raise the floor for the tiles that follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractlens.llm.common import materialize, settled, small_batches

SCALE = 1024
BLOCK_ROWS = 4096  # candidates per block, about, in small tables
BLOCK_NUMBERS = 1 << 23  # coordinates per block, about, in large ones: what a task holds
BLOCKS = 256  # blocks are made larger before there are more of them
ROUND = 16  # times as many blocks in each round as in the one before
QUERY_ROWS = 1024  # queries scored together, at most
TILE = 1024  # candidates scored together, at most
HEAD = 0.8  # share of the squared length that the first rotated coordinates hold, at least
SLACK = 1e-4  # share of the lengths that rounding of the rotated numbers stays far below
NONE = np.iinfo(np.int64).min
VECTORS = "vec_id long, row long, x binary, width int, size int, length double"
HITS = "query_row long, query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Usable vectors as whole numbers: NULL vectors, and those holding NULL or non-finite components, go.

    ``x`` holds ``size`` numbers of ``width`` bytes; ``row`` names the row, ``length`` is squared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = batch.column("x")
            sizes = np.diff(arrays.offsets.to_numpy())
            flat = arrays.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            usable = np.ones(len(sizes), bool)
            if not (finite := np.isfinite(flat)).all():  # NULL is NaN here
                usable[np.repeat(np.arange(len(sizes)), sizes)[~finite]] = False
                flat, sizes = flat[np.repeat(usable, sizes)], sizes[usable]
            whole = longs(np.floor(flat * SCALE))
            width = next(w for w in (2, 4, 8) if w == 8 or not len(whole) or -(1 << (8 * w - 1)) <= whole.min() <= whole.max() < 1 << (8 * w - 1))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            squares = np.concatenate([[0.0], (whole.astype(np.float64) ** 2)])
            length = np.add.reduceat(squares, np.minimum(ends[:-1] + 1, len(squares) - 1)) * (sizes > 0) if len(sizes) else np.empty(0)
            x = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((ends * width).astype(np.int32)), pa.py_buffer(whole.astype(f"<i{width}"))])
            ids, rows = (batch.column(n).filter(pa.array(usable)) for n in ("vec_id", "row"))
            widths, lengths = pa.array(np.full(len(sizes), width), pa.int32()), pa.array(length)
            yield pa.RecordBatch.from_arrays([ids, rows, x, widths, pa.array(sizes, pa.int32()), lengths], ["vec_id", "row", "x", "width", "size", "length"])

    given = vectors.filter(F.col(embedding).isNotNull() & F.col(vec_id).isNotNull())
    numbers = F.col(embedding)
    if not isinstance(vectors.schema[embedding].dataType.elementType, (T.FloatType, T.DoubleType)):
        numbers = numbers.cast("array<double>")
    columns = F.col(vec_id).cast("long").alias("vec_id"), F.monotonically_increasing_id().alias("row"), numbers.alias("x")
    return given.select(*columns).mapInArrow(run, VECTORS)


def longs(floored: np.ndarray) -> np.ndarray:
    """Whole doubles as 64-bit numbers; beyond those, the outermost, as Spark casts."""
    with np.errstate(invalid="ignore"):
        out = floored.astype(np.int64)
    out[floored >= 2.0**63] = np.iinfo(np.int64).max
    out[floored < -(2.0**63)] = np.iinfo(np.int64).min
    return out


def numbers_of(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """Rows of `whole_vectors` as a matrix, of the widest numbers among them; shorter vectors count as zero beyond their end."""
    widths, sizes = batch.column("width").to_numpy(), batch.column("size").to_numpy()
    out = np.zeros((len(sizes), dim), f"<i{max(widths, default=2)}")
    for width in np.unique(widths):
        held = np.flatnonzero(widths == width)
        flat = np.frombuffer(b"".join(batch.column("x").take(pa.array(held)).to_pylist()), f"<i{width}")
        part = np.zeros((len(held), dim), out.dtype)
        part[np.arange(dim) < sizes[held, None]] = flat
        out[held] = part
    return out


def matrix_of(arrays: pa.Array, dim: int) -> np.ndarray:
    """Rows of equal length; shorter vectors count as zero beyond their end."""
    flat = arrays.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(arrays.offsets.to_numpy())
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def gram(whole: DataFrame, dim: int, read=None) -> np.ndarray:
    """Sum of outer products over all vectors, in floating point: dim x dim numbers, whatever the rows.

    ``read`` makes a matrix of a batch; without it, ``x`` holds arrays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x = (read(batch, dim) if read else matrix_of(batch.column("x"), dim)).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(list(total))], ["i", "row"])

    rows = whole.select("x", *(["width", "size"] if read else [])).mapInArrow(run, "i int, row array<double>")
    summed = rows.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((dim, dim))
    for i, j, v in summed.collect():  # dim * dim
        out[i, j] = v
    return out


def rotation(total: np.ndarray) -> tuple[np.ndarray, int]:
    """Right singular vectors of the table, largest first, and how many form the head."""
    values, vectors = np.linalg.eigh(total)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    held = np.cumsum(values) / max(values.sum(), 1e-300)
    return np.ascontiguousarray(vectors), int(min(len(values), np.searchsorted(held, HEAD) + 1))


def places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of what holds, row by row."""
    return np.divmod(np.flatnonzero(mask), mask.shape[1])


class Block:
    """Candidates of one block, by ascending id, and what is best in them for queries."""

    def __init__(self, batches: list[pa.RecordBatch], turn: np.ndarray, head: int, k: int, tile: int) -> None:
        ids = np.concatenate([b.column("vec_id").to_numpy() for b in batches])
        order = np.argsort(ids, kind="stable")
        self.ids, self.k, self.turn, self.tile = ids[order], k, turn, tile
        self.rows = np.concatenate([b.column("row").to_numpy() for b in batches])[order]
        self.whole = np.concatenate([numbers_of(b, len(turn)) for b in batches])[order]
        self.length = np.concatenate([b.column("length").to_numpy() for b in batches])[order]
        self.longest = float(np.sqrt(self.length.max()))
        # A head of most coordinates costs as much as the whole product.
        self.head = head if 2 * head <= len(turn) else len(turn)
        self.single = self.rotated = None

    def turned(self, whole: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The first rotated coordinates; the length of the rest stands last if there is one."""
        out = np.empty((len(whole), self.head + (self.head < len(self.turn))), np.float32)
        for at in range(0, len(whole), 4096):
            part = whole[at : at + 4096].astype(np.float64) @ self.turn[:, : self.head]
            out[at : at + 4096, : self.head] = part
            if self.head < len(self.turn):
                out[at : at + 4096, self.head] = np.sqrt(np.maximum(length[at : at + 4096] - (part**2).sum(1), 0))
        return out

    def best(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """Per query the block's best k that can still count."""
        q_rows, length, dim = batch.column("row").to_numpy(), batch.column("length").to_numpy(), len(self.turn)
        whole, lengths = numbers_of(batch, dim), np.sqrt(length)
        need = pc.fill_null(batch.column("least"), NONE).to_numpy().copy()
        most = self.longest * float(lengths.max())
        # Whole numbers whose products and sums stay below 2**24 are exact in single precision, in any order.
        exact = self.head == len(self.turn) and most < 2**24
        if exact:
            if self.single is None:
                self.single = self.whole.astype(np.float32)
            x, q, spare = self.single, whole.astype(np.float32), 0.0
        else:
            if self.rotated is None:
                self.rotated = self.turned(self.whole, self.length)
            x, q, spare = self.rotated, self.turned(whole, length), SLACK * self.longest * lengths + 1
        found, new, held = [np.empty(0, np.int64)] * 3, [], 0
        out = np.empty((len(q), min(self.tile, len(x))), np.float32)
        for at in range(0, len(x), self.tile):
            tile = x[at : at + self.tile]
            product = out[:, : len(tile)] if len(tile) == out.shape[1] else np.empty((len(q), len(tile)), np.float32)
            np.matmul(q, tile.T, out=product)
            low = need.astype(np.float32) if exact else np.nextafter((need - spare).astype(np.float32), np.float32(-np.inf))
            asked = np.flatnonzero(~(product.max(axis=1) < low))
            if not len(asked):
                continue
            some, low = product[asked] if len(asked) < len(q) else product, low[asked]
            if exact:
                r, c, score = self.firsts(some, low)
            else:
                near = ~(some < low[:, None])
                if np.count_nonzero(near) * 32 > near.size:
                    r, c, score = self.firsts(self.products(whole[asked], slice(at, at + self.tile), most), need[asked])
                else:
                    r, c = places(near)
                    score = self.pairs(whole[asked], r, at + c, most)
                    keep = score >= need[asked[r]]
                    r, c, score = r[keep], c[keep], score[keep]
            r, c = asked[r], at + c
            other = self.rows[c] != q_rows[r]
            new.append((r[other], c[other], score[other].astype(np.int64)))
            held += len(new[-1][0])
            if held >= len(q):
                found, new, held = self.merged(found, new, need), [], 0
        found = self.merged(found, new, need) if new else found
        r, c, score = found
        return pa.RecordBatch.from_arrays(
            [pa.array(v, pa.int64()) for v in (q_rows[r], batch.column("vec_id").to_numpy()[r], self.ids[c], score)],
            ["query_row", "query_id", "vec_id", "score"],
        )

    def firsts(self, scores: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, column, score) from ``least``; of a crowd the k + 1 highest a row, the first of equal ones: one may be the query."""
        most = self.k + 1
        near = scores >= least[:, None]
        if scores.shape[1] <= most or np.count_nonzero(near) <= 4 * most * len(scores):
            r, c = places(near)
            return r, c, scores[r, c]
        last = np.partition(scores, -most, axis=1)[:, -most]
        r, c = places(near & (scores >= last[:, None]))
        score = scores[r, c]
        equal = np.flatnonzero(score == last[r])
        place = np.arange(len(equal)) - np.searchsorted(r[equal], r[equal])
        keep = np.ones(len(r), bool)
        keep[equal[place >= most]] = False
        return r[keep], c[keep], score[keep]

    def products(self, whole: np.ndarray, tile: slice, most: float) -> np.ndarray:
        """Exact scores of queries and a tile."""
        if most < 2**52:  # whole numbers below 2**53 multiply and add exactly
            return (whole.astype(np.float64) @ self.whole[tile].astype(np.float64).T).astype(np.int64)
        return whole.astype(np.int64) @ self.whole[tile].astype(np.int64).T

    def pairs(self, whole: np.ndarray, r: np.ndarray, c: np.ndarray, most: float) -> np.ndarray:
        """Exact scores of pairs."""
        kind = np.float64 if most < 2**52 else np.int64  # float64: whole numbers below 2**53 multiply and add exactly
        out = np.empty(len(r), np.int64)
        for at in range(0, len(r), 8192):
            some = slice(at, at + 8192)
            out[some] = np.einsum("ij,ij->i", whole[r[some]].astype(kind), self.whole[c[some]].astype(kind))
        return out

    def merged(self, found: list[np.ndarray], new: list[tuple], need: np.ndarray) -> list[np.ndarray]:
        """The best k of each query; ``need`` rises: what follows has no smaller id, so it must be higher than the k-th."""
        r, c, score = (np.concatenate(v) for v in zip(found, *new, strict=True))
        order = np.lexsort((c, -score, r))
        r, c, score = r[order], c[order], score[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        last = place == self.k - 1
        need[r[last]] = np.maximum(need[r[last]], score[last] + 1)
        return [v[place < self.k] for v in (r, c, score)]


def scorer(turn: np.ndarray, head: int, k: int):
    """Rows by key, a block's candidates before its queries -> per query the block's best k that can still count."""
    together, tile = QUERY_ROWS, TILE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None
        for batch in batches:
            keys, asks = batch.column("key").to_numpy(), batch.column("asks").to_numpy()
            edges = np.flatnonzero((np.diff(keys) != 0) | (np.diff(asks) != 0)) + 1
            for at, end in zip([0, *edges], [*edges, len(keys)]):
                if end == at:
                    continue
                if keys[at] != key:
                    key, held, block = keys[at], [], None
                if not asks[at]:
                    held.append(batch.slice(at, end - at))
                    continue
                if block is None and held:
                    block, held = Block(held, turn, head, k, tile), []
                for some in range(at, end if block else at, together):
                    yield block.best(batch.slice(some, min(together, end - some)))

    return run


def best_of(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, *, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): every query's k highest scores over all other rows.

    Queries are the usable rows for which ``is_query`` (over `vec_id`) holds.
    Ties go to the smaller id; fewer than k others give fewer rows.  Rows that
    share an id are queries and candidates of their own: each has its own
    ranking, and the others of its id stand in it.  Vectors that are NULL or hold
    NULL or non-finite components, and rows without id, take no part; shorter
    vectors count as zero beyond their end.  No rows, no result.  Other columns,
    whatever their names, play no part.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    blocks = settled(spark, lambda: dealt(whole_vectors(vectors, vec_id, embedding), is_query), "blocks")  # without its copy by row
    n, dim, last = blocks.agg(F.count("*"), F.max("size"), F.max("block")).first()
    queries = materialize(blocks.drop("block").filter(is_query), "queries")
    asked = queries.count()
    if not n or not dim or not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    turn, head = rotation(gram(blocks, dim, numbers_of))
    parts = last + 1
    longest = {r[0]: float(np.sqrt(r[1])) for r in blocks.groupBy("block").agg(F.max("length")).collect()}  # a number per block
    best, at, size = None, 0, 1
    while at < parts:
        # A round of few blocks deals its queries out, so that it has tasks enough.
        shares = max(1, min(-(-asked // QUERY_ROWS), -(-4 * spark.sparkContext.defaultParallelism // min(size, parts - at))))
        lengths = [longest.get(b, 0.0) for b in range(at, min(at + size, parts))]
        hits = pairs_of(blocks, with_floors(queries, best, k), at, lengths, shares).mapInArrow(scorer(turn, head, k), HITS)
        best = materialize(best_of(hits if best is None else best.drop("rank").unionByName(hits), k), "best")
        at, size = at + size, size * ROUND
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def dealt(vectors: DataFrame, is_query: Column) -> DataFrame:
    """Vectors with their block, the longest first."""
    whole = materialize(vectors, "vectors")
    n, dim, asked = whole.agg(F.count("*"), F.max("size"), F.count(F.when(is_query, 1))).first()
    # With as many candidates in a block as there are queries, sending all queries to all blocks doubles the rows.
    rows = max(1, min(max(BLOCK_ROWS, asked, n // BLOCKS), BLOCK_NUMBERS // max(1, dim or 0)))
    order = F.desc("length"), "vec_id", "row"
    return whole.repartitionByRange(max(1, -(-n // rows)), *order).withColumn("block", F.spark_partition_id())


def with_floors(queries: DataFrame, best: DataFrame | None, k: int) -> DataFrame:
    """Queries with the least score that can still count; NULL where fewer than k are known."""
    if best is None:
        return queries.withColumn("least", F.lit(None).cast("long"))
    least = best.filter(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").alias("least"))
    return queries.join(least, "row", "left")


def pairs_of(blocks: DataFrame, queries: DataFrame, first: int, longest: list[float], shares: int) -> DataFrame:
    """Candidates of the blocks from ``first`` on, and the queries whose floor they may reach, in one partition for each block and share of the queries."""
    columns = ["key", "asks", "vec_id", "row", "x", "width", "size", "length", "least"]
    reach = lambda i: F.element_at(F.lit(longest), i + 1) * F.sqrt("length") * (1 + SLACK) + 1 >= F.col("least")
    near = F.filter(F.sequence(F.lit(0), F.lit(len(longest) - 1)), lambda i: F.col("least").isNull() | reach(i))
    share = F.pmod(F.xxhash64("row"), F.lit(shares)).cast("int")
    asks = queries.withColumn("near", F.explode(near)).withColumn("key", F.col("near") * shares + share)
    some = blocks.filter(F.col("block").between(first, first + len(longest) - 1))
    held = some.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).withColumn("key", (F.col("block") - first) * shares + F.col("share"))
    rows = held.withColumns({"asks": F.lit(0), "least": F.lit(None).cast("long")}).select(columns)
    rows = rows.unionByName(asks.withColumn("asks", F.lit(1)).select(columns))
    return rows.repartitionById(len(longest) * shares, "key").sortWithinPartitions("key", "asks")
