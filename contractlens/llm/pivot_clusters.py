"""Exact centroid clustering with a stored table of pivot distances (LAESA).

Vectors become whole numbers.  Their distances to a few fixed pivots are computed
and stored once.  In every round a centroid's distance to a vector is at least
the largest difference of the two's pivot distances; centroids whose bound lies
beyond the best distance found so far are dropped, the others get their exact
integer distance.  A round reads the table once and sends (k x dim) partial sums
per task; only the centroids, k x dim numbers, meet on the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.llm.common import materialize, small_batches

SCALE = 64
DIM = 64
CLUSTERS = 16
ROUNDS = 3
PIVOTS = 8
SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def kept_vectors(vectors: DataFrame, vec_id: str, embedding: str, dim: int, scale: int) -> DataFrame:
    """(vec_id, x): vectors of ``dim`` finite components as whole numbers."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    usable = vectors.filter((F.size(embedding) == dim) & ~bad)
    return usable.select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("x"))


def seeds(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hash of their id; vectors without id come last, ties go by components."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(order.alias("h"), "x").orderBy(F.asc_nulls_last("h"), "x").limit(k).collect()  # k rows
    return np.array([r.x for r in rows], np.int64)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return ((x - y) ** 2).sum(-1)


def spread(points: np.ndarray, many: int) -> np.ndarray:
    """Pivots: one after the other the point with the largest distance sum to those taken, from the first on."""
    taken, total = [0], np.zeros(len(points))
    while len(taken) < min(many, len(points)):
        total += np.sqrt(squared(points, points[taken[-1]]))
        total[taken] = -1
        taken.append(int(total.argmax()))
    return points[taken]


def rows_of(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def nested(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def pivot_table(kept: DataFrame, pivots: np.ndarray, dim: int) -> DataFrame:
    """Adds `d`, the distances to the pivots; written once."""
    limit = isqrt((1 << 62) // dim) // 2  # squared distances stay whole numbers of 63 bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = rows_of(batch.column("x"), dim)
            if np.abs(x).max() > limit:
                raise ValueError(f"a component is beyond {limit} after scaling: distances would not fit 64 bits")
            d = np.sqrt(np.stack([squared(x, p) for p in pivots], 1).astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), nested(d)], ["vec_id", "x", "d"])

    return materialize(kept.mapInArrow(run, "vec_id long, x array<long>, d array<double>"), "pivot_table")


def nearest(x: np.ndarray, d: np.ndarray, centres: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of every vector; ties go to the smaller number.

    `slack` is far above the rounding of square roots, so a bound never drops a
    centroid that is nearest or ties.
    """
    to_pivots = np.sqrt(squared(centres[:, None, :], pivots[None]).astype(np.float64))
    slack = 1e-9 * (d.max() + to_pivots.max() + 1)
    bound = np.zeros((len(x), len(centres)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(d[:, p, None] - to_pivots[:, p]), out=bound)
    cluster = bound.argmin(1)
    best = squared(x, centres[cluster])
    first = cluster.copy()
    for c in range(len(centres)):
        rows = np.flatnonzero((first != c) & (bound[:, c] <= np.sqrt(best.astype(np.float64)) + slack))
        exact = squared(x[rows], centres[c])
        better = (exact < best[rows]) | ((exact == best[rows]) & (c < cluster[rows]))
        cluster[rows[better]], best[rows[better]] = c, exact[better]
    return cluster, best


def each_batch(dim: int, pivots: np.ndarray, centres: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                x = rows_of(batch.column("x"), dim)
                yield batch, x, *nearest(x, rows_of(batch.column("d"), len(pivots)), centres, pivots)

    return run


def moved(table: DataFrame, centres: np.ndarray, pivots: np.ndarray, dim: int) -> np.ndarray:
    """Centroids after one round: floor of the mean of their vectors; an empty one stays."""
    assign = each_batch(dim, pivots, centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centres), dim + 1), np.int64)  # the last column counts
        for _, x, cluster, _ in assign(batches):
            np.add.at(sums[:, :dim], cluster, x)
            sums[:, dim] += np.bincount(cluster, minlength=len(centres))
        held = np.flatnonzero(sums[:, dim])
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), nested(sums[held])], ["cluster", "sums"])

    parts = table.mapInArrow(run, "cluster int, sums array<long>")
    totals = parts.select("cluster", F.posexplode("sums").alias("j", "v")).groupBy("cluster", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((len(centres), dim + 1), np.int64)
    for cluster, j, v in totals.collect():  # k * (dim + 1)
        total[cluster, j] = v
    count = total[:, dim:]
    return np.where(count > 0, total[:, :dim] // np.maximum(count, 1), centres)


def cluster(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    dim: int = DIM,
    scale: int = SCALE,
    seed: int = 1,
    pivots: int = PIVOTS,
) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors take part if they have exactly ``dim`` components, none NULL or not
    finite; component x becomes floor(scale * x).  Centroids start as the ``k``
    vectors with the smallest sha256 of ``seed:vec_id`` and are moved ``rounds``
    times; then vectors are assigned once more.  Repeated ids and equal vectors
    are rows like any others, a NULL id too (as a seed it comes last); equal
    distances go to the smaller number; fewer vectors than ``k`` give fewer
    centroids; no vectors, no rows.  Other columns play no part.  Components so
    large that squared distances leave 64 bits are an error.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    kept = kept_vectors(vectors, vec_id, embedding, dim, scale)
    centres = seeds(kept, k, seed)
    if not len(centres):
        return spark.createDataFrame([], SCHEMA)
    fixed = spread(centres, pivots)
    table = pivot_table(kept, fixed, dim)
    for _ in range(rounds):
        centres = moved(table, centres, fixed, dim)
    assign = each_batch(dim, fixed, centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, number, distance in assign(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"]
            )

    found = materialize(table.mapInArrow(run, "vec_id long, cluster int, distance long"), "assigned")
    per_cluster = dict(found.groupBy("cluster").agg(F.sum("distance")).collect())  # k rows
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    pick = lambda values: by_number(F.col("cluster"), values)
    return found.select(
        "vec_id", "cluster", "distance",
        pick([per_cluster.get(c, 0) for c in range(len(centres))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(per_cluster.values())).cast("long").alias("inertia"),
        pick(sha).alias("centroid_sha256"),
    )


def by_number(number: Column, values: list) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), number)


def oracle(k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = 1) -> str:
    """Every vector against every centroid, round by round."""

    def assigned(n: int) -> str:
        return f"""
a{n} as materialized (
  select r, min([vv + cc - 2 * cast(list_dot_product(cast(x as double[]), cast(y as double[])) as bigint), c]) as best
  from kept cross join (select c, y, cast(list_dot_product(cast(y as double[]), cast(y as double[])) as bigint) as cc from c{n})
  group by r)"""

    def moved_to(n: int) -> str:
        return f"""
c{n} as materialized (
  select c, coalesce(y_new, y) as y from c{n - 1} left join (
    select c, list((s - ((s % n) + n) % n) // n order by i) as y_new
    from (select c, i, cast(sum(v) as bigint) as s, count(*) as n
      from (select best[2] as c, unnest(x) as v, unnest(range({dim})) as i from a{n - 1} join kept using (r)) group by c, i)
    group by c) using (c))"""

    steps = "".join(f"{assigned(n)},{moved_to(n + 1)}," for n in range(rounds))
    return f"""
with kept as materialized (
  select *, cast(list_dot_product(cast(x as double[]), cast(x as double[])) as bigint) as vv from (
    select row_number() over () as r, vec_id, [cast(floor({scale} * cast(e as double)) as bigint) for e in embedding] as x from embeddings
    where len(embedding) = {dim} and len([1 for e in embedding if e is null or not isfinite(e)]) = 0)),
c0 as materialized (
  select cast(row_number() over (order by h nulls last, x) - 1 as bigint) as c, x as y
  from (select sha256('{seed}:' || cast(vec_id as varchar)) as h, x from kept) qualify c < {k}),{steps}{assigned(rounds)}
select vec_id, cast(best[2] as int) as cluster, best[1] as distance, cast(sum(best[1]) over (partition by best[2]) as bigint) as cluster_inertia,
  cast(sum(best[1]) over () as bigint) as inertia, sha256(array_to_string(y, ',')) as centroid_sha256
from a{rounds} join kept using (r) join c{rounds} on c = best[2]"""
