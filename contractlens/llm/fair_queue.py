"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue with a weight; its documents stand in it in shuffled
order.  A document's virtual finish time is the number of source tokens up to
and including it, divided by the source's target.  All documents, and their
repeats where a target exceeds the source, are range-sorted by finish time and
the mix takes them from the front until the total budget is used.  Whatever the
prefix, the sources have then been served in proportion to their targets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlens.llm.common import materialize
from contractlens.operators.shape import dense_number

BUCKET_ROWS = 512  # about so many documents share one running-sum window
SORT_ROWS = 100_000  # about so many queue entries share one sorted partition
BEFORE = (Window.unboundedPreceding, -1)
UP_TO = (Window.unboundedPreceding, Window.currentRow)


def source_targets(
    totals: DataFrame, weights: Sequence[int], share: float = 1.0, max_repeats: int = 3
) -> tuple[DataFrame, float]:
    """One row per source (`_key`, `source_size`) -> the same with `weight`, `target`.

    Weights repeat along the sources in code-point order, NULL last.  The
    budget is ``share`` of all sizes.  A target stops at ``max_repeats`` times
    its source; the excess goes to the others by weight.  That level is raised
    until no further source reaches its stop; only sums leave the cluster.
    """
    numbered = dense_number(totals, "_number", [F.asc("_null"), F.asc("_key")])
    place = ((F.col("_number") - 1) % len(weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), place + 1).cast("long")
    sources = materialize(numbered.withColumn("weight", weight).drop("_number"), "sources")
    budget = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    stop, level, held = F.col("source_size") * max_repeats, 0.0, -1
    while True:
        full = stop <= F.col("weight") * F.lit(level)
        capped, free = sources.agg(
            F.coalesce(F.sum(F.when(full, stop)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))
        ).first()
        if capped == held or not free:
            break
        held, level = capped, (budget - capped) / free
    target = F.least(stop.cast("double"), F.col("weight") * F.lit(float(level)))
    return sources.withColumn("target", target), budget


def fair_mix(
    docs: DataFrame,
    size: Column,
    *,
    source: str = "source",
    doc_id: str = "doc_id",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.0,
    max_repeats: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """Adds `size`, `source_size`, `target` and `taken` to every document.

    `taken` is what the mix takes of it: its size times the repeats served
    (0 .. ``max_repeats``).  NULL sources are one source, the last; NULL ids
    share one place in the shuffle; rows equal in all columns are served like
    any others.  An empty table gives an empty result.  Columns of these four
    names in the input are replaced.  Reruns agree: the order is a hash of id.

    A source may hold most rows: its queue is cut into hash buckets, and running
    sums go over buckets first and inside a bucket second.
    """
    spark = docs.sparkSession
    key = F.when(F.col(source).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(source)))
    ticket = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    number = F.conv(F.substring("_ticket", 1, 8), 16, 10).cast("long")
    queue = docs.withColumns({"size": size, "_key": key, "_null": F.col(source).isNull(), "_ticket": ticket})
    n = queue.select(doc_id).count()
    buckets = max(1, -(-n // BUCKET_ROWS))
    queue = queue.withColumn("_bucket", F.floor(number * buckets / F.lit(1 << 32)).cast("int"))
    loads = materialize(queue.groupBy("_key", "_null", "_bucket").agg(F.sum("size").alias("_load")), "loads")
    totals = loads.groupBy("_key", "_null").agg(F.sum("_load").alias("source_size"))
    targets, budget = source_targets(totals, weights, share, max_repeats)
    starts = (
        loads.withColumn("_start", F.sum("_load").over(Window.partitionBy("_key").orderBy("_bucket").rowsBetween(*BEFORE)))
        .join(targets.select("_key", "source_size", "target"), "_key")
        .select("_key", "_bucket", F.coalesce("_start", F.lit(0)).alias("_start"), "source_size", "target")
    )
    inside = Window.partitionBy("_key", "_bucket").orderBy("_ticket", doc_id, "size").rowsBetween(*UP_TO)
    placed = materialize(
        queue.drop("source_size", "target", "taken")
        .join(starts, ["_key", "_bucket"])
        .withColumn("_until", F.col("_start") + F.sum("size").over(inside))
        .drop("_start", "_null", "_ticket", "_bucket", "_key"),
        "queue",
    )
    finish = (F.col("source_size") * (F.col("_turn") - 1) + F.col("_until")) / F.col("target")
    turns = F.explode(F.sequence(F.lit(1), F.lit(max_repeats))).alias("_turn")
    entries = (
        placed.filter("size > 0 and target > 0")
        .select("size", "_until", "source_size", "target", turns)
        .select("size", finish.alias("_finish"))
    )
    cut = last_served(entries, budget, max(1, n * max_repeats // SORT_ROWS))
    served = sum(
        (F.when(finish_at(turn) <= F.lit(cut), 1).otherwise(0) for turn in range(2, max_repeats + 1)),
        F.when(finish_at(1) <= F.lit(cut), 1).otherwise(0),
    )
    taken = F.when(F.col("target") > 0, F.col("size") * served).otherwise(F.lit(0)).cast("long")
    return placed.withColumn("taken", taken).drop("_until")


def finish_at(turn: int) -> Column:
    return (F.col("source_size") * (turn - 1) + F.col("_until")) / F.nullif(F.col("target"), F.lit(0.0))


def last_served(entries: DataFrame, budget: float, partitions: int) -> float:
    """Finish time at which the range-sorted entries have used the budget.

    Equal finish times are served together or not at all.  Running sums go over
    the sorted partitions first (one row each), then inside the one partition
    in which the budget runs out.
    """
    placed = materialize(
        entries.repartitionByRange(partitions, "_finish").withColumn("_part", F.spark_partition_id()), "served"
    )
    parts = placed.groupBy("_part").agg(F.sum("size").alias("_load"), F.min("_finish").alias("_from"))
    before = F.coalesce(F.sum("_load").over(Window.orderBy("_from").rowsBetween(*BEFORE)), F.lit(0))
    # One row per sorted partition; the budget runs out in the last that starts within it.
    at = parts.withColumn("_before", before).filter(F.col("_before") <= budget).orderBy(F.desc("_from")).first()
    if at is None:
        return 0.0
    order = Window.partitionBy("_part").orderBy("_finish").rangeBetween(*UP_TO)
    inside = placed.filter(F.col("_part") == at["_part"]).withColumn("_sum", F.sum("size").over(order) + F.lit(at["_before"]))
    cut = inside.filter(F.col("_sum") <= budget).agg(F.max("_finish")).first()[0]
    if cut is None:  # even the first entry of that partition is too long
        cut = placed.filter(F.col("_finish") < at["_from"]).agg(F.max("_finish")).first()[0]
    return 0.0 if cut is None else float(cut)


def repeat_taken(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: every document as often as it is served."""
    times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(F.lit(0))
    return (
        mixed.withColumn("_times", times)
        .filter("_times > 0")
        .withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        .select(*columns)
    )


def oracle(words: str) -> str:
    """The same mix in plain SQL over one sorted table."""
    return f"""
with sized as (select doc_id, source, cast({words} as bigint) as size from documents),
totals as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
weighted as (
  select *, [5, 2, 1][1 + cast((row_number() over (order by source nulls last) - 1) % 3 as int)] as weight from totals),
steps as (
  select *, 3 * source_size / weight as stops_at,
    coalesce(sum(3 * source_size) over before, 0) as held,
    sum(weight) over (order by 3 * source_size / weight, source rows between current row and unbounded following) as free,
    sum(source_size) over () as budget
  from weighted window before as (order by 3 * source_size / weight, source rows between unbounded preceding and 1 preceding)),
level as (select max((budget - held) / free) as height from steps),
targets as (select source, source_size, least(cast(3 * source_size as double), weight * height) as target from weighted, level),
queue as (
  select s.doc_id, s.size, t.source_size, t.target,
    sum(s.size) over (partition by s.source order by substr(md5('mix' || coalesce(cast(s.doc_id as varchar), '')), 1, 8),
      md5('mix' || coalesce(cast(s.doc_id as varchar), '')), s.doc_id, s.size rows unbounded preceding) as until
  from sized s join targets t on s.source is not distinct from t.source),
entries as (
  select size, (source_size * (turn - 1) + until) / target as finish
  from queue, (values (1), (2), (3)) as x(turn) where size > 0 and target > 0),
sums as (select finish, sum(size) over (order by finish range unbounded preceding) as used from entries),
cut as (select coalesce(max(finish), 0) as cut_at from sums where used <= (select sum(size) from sized))
select doc_id, size, source_size, target,
  cast(case when target > 0 then size * (cast(until / target <= cut_at as int)
    + cast((source_size + until) / target <= cut_at as int) + cast((source_size * 2 + until) / target <= cut_at as int))
    else 0 end as bigint) as taken
from queue, cut"""
