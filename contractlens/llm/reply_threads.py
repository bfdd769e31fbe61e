"""Threads out of reply pointers: root, depth and place of every message.

A message that replies to the one before it continues the segment of that message;
a segment starts with the first message of a conversation or with a linked
quotation.  Inside a segment depth grows by one, so only the segments, a row per
quotation, are walked: each asks where its pointer leads, and the pointers double
until they end at a root, whatever the length of the conversations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contractlens.llm.common import materialize
from contractlens.operators.shape import dense_number

BLOCK = 50_000  # messages whose segment is looked for in one task


def segments(numbered: DataFrame) -> DataFrame:
    """Adds `_seg`, the number of the last start at or before `_n`; every block takes what the ones before leave."""
    start = F.when(F.col("_start"), F.col("_n"))
    blocks = numbered.withColumn("_block", F.floor(F.col("_n") / BLOCK))
    ends = blocks.groupBy("_block").agg(F.max(start).alias("_last"))  # one row per block
    ends = ends.withColumn("_earlier", F.max("_last").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))).drop("_last")
    inside = blocks.withColumn("_here", F.max(start).over(Window.partitionBy("_block").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)))
    return inside.join(ends, "_block").withColumn("_seg", F.coalesce("_here", "_earlier")).drop("_block", "_here", "_earlier")


def walk(pointers: DataFrame) -> DataFrame:
    """Where the pointers (_seg, _up, _add) end: (_seg, _root, _depth).

    Quotations that lead back to themselves have no end: of each such ring the
    smallest segment is cut off and becomes the root.
    """
    cuts = None
    while True:
        open_ = pointers if cuts is None else pointers.join(cuts, "_seg", "left_anti")
        state = materialize(open_.withColumn("_low", F.col("_seg")), "pointers")
        steps, n = 1, state.count()
        while True:
            ahead = state.select(F.col("_seg").alias("_up"), F.col("_up").alias("_next"), F.col("_add").alias("_more"), F.col("_low").alias("_lower"))
            joined = state.join(ahead, "_up", "left")
            state = materialize(
                joined.select(
                    "_seg",
                    F.coalesce("_next", "_up").alias("_up"),
                    (F.col("_add") + F.coalesce("_more", F.lit(0))).alias("_add"),
                    F.least("_low", "_lower").alias("_low"),
                    F.col("_next").isNotNull().alias("_moved"),
                ),
                "pointers",
            )
            steps *= 2
            moving = state.filter("_moved")
            if moving.isEmpty():
                return state.select("_seg", F.col("_up").alias("_root"), F.col("_add").alias("_depth"))
            state = state.drop("_moved")
            if steps > n:  # no path is that long: what still moves goes round
                on_ring = moving.select(F.col("_up").alias("_seg")).distinct()
                cuts = materialize(state.join(on_ring, "_seg").select(F.col("_low").alias("_seg")).distinct(), "cuts")
                break


def assemble(nodes: DataFrame) -> DataFrame:
    """Adds root_conv, root_turn, depth and position to messages (conv_id, turn, reply_conv, reply_turn, linked).

    One row per message, conv_id and turn not NULL; a message that is not linked
    replies to the turn before it in its conversation, or to nothing.  `position`
    counts from 0 in the order of depth, conversation and turn, so replies follow what
    they reply to.  The smallest message of a ring of quotations is its root.
    """
    numbered = dense_number(nodes, "_n", [F.asc("conv_id"), F.asc("turn")])
    numbered = numbered.withColumn("_start", F.col("linked") | F.col("reply_turn").isNull())
    placed = materialize(segments(numbered), "segments")
    target = placed.select(F.col("conv_id").alias("reply_conv"), F.col("turn").alias("reply_turn"), F.col("_seg").alias("_up"), F.col("_n").alias("_at"))
    pointers = placed.filter("linked").select("reply_conv", "reply_turn", "_seg", F.col("_n").alias("_from"))
    pointers = pointers.join(target, ["reply_conv", "reply_turn"]).select("_seg", "_up", (F.col("_at") - F.col("_up") + 1).alias("_add"))
    ends = walk(pointers)
    rooted = placed.join(ends, "_seg", "left").select(
        *nodes.columns, "_n", F.coalesce("_root", "_seg").alias("_root"), (F.col("_n") - F.col("_seg") + F.coalesce("_depth", F.lit(0))).alias("depth")
    )
    ordered = materialize(dense_number(rooted, "_place", [F.asc("_root"), F.asc("depth"), F.asc("_n")]), "places")
    first = ordered.groupBy("_root").agg(F.min("_place").alias("_first"))
    names = placed.filter("_start").select(F.col("_n").alias("_root"), F.col("conv_id").alias("root_conv"), F.col("turn").alias("root_turn"))
    heads = first.join(names, "_root")
    return ordered.join(heads, "_root").select(*nodes.columns, "root_conv", "root_turn", "depth", (F.col("_place") - F.col("_first")).alias("position"))
