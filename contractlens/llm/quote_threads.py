"""Conversations without quotes, in reply order.

Lines that begin with `>` quote; the number of marks is the level.  A message's
own lines are the level-0 lines.  Quoted lines of every level, and runs of WIDTH
words across the line breaks of a level, are normalised, hashed and joined to the
first message that has them as its own.  A quoted line is held by a message that
has the whole line, or at least half of the runs that start in it; the message
that holds most lines of a level is its original, and that of the shallowest
level with an original is the one replied to.  A message that quotes nothing
known replies to the one before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlens.llm.adaptive_quality import let
from contractlens.llm.common import SPACE, materialize
from contractlens.llm.reply_threads import assemble

MARKS = rf"^[{SPACE}]*(?:>[{SPACE}]*)+"
# Fixed value: the line that names the author of the quotation below it.
ATTRIBUTION = rf"(?i)[{SPACE}]wrote:[{SPACE}]*$"
RANGE_ROWS = 50_000  # messages per sorted partition, about
WIDTH = 5  # words that are looked up together where line breaks differ


def quote_lines(text: Column) -> Column:
    """Array of (level, body) of the lines of a text."""

    def line(x: Column) -> Column:
        marks = F.regexp_extract(x, MARKS, 0)
        level = F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))
        return F.struct(level.alias("level"), F.substring(x, F.length(marks) + 1, F.length(x)).alias("body"))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), line)


def normal(body: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(body, f"[{SPACE}]+", " ")))


def keys(lines: Column, level: Column) -> Column:
    """Array of (level, line, whole, key) of the lines of a level: each line, and each run of WIDTH words by its first line."""
    entry = lambda line, whole, text: F.struct(level.alias("level"), line.alias("line"), F.lit(whole).alias("whole"), F.md5(text).alias("_key"))
    placed = F.transform(lines, lambda x, i: F.struct(x["level"].alias("level"), normal(x["body"]).alias("body"), i.alias("line")))
    held = F.filter(placed, lambda x: (x["level"] == level) & (x["body"] != ""))
    words = lambda x: F.transform(F.split(x["body"], " "), lambda w: F.struct(x["line"].alias("line"), w.alias("word")))
    run = lambda w, i: entry(F.get(w, i)["line"], False, F.array_join(F.slice(w, i + 1, WIDTH)["word"], " "))
    runs = lambda w: F.when(F.size(w) >= WIDTH, F.transform(F.sequence(F.lit(0), F.size(w) - WIDTH), lambda i: run(w, i)))
    whole = lambda h: F.transform(h, lambda x: entry(x["line"], True, x["body"]))
    return let(held, lambda h: F.concat(whole(h), F.coalesce(let(F.flatten(F.transform(h, words)), runs), F.filter(whole(h), lambda x: F.lit(False)))))


def own_text(lines: Column, text: Column, known: Column) -> Column:
    """The text without known quotations and without empty lines at its ends.

    A quotation is a run of lines of one level above 0; it is known if one of its
    lines is among ``known`` (numbers of lines, or NULL).  Others, and marks that
    quote nobody, stay as they are.  A line that names the author goes with the known
    quotation below it, also across empty lines.  Levels above 26 count as 26.
    """
    body = F.split(text, "\n")

    def mark(i: Column, is_known: Column, body: Column) -> Column:
        # one character per line: its level as a letter, in capitals if known; own lines are blank, name an author, or neither
        level = F.least(F.get(lines, i)["level"], F.lit(26))
        letter = F.char(F.when(is_known, 64).otherwise(96) + level)
        line = F.get(body, i)
        own = F.when(F.trim(line) == "", "_").when(line.rlike(ATTRIBUTION), "!").otherwise(".")
        return F.when(level > 0, letter).otherwise(own)

    # Line i is 2i, followed by 2i + 1 if it is known: sorted, so that no line looks for itself in `known`.
    places = F.array_sort(F.concat(F.transform(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: i * 2), F.transform(known, lambda i: i * 2 + 1)))
    follows = lambda p, e, at: F.coalesce(F.get(p, at + 1) == e + 1, F.lit(False))
    marks = lambda p, b: F.transform(p, lambda e, at: F.when(e % 2 == 0, mark((e / 2).cast("int"), follows(p, e, at), b)).otherwise(""))
    made = let(places, lambda p: let(body, lambda b: marks(p, b)))
    runs = F.regexp_extract_all(F.array_join(made, ""), F.lit(r"(?i)((.)\2*)"), F.lit(1))
    gone = F.array_join(F.transform(runs, lambda r: F.when(r == F.lower(r), r).otherwise(F.repeat(F.lit("X"), F.length(r)))), "")
    gone = F.split(F.regexp_replace(gone, "!(?=_*X)", "X"), "")
    without = lambda g: F.array_join(F.filter(body, lambda line, i: F.get(g, i) != "X"), "\n")
    own = F.when(F.size(known) > 0, let(gone, without)).otherwise(text)
    return F.regexp_replace(F.regexp_replace(own, rf"^[{SPACE}]+", ""), rf"[{SPACE}]+$", "")


def turns_before(messages: DataFrame, n: int) -> DataFrame:
    """Adds `_before`, the greatest smaller turn of the conversation.

    The table is range-sorted, so a long conversation covers several partitions;
    each looks at its own rows, and the last turn of the earlier ones is added.
    """
    parts = max(1, n // RANGE_ROWS)
    placed = materialize(messages.repartitionByRange(parts, "conv_id", "turn").withColumn("_part", F.spark_partition_id()), "messages")
    ends = placed.groupBy("conv_id", "_part").agg(F.max("turn").alias("_last"))
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_earlier", F.max("_last").over(earlier)).filter("_earlier is not null").drop("_last")
    own = Window.partitionBy("_part", "conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("_inside", F.max("turn").over(own))
    return inside.join(ends, ["conv_id", "_part"], "left").withColumn("_before", F.coalesce("_inside", "_earlier")).drop("_part", "_inside", "_earlier")


def thread(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, reply_conv, reply_turn, linked, n_levels, n_quoted, body, formatted,
    root_conv, root_turn, depth, position, links.

    `linked` says that a quotation names the message replied to; else it is the
    turn before, if there is one.  `links` has (level, conv_id, turn), the original
    of every level that has one; NULL if none has.  Lines and runs of words are
    looked up in earlier turns of the conversation first, then in all other
    conversations; the earliest message that has them is the original.  Quoted
    fragments of fewer than WIDTH words are found only as whole lines.  `body` is
    the text without the quotations that have an original (see `own_text`).
    A thread is all messages that lead to one root; sorted by (root_conv, root_turn,
    position), replies follow what they reply to (see `assemble`).
    NULL texts are empty; NULL conversations or turns have no turn before and no
    thread (root, depth and position NULL); different texts under one conversation
    and turn share their place and their links; repeated rows are threaded alike;
    texts of any length are read whole; an empty table stays empty; other columns
    play no part.
    """
    n = messages.count()
    text = F.coalesce("text", F.lit(""))
    parsed = messages.select("conv_id", "turn", "role", text.alias("_text"), quote_lines(text).alias("_lines"))
    parsed = turns_before(parsed, n)
    quoted = F.filter("_lines", lambda x: x["level"] > 0)
    made = parsed.withColumns({"n_levels": F.array_max(F.transform("_lines", lambda x: x["level"])), "n_quoted": F.size(quoted)})
    levels = F.array_distinct(F.transform(quoted, lambda x: x["level"]))
    asked = F.flatten(F.transform(levels, lambda level: keys(F.col("_lines"), level)))
    asks = parsed.select("conv_id", "turn", F.inline(asked)).distinct()
    asks = materialize(asks, "asks")
    # Owners need a name that a reply can point to.
    owns = parsed.filter("conv_id is not null and turn is not null").select("conv_id", "turn", F.explode(keys(F.col("_lines"), F.lit(0))["_key"]).alias("_key"))
    owns = owns.join(asks.select("_key").distinct(), "_key", "left_semi")
    near = materialize(owns.groupBy("conv_id", "_key").agg(F.min("turn").alias("_near")), "owners")
    # The two first owners in different conversations: one of them is not the asker's.
    owner = F.min(F.struct("conv_id", F.col("_near").alias("turn")))
    first = near.groupBy("_key").agg(owner.alias("_first"))
    rest = near.join(first, "_key").filter(F.col("conv_id") != F.col("_first.conv_id"))
    far = first.join(rest.groupBy("_key").agg(owner.alias("_second")), "_key", "left")
    here = F.col("_near") < F.col("turn")
    other = F.when(F.col("_first.conv_id") != F.col("conv_id"), F.col("_first")).otherwise(F.col("_second"))
    line = ["conv_id", "turn", "level", "line"]
    runs = asks.filter("not whole").groupBy(*line).agg(F.count("*").alias("_runs"))
    votes = (
        asks.join(near, ["conv_id", "_key"], "left")
        .join(far, "_key", "left")
        .withColumn("_at", F.when(here, F.struct("conv_id", F.col("_near").alias("turn"))).otherwise(other))
        .filter("_at is not null")
        .groupBy(*line, "_at")
        .agg(F.max("whole").alias("_whole"), F.count_if(~F.col("whole")).alias("_held"))
        .join(runs, line, "left")
        .filter("_whole or 2 * _held >= _runs")
    )
    votes = votes.groupBy("conv_id", "turn", "level", "_at").agg(F.count("*").alias("_n"), F.collect_set("line").alias("_known"))
    votes = materialize(votes, "votes")
    least = F.struct(-F.col("_n"), F.col("_at.conv_id") != F.col("conv_id"), "_at")
    links = votes.groupBy("conv_id", "turn", "level").agg(F.min_by("_at", least).alias("_at"))
    named = F.struct("level", F.col("_at.conv_id").alias("conv_id"), F.col("_at.turn").alias("turn"))
    links = links.groupBy("conv_id", "turn").agg(F.min_by("_at", "level").alias("_at"), F.array_sort(F.collect_list(named)).alias("links"))
    known = votes.groupBy("conv_id", "turn").agg(F.array_distinct(F.flatten(F.collect_list("_known"))).alias("_known"))
    # Nodes are messages by name; what they reply to needs no text.
    linked = F.col("_at").isNotNull()
    nodes = parsed.filter("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.max("_before").alias("_before"))
    nodes = nodes.join(links.join(known, ["conv_id", "turn"]), ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        F.when(linked, F.col("_at.conv_id")).when(F.col("_before").isNotNull(), F.col("conv_id")).alias("reply_conv"),
        F.when(linked, F.col("_at.turn")).otherwise(F.col("_before")).alias("reply_turn"),
        linked.alias("linked"),
        "links",
        "_known",
    )
    joined = made.join(assemble(nodes), ["conv_id", "turn"], "left")
    body = own_text(F.col("_lines"), F.col("_text"), F.coalesce("_known", F.array().cast("array<int>")))
    return joined.withColumn("body", body).select(
        "conv_id",
        "turn",
        "role",
        "reply_conv",
        "reply_turn",
        F.coalesce("linked", F.lit(False)).alias("linked"),
        F.coalesce("n_levels", F.lit(0)).cast("long").alias("n_levels"),
        F.col("n_quoted").cast("long").alias("n_quoted"),
        "body",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), "body").alias("formatted"),
        "root_conv",
        "root_turn",
        "depth",
        "position",
        "links",
    )
