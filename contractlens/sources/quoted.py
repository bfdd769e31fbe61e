"""Records of delimited files whose quoted values hold line breaks, read by many tasks.

A line alone does not tell whether it starts inside a quoted value.  What it does
tell is where it ends for either start: so every line is a function from state to
state (outside or inside quotes), and functions compose.  Each block of a file is
composed by itself, one row per block is composed along the file, and with the
state that reaches a block all of its lines know theirs.  A line that starts
outside starts a record; most records are one line and stay where they are, only
the lines of longer records meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEPARATOR = ";"
_INSIDE = r'(?:[^"]|"")*+'
_FIELD = rf'(?:"{_INSIDE}"[^{SEPARATOR}]*+|[^"{SEPARATOR}][^{SEPARATOR}]*+|)'  # one that ends in this line
_OPEN = rf'(?:{_FIELD}{SEPARATOR})*+"{_INSIDE}$'  # fields up to one that stays open
FROM_OUTSIDE = f"^{_OPEN}"
FROM_INSIDE = rf'^{_INSIDE}(?:$|"[^{SEPARATOR}]*+{SEPARATOR}{_OPEN})'
BLOCK = ["path", "start"]


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with file, block start and a position that rises inside the block; `out0`, `out1`: state after the line."""
    where = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")]
    lines = spark.read.option("lineSep", "\n").text(path).select(*where, F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    quoted = F.contains("line", F.lit('"'))
    return lines.withColumns({
        "out0": (quoted & F.col("line").rlike(FROM_OUTSIDE)).cast("int"),
        "out1": (~quoted | F.col("line").rlike(FROM_INSIDE)).cast("int"),
    })


def composed(df: DataFrame, within: list[str], order: str) -> DataFrame:
    """`out0` and `out1` of each row become those of all rows up to it.

    A row whose outcome is the same for both states forgets what came before; the
    others keep the state or swap it.  So the state is that of the last forgetful
    row, or the initial one, and the swaps since.
    """
    upto = Window.partitionBy(*within).orderBy(order)
    swaps = F.sum(F.when((F.col("out0") == 1) & (F.col("out1") == 0), 1).otherwise(0)).over(upto)
    fixed = F.when(F.col("out0") == F.col("out1"), F.pmod(F.col("out0") + F.col("_swaps"), F.lit(2)))
    known = df.withColumn("_swaps", swaps).withColumn("_from", F.last(fixed, ignorenulls=True).over(upto))
    after = lambda first: F.pmod(F.coalesce("_from", F.lit(first)) + F.col("_swaps"), F.lit(2)).cast("int")
    return known.withColumns({"out0": after(0), "out1": after(1)}).drop("_swaps", "_from")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(path, number, record): the records of each file, numbered from 1; blank lines between records are none.

    A file that ends inside a quoted value is an error.  Quotes inside an
    unquoted value are plain characters.
    """
    lines = composed(text_lines(spark, path), BLOCK, "at")
    in_block = Window.partitionBy(*BLOCK).orderBy("at")
    blank = F.rtrim("line", F.lit(" \t\r")) == ""

    def states(of: DataFrame, entering: Column) -> DataFrame:
        after = F.when(entering == 1, F.col("out1")).otherwise(F.col("out0"))
        seen = of.withColumn("_after", after)
        return seen.withColumn("_before", F.coalesce(F.lag("_after").over(in_block), entering))

    # Records that start in a block: counted for both states, as the entering one is not known yet.
    starts = lambda before: F.count_if((before == 0) & ~blank)
    both = lines.withColumns({f"_b{s}": F.coalesce(F.lag(f"out{s}").over(in_block), F.lit(s)) for s in (0, 1)})
    blocks = both.groupBy(*BLOCK).agg(
        F.max_by("out0", "at").alias("out0"), F.max_by("out1", "at").alias("out1"),
        starts(F.col("_b0")).alias("starts0"), starts(F.col("_b1")).alias("starts1"),
    )
    along = Window.partitionBy("path").orderBy("start")  # one row per block of a file
    entered = composed(blocks, ["path"], "start").withColumn("entering", F.coalesce(F.lag("out0").over(along), F.lit(0)))
    count = F.when(F.col("entering") == 1, F.col("starts1")).otherwise(F.col("starts0"))
    before = F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    entered = entered.withColumn("_n", count).withColumn("records_before", before)
    last = Window.partitionBy("path").orderBy(F.desc("start"))
    unclosed = entered.withColumn("_r", F.row_number().over(last)).filter("_r = 1 and out0 = 1").select("path").head()
    if unclosed:
        raise ValueError(f"{unclosed.path} ends inside a quoted value")

    placed = states(lines.join(entered.select(*BLOCK, "entering", "records_before"), BLOCK), F.col("entering"))
    first = (F.col("_before") == 0) & ~blank
    number = F.col("records_before") + F.sum(first.cast("int")).over(in_block)
    held = placed.withColumns({"number": number, "_first": first}).filter("_first or _before = 1")
    alone = F.col("_first") & (F.col("_after") == 0)
    single = held.filter(alone).select("path", "number", F.col("line").alias("record"))
    parts = held.filter(~alone).groupBy("path", "number").agg(F.sort_array(F.collect_list(F.struct("start", "at", "line"))).alias("_l"))
    longer = parts.select("path", "number", F.array_join(F.col("_l.line"), "\n").alias("record"))
    return single.unionByName(longer).withColumn("record", F.rtrim("record", F.lit("\r")))
