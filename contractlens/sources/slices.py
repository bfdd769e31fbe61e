"""Facts stored by month under a manifest, and replacing delivered slices of them.

    data/<write>/_slice=<month>/   files, never changed once written
    index/<write>/                 month of every number, for facts replaced by number
    manifest/v<n>/                 one row per month: which folder holds it now

A load writes new files for the months it touches, then one new manifest.  The
marker that ends this last write is the swap: readers take the newest manifest
that has it, so a load that dies earlier leaves them on the old state, whole.
The manifest also answers which months there are without a look at the facts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractlens.session import materialize

MONTH = "fact_month"
SLICE = "_slice"
ROWS_PER_FILE = 2_000_000
ROW = "fact_month int, folder string, rows long, schema string, index array<string>, last_key long"


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


@dataclass(frozen=True)
class State:
    """What a manifest says; `months` maps a month to its folder and number of rows."""

    version: int = 0
    months: dict[int, tuple[str, int]] = field(default_factory=dict)
    schema: T.StructType | None = None
    index: tuple[str, ...] = ()
    last_key: int = 0

    @property
    def latest_month(self) -> int | None:
        return max(self.months, default=None)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all manifests that were finished."""
    names = [n for n in children(spark, f"{root}/manifest") if n.startswith("v")]
    return [int(n[1:]) for n in names if exists(spark, f"{root}/manifest/{n}/_SUCCESS")]


def state(spark: SparkSession, root: str, version: int | None = None) -> State:
    """The newest state, or an older one; an empty one where nothing was stored."""
    done = versions(spark, root)
    if not done:
        return State()
    version = done[-1] if version is None else version
    rows = spark.read.schema(ROW).parquet(f"{root}/manifest/v{version:08d}").collect()  # one per month, and one for all
    head = next(r for r in rows if r.fact_month is None)
    months = {r.fact_month: (r.folder, r.rows) for r in rows if r.fact_month is not None}
    return State(version, months, T.StructType.fromJson(json.loads(head.schema)), tuple(head["index"]), head.last_key)


def read(spark: SparkSession, root: str, months: Iterable[int] | None = None, of: State | None = None) -> DataFrame:
    """The facts, or those of some months: only their folders are listed and read."""
    now = of or state(spark, root)
    if now.schema is None:
        raise FileNotFoundError(f"nothing is stored at {root}")
    wanted = now.months if months is None else [m for m in months if m in now.months]
    paths = [f"{root}/data/{now.months[m][0]}/{SLICE}={m}" for m in sorted(wanted)]
    return spark.read.schema(now.schema).parquet(*paths) if paths else spark.createDataFrame([], now.schema)


def known_months(spark: SparkSession, root: str, now: State, numbers: DataFrame, key: str) -> DataFrame:
    """(key, fact_month) of the numbers that are stored, from the index alone."""
    if not now.index:
        return numbers.select(key, F.lit(None).cast("int").alias(MONTH)).limit(0)
    entries = spark.read.parquet(*[f"{root}/index/{name}" for name in now.index])
    newest = entries.join(numbers.select(key), key, "left_semi").groupBy(key).agg(F.max_by(MONTH, "version").alias(MONTH))
    return newest.filter(F.col(MONTH).isNotNull())


def months_of(rows: DataFrame) -> set[int]:
    """Calendar months of the rows."""
    return {r[0] for r in rows.select(MONTH).distinct().collect()}


def replace_slices(
    spark: SparkSession,
    root: str,
    rows: DataFrame,
    delivered: DataFrame,
    keys: Sequence[str],
    *,
    numbered: bool = False,
    last_key: int | None = None,
    of: State | None = None,
    cleared: set[int] | None = None,
    stored: bool = False,
) -> int:
    """Replace the delivered slices of the facts at ``root``; returns the number of months written.

    ``rows`` are the new facts with their month in `fact_month`.  ``delivered``
    names the slices to clear by ``keys``, whether or not new rows take their
    place; it has `fact_month` too, unless the facts are ``numbered``: then its
    single key is a number whose month the index knows.  Only months that hold a
    cleared or a new row are read and written; a month that becomes empty leaves
    the manifest.  Rows of a month are written by as many tasks as its size asks
    for.  A caller that has looked up the state and the ``cleared`` months gives them;
    ``stored`` rows come from files with little work and are not written first.
    """
    new = rows if stored else materialize(rows, "new_facts")
    now = of or state(spark, root)
    slices = delivered.select(*keys).distinct()  # written nowhere: each use shuffles them by the key it needs anyway
    if cleared is None:
        cleared = months_of(known_months(spark, root, now, delivered, keys[0]) if numbered else delivered)
    months = cleared | months_of(new)
    held = read(spark, root, months, now) if now.schema else None
    kept_rows = held if months.isdisjoint(now.months) else held.join(slices, list(keys), "left_anti")
    state_rows = new if held is None else kept_rows.unionByName(new, allowMissingColumns=True)
    names = [*(c for c in (held or new).columns if c != MONTH), *(c for c in new.columns if held is not None and c not in held.columns), MONTH]
    write = uuid.uuid4().hex
    written = _write(state_rows.select(*names), f"{root}/data/{write}")
    index = list(now.index)
    if numbered:
        entry = slices.join(new.select(*keys, MONTH), list(keys), "left").withColumn("version", F.lit(now.version + 1))
        entry.write.parquet(f"{root}/index/{write}")  # a number without a new row has no month any more
        index.append(write)
    kept = {m: f for m, f in now.months.items() if m not in months}
    fresh = {m: (write, n) for m, n in written.items()}
    schema = state_rows.select(*names).schema
    _commit(spark, root, State(now.version, kept | fresh, schema, tuple(index), now.last_key if last_key is None else last_key))
    return len(months)


def _write(df: DataFrame, folder: str) -> dict[int, int]:
    """Write the months and count their rows."""
    (
        df.withColumn(SLICE, F.col(MONTH))
        .hint("rebalance", SLICE)
        .write.option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(SLICE)
        .parquet(folder)
    )
    counts = df.sparkSession.read.schema(T.StructType([df.schema[MONTH]])).parquet(folder) if _has_files(df.sparkSession, folder) else None
    return {} if counts is None else {r[0]: r[1] for r in counts.groupBy(MONTH).count().collect()}  # calendar months


def _has_files(spark: SparkSession, folder: str) -> bool:
    return any(n.startswith(f"{SLICE}=") for n in children(spark, folder))


def _commit(spark: SparkSession, root: str, new: State) -> None:
    """Write the next manifest; the marker that ends the write makes it the current one."""
    taken = [int(n[1:]) for n in children(spark, f"{root}/manifest") if n.startswith("v")]  # unfinished ones too
    if any(n > new.version for n in versions(spark, root)):
        raise RuntimeError(f"another load of {root} was finished meanwhile; run this one again")
    head = (None, None, None, new.schema.json(), list(new.index), new.last_key)
    rows = [head, *[(m, folder, n, None, None, None) for m, (folder, n) in new.months.items()]]
    manifest = spark.createDataFrame(rows, ROW).coalesce(1)
    manifest.write.parquet(f"{root}/manifest/v{max(taken, default=0) + 1:08d}")


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete manifests before the last ``keep``, and what only they point to; not while a load or an old reader runs."""
    done = versions(spark, root)
    held = [state(spark, root, v) for v in done[-keep:]]
    used = {f"data/{folder}/{SLICE}={m}" for s in held for m, (folder, _) in s.months.items()} | {f"index/{i}" for s in held for i in s.index}
    used |= {f"manifest/v{s.version:08d}" for s in held}
    every = [f"manifest/{n}" for n in children(spark, f"{root}/manifest")] + [f"index/{n}" for n in children(spark, f"{root}/index")]
    for write in children(spark, f"{root}/data"):
        every += [f"data/{write}/{n}" for n in children(spark, f"{root}/data/{write}") if n.startswith(f"{SLICE}=")]
    gone = sorted(set(every) - used)
    for name in gone:
        fs, where = _fs(spark, f"{root}/{name}")
        fs.delete(where, True)
    return gone
