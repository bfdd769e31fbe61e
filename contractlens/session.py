"""Session helpers: configuration for local runs and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app_name: str = "contractlens") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """Shared folder for cut points, as the cluster names it.

    Only a local session without the setting gets a folder of its own: on a
    cluster a machine-local path would be lost with its executor.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if not configured:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="contractlens-")
        spark.conf.set(CHECKPOINT_SETTING, configured)
    return configured.rstrip("/")


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for the block's own jobs."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


_written: list[str] = []  # cut points of this application that are still there


def _folder(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder beside the cut points, gone when the application ends."""
    path = f"{work_dir(spark)}/contractlens/{name}-{uuid.uuid4().hex}"
    target, fs = _folder(spark, path)
    fs.deleteOnExit(target)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where one frame feeds several outputs: the facts are scanned once,
    the lineage is cut, a lost executor re-reads files, and the readers keep
    column pruning, filter pushdown and size statistics.  The files go away
    when the application ends, or with the `cut_points` block around the call.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, job, name: str) -> DataFrame:
    """The frame that ``job`` returns, written; the cut points made on the way are deleted at once."""
    mark = len(_written)
    result = materialize(job(), name)
    for path in _written[mark:-1]:
        target, fs = _folder(spark, path)
        fs.delete(target, True)
    del _written[mark:-1]
    return result


@contextmanager
def cut_points(spark: SparkSession):
    """Delete the cut points written inside the block; for jobs whose results are stored by its end."""
    mark = len(_written)
    try:
        yield
    finally:
        for path in _written[mark:]:
            target, fs = _folder(spark, path)
            fs.delete(target, True)
        del _written[mark:]
