"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "playspan", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on: UTC, ANSI, AQE with skew splitting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, on storage every executor can read.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="playspan-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_scope: ContextVar[str | None] = ContextVar("scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that nothing has written to before."""
    return f"{_scope.get() or f'{scratch_root(spark)}/playspan'}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession, name: str) -> Iterator[None]:
    """What is staged inside is removed at the end: for jobs whose results are written elsewhere."""
    folder = scratch_path(spark, name)
    before = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(before)
        remove(spark, folder)


LISTING_TASKS = 64
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Many folders read inside are listed by ``LISTING_TASKS`` tasks at most.

    Spark takes a task per folder, and each sends some KB of its own to the driver.
    """
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(before), LISTING_TASKS)))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def file_system(spark: SparkSession, path: str):
    """The Hadoop path and its file system, for listings and removals by the driver."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    where, files = file_system(spark, path)
    files.delete(where, True)


DICTIONARY_BYTES = 512 << 20


def long_texts_once(spark: SparkSession, *columns: str) -> None:
    """What the session writes as parquet holds a long text that many rows share once per row group.

    Parquet's dictionary of a column ends at 1 MB otherwise, and from there on each row holds its
    text in full. Columns of different values are written without a dictionary as before.
    Statistics of the named ``columns`` are not written: equal texts would be compared in full
    with the least and the greatest of their page, row by row, and long ones are not kept.
    """
    spark.conf.set("parquet.dictionary.page.size", str(DICTIONARY_BYTES))
    for column in columns:
        spark.conf.set(f"parquet.column.statistics.enabled#{column}", "false")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage like ``checkpoint()``, but stays columnar: later passes
    read only the columns they need and row counts come from file footers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
