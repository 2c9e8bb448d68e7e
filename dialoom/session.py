"""Shared folder and written intermediate tables.

Operators that need the same rows twice (a global rank, a search over bins) write
them once to the shared folder of the cluster and read them back.  That cuts the
lineage, and a lost executor costs a re-read instead of a re-run.  The planner knows the
size of a written table, so small ones are broadcast by its own threshold.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # from Spark 4.1 on
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"  # from Spark 4.0 on


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or what the context
    was given.  Only in local mode, where one machine holds all, a folder in the session's
    warehouse is the fallback."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staged"


def new_folder(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for what is written or collected inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Rows go to Python workers some 4 MB at a time instead of 64: a worker holds them as
    Arrow and as Python objects, next to its executor's own copy."""
    return setting(spark, _BATCH, str(4 << 20))


def _write(df: DataFrame, path: str) -> None:
    """Write a table once; the shuffle files of this write go as soon as it ends, not when
    the driver next happens to collect what refers to them."""
    with setting(df.sparkSession, _CLEANUP, "true"):
        df.write.parquet(path)


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the table read back."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    _write(df, path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``new_folder`` named."""
    target, files = _file_system(spark, path)
    files.delete(target, True)


def create_marker(spark: SparkSession, path: str) -> None:
    """Create an empty file; it is there or not, never in between."""
    target, files = _file_system(spark, path)
    if not files.createNewFile(target):
        raise FileExistsError(path)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no folder."""
    target, files = _file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target))


class Stages:
    """Tables staged during a run; all but those to keep go when it is done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.open = spark, [], []

    def table(self, df: DataFrame, label: str, keep: bool = False) -> DataFrame:
        path = new_folder(self.spark, label)
        _write(df, path)
        table = self.spark.read.schema(df.schema).parquet(path)
        if not keep:
            self.paths.append(path)
            self.open.append((table, path))
        return table

    def release(self, *tables: DataFrame) -> None:
        """Drop tables that nothing reads any more; others than those staged here stay."""
        for path in [p for t, p in self.open if any(t is x for x in tables)]:
            drop_folder(self.spark, path)
            self.paths.remove(path)
        self.open = [(t, p) for t, p in self.open if p in self.paths]

    def drop(self) -> None:
        for path in self.paths:
            drop_folder(self.spark, path)
        self.paths, self.open = [], []
