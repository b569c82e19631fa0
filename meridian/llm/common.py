"""Helpers shared by the operators: table loading, durable intermediate
tables in the session's shared checkpoint folder, and UDF shipping."""

from __future__ import annotations

import ctypes
import sys
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.session import ensure_checkpoint_dir


def ship(module_name: str) -> None:
    """Pickle a module's functions by value: executors need no installed copy."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new folder under the shared checkpoint folder, deleted by the
    session's JVM when it ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the
    lineage ends there, and a lost executor costs only its running tasks."""
    path = shared_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """Arrow batches of so many rows, for wide rows in jobs that run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


WIDE_ROWS = 1000    # rows of whole texts in a batch


def give_back() -> None:
    """Memory that Python has freed goes back to the system, where it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run):
    """``run`` over a task's batches. Workers are kept for later tasks and
    stages: what the task before held goes back first, and this one's last."""
    def tidied(batches):
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()
    return tidied


MAX_BROADCAST_KEYS = 1_000_000


def without(docs: DataFrame, gone: DataFrame, condition: Column) -> DataFrame:
    """The rows of ``docs`` that meet none of ``gone``, a few narrow columns.
    Up to ``MAX_BROADCAST_KEYS`` rows of it are sent to every task; more are
    joined by a shuffle."""
    gone = staged(gone, "gone")
    small = gone.count() <= MAX_BROADCAST_KEYS
    return docs.join(F.broadcast(gone) if small else gone, condition, "left_anti")


def utf8(col: Column | str) -> Column:
    """Text as UTF-8 bytes; null counts as empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit("")).cast("binary")


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


ship(__name__)
