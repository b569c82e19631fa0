"""Stored results keyed by a fingerprint of the files they come from.

A long derivation (identity resolution) is worked out once and read back by
every later query that starts from the same files. The key covers the path,
length and modification time of every input file and the logical plan over
them, so a changed input, another file or another projection is derived anew.

A table is written to a folder of its own, then announced by a marker file that
is renamed into its place. Readers look for the marker only, so they never see a
half-written table or marker; whichever of several writers announces its table,
that one is whole. A lost executor costs its running tasks, a lost driver leaves
an unannounced folder that nothing reads.

By default the store lies in the session's shared checkpoint folder and goes
with the session. With a ``root`` of one's own, stored tables outlive the
session and are shared by all sessions that name it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meridian.session import ensure_checkpoint_dir

FORMAT = 1          # of the stored tables; another number derives everything anew


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _only_files(df: DataFrame) -> bool:
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return all(leaves.apply(i).getClass().getSimpleName() == "LogicalRelation" for i in range(leaves.size()))


def fingerprint(*frames: DataFrame, salt: str = "") -> str | None:
    """A key for what is derived from ``frames``; None when one of them reads
    anything but files, which can't be recognised again."""
    key = hashlib.sha256(f"{FORMAT} {salt}".encode())
    for df in frames:
        files = sorted(df.inputFiles())
        if not files or not _only_files(df):
            return None
        key.update(f"{df.semanticHash()} {df.schema.simpleString()} {len(files)}\n".encode())
        for f in files:
            fs, path = _file_system(df.sparkSession, f)
            status = fs.getFileStatus(path)
            key.update(f"{f} {status.getLen()} {status.getModificationTime()}\n".encode())
    return key.hexdigest()[:32]


class Store:
    """Tables derived from ``frames``: ``table(name, build)`` reads the stored
    one, or builds and stores it. Frames that can't be recognised again get a
    store that only this object uses."""

    def __init__(self, *frames: DataFrame, salt: str = "", root: str | None = None) -> None:
        self.spark = frames[0].sparkSession
        self.key = fingerprint(*frames, salt=salt) or f"once-{uuid.uuid4().hex}"
        app = self.spark.sparkContext.applicationId
        self.root = root or f"{ensure_checkpoint_dir(self.spark)}/store-{app}"
        self.keep = root is not None
        self.built: list[str] = []          # names of the tables built by this object

    def _announced(self, name: str) -> str | None:
        fs, marker = _file_system(self.spark, f"{self.root}/{self.key}/{name}.at")
        if not fs.exists(marker):
            return None
        stream = fs.open(marker)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _announce(self, name: str, path: str) -> str:
        fs, marker = _file_system(self.spark, f"{self.root}/{self.key}/{name}.at")
        pending = f"{path}.at"
        fs_, jpending = _file_system(self.spark, pending)
        stream = fs_.create(jpending, False)
        stream.write(bytearray(path.encode()))
        stream.close()
        if fs.exists(marker) or not fs.rename(jpending, marker):
            fs_.delete(jpending, False)
        return self._announced(name) or path

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = self._announced(name)
        if path is None:
            fs, folder = _file_system(self.spark, f"{self.root}/{self.key}")
            fs.mkdirs(folder)
            if not self.keep:
                fs.deleteOnExit(folder)
            path = f"{self.root}/{self.key}/{name}-{uuid.uuid4().hex}"
            build().write.option("compression", "zstd").parquet(path)
            self.built.append(name)
            path = self._announce(name, path)
        return self.spark.read.parquet(path)
