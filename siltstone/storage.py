"""Intermediate tables in the folder that all executors share.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir``.  The folder is read from the session; a private one
is made only where the setting is missing and the master is local, as in tests on one machine.
"""

from __future__ import annotations

import tempfile
import uuid
from contextvars import ContextVar, Token

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

_own_root: str | None = None


class Scratch:
    """The intermediate tables of one job.

    What is written inside ``with`` belongs to it, until ``close`` deletes it; call that when the job's lazy results are
    written.  Tables made outside any ``with`` belong to a common one, which ``release`` clears.
    """

    def __init__(self) -> None:
        self.paths: list[str] = []
        self._tokens: list[Token] = []

    def __enter__(self) -> Scratch:
        self._tokens.append(_current.set(self))
        return self

    def __exit__(self, *_) -> None:
        _current.reset(self._tokens.pop())

    def close(self, spark: SparkSession) -> None:
        while self.paths:
            delete(spark, self.paths.pop(0))


_common = Scratch()
_current: ContextVar[Scratch] = ContextVar("scratch", default=_common)


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the session, without a trailing slash."""
    global _own_root
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("a cluster needs spark.checkpoint.dir, a folder that driver and executors share")
    if _own_root is None:
        _own_root = "file://" + tempfile.mkdtemp(prefix="siltstone-")
    return _own_root


def scratch_path(spark: SparkSession, label: str, released: bool = True) -> str:
    """A new path below the shared folder, which goes with the present ``Scratch`` unless told not to."""
    path = f"{shared_root(spark)}/siltstone/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    if released:
        _current.get().paths.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table, which survives lost executors and has known statistics."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path within it, for code that runs on executors."""
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path through Hadoop's file system, wherever it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Delete what was written outside any ``Scratch``; call it when results are written."""
    _common.close(spark)


def bounded_batches(spark: SparkSession, rows: int = 2_000, megabytes: int = 16) -> None:
    """Bound the Arrow batches that go to Python workers by bytes too, so that very long texts do not pile up.

    The plan reads these settings when it runs, so they stay; smaller bounds that the session has already are kept.
    """
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", megabytes << 20)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key)
        if not now.removesuffix("b").isdigit() or not 0 < int(now.removesuffix("b")) <= most:
            spark.conf.set(key, str(most))
