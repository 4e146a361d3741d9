"""Where shared intermediate tables go."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open blocks of passing()", default=())
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def _local_dir(app: str) -> str:
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return _LOCAL[app]


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; only a local session without one gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_dir(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/voltloom-{uuid.uuid4().hex}"


def materialise(df: DataFrame, spark: SparkSession | None = None, compression: str | None = None) -> DataFrame:
    """Write a frame that several later jobs read to the shared folder and read it back.

    The written table cuts the lineage and survives lost executors.  ``compression`` is a
    parquet codec; the session's is the default.
    """
    s = spark or df.sparkSession
    path = shared_dir(s)
    for tables in _OPEN.get()[-1:]:
        tables.append(path)
    df.write.parquet(path, compression=compression)
    out = s.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def discard(df: DataFrame, spark: SparkSession) -> None:
    """Remove the table that ``materialise`` wrote for this very frame; any other frame is left alone."""
    if path := _PATHS.pop(df, None):
        _remove(spark, path)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block whose tables are removed when it ends.

    Every table that ``materialise`` writes inside goes, also on an error.  Frames needed
    afterwards are written by the function this gives; their tables belong to the block
    around this one, if any.
    """
    outer, mine = _OPEN.get(), []

    def keep(df: DataFrame) -> DataFrame:
        inside = _OPEN.set(outer)
        try:
            return materialise(df, spark)
        finally:
            _OPEN.reset(inside)

    block = _OPEN.set((*outer, mine))
    try:
        yield keep
    finally:
        _OPEN.reset(block)
        for path in mine:
            _remove(spark, path)
