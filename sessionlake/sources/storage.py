"""Where results that are read twice are kept: below the folder that the cluster shares, until a scope ends."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir; a temporary one only where none is set, in local mode."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="sessionlake-")
        sc.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/sessionlake-{uuid.uuid4().hex}"
    if (held := _scope.get()) is not None:
        held.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What this thread stores in this scope is deleted at its end: use it around an operator whose result is written elsewhere."""
    token = _scope.set([])
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in _scope.get() or []:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        _scope.reset(token)


def stored(df: DataFrame, sort_by: list[str] | None = None) -> DataFrame:
    """df written once to the shared folder and read back: cuts lineage, survives the loss of executors."""
    path = shared_folder(df.sparkSession)
    (df.sortWithinPartitions(*sort_by) if sort_by else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
