"""Shared scratch space for written intermediates."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may go without the setting; it then gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return _own_folder(spark.sparkContext.applicationId)


@cache
def _own_folder(application: str) -> str:
    """One folder per application; the setting itself cannot be changed while a session runs."""
    return tempfile.mkdtemp(prefix="matchday-")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/matchday/{label}-{uuid.uuid4().hex}"


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path``, in whatever store it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes what a step has written to ``path`` and nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_FREEING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
#: By session: steps that are running, and the setting to go back to.
_FREED: dict[int, list] = {}


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that wrote them ends, not when the driver happens to collect its garbage."""
    session = spark._jsparkSession.hashCode()
    with _LOCK:
        if session not in _FREED:
            _FREED[session] = [0, spark.conf.get(_FREEING, "false")]
            spark.conf.set(_FREEING, "true")
        _FREED[session][0] += 1
    try:
        yield
    finally:
        with _LOCK:
            _FREED[session][0] -= 1
            if not _FREED[session][0]:
                spark.conf.set(_FREEING, _FREED.pop(session)[1])


def materialise(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), at: str | None = None) -> DataFrame:
    """Write ``df`` once and continue from the written table.

    Cuts the lineage, survives the loss of executors and stays columnar, so later scans of the
    result prune columns, and partitions where ``partition_by`` is given. Rows are then gathered by
    partition first, so that a task does not open a file in every one; Spark splits the large ones.
    ``at`` is a folder that the caller removes; without it the table stays as long as the shared folder.
    """
    path = f"{at}/{label}-{uuid.uuid4().hex}" if at else new_folder(df.sparkSession, label)
    schema = df.schema
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    with shuffles_freed(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path)
    back = df.sparkSession.read.schema(schema).parquet(path)
    return back.select(*[f"`{f.name}`" for f in schema.fields])
