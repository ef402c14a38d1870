"""Session plumbing: shared scratch space, checkpoints, shipping the package to workers."""

from __future__ import annotations

import os
import shutil
import sys
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_SCRATCH: dict[str, str] = {}
_SHIPPED: set[tuple[str, str]] = set()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session, whose executors share the driver's disk, may go without that
    setting; a cluster without it is an error rather than a silent fall-back to a local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[context.applicationId] = tempfile.mkdtemp(prefix="shardweave-")
    return _LOCAL_SCRATCH[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


class _Scopes(threading.local):
    """The folders of the scopes that are open in a thread, the innermost last."""

    def __init__(self):
        self.folders: list[str] = []


_SCOPES = _Scopes()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that ``checkpointed`` writes within a scope live until its end; whoever needs their rows later must
    have written them elsewhere. Scopes may be nested, a wave within a run."""
    folder = scratch_path(spark, "scope")
    _SCOPES.folders.append(folder)
    try:
        yield
    finally:
        _SCOPES.folders.remove(folder)
        delete_folder(spark, folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder with all that is in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage once, so that later uses see one fixed result.

    Within a ``scratch_scope`` it is a table that goes with the scope, else a checkpoint.
    """
    if _SCOPES.folders:
        path = f"{_SCOPES.folders[-1]}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{scratch_root(df.sparkSession)}/checkpoints")
    return df.checkpoint()


# Bytes of rows that a Python worker gets at a time where rows hold whole texts or images.
BATCH_BYTES = 8 << 20


@contextmanager
def _setting(spark: SparkSession, name: str, value: str | int) -> Iterator[None]:
    """A setting of the session for the jobs started within."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Jobs started within send their Python workers batches of about ``BATCH_BYTES``, however many rows these are.

    A worker holds a batch several times over, so the memory of all workers would else grow with the rows of a shard.
    """
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries started within delete their shuffle files when they end, each wave of a run its own.

    Else these stay until the driver happens to collect its garbage, so that disk grows with all that was ever
    written. For writes: their plans run once.
    """
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


# A table of at most this many short rows may be copied to every executor.
BROADCAST_ROWS = 200_000


def join_small(df: DataFrame, small: DataFrame, on: str | list[str], rows: int | None = None) -> DataFrame:
    """Join a table that is usually small: broadcast once its counted rows allow it.

    Beyond that Spark chooses the join itself, and splits hot keys of ``df`` at run time; ``small``
    must have one row per key.
    """
    counted = small.count() if rows is None else rows
    return df.join(F.broadcast(small) if counted <= BROADCAST_ROWS else small, on)


def balanced(df: DataFrame, identity: list[str]) -> DataFrame:
    """Spread the rows of a small scan over all cores before costly Python work.

    A few files make few partitions, and of the splits of one row group all but one are empty; so a
    scan is left alone only when it has several partitions per core. ``df`` must come straight from a
    scan. ``identity`` must tell the records apart, so that copies of one record spread as well; the
    exchange is by hash, hence the same on every attempt.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 4 * cores:
        return df
    return df.repartition(2 * cores, *identity)


def ship_package(spark: SparkSession, *others: ModuleType) -> None:
    """Send this package, and ``others`` that hold user functions, to the Python workers.

    Does nothing for packages that this application has already sent.
    """
    application = spark.sparkContext.applicationId
    for package in (sys.modules[__name__.partition(".")[0]], *others):
        folder = os.path.dirname(os.path.abspath(package.__file__))
        if (application, folder) in _SHIPPED:
            continue
        parent, name = os.path.split(folder)
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="shardweave-"), name), "zip", parent, name)
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add((application, folder))
