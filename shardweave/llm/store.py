"""Intermediate tables in the shared scratch folder, and broadcast models."""

from __future__ import annotations

import atexit
from contextlib import suppress

from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession

from shardweave.session import scratch_path

_FOLDERS: list[tuple[str, str]] = []
_SHARED: list[tuple[str, Broadcast]] = []


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet below ``spark.checkpoint.dir`` and read it back.

    Later steps then see one fixed result, whatever executors are lost, and their lineage ends here.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    _FOLDERS.append((spark.sparkContext.applicationId, path))
    return spark.read.schema(df.schema).parquet(path)


def claimed(spark: SparkSession, label: str) -> str:
    """A new folder for several tables of one operator, deleted with the others."""
    path = scratch_path(spark, label)
    _FOLDERS.append((spark.sparkContext.applicationId, path))
    return path


def stored_by(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """As ``stored``, but bucketed by ``key``: joins on it shuffle only their other side."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    name = path.rpartition("/")[2].replace("-", "_")
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    _FOLDERS.append((spark.sparkContext.applicationId, path))
    return spark.table(name)


def everywhere(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast a model or table of bounded size, which ``destroy`` takes from all executors again."""
    sent = spark.sparkContext.broadcast(value)
    _SHARED.append((spark.sparkContext.applicationId, sent))
    return sent


def broadcasts(spark: SparkSession) -> list[Broadcast]:
    """What this application has sent with ``everywhere`` and not destroyed, in order."""
    return [sent for owner, sent in _SHARED if owner == spark.sparkContext.applicationId]


def destroy(sent: list[Broadcast]) -> None:
    """Remove broadcasts everywhere, once every result that uses them has been written."""
    for one in sent:
        one.destroy(blocking=False)
    _SHARED[:] = [pair for pair in _SHARED if not any(pair[1] is one for one in sent)]


@atexit.register
def _sweep() -> None:
    """Delete what is left when the driver ends while its session still runs."""
    with suppress(Exception):  # the session may be gone already
        spark = SparkSession.getActiveSession()
        if spark is not None:
            release(spark, folders(spark))


def folders(spark: SparkSession) -> list[str]:
    """The tables that this application has stored and not released, in order."""
    application = spark.sparkContext.applicationId
    return [path for owner, path in _FOLDERS if owner == application]


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables, once every result that reads them has been written elsewhere."""
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        spark.sql(f"DROP TABLE IF EXISTS {path.rpartition('/')[2].replace('-', '_')}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
        _FOLDERS[:] = [f for f in _FOLDERS if f[1] != path]
