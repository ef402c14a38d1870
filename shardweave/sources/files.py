"""Reading byte ranges of files inside tasks, on any file system that Arrow knows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardweave.session import checkpointed

RANGES = "path STRING, start LONG, stop LONG"
# Files whose size one task asks for.
STATS_PER_TASK = 256
# Bytes that one task reads, if there are enough for all cores, and what opening a range costs in bytes.
TASK_BYTES, OPEN_BYTES = 64 << 20, 256 << 10


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a URI or local path."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    if path.startswith(("s3a://", "s3n://")):
        path = "s3" + path[3:]
    return pafs.FileSystem.from_uri(path)


def replace_file(fs: pafs.FileSystem, source: str, target: str) -> None:
    """Rename, also where the file system refuses to rename onto an existing file."""
    try:
        fs.move(source, target)
    except OSError:
        if fs.get_file_info(target).type != pafs.FileType.File:
            raise
        fs.delete_file(target)
        fs.move(source, target)


def plan_ranges(
    paths: DataFrame, boundaries: Callable[[object, int], Iterator[int]], split_bytes: int
) -> DataFrame:
    """One row per piece of work: whole files, or runs of about ``split_bytes`` of large ones.

    ``boundaries(file, size)`` yields the offsets at which a record starts. Only files larger than
    ``split_bytes`` are walked for it, each in its own task, so a dataset with one huge shard is
    still read in parallel.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("bytes").to_pylist()):
                fs, inner = open_fs(path)
                cuts = [0]
                with fs.open_input_file(inner) as file:
                    for offset in boundaries(file, size):
                        if offset - cuts[-1] >= split_bytes:
                            cuts.append(offset)
                columns = [path] * len(cuts), cuts, [*cuts[1:], size]
                types = pa.string(), pa.int64(), pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], ["path", "start", "stop"]
                )

    sized = checkpointed(file_sizes(paths).filter("bytes > 0"))
    whole = sized.filter(F.col("bytes") <= split_bytes)
    cut = spread(sized.filter(F.col("bytes") > split_bytes)).mapInArrow(walk, RANGES)
    start = F.lit(0).cast("bigint").alias("start")
    return whole.select("path", start, F.col("bytes").alias("stop")).unionByName(cut)


def file_sizes(paths: DataFrame) -> DataFrame:
    """``path`` and ``bytes`` of each file: as listed, else asked from the file system in parallel."""
    if "bytes" in paths.columns:
        return paths.select("path", "bytes")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("path").to_pylist()
            sizes = []
            for path in names:
                fs, inner = open_fs(path)
                info = fs.get_file_info(inner)
                if info.type != pafs.FileType.File:
                    raise FileNotFoundError(path)
                sizes.append(info.size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["path", "bytes"]
            )

    return spread(paths.select("path"), STATS_PER_TASK).mapInArrow(look, "path STRING, bytes LONG")


def spread(work: DataFrame, per_task: int = 1) -> DataFrame:
    """One partition per ``per_task`` rows of a small table of work items (files or ranges).

    The items are written once, so that finding them is not repeated. The number of partitions is
    given explicitly because adaptive execution would otherwise merge these tiny rows, and with them
    all of the work they stand for, into one task.
    """
    items = checkpointed(work)
    return items.repartition(max(1, -(-items.count() // per_task)))


def packed(ranges: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Ranges of files with as many to a partition as make about ``task_bytes``; a larger one has its own.

    Bins are cut from running sums of bytes within each partition of the table as it is written, so no task sees all
    ranges. With few bytes for the cores there are more and smaller bins. Results do not depend on the bins.
    """
    cost = F.col("stop") - F.col("start") + OPEN_BYTES
    placed = checkpointed(ranges.withColumn("_part", F.spark_partition_id()))
    total = placed.agg(F.coalesce(F.sum(cost), F.lit(0))).first()[0]
    size = max(1, min(task_bytes, -(-total // ranges.sparkSession.sparkContext.defaultParallelism)))
    before = F.sum(cost).over(Window.partitionBy("_part").orderBy("path", "start", "stop").rowsBetween(Window.unboundedPreceding, -1))
    cut = placed.withColumn("_cut", F.floor(F.coalesce(before, F.lit(0)) / F.lit(size)))
    within = F.dense_rank().over(Window.partitionBy("_part").orderBy("_cut")) - 1
    binned = cut.withColumn("_bin", within)
    # One row per partition of a table of files.
    parts = binned.groupBy("_part").agg((F.max("_bin") + 1).alias("_bins"))
    first = F.sum("_bins").over(Window.orderBy("_part")) - F.col("_bins")
    offsets = parts.select("_part", first.alias("_first"))
    bins = max(1, parts.agg(F.sum("_bins")).first()[0] or 0)
    numbered = binned.join(F.broadcast(offsets), "_part").withColumn("_bin", (F.col("_first") + F.col("_bin")).cast("int"))
    return numbered.repartitionById(bins, F.col("_bin")).select(*ranges.columns)
