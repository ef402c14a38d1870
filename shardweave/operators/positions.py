"""Running numbers over a total order, without sending all rows through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardweave.session import checkpointed


def global_index(df: DataFrame, order: list[str], out: str, start: int = 0) -> DataFrame:
    """Number the rows of ``df`` from ``start`` in the order of ``order`` (which must be unique).

    The rows are range-partitioned and written once, so that every later step sees the same ranges;
    each range is numbered on its own and shifted by the size of the ranges before it. Only the
    table of range sizes, one row per partition, is ever in one task.
    """
    ranged = checkpointed(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_range").orderBy(*order)
    # One row per range, so a broadcast of at most the number of shuffle partitions.
    numbered = ranged.join(F.broadcast(offsets), "_range").withColumn(
        out, (F.col("_offset") + F.row_number().over(within) - 1 + start).cast("bigint")
    )
    return numbered.drop("_range", "_offset")
