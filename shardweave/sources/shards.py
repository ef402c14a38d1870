"""Reading a whole dataset, whatever the formats of its shards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardweave.operators.records import REST, as_struct, rename_keys, select_fields, unwrap_features
from shardweave.sources.jsonl import POSITION, read_jsonl
from shardweave.sources.paths import shard_paths, with_format
from shardweave.sources.tar import read_tar_samples
from shardweave.sources.tfrecord import read_tfrecord


def paths_by_format(paths: DataFrame) -> dict[str, DataFrame]:
    """The shard paths of each format that there is; unknown formats are an error. Paths stay in Spark."""
    named = with_format(paths)
    counts = {row["format"]: row["n"] for row in named.groupBy("format").agg(F.count(F.lit(1)).alias("n")).collect()}
    if "unknown" in counts:
        some = sorted(row["path"] for row in named.where("format = 'unknown'").limit(20).collect())
        raise ValueError(f"{counts['unknown']} unsupported shard files, among them {some}")
    kinds = {"jsonl": ("jsonl", "jsonl_zstd", "jsonl_gzip"), "tar": ("tar",), "tfrecord": ("tfrecord",)}
    found = {kind: [f for f in formats if f in counts] for kind, formats in kinds.items()}
    return {kind: named.where(F.col("format").isin(formats)).drop("format") for kind, formats in found.items() if formats}


def read_shards(
    spark: SparkSession,
    source: str | DataFrame,
    schema: T.StructType | str,
    content_key: str | None = None,
    rekey: dict[str, str] | None = None,
    shuffle_seed: int | None = None,
) -> DataFrame:
    """Records of all shards of a manifest, pattern or table of paths, with ``_shard`` and ``_pos``.

    The keys of ``schema`` become columns, all others are carried in ``_rest`` and written back by the sinks.
    ``content_key`` keeps the keys that it matches from their start, in both; ``rekey`` then renames columns. ``shuffle_seed`` shuffles the records of TFRecord
    shards.
    """
    wanted = select_fields(as_struct(schema), content_key)
    paths = shard_paths(spark, source) if isinstance(source, str) else source
    grouped = paths_by_format(paths)
    parts = []
    if "jsonl" in grouped:
        parts.append(read_jsonl(spark, grouped["jsonl"], wanted, content_key))
    if "tar" in grouped:
        parts.append(read_tar_samples(spark, grouped["tar"], wanted, keys=content_key))
    if "tfrecord" in grouped:
        parts.append(unwrap_features(read_tfrecord(spark, grouped["tfrecord"], shuffle_seed), wanted, keys=content_key))
    if not parts:
        place = as_struct(f"_shard STRING, _pos {POSITION}, {REST} STRING")
        parts.append(spark.createDataFrame([], T.StructType([*wanted.fields, *place.fields])))
    records = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rename_keys(records, rekey) if rekey else records
