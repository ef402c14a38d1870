"""The two jobs as a user starts them: captions or embeddings for a whole sharded dataset."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardweave.operators import infer, records
from shardweave.operators.ledger import full_manifest, recover, run_waves
from shardweave.operators.shards import MAX_BYTES, require_verified, write_config, write_info_manifest, write_manifest
from shardweave.operators.teachers import TeacherSpec
from shardweave.plans.augment_plan import compress_draws
from shardweave.plans.config import steps_from_config
from shardweave.session import scratch_scope
from shardweave.sources.paths import shard_paths
from shardweave.sources.shards import read_shards


def caption_records(
    df: DataFrame,
    teacher: TeacherSpec,
    num_samples: int,
    tag_suffix: str,
    seed: int,
    batch_size: int,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Records with captions, invalid ones unchanged."""
    identified = records.record_id(df)
    captioned = infer.add_captions(
        records.flag_valid(identified), teacher, num_samples, tag_suffix, seed, "uid", batch_size, profile
    )
    return captioned.drop("_image", "_valid", "_reason")


def embed_records(
    df: DataFrame,
    teachers: list[TeacherSpec],
    aug_config: Mapping,
    num_samples: int,
    tag_suffix: str,
    syn_text_key_regex: str,
    decode: Column,
    seed: int,
    batch_size: int,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Records with image and text embeddings and the stored augmentation parameters."""
    steps = steps_from_config(aug_config)
    checked = records.unify_text(records.flag_valid(records.record_id(df)))
    decoded = checked.withColumn("_tensor", decode)
    usable = decoded.withColumn("_valid", F.col("_valid") & F.col("_tensor").isNotNull())
    keys = [k for k in ("text", "texts") if k in usable.columns]
    keys += [k for k in records.match_syn_keys(usable, syn_text_key_regex) if k not in keys]
    texts = records.collect_texts(usable, syn_text_key_regex)
    seen = infer.add_image_embeddings(
        texts, teachers, num_samples, aug_config, seed, "_tensor", "uid", tag_suffix, batch_size, profile
    )
    stored = seen.withColumn(
        "param_aug", F.when(F.col("_valid"), compress_draws(F.col("params"), steps))
    ).drop("params")
    read = infer.add_text_embeddings(stored, teachers, batch_size, profile=profile)
    split = infer.split_text_embeddings(read, keys, tag_suffix)
    return split.drop("_image", "_valid", "_reason", "_tensor", "_texts", "_text_lengths", "_text_emb")


def _finish(spark: SparkSession, out: str, output_format: str, verify: bool) -> DataFrame:
    if verify:
        require_verified(spark, out, [".jsonl" if output_format == "jsonl" else ".tar"])
    manifest = full_manifest(recover(spark, out))
    if output_format == "jsonl":
        write_info_manifest(manifest, out)
    else:
        write_manifest(manifest, out)
    return manifest


def caption_run(
    spark: SparkSession,
    source: str,
    out: str,
    teacher: TeacherSpec,
    schema: T.StructType | str,
    num_samples: int = 5,
    tag_suffix: str = "",
    output_format: str = "wds",
    naming: str = "count",
    freq: int = 1000,
    batch_size: int = 1024,
    seed: int = 0,
    max_bytes: int = MAX_BYTES,
    verify: bool = False,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Caption every pending shard of ``source`` into ``out``; returns the manifest of all runs.

    ``profile`` asks for executors with the GPUs that the teacher needs; only the stages that call it get them.
    ``verify`` reads all output again at the end and compares it with the checksums of the writer.
    """
    with scratch_scope(spark):
        run_waves(
            spark,
            shard_paths(spark, source),
            out,
            lambda paths: read_shards(spark, paths, schema),
            lambda df: caption_records(df, teacher, num_samples, tag_suffix, seed, batch_size, profile),
            freq,
            output_format=output_format,
            naming=naming,
            max_bytes=max_bytes,
        )
        return _finish(spark, out, output_format, verify)


def embedding_run(
    spark: SparkSession,
    source: str,
    out: str,
    teachers: list[TeacherSpec],
    schema: T.StructType | str,
    aug_config: Mapping,
    decode: Column,
    num_samples: int = 5,
    tag_suffix: str = "",
    syn_text_key_regex: str = "syn_text",
    output_format: str = "wds",
    naming: str = "count",
    bfloat16: bool = False,
    freq: int = 1000,
    batch_size: int = 1024,
    seed: int = 0,
    max_bytes: int = MAX_BYTES,
    verify: bool = False,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Embed every pending shard of ``source`` into ``out``; returns the manifest of all runs.

    ``profile`` asks for executors with the GPUs that the teachers need; only the stages that call them get them.
    ``decode`` turns the payload column ``_image`` into a tensor, null when it cannot be decoded.
    """
    infer.check_ensemble(teachers, steps_from_config(aug_config))
    write_config(spark, json.dumps(aug_config, sort_keys=True), out)
    with scratch_scope(spark):
        run_waves(
            spark,
            shard_paths(spark, source),
            out,
            lambda paths: read_shards(spark, paths, schema),
            lambda df: embed_records(
                df, teachers, aug_config, num_samples, tag_suffix, syn_text_key_regex, decode, seed, batch_size, profile
            ),
            freq,
            output_format=output_format,
            naming=naming,
            max_bytes=max_bytes,
            bfloat16=bfloat16,
        )
        return _finish(spark, out, output_format, verify)
