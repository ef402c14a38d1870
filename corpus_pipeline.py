"""The training-data pipeline over ``documents``: what is toxic, repeated or leaked goes, the rest is encoded.

Each stage takes the documents that the one before it kept, whole, and returns those that it keeps with the
columns of ``documents``; the last returns digests of their tokens. Nulls, empty texts and repeated rows pass
through as each stage's docstring says; an empty table stays empty; columns beyond those of ``documents`` are
left out.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardweave import scratch_path, ship_package
from shardweave.llm import decontamination, queries, similarity_join, store, substring_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Rows hold whole texts, so a batch for Python ends at so many bytes, however few rows these are.
BATCH_BYTES = 8 << 20
_LEFT: list[str] = []
_SENT: list[Broadcast] = []


def _stage(fn: Stage) -> Stage:
    """Ship the package, bound the batches, and delete what the stage before, whose result is written, has left:
    intermediate tables and broadcasts."""

    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        before, sent = store.folders(spark), store.broadcasts(spark)
        store.release(spark, [path for path in before if path in _LEFT])
        store.destroy([one for one in sent if any(one is other for other in _SENT)])
        result = fn(spark, docs, sf_dir)
        _LEFT[:] = [path for path in store.folders(spark) if path not in before]
        _SENT[:] = [one for one in store.broadcasts(spark) if not any(one is other for other in sent)]
        return result

    return run


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on the labelled ones among them, does not call toxic.

    Null and empty texts are not toxic unless most labelled texts are; each repeated row is judged alike. Where none
    of the documents is labelled all stay.
    """
    docs = docs.select(*COLUMNS)
    return queries.toxic_marks(docs, docs, queries.table(spark, sf_dir, "labels")).where("toxic = 0").select(*COLUMNS)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the least id.

    Links are at a Jaccard similarity of 0.8 on five-word shingles. Documents without words or without id stay; of
    rows with the same id and text one stays.
    """
    docs = docs.select(*COLUMNS)
    classes = store.stored(similarity_join.joined(docs, shingle=5, num=80, den=100), "classes")
    goes = classes.where("component_id <> doc_id").select("doc_id", "text_hash").distinct()
    kept = docs.withColumn("text_hash", F.xxhash64("text")).join(goes, ["doc_id", "text_hash"], "left_anti").select(*COLUMNS)
    if classes.where("doc_id is not null").groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        return kept
    return kept.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionAll(kept.where("doc_id is null"))


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the words of 20-word passages that start earlier elsewhere.

    A text that loses words has the rest joined by single spaces; others stay as they are, null too. Documents
    that lose all their words go.
    """
    found = substring_dedup.deduplicated(docs.select(*COLUMNS))
    changed = F.col("n_removed") > 0
    return found.where("n_removed = 0 or n_removed < n_words").select(
        "doc_id",
        F.when(changed, F.col("kept_text")).otherwise(F.col("text")).alias("text"),
        "lang",
        "source",
        F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


@_stage
def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of the benchmark is found. Null and empty texts stay."""
    docs = docs.select(*COLUMNS)
    # Rows are told apart by id and text, so that a missing or repeated id does no harm.
    keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("key"), "text")
    found = decontamination.leaks(keyed, queries.table(spark, sf_dir, "benchmark"), id="key")
    found = found.select(F.col("key.doc_id").alias("leaked"), "key.text_hash").distinct()
    marked = docs.withColumn("text_hash", F.xxhash64("text"))
    same = (marked["text_hash"] == found["text_hash"]) & marked["doc_id"].eqNullSafe(found["leaked"])
    return marked.join(found, same, "left_anti").select(*COLUMNS)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document that is left: number of tokens, digests of the ids and of the bytes
    decoded from them. Null counts as empty."""
    return queries.bpe_digests(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("byte_bpe", encode),
]
# SQL cannot express the fitted models, the similarity search and the tokenizer; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each stage's result is written before the next reads it."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
