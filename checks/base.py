"""Registry of the queries, and the records and images that they share.

Each fixture is a rule over whole tables, stated once as a DataFrame and once as SQL. Computed arrays
are unnested with the ``_outer`` functions: for the plain ones Spark first filters on the array's
size, and so computes it twice.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardweave.functions import tensor as px
from shardweave.functions.text import base64_text
from shardweave.session import balanced

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_WRITTEN: dict[tuple, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


def written_once(spark: SparkSession, sf: str, label: str, write: Callable[[str], None]) -> str:
    """Folder that ``write`` has filled, once per session and scale."""
    from shardweave.session import scratch_path

    key = (spark.sparkContext.applicationId, sf, label)
    if key not in _WRITTEN:
        folder = scratch_path(spark, label)
        write(folder)
        _WRITTEN[key] = folder
    return _WRITTEN[key]


def written_anew(spark: SparkSession, label: str, write: Callable[[str], None]) -> str:
    """Folder that ``write`` fills now, for queries whose work is the writing."""
    from shardweave.session import scratch_path

    folder = scratch_path(spark, label)
    write(folder)
    return folder


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as records: shard = source, position = doc_id, synthetic texts = all sentences."""
    return _records(table(spark, sf, "documents"))


def balanced_records(spark: SparkSession, sf: str) -> DataFrame:
    """The same, spread over the cores: the table is one file with one row group."""
    return _records(balanced(table(spark, sf, "documents"), ["doc_id"]))


def _records(d: DataFrame) -> DataFrame:
    sentences = F.filter(F.transform(F.split("text", "[.]"), lambda s: F.trim(s)), lambda s: s != "")
    return d.select(
        F.col("doc_id").cast("string").alias("uid"),
        F.concat(F.col("source"), F.lit(".jsonl")).alias("_shard"),
        F.col("doc_id").alias("_pos"),
        "text",
        "lang",
        "source",
        "n_chars",
        sentences.alias("syn_text"),
    )


RECORDS = """records AS (
  SELECT doc_id::VARCHAR AS uid, source || '.jsonl' AS _shard, doc_id AS _pos, text, lang, source, n_chars,
    list_filter(list_transform(string_split(text, '.'), lambda s: trim(s)), lambda s: s <> '') AS syn_text
  FROM documents)"""


def dirty_images(spark: SparkSession, sf: str) -> DataFrame:
    """Records with an image column: base64 of the text, but broken for German, empty for Spanish."""
    image = (
        F.when(F.col("lang") == "de", F.lit("@@@"))
        .when(F.col("lang") == "es", F.lit(""))
        .otherwise(base64_text(F.encode("text", "UTF-8")))
    )
    return records(spark, sf).withColumn("image", image)


def images(spark: SparkSession, sf: str, h: int = 8, w: int = 8, c: int = 1) -> DataFrame:
    """Embeddings as small images with whole values 0..255."""
    e = table(spark, sf, "embeddings")

    def level(x: Column) -> Column:
        unit = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x.cast("double") + 1) / 2))
        return F.floor(unit * 255)

    return e.select(
        F.col("vec_id").cast("string").alias("uid"),
        "vec_id",
        "label",
        px.tensor(F.transform("embedding", level), h, w, c).alias("image"),
    )


IMAGES = """images AS (
  SELECT vec_id::VARCHAR AS uid, vec_id, label,
    list_transform(embedding, lambda x: floor(greatest(0.0, least(1.0, (x::DOUBLE + 1) / 2)) * 255)) AS px
  FROM embeddings)"""


def checksum(image: Column, digits: int = 3) -> Column:
    """Position-weighted sum of the values of a tensor."""
    weighted = F.transform(image["data"], lambda x, i: x.cast("double") * (i + 1))
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x), digits)


def sql_checksum(values: str, digits: int = 3) -> str:
    return f"round(list_sum(list_transform({values}, lambda x, i: x::DOUBLE * i)), {digits})"


def list_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double"))


def sql_u(seed, uid: str, draw: str, slot: str) -> str:
    """The uniform draw in SQL; ``slot`` is a SQL expression."""
    key = f"concat_ws('|', '{seed}', {uid}, {draw}, {slot})"
    return f"(('0x' || substr(md5({key}), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def sql_int(seed, uid: str, draw: str, slot: str, low: str, high: str) -> str:
    return f"({low} + floor({sql_u(seed, uid, draw, slot)} * (({high}) - ({low}))))::BIGINT"
