"""JSON-lines shards (plain, gzip, zstd): reading, rejects and rendering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from shardweave.functions.packing import VECTORS, pack_embedding, unpack_embedding
from shardweave.functions.tensor import to_bfloat16
from shardweave.functions.text import canonical_path
from shardweave.operators.records import REST, as_struct, emb_name, record_keys, rest_of, to_json_object
from shardweave.sources.files import file_sizes, open_fs, packed

POSITION = "STRUCT<block: BIGINT, line: BIGINT>"


LINES = f"value BINARY, _shard STRING, _pos {POSITION}"
# Bytes of a plain file that one task reads, and of one read within it.
RANGE, BLOCK = 64 << 20, 4 << 20
PACKED = (".gz", ".zst", ".zstd")


def _blocks(path: str, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes): whole lines that begin in [start, stop), in blocks; packed files are unpacked."""
    fs, inner = open_fs(path)
    if path.endswith(PACKED):
        raw = fs.open_input_stream(inner, compression=None if path.endswith((".zst", ".zstd")) else "gzip")
        stream = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True) if path.endswith((".zst", ".zstd")) else raw
        at, stop = 0, None
    else:
        stream = fs.open_input_file(inner)
        at = max(start - 1, 0)
        stream.seek(at)
        if start:  # a line that begins before the range belongs to the range before
            while data := stream.read(BLOCK):
                cut = data.find(b"\n")
                at += len(data) if cut < 0 else cut + 1
                if cut >= 0:
                    stream.seek(at)
                    break
            else:
                return
    with stream:
        kept = b""
        while stop is None or at < stop:
            data = stream.read(BLOCK)
            if not data:
                if kept:
                    yield at, kept
                return
            kept += data
            last = kept.rfind(b"\n") + 1
            if stop is not None and at + last > stop:  # the line that reaches over the end is still this range's
                last = kept.find(b"\n", max(stop - at - 1, 0)) + 1
            if last:
                yield at, kept[:last]
                at, kept = at + last, kept[last:]


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for work in batch.to_pylist():
            for at, data in _blocks(work["path"], work["start"], work["stop"]):
                lines = data.split(b"\n")
                starts = at + np.cumsum([0, *[len(line) + 1 for line in lines[:-1]]])
                if not lines[-1]:
                    lines, starts = lines[:-1], starts[:-1]
                values = pa.array([line.removesuffix(b"\r") for line in lines], pa.binary())
                place = pa.StructArray.from_arrays([pa.array(np.zeros(len(starts), np.int64)), pa.array(starts)], ["block", "line"])
                yield pa.RecordBatch.from_arrays([values, pa.array([work["path"]] * len(lines)), place], names=["value", "_shard", "_pos"])


def read_lines(spark: SparkSession, paths: DataFrame | list[str]) -> DataFrame:
    """Lines with ``_shard`` (the file) and ``_pos`` (the offset at which the line begins in it).

    Files are read by ranges of bytes, whatever their names; a folder stands for the files in it. The codec
    follows from the suffix, and a packed file is one range. Lines and places do not depend on the ranges.
    """
    from shardweave.sources.paths import files_of

    work = files_of(spark, paths)
    whole = F.lit(False)
    for suffix in PACKED:
        whole = whole | F.col("path").endswith(suffix)
    step = F.lit(RANGE).cast("bigint")
    starts = F.when(whole, F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, step))
    ranges = file_sizes(work).where("bytes > 0").select("path", "bytes", F.explode(starts).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + step, F.col("bytes")).alias("stop"))
    lines = packed(ranges).mapInArrow(_lines, LINES)
    return lines.select(F.col("value").cast("string").alias("value"), canonical_path(F.col("_shard")).alias("_shard"), "_pos")


def parsed_object(line: Column) -> tuple[Column, Column]:
    """The line as VARIANT, and whether it is one JSON object."""
    parsed = F.try_parse_json(line)
    opens = F.ltrim(line, F.lit(" \t\r")).startswith("{")
    return parsed, parsed.isNotNull() & opens


def field_of(record: Column, field: T.StructField) -> Column:
    """One key of a VARIANT record; null when absent or of another type."""
    name = field.name.replace("\\", "\\\\").replace("'", "\\'")
    kind = field.dataType
    if isinstance(kind, T.BinaryType):
        text = F.try_variant_get(record, f"$['{name}']", "string")
        return F.try_to_binary(text, F.lit("base64"))
    return F.try_variant_get(record, f"$['{name}']", kind.simpleString())


def vectors_of(record: Column, field: T.StructField) -> Column:
    """Embedding key of a record, stored as plain lists or packed as text."""
    plain = field_of(record, field)
    text = field_of(record, T.StructField(field.name, T.StringType()))
    # Packed text starts with the base64 form of the gzip mark.
    packed = F.when(plain.isNull() & text.startswith("H4sI"), text)
    return F.coalesce(plain, unpack_embedding(packed))


def read_jsonl(
    spark: SparkSession, paths: DataFrame | list[str], schema: T.StructType | str | None = None, keys: str | None = None
) -> DataFrame:
    """One record per line that holds a JSON object; other lines are skipped.

    With a schema the keys become columns, otherwise the record stays a VARIANT column ``record``.
    Embedding columns (``ARRAY<ARRAY<FLOAT>>``, "emb" in the name) are unpacked. Keys that the schema does not
    name (of those that ``keys`` matches from their start), keys that are null, and values that do not fit their
    column, which is null then, stay as they are in ``_rest``.
    """
    lines = read_lines(spark, paths)
    parsed, is_object = parsed_object(F.col("value"))
    records = lines.filter(is_object).select(parsed.alias("record"), "_shard", "_pos")
    if schema is None:
        return records
    columns = {}
    for field in as_struct(schema).fields:
        get = vectors_of if "emb" in field.name and field.dataType == VECTORS else field_of
        columns[field.name] = get(F.col("record"), field)
    records = records.select(*[c.alias(n) for n, c in columns.items()], F.col("record").alias("_record"), "_shard", "_pos")
    rest = rest_of(F.col("_record"), {n: F.col(n) for n in columns}, keys)
    return records.withColumn(REST, rest).drop("_record")


@arrow_udf(T.BinaryType())
def zstd_frames(chunks: pa.Array) -> pa.Array:
    """Each chunk as a zstd frame of its own; a file of frames is read as one packed file."""
    compressor = zstandard.ZstdCompressor()
    return pa.array([None if c is None else compressor.compress(c) for c in chunks.to_pylist()], pa.binary())


def read_jsonl_rejects(spark: SparkSession, paths: DataFrame | list[str]) -> DataFrame:
    """Number of skipped lines per shard."""
    _, is_object = parsed_object(F.col("value"))
    rejected = F.count_if(~is_object)
    return read_lines(spark, paths).groupBy("_shard").agg(rejected.alias("rejected"))


def to_json_lines(df: DataFrame, bfloat16: bool = False) -> Column:
    """One JSON line per record: images as base64, embeddings packed under their stored names, and all keys
    that the reader put into ``_rest``; without that column nulls are written as null."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    values = {}
    for name in record_keys(df):
        value, kind = F.col(name), kinds[name]
        if "emb" in name and isinstance(kind, T.ArrayType):
            if not isinstance(kind.elementType, T.ArrayType):
                value = F.when(value.isNotNull(), F.array(value))
            value = value.cast("array<array<float>>")
            value = pack_embedding(F.transform(value, to_bfloat16) if bfloat16 else value)
        values[emb_name(name)] = value
    return F.concat(to_json_object(df, values), F.lit("\n"))
