"""Batch sink that writes named shard files from rendered chunks, with checksums and a manifest.

Rows are ``(_out, _shard, chunk)``; the chunks of one ``_out`` must arrive together and in order, which
``repartition("_out").sortWithinPartitions("_out", "_pos")`` provides. A task writes each shard under
a name of its own attempt and renames it when complete, so a lost or repeated task never leaves half
a shard under a final name; the content of a shard is the same on every attempt. The manifest has two phases: a
task writes the lines of its shards into a part of its own attempt, and the commit lists the parts of the
attempts that count. The driver sees the name of one part per task, never a line per shard.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from shardweave.operators.records import normalise_emb_names, to_members
from shardweave.session import shuffles_dropped, small_batches
from shardweave.sources.files import open_fs, replace_file
from shardweave.sources.jsonl import to_json_lines
from shardweave.sources.tar import TAR_TRAILER, to_tar_chunk

FORMAT = "shardweave_files"
MANIFEST_FOLDER, PARTS_FOLDER = "_manifest", "_manifest_parts"
MANIFEST = "shard STRING, input STRING, num_uids LONG, bytes LONG, sha256 STRING, run STRING"


@dataclass
class Written(WriterCommitMessage):
    """The manifest part of one task, None if it has written no shard."""

    part: str | None = None


class _OpenShard:
    """One shard file being written."""

    def __init__(self, fs: pafs.FileSystem, folder: str, name: str, source: str | None):
        self.fs, self.name, self.source = fs, name, source
        self.final = f"{folder}/{name}"
        self.partial = f"{folder}/_partial/{uuid.uuid4().hex}"
        if "/" in name:
            fs.create_dir(self.final.rpartition("/")[0], recursive=True)
        self.stream = fs.open_output_stream(self.partial)
        self.digest, self.records, self.size = hashlib.sha256(), 0, 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.digest.update(data)
        self.size += len(data)

    def finish(self, trailer: bytes, run: str) -> dict:
        if trailer:
            self.write(trailer)
        self.stream.close()
        replace_file(self.fs, self.partial, self.final)
        return {
            "shard": self.name,
            "input": self.source,
            "num_uids": self.records,
            "bytes": self.size,
            "sha256": self.digest.hexdigest(),
            "run": run,
        }

    def abandon(self) -> None:
        self.stream.close()
        self.fs.delete_file(self.partial)


class ShardFileWriter(DataSourceArrowWriter):
    """Writer of one run; see the module text for its guarantees."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.trailer = bytes.fromhex(options.get("trailer", ""))
        self.run = options.get("run", "run")
        fs, inner = open_fs(self.path)
        fs.create_dir(f"{inner}/_partial", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = open_fs(self.path)
        lines, shard = [], None
        try:
            for batch in iterator:
                columns = batch.column("_out").to_pylist(), batch.column("_shard").to_pylist()
                for name, source, chunk in zip(*columns, batch.column("chunk")):
                    if shard is None or shard.name != name:
                        if shard is not None:
                            lines.append(shard.finish(self.trailer, self.run))
                        shard = _OpenShard(fs, folder, name, source)
                    shard.write(chunk.as_buffer())
                    shard.records += 1
            if shard is not None:
                lines.append(shard.finish(self.trailer, self.run))
                shard = None
        finally:
            if shard is not None:
                shard.abandon()
        if not lines:
            return Written()
        part = f"{uuid.uuid4().hex}.jsonl"
        fs.create_dir(f"{folder}/{PARTS_FOLDER}/{self.run}", recursive=True)
        with fs.open_output_stream(f"{folder}/{PARTS_FOLDER}/{self.run}/{part}") as stream:
            stream.write("".join(json.dumps(line) + "\n" for line in lines).encode())
        return Written(part)

    def commit(self, messages: list) -> None:
        """List the parts that count; those of attempts that do not, or of an earlier write of the run, go."""
        fs, folder = open_fs(self.path)
        own = f"{folder}/{PARTS_FOLDER}/{self.run}"
        for path in (f"{folder}/{MANIFEST_FOLDER}", own):
            fs.create_dir(path, recursive=True)
        parts = {message.part for message in messages if message is not None and message.part is not None}
        listed = f"{folder}/{MANIFEST_FOLDER}/{self.run}.jsonl"
        with fs.open_output_stream(f"{listed}.partial") as out:
            out.write("".join(json.dumps({"part": part}) + "\n" for part in sorted(parts)).encode())
        replace_file(fs, f"{listed}.partial", listed)
        for info in fs.get_file_info(pafs.FileSelector(own)):
            if info.base_name not in parts:
                fs.delete_file(info.path)

    def abort(self, messages: list) -> None:
        """Nothing to undo: finished shards are whole, and a rerun replaces them by the same bytes."""


class ShardFileSink(DataSource):
    """``df.write.format("shardweave_files")``; options ``path``, ``run`` and ``trailer`` (hex)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "_out STRING, _shard STRING, chunk BINARY"

    def writer(self, schema, overwrite: bool) -> ShardFileWriter:
        return ShardFileWriter(dict(self.options))


def dealt(df: DataFrame, shards: int | None = None) -> DataFrame:
    """``df`` with the records of each ``_out`` in one partition, of ``shards`` or the session's number of them.

    Files with a running number ``_place`` are dealt in turn, so that each has a partition of its own if there are
    as many; files without one go by a hash of their names.
    """
    if "_place" not in df.columns:
        return df.repartition("_out") if shards is None else df.repartition(max(1, shards), "_out")
    session = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = session if shards is None else max(1, shards)
    return df.repartitionById(tasks, F.pmod("_place", F.lit(tasks)).cast("int"))


def write_chunks(
    df: DataFrame, chunk: Column, out: str, run: str, trailer: bytes = b"", shards: int | None = None
) -> None:
    """Write one file per ``_out``, its chunks in the order of ``_pos``; ``shards`` is the number of files to expect,
    each of which then has a writing task of its own."""
    spark = df.sparkSession
    spark.dataSource.register(ShardFileSink)
    ordered = dealt(df, shards).sortWithinPartitions("_out", "_pos")
    rendered = ordered.select("_out", "_shard", chunk.cast("binary").alias("chunk"))
    with small_batches(spark), shuffles_dropped(spark):
        rendered.write.format(FORMAT).mode("append").option("run", run).option("trailer", trailer.hex()).save(out)


def _placing(df: DataFrame) -> list[str]:
    """The columns that say where a record goes."""
    return ["_out", "_shard", "_pos", *(["_place"] if "_place" in df.columns else [])]


def write_jsonl(
    df: DataFrame, out: str, run: str = "run", bfloat16: bool = False, shards: int | None = None
) -> DataFrame:
    """Write records as JSON-lines shards; returns the manifest of the run."""
    line = F.encode(to_json_lines(df, bfloat16), "UTF-8")
    write_chunks(df.select(*_placing(df), line.alias("_line")), F.col("_line"), out, run, shards=shards)
    return read_manifest(df.sparkSession, out).filter(F.col("run") == run)


def write_tar_samples(
    df: DataFrame, out: str, run: str = "run", bfloat16: bool = False, shards: int | None = None
) -> DataFrame:
    """Write records as tar shards, one set of members per record; returns the manifest of the run."""
    members = to_members(normalise_emb_names(df), bfloat16).select(*_placing(df), "_key", "_members")
    # Rendered in the order of the shard, so that a repeated key is seen beside the first.
    write_chunks(members, to_tar_chunk(F.col("_key"), F.col("_members")), out, run, TAR_TRAILER, shards)
    return read_manifest(df.sparkSession, out).filter(F.col("run") == run)


def write_shards(
    df: DataFrame,
    out: str,
    output_format: str,
    run: str = "run",
    bfloat16: bool = False,
    shards: int | None = None,
) -> DataFrame:
    """Write records in one of the output formats; returns the manifest of the run."""
    if output_format in ("wds", "webdataset", "tar"):
        return write_tar_samples(df, out, run, bfloat16, shards)
    if output_format == "jsonl":
        return write_jsonl(df, out, run, bfloat16, shards)
    raise ValueError(f"unsupported output format: {output_format}")


def write_lines(df: DataFrame, line: Column, order: list[str], out: str, name: str) -> None:
    """Write a table as the lines of one named file, in order; used for manifests."""
    place = [F.lit(name).alias("_out"), F.lit(None).cast("string").alias("_shard")]
    numbered = df.select(*place, F.struct(*order).alias("_pos"), line.alias("_line"))
    text = F.encode(F.concat(F.col("_line"), F.lit("\n")), "UTF-8")
    write_chunks(numbered, text, out, f"{name}-lines", shards=1)


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    """Manifest of all runs into ``out``."""
    root = out.rstrip("/")
    listed = spark.read.schema("part STRING").json(f"{root}/{MANIFEST_FOLDER}")
    lines = spark.read.schema(MANIFEST).json(f"{root}/{PARTS_FOLDER}/*")
    return lines.withColumn("part", F.col("_metadata.file_name")).join(listed, "part", "left_semi").drop("part")
