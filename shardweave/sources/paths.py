"""Finding shards: manifests, name patterns, file listings, formats and folder groups."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardweave.functions.text import canonical_path, raw_file_type
from shardweave.operators.positions import global_index
from shardweave.session import checkpointed
from shardweave.sources.files import open_fs

MANIFEST_SUFFIX = "info.json"


# Strings and marks of JSON; a quote alone begins a string that the text at hand does not end.
_JSON_TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*"|[{}\[\]:]|"', re.DOTALL)
MANIFEST_BLOCK, KEYS_PER_BATCH = 4 << 20, 100_000


def _keys_of(blocks: Iterator[bytes], name: str) -> Iterator[str]:
    """Keys of the object under ``name`` in one JSON object that comes in blocks, of which one is held at a time."""
    depth, top, string, held, opened = 0, "", b'""', b"", False
    for block in blocks:
        held += block
        done = len(held)
        for token in _JSON_TOKEN.finditer(held):
            mark = token.group()
            if mark == b'"':
                done = token.start()
                break
            if mark in (b"{", b"["):
                depth, opened = depth + 1, True
            elif mark in (b"}", b"]"):
                depth -= 1
            elif mark != b":":
                string = mark
            elif depth == 1:
                top = json.loads(string)
            elif depth == 2 and top == name:
                yield json.loads(string)
        held = held[done:]
    if depth or held or not opened:
        raise ValueError("the manifest is not one whole JSON object")


def _manifest_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, inner = open_fs(path)
            with fs.open_input_stream(inner) as file:
                keys = _keys_of(iter(lambda: file.read(MANIFEST_BLOCK), b""), "lengths")
                while some := list(islice(keys, KEYS_PER_BATCH)):
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], ["path"])


def shards_from_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Shard paths named by a JSON manifest: the keys of its ``lengths``, in its order; a repeated one is repeated.

    A manifest is one JSON object, so one task reads it, but as a stream: memory does not grow with it. A manifest
    that is cut off is an error.
    """
    if not path.endswith(MANIFEST_SUFFIX):
        raise ValueError(f"a manifest must be named {MANIFEST_SUFFIX}: {path}")
    return spark.createDataFrame([(path,)], "path STRING").coalesce(1).mapInArrow(_manifest_keys, "path STRING")


# A pattern is cut into braces and literal text.
_TOKENS = r"(\{[^{}]*\}|[^{}]+)"
_NUMBERS = r"^\{(-?\d+)\.\.(-?\d+)(?:\.\.(-?\d+))?\}$"
_LETTERS = r"^\{([a-zA-Z])\.\.([a-zA-Z])\}$"


def _token(text: Column) -> Column:
    """What a token stands for: a range (numbers or letters) or a list of alternatives."""
    low_text, high_text = (F.regexp_extract(text, _NUMBERS, i) for i in (1, 2))
    step_text = F.regexp_extract(text, _NUMBERS, 3)
    numbers = text.rlike(_NUMBERS)
    letters = text.rlike(_LETTERS)
    low = (
        F.when(numbers, low_text.try_cast("bigint"))
        .when(letters, F.ascii(F.regexp_extract(text, _LETTERS, 1)).cast("bigint"))
    )
    high = (
        F.when(numbers, high_text.try_cast("bigint"))
        .when(letters, F.ascii(F.regexp_extract(text, _LETTERS, 2)).cast("bigint"))
    )
    step = F.when(
        numbers & (step_text != "") & (F.abs(step_text.try_cast("bigint")) > 0), F.abs(step_text.try_cast("bigint"))
    ).otherwise(F.lit(1).cast("bigint"))
    padded = low_text.rlike(r"^-?0\d") | high_text.rlike(r"^-?0\d")
    width = F.when(numbers & padded, F.greatest(F.length(low_text), F.length(high_text))).otherwise(F.lit(0))
    listed = text.startswith("{") & text.contains(",")
    choices = F.when(listed, F.split(F.substr(text, F.lit(2), F.length(text) - 2), ",")).otherwise(F.array(text))
    ranged = numbers | letters
    size = F.when(ranged, F.floor(F.abs(high - low) / step) + 1).otherwise(F.size(choices)).cast("bigint")
    return F.struct(
        ranged.alias("ranged"),
        letters.alias("letters"),
        low.alias("low"),
        F.when(high < low, -step).otherwise(step).alias("step"),
        width.alias("width"),
        choices.alias("choices"),
        size.alias("size"),
    )


def _token_value(token: Column, i: Column) -> Column:
    """The ``i``-th text a token stands for."""
    number = token["low"] + i * token["step"]
    digits = F.abs(number).cast("string")
    sign = F.when(number < 0, F.lit("-")).otherwise(F.lit(""))
    # The widest number of a range is one of its ends, so lpad never cuts.
    numeric = F.when(
        token["width"] > 0, F.concat(sign, F.lpad(digits, token["width"] - F.length(sign), F.lit("0")))
    ).otherwise(F.concat(sign, digits))
    return (
        F.when(~token["ranged"], F.get(token["choices"], i.cast("int")))
        .when(token["letters"], F.char(number))
        .otherwise(numeric)
    )


def expand_patterns(df: DataFrame, pattern: str = "pattern", out: str = "path") -> DataFrame:
    """One row per path that a pattern stands for.

    ``::`` separates patterns; ``{00000000..00001023}``, ``{a..f}`` and ``{x,y}`` are expanded, with
    several braces in every combination. A pattern's paths are numbered and each path is computed
    from its number, so no intermediate list of paths is built.
    """
    single = df.withColumn("_pattern", F.explode(F.split(F.col(pattern), "::")))
    tokens = F.transform(F.regexp_extract_all(F.col("_pattern"), F.lit(_TOKENS), F.lit(1)), _token)
    strided = single.withColumn("_tokens", tokens).withColumn(
        "_total", F.aggregate("_tokens", F.lit(1).cast("bigint"), lambda acc, t: acc * t["size"])
    )
    numbered = strided.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_total") - 1)))
    start = F.struct(F.col("_i").alias("rest"), F.lit("").alias("path"))
    spelled = F.aggregate(
        F.reverse("_tokens"),
        start,
        lambda acc, t: F.struct(
            F.floor(acc["rest"] / t["size"]).cast("bigint").alias("rest"),
            F.concat(_token_value(t, F.pmod(acc["rest"], t["size"])), acc["path"]).alias("path"),
        ),
    )
    return numbered.withColumn(out, spelled["path"]).drop("_pattern", "_tokens", "_total", "_i")


def shards_from_pattern(spark: SparkSession, pattern: str) -> DataFrame:
    """Shard paths of one pattern."""
    return expand_patterns(spark.createDataFrame([(pattern,)], "pattern STRING")).select("path")


def shard_paths(spark: SparkSession, source: str) -> DataFrame:
    """Shard paths of a manifest or a pattern."""
    if source.endswith(MANIFEST_SUFFIX):
        return shards_from_manifest(spark, source)
    return shards_from_pattern(spark, source)


def canonical(path: str) -> str:
    """The spelling that :func:`canonical_path` gives, for a path at hand."""
    return re.sub("^file:/+", "/", path)


_LISTED = "path STRING, bytes LONG, folder BOOLEAN"
# Folders of the engine itself; every other name is data, also one that starts with a dot or underscore.
OWN_FOLDERS = frozenset({"_partial", "_manifest", "_manifest_parts", "_ledger", "_stream"})


# Folders that one task lists, and entries in one batch.
FOLDERS_PER_TASK, PAGE = 32, 10_000


def _list_folders(folders: DataFrame) -> DataFrame:
    """Entries directly in each folder of ``path``, without the engine's own folders."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                fs, inner = open_fs(folder)
                prefix = folder[: len(folder) - len(inner)] if folder.endswith(inner) else ""
                entries = [i for i in fs.get_file_info(pafs.FileSelector(inner)) if i.base_name not in OWN_FOLDERS]
                for start in range(0, len(entries), PAGE):
                    page = entries[start : start + PAGE]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([prefix + i.path for i in page], pa.string()),
                            pa.array([i.size or 0 for i in page], pa.int64()),
                            pa.array([i.type == pafs.FileType.Directory for i in page], pa.bool_()),
                        ],
                        ["path", "bytes", "folder"],
                    )

    return folders.mapInArrow(look, _LISTED)


def _walk(root: DataFrame) -> DataFrame:
    """Files in the folders of ``path`` and below: level by level, the folders of a level in parallel.

    Each level is written once; the driver only counts its folders.
    """
    folders, files = root.coalesce(1), []
    while True:
        found = checkpointed(_list_folders(folders))
        files.append(found.where("NOT folder").drop("folder"))
        below = found.where("folder").select("path")
        count = below.count()
        if not count:
            return reduce(DataFrame.unionByName, files)
        folders = below.repartition(-(-count // FOLDERS_PER_TASK) if count > FOLDERS_PER_TASK else count)


def list_files(spark: SparkSession, root: str, suffixes: list[str], depth: int = 0) -> DataFrame:
    """Files below ``root`` that end in one of ``suffixes``, each once, with their group and size.

    The group is the first ``depth`` parts of the path below the root, empty for depth 0. Folders are listed
    level by level, those of a level in parallel. Empty files are listed too, which Spark's own
    file sources would skip.
    """
    base = root.rstrip("/")
    listing = _walk(spark.createDataFrame([(base,)], "path STRING"))
    wanted = F.lit(False)
    for suffix in suffixes:
        wanted = wanted | F.col("path").endswith(suffix)
    inside = F.substr(F.col("path"), F.lit(len(canonical(base)) + 2), F.length("path"))
    parts = F.split(inside, "/")
    group = F.array_join(F.slice(parts, 1, depth), "/") if depth > 0 else F.lit("")
    found = listing.withColumn("path", canonical_path(F.col("path"))).filter(wanted)
    return found.select(group.alias("group"), "path", "bytes")


def files_of(spark: SparkSession, paths: DataFrame | list[str]) -> DataFrame:
    """``path`` (and ``bytes``) of the files named, or lying directly in the folders named.

    In a folder, checksums and the success marks of Spark's writers are no data.
    """
    if isinstance(paths, DataFrame):
        return paths
    named = spark.createDataFrame([(p,) for p in paths], "path STRING")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                fs, inner = open_fs(path)
                info = fs.get_file_info(inner)
                if info.type == pafs.FileType.Directory:
                    prefix = path.rstrip("/")
                    for entry in fs.get_file_info(pafs.FileSelector(inner)):
                        mark = entry.base_name.startswith("_SUCCESS") or entry.base_name.endswith(".crc")
                        if entry.type == pafs.FileType.File and not mark:
                            rows.append((f"{prefix}/{entry.base_name}", entry.size))
                elif info.type == pafs.FileType.File:
                    rows.append((path, info.size))
                else:
                    raise FileNotFoundError(path)
            columns = zip(*rows) if rows else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()))], names=["path", "bytes"])

    return named.mapInArrow(look, "path STRING, bytes LONG")


def with_format(paths: DataFrame, path: str = "path") -> DataFrame:
    """Add ``format``, judged by the path."""
    return paths.withColumn("format", raw_file_type(F.col(path)))


def group_into_folders(paths: DataFrame, size: int, path: str = "path") -> DataFrame:
    """Put runs of ``size`` consecutive paths into numbered folders; -1 makes one unnamed group."""
    if size == -1:
        return paths.select(F.lit("").alias("folder"), path)
    total = paths.count()
    digits = int(max(0.0, math.log10(total / size)) + 1) if total else 1
    indexed = global_index(paths.select(path), [path], "_index")
    folder = F.floor(F.col("_index") / size)
    return indexed.select(F.format_string(f"%0{digits}d", folder).alias("folder"), path)


__all__ = [
    "expand_patterns",
    "group_into_folders",
    "list_files",
    "shard_paths",
    "shards_from_manifest",
    "shards_from_pattern",
    "with_format",
]
