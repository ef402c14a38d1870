"""Output shards: names, counts, sizes, manifests and checks of what was written."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardweave.functions.text import basename
from shardweave.operators.positions import global_index
from shardweave.session import checkpointed, join_small
from shardweave.sources.files import file_sizes, open_fs, spread
from shardweave.sources.paths import canonical, list_files
from shardweave.sources.sink import read_manifest, write_lines

DIGEST = "path STRING, bytes LONG, sha256 STRING"
# Larger input shards are written as several output shards.
MAX_RECORDS = 1_000_000
MAX_BYTES = 1 << 30
# Buckets of positions for every output piece.
BUCKETS = 16


def shard_counts(df: DataFrame, shard: str = "_out") -> DataFrame:
    """Records per shard."""
    return df.groupBy(F.col(shard).alias("shard")).agg(F.count(F.lit(1)).alias("num_uids"))


def dataset_total(manifest: DataFrame) -> DataFrame:
    """Records of the dataset."""
    return manifest.agg(F.coalesce(F.sum("num_uids"), F.lit(0)).alias("total_uids"))


def sorted_manifest(manifest: DataFrame) -> DataFrame:
    """Manifest in the order of the shard names."""
    return manifest.select("shard", "num_uids").orderBy("shard")


def shard_sizes(df: DataFrame, payload: list[str], shard: str = "_shard") -> DataFrame:
    """Records and bytes (of the payload columns) per shard."""
    size = F.lit(0).cast("bigint")
    for name in payload:
        size = size + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    return df.groupBy(F.col(shard).alias("shard")).agg(
        F.count(F.lit(1)).alias("num_uids"), F.sum(size).alias("bytes"), (F.sum(size) / 1048576.0).alias("mib")
    )


def offset_of(df: DataFrame) -> Column:
    """Where a record stands in its input shard, as one number; 0 if that is not known."""
    nested = isinstance(df.schema["_pos"].dataType, T.StructType)
    return F.coalesce(F.col("_pos.line" if nested else "_pos").cast("bigint"), F.lit(0).cast("bigint"))


def _numbered(pieces: DataFrame, start: int) -> DataFrame:
    """Shard table from ``_shard`` and ``_pieces``: the running number of each shard's first piece."""
    each = pieces.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1)))
    indexed = global_index(each, ["_shard", "_piece"], "_index", start)
    return indexed.filter("_piece = 0").select("_shard", F.col("_index").alias("_first"), "_pieces")


def piece_starts(df: DataFrame, max_records: int) -> DataFrame:
    """(_shard, _starts): the positions at which the pieces of each shard begin, ascending.

    The span of a shard's positions is cut into buckets of equal width, about ``BUCKETS`` for every ``max_records``
    records; a piece ends with the first bucket that brings the running count to a multiple of ``max_records``.
    Only counts are shuffled, a row per bucket.
    """
    at = df.select("_shard", offset_of(df).alias("_at"))
    spans = at.groupBy("_shard").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_low"), F.max("_at").alias("_high"))
    width = F.greatest(F.expr(f"(_high - _low + 1) * {max_records} div (_n * {BUCKETS})"), F.lit(1))
    spans = checkpointed(spans.select("_shard", "_low", width.alias("_step")))
    buckets = join_small(at, spans, "_shard").withColumn("_bucket", F.expr("(_at - _low) div _step"))
    counts = buckets.groupBy("_shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"), F.min(F.expr("_low + _bucket * _step")).alias("_from"))
    before = Window.partitionBy("_shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    turn = F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / max_records)
    starts = counts.withColumn("_turn", turn).groupBy("_shard", "_turn").agg(F.min("_from").alias("_from"))
    return starts.groupBy("_shard").agg(F.sort_array(F.collect_list("_from")).alias("_starts"))


def shard_table(df: DataFrame, start: int = 0, max_records: int = MAX_RECORDS) -> DataFrame:
    """Input shards with the number of their first output shard, their number of pieces and where these begin.

    Numbers follow the order of the input paths, so a rerun gives the same names.
    """
    starts = checkpointed(piece_starts(df, max_records))
    numbered = _numbered(starts.select("_shard", F.size("_starts").cast("bigint").alias("_pieces")), start)
    return numbered.join(starts, "_shard")


def shard_table_of_files(
    paths: DataFrame, start: int = 0, max_bytes: int = MAX_BYTES, known: DataFrame | None = None
) -> DataFrame:
    """The same from the sizes of the input files, without reading them: a piece has ``_width`` bytes of its file.

    ``known`` has the ``path`` of every input of the output folder, done or not; inputs whose names are
    repeated among them get a ``_tag``.
    """
    pieces = F.greatest(F.ceil(F.col("bytes") / max_bytes).cast("bigint"), F.lit(1).cast("bigint"))
    table = _numbered(file_sizes(paths).select(F.col("path").alias("_shard"), pieces.alias("_pieces")), start)
    table = table.withColumn("_width", F.lit(max_bytes).cast("bigint"))
    return tagged(table, known) if known is not None else table


def piece_of(table: DataFrame, at: Column) -> Column:
    """Which piece of its shard the record at a position goes to.

    Positions of packed files are those of the unpacked bytes, which go on beyond the last piece; their
    pieces then take turns.
    """
    if "_starts" in table.columns:
        return (F.size(F.filter("_starts", lambda first: first <= at)) - 1).cast("bigint")
    return F.pmod(F.floor(at / F.col("_width")), F.col("_pieces")).cast("bigint")


def plain_base(shard: Column) -> Column:
    """Base name without a compression suffix: output is not compressed."""
    return F.regexp_replace(basename(shard), r"\.(gz|zst|zstd)$", "")


def tagged(shards: DataFrame, known: DataFrame) -> DataFrame:
    """Shard table with ``_tag``: a digest of the input's path where another input has the same base name.

    It depends on the set of all inputs alone, so a rerun finds the same names.
    """
    names = known.select("path").distinct().groupBy(plain_base(F.col("path")).alias("_base")).count()
    repeated = names.where("count > 1").select("_base", F.lit(True).alias("_repeated"))
    marked = shards.withColumn("_base", plain_base(F.col("_shard"))).join(repeated, "_base", "left")
    tag = F.when(F.col("_repeated"), F.substring(F.md5("_shard"), 1, 8))
    return marked.withColumn("_tag", tag).drop("_base", "_repeated")


def out_name(naming: str, extension: str, piece: Column, tag: Column | None = None) -> Column:
    """Name of an output shard, from a row of the shard table and a piece number; ``tag`` tells inputs of one
    name apart."""
    if naming == "count":
        return F.concat(F.format_string("%08d", F.col("_first") + piece), F.lit(f".{extension}"))
    if naming == "orig":
        # A leading dot belongs to the stem, not to the suffix.
        base = plain_base(F.col("_shard"))
        stem = F.regexp_extract(base, r"^(\.?[^.]*)", 1)
        rest = F.substr(base, F.length(stem) + 1)
        if tag is not None:
            stem = F.concat(stem, F.coalesce(F.concat(F.lit("-"), tag), F.lit("")))
        part = F.when(piece == 0, F.lit("")).otherwise(F.format_string("-%05d", piece))
        return F.concat(stem, part, rest)
    raise ValueError(f"unsupported shard naming: {naming}")


def shard_outputs(shards: DataFrame, naming: str, extension: str) -> DataFrame:
    """Input and output name of every output shard of a shard table."""
    pieces = shards.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1)))
    tag = F.col("_tag") if "_tag" in shards.columns else None
    return pieces.select("_shard", out_name(naming, extension, F.col("_piece"), tag).alias("_out"))


def written_outputs(outputs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Planned output shards with their number of records, zero for those not written."""
    written = manifest.select(F.col("shard").alias("_out"), "num_uids")
    return outputs.join(written, "_out", "left").select(
        "_shard", "_out", F.coalesce("num_uids", F.lit(0).cast("bigint")).alias("num_uids")
    )


def remove_stale(outputs: DataFrame, out: str) -> None:
    """Delete, now, the files of planned output shards that received no record.

    Such a file is left by an earlier attempt at the same wave. Inputs are never deleted, even if ``out``
    is the folder in which they lie.
    """

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_fs(out)
        for batch in batches:
            for name in batch.column("_out").to_pylist():
                if fs.get_file_info(f"{folder}/{name}").type == pafs.FileType.File:
                    fs.delete_file(f"{folder}/{name}")
            yield batch

    target = F.concat(F.lit(canonical(out.rstrip("/")) + "/"), F.col("_out"))
    stale = outputs.where("num_uids = 0").where(target != F.col("_shard")).select("_out")
    stale.mapInArrow(delete, "_out STRING").write.format("noop").mode("overwrite").save()


def duplicate_ids(df: DataFrame, id: str = "uid", shard: str = "_shard") -> DataFrame:
    """(shard, uid, times) of the ids that stand more than once in a shard; a missing id counts as one too."""
    counted = df.groupBy(F.col(shard).alias("shard"), F.col(id).alias("uid")).agg(F.count(F.lit(1)).alias("times"))
    return counted.where("times > 1")


def name_shards(
    df: DataFrame,
    naming: str = "count",
    extension: str = "jsonl",
    start: int = 0,
    max_records: int = MAX_RECORDS,
    shards: DataFrame | None = None,
    shard_rows: int | None = None,
) -> DataFrame:
    """Add ``_out``, the name of the output shard of each record, and ``_place``, its running number.

    ``count`` numbers the shards with eight digits from ``start``; ``orig`` keeps the input's base
    name, with a number from the second piece on. Every input shard is laid out by the same rule: its records go by
    their position ``_pos`` to pieces of about ``max_records``, so that no writer task receives much more than
    that, however uneven the input is, and a shard that grows keeps its first pieces. The join is with the
    table of shards (one row per input file; ``shards`` of ``shard_rows`` rows, if at hand), which is
    broadcast after its rows have been counted.
    """
    df = df.withColumn("_shard", F.coalesce("_shard", F.lit("")))
    table = shards if shards is not None else checkpointed(shard_table(df, start, max_records))
    placed = join_small(df.drop("_place"), table, "_shard", shard_rows)
    piece = piece_of(table, offset_of(placed))
    tag = F.col("_tag") if "_tag" in placed.columns else None
    named = placed.withColumn("_out", out_name(naming, extension, piece, tag)).withColumn("_place", F.col("_first") + piece)
    return named.drop("_first", "_pieces", "_tag", "_starts", "_width")


def shard_manifest(df: DataFrame, out: str = "_out") -> DataFrame:
    """``{shard, num_uids}`` per output shard (name without extension), sorted."""
    counts = shard_counts(df, out)
    return counts.withColumn("shard", F.substring_index("shard", ".", 1)).orderBy("shard")


def write_manifest(manifest: DataFrame, out: str, filename: str = "manifest.jsonl") -> None:
    """Write manifest rows as one JSON-lines file, sorted by shard."""
    line = F.to_json(F.struct("shard", "num_uids"))
    write_lines(manifest, line, ["shard"], out, filename)


def info_manifest(manifest: DataFrame, name: str) -> DataFrame:
    """The dataset manifest as the lines of one JSON object: ``part``, ``key`` (their order), ``line``.

    One line per shard, so the object is never built in memory. Counts are text, as readers expect.
    """
    root = name.strip("/")
    totals = manifest.agg(
        F.coalesce(F.sum("num_uids"), F.lit(0)).cast("string").alias("totalLength"), F.min("shard").alias("_first")
    )
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    about = F.to_json(
        F.struct(
            F.lit(root).alias("name"),
            F.col("totalLength"),
            F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        )
    )
    open_object = F.concat(F.substr(about, F.lit(1), F.length(about) - 1), F.lit(',"lengths":{'))
    head = totals.select(F.lit(0).alias("part"), F.lit("").alias("key"), open_object.alias("line"))
    tail = totals.select(F.lit(2).alias("part"), F.lit("").alias("key"), F.lit("}}").alias("line"))
    path = F.concat(F.lit(f"{root}/"), F.col("shard"), F.lit(".jsonl"))
    entry = F.to_json(F.create_map(path, F.col("num_uids").cast("string")))
    inner = F.substr(entry, F.lit(2), F.length(entry) - 2)
    # The join is with a single row; only the first entry goes without a comma.
    body = manifest.join(F.broadcast(totals), F.col("shard") == F.col("_first"), "left").select(
        F.lit(1).alias("part"),
        F.col("shard").alias("key"),
        F.when(F.col("_first").isNotNull(), inner).otherwise(F.concat(F.lit(","), inner)).alias("line"),
    )
    return head.unionByName(body).unionByName(tail)


def write_info_manifest(manifest: DataFrame, out: str, name: str | None = None) -> None:
    """Write ``info.json`` for JSON-lines shards."""
    lines = info_manifest(manifest, name if name is not None else out)
    write_lines(lines, F.col("line"), ["part", "key"], out, "info.json")


def write_config(spark: SparkSession, config_json: str, out: str) -> None:
    """Keep the augmentation configuration beside the data, for replaying it."""
    line = spark.createDataFrame([(config_json,)], "line STRING")
    write_lines(line, F.col("line"), ["line"], out, "config.json")


def file_digests(paths: DataFrame) -> DataFrame:
    """Size and SHA-256 of each file of ``path``, read as a stream."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                fs, inner = open_fs(path)
                sha, size = hashlib.sha256(), 0
                with fs.open_input_stream(inner) as stream:
                    while data := stream.read(8 << 20):
                        sha.update(data)
                        size += len(data)
                rows.append({"path": path, "bytes": size, "sha256": sha.hexdigest()})
            yield pa.RecordBatch.from_pylist(
                rows,
                schema=pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string())]),
            )

    return spread(paths.select("path")).mapInArrow(digest, DIGEST)


def verify_output(spark: SparkSession, out: str, suffixes: list[str]) -> DataFrame:
    """Compare the stored shards with the manifest: ``ok``, ``changed``, ``missing`` or ``extra``."""
    stored = file_digests(list_files(spark, out, suffixes)).select(
        basename(F.col("path")).alias("shard"), F.col("sha256").alias("_stored")
    )
    expected = read_manifest(spark, out).select("shard", "num_uids", "sha256").distinct()
    wanted = F.lit(False)
    for suffix in suffixes:
        wanted = wanted | F.col("shard").endswith(suffix)
    joined = expected.filter(wanted).join(stored, "shard", "full_outer")
    status = (
        F.when(F.col("sha256").isNull(), "extra")
        .when(F.col("_stored").isNull(), "missing")
        .when(F.col("sha256") == F.col("_stored"), "ok")
        .otherwise("changed")
    )
    return joined.select("shard", "num_uids", status.alias("status"))


def require_verified(spark: SparkSession, out: str, suffixes: list[str]) -> None:
    """Raise when a stored shard is not what was written."""
    bad = verify_output(spark, out, suffixes).filter("status <> 'ok'")
    some = bad.limit(20).collect()
    if some:
        names = [(r["shard"], r["status"]) for r in some]
        raise ValueError(f"{bad.count()} shards differ from the manifest, among them {names}")
