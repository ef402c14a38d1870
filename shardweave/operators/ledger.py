"""The ledger of a run: which input shards are done, what they gave, and how to go on."""

from __future__ import annotations

import time
from collections.abc import Callable

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardweave.functions.text import basename, canonical_path
from shardweave.operators.shards import (
    MAX_BYTES,
    name_shards,
    remove_stale,
    shard_outputs,
    shard_table_of_files,
    written_outputs,
)
from shardweave.session import checkpointed, scratch_scope
from shardweave.sources.files import open_fs
from shardweave.sources.sink import write_shards

LEDGER_FOLDER = "_ledger"
LEDGER = (
    "wave LONG, input_path STRING, output_path STRING, num_uids LONG, time_seconds DOUBLE,"
    " cpu_seconds DOUBLE, gpu_seconds DOUBLE, finished_at TIMESTAMP"
)


def pending_shards(paths: DataFrame, ledger: DataFrame) -> DataFrame:
    """Input paths that the ledger does not list, each once, with their ``bytes`` if they have any."""
    done = ledger.select(F.col("input_path").alias("path"))
    sizes = [F.max("bytes").alias("bytes")] if "bytes" in paths.columns else []
    once = paths.groupBy("path").agg(*sizes) if sizes else paths.select("path").distinct()
    return once.join(done, "path", "left_anti")


def recover(spark: SparkSession, out: str) -> DataFrame:
    """Ledger of earlier runs into ``out``, empty when there is none; ``part`` names the wave's folder."""
    folder = f"{out.rstrip('/')}/{LEDGER_FOLDER}"
    fs, inner = open_fs(folder)
    if fs.get_file_info(inner).type != pafs.FileType.Directory:
        return spark.createDataFrame([], f"{LEDGER}, part STRING")
    return spark.read.schema(f"{LEDGER}, part STRING").parquet(folder)


def next_index(ledger: DataFrame) -> DataFrame:
    """Number of the next output shard (one row): as many as have been written."""
    return ledger.agg(F.count_distinct("output_path").alias("next_index"))


def next_wave(ledger: DataFrame) -> int:
    """Number of the next wave."""
    last = ledger.agg(F.max("wave").alias("w")).first()["w"]
    return 0 if last is None else last + 1


def part_name(kind: str, wave: int) -> str:
    """Name of a wave's part of the ledger and of the manifest."""
    return f"{kind}-{wave:08d}"


def append_ledger(spark: SparkSession, out: str, wave: int, rows: DataFrame, kind: str = "wave") -> None:
    """Persist the results of a wave.

    A wave has its own folder and replaces it, so repeating a wave after a crash between data and
    ledger leaves one entry.
    """
    folder = f"{out.rstrip('/')}/{LEDGER_FOLDER}/part={part_name(kind, wave)}"
    columns = [F.col(c.split()[0]).cast(c.split()[1]) for c in LEDGER.split(", ")]
    rows.select(*columns).write.mode("overwrite").parquet(folder)


def running_totals(ledger: DataFrame) -> DataFrame:
    """Ledger with cumulative records and seconds in the order of completion.

    Rows are accumulated within their wave (waves of a stream and of runs are told apart by ``part``), and a
    wave is shifted by the totals of those that ended before it; only the table of waves is ordered as a whole.
    """
    part = F.col("part") if "part" in ledger.columns else F.lit("")
    ledger = ledger.withColumn("_part", part)
    sums = {"total_uids": "num_uids", "total_time_s": "time_seconds", "total_cpu_s": "cpu_seconds", "total_gpu_s": "gpu_seconds"}
    within = Window.partitionBy("_part", "wave").orderBy("finished_at", "input_path")
    inside = within.rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_ended", "_kind", "wave").rowsBetween(Window.unboundedPreceding, -1)
    waves = ledger.groupBy("_part", "wave").agg(
        F.max("finished_at").alias("_ended"), *[F.sum(c).alias(f"_{n}") for n, c in sums.items()]
    )
    # Waves of one kind follow one another; between a stream and a run the time of completion decides.
    kind = F.regexp_replace("_part", r"-\d+$", "")
    so_far = Window.partitionBy("_kind").orderBy("wave")
    waves = waves.withColumn("_kind", kind).withColumn("_ended", F.max("_ended").over(so_far))
    shifts = waves.select(
        "_part", "wave", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums]
    )
    shifted = ledger.join(shifts, ["_part", "wave"])
    totals = [(F.sum(c).over(inside) + F.col(f"_{n}")).alias(n) for n, c in sums.items()]
    return shifted.select(*[c for c in ledger.columns if c != "_part"], *totals)


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """Totals of all runs, in records and hours."""
    hours = {"total_time_h": "time_seconds", "total_cpu_h": "cpu_seconds", "total_gpu_h": "gpu_seconds"}
    return ledger.agg(
        F.count(F.lit(1)).alias("shards"),
        F.coalesce(F.sum("num_uids"), F.lit(0)).alias("total_uids"),
        *[(F.coalesce(F.sum(c), F.lit(0.0)) / 3600.0).alias(n) for n, c in hours.items()],
    )


def progress_report(ledger: DataFrame, total: DataFrame) -> DataFrame:
    """Shards done and left, time spent and expected: ``left * elapsed / done``.

    ``total`` has one row with ``total_shards``.
    """
    spent = ledger.agg(
        F.count(F.lit(1)).alias("done"), F.coalesce(F.sum("time_seconds"), F.lit(0.0)).alias("elapsed_s")
    ).withColumn("_one", F.lit(1))
    joined = spent.join(total.withColumn("_one", F.lit(1)), "_one")
    left = F.col("total_shards") - F.col("done")
    remaining = F.when(F.col("done") > 0, left * F.col("elapsed_s") / F.col("done"))
    return joined.select("done", left.alias("left"), "elapsed_s", remaining.alias("remaining_s"))


def full_manifest(ledger: DataFrame) -> DataFrame:
    """``{shard, num_uids}`` over all runs, sorted."""
    name = F.substring_index(basename(F.col("output_path")), ".", 1)
    written = ledger.filter("num_uids > 0")
    return written.groupBy(name.alias("shard")).agg(F.sum("num_uids").alias("num_uids")).orderBy("shard")


def _ledger_rows(outputs: DataFrame, out: str, wave: int, seconds: float, cpus: int, gpus: int) -> DataFrame:
    """Ledger rows of a wave; its time is shared out over its shards by their records.

    Planned shards that received no record are listed with zero, so that numbering goes on behind
    them.
    """
    # One group, but of at most the shards of one wave.
    whole = F.greatest(F.sum("num_uids").over(Window.partitionBy("wave")), F.lit(1))
    spent = F.lit(float(seconds)) * F.col("num_uids") / whole
    return outputs.withColumn("wave", F.lit(wave).cast("bigint")).select(
        "wave",
        F.col("_shard").alias("input_path"),
        F.concat(F.lit(out.rstrip("/") + "/"), F.col("_out")).alias("output_path"),
        "num_uids",
        spent.alias("time_seconds"),
        (spent * cpus).alias("cpu_seconds"),
        (spent * gpus).alias("gpu_seconds"),
        F.current_timestamp().alias("finished_at"),
    )


def run_wave(
    spark: SparkSession,
    shards: DataFrame,
    files: int,
    out: str,
    wave: int,
    read: Callable[[DataFrame], DataFrame],
    enrich: Callable[[DataFrame], DataFrame],
    output_format: str = "jsonl",
    naming: str = "count",
    bfloat16: bool = False,
    gpus: int = 0,
    kind: str = "wave",
) -> None:
    """Enrich the input shards of a shard table, write the ``files`` output shards that it plans, and
    then the wave's part of the ledger. Tables that ``read`` and ``enrich`` have checkpointed go with the wave."""
    begun = time.monotonic()
    cpus = spark.sparkContext.defaultParallelism
    extension = "jsonl" if output_format == "jsonl" else "tar"
    with scratch_scope(spark):
        records = read(shards.select(F.col("_shard").alias("path")))
        named = name_shards(records, naming, extension, shards=shards, shard_rows=files)
        manifest = write_shards(enrich(named), out, output_format, part_name(kind, wave), bfloat16, files)
        outputs = written_outputs(shard_outputs(shards, naming, extension), manifest)
        remove_stale(outputs, out)
        seconds = time.monotonic() - begun
        append_ledger(spark, out, wave, _ledger_rows(outputs, out, wave, seconds, cpus, gpus), kind)


def run_waves(
    spark: SparkSession,
    paths: DataFrame,
    out: str,
    read: Callable[[DataFrame], DataFrame],
    enrich: Callable[[DataFrame], DataFrame],
    freq: int = 1000,
    max_waves: int | None = None,
    max_bytes: int = MAX_BYTES,
    **options,
) -> int:
    """Enrich the pending shards in waves of about ``freq`` output shards; returns the number of waves.

    Each wave writes its data and then its ledger part, so an interrupted run repeats at most one
    wave, under the same names. ``read`` turns a table of paths into records with ``_shard`` and
    ``_pos``; ``enrich`` adds columns and keeps all that start with an underscore. Input files of more
    than ``max_bytes`` are spread over several output shards. ``options`` are those of
    :func:`run_wave`.
    """
    with scratch_scope(spark):
        spelled = paths.withColumn("path", canonical_path(F.col("path")))
        ledger = recover(spark, out)
        wave, start = next_wave(ledger), next_index(ledger).first()["next_index"]
        known = spelled.select("path").unionAll(ledger.select("input_path"))
        table = checkpointed(shard_table_of_files(pending_shards(spelled, ledger), start, max_bytes, known))
        turn = F.floor((F.col("_first") - start) / freq)
        # The plan of the run on the driver: one row per wave.
        plan = table.groupBy(turn.alias("turn")).agg(F.sum("_pieces").alias("files")).orderBy("turn").collect()
        for step in plan[:max_waves]:
            run_wave(spark, table.filter(turn == step["turn"]), step["files"], out, wave, read, enrich, **options)
            wave += 1
        return len(plan[:max_waves])
