"""The resumable run as a stream over a folder that keeps growing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shardweave.functions.text import canonical_path
from shardweave.operators.ledger import next_index, part_name, pending_shards, recover, run_wave
from shardweave.operators.shards import MAX_BYTES, shard_table_of_files
from shardweave.session import checkpointed, scratch_scope
from shardweave.sources.shards import read_shards
from shardweave.streaming.listing import FORMAT as LISTING
from shardweave.streaming.listing import ListingSource


def stream_shards(
    spark: SparkSession,
    folder: str,
    out: str,
    schema: T.StructType | str,
    enrich: Callable[[DataFrame], DataFrame],
    freq: int = 1000,
    checkpoint: str | None = None,
    max_bytes: int = MAX_BYTES,
    **options,
) -> StreamingQuery:
    """Enrich every shard that is in ``folder``, then stop; started again it goes on with the shards
    that came since. All input formats and names are read, hidden ones too, so files must get their name
    when they are whole. ``options`` are those of ``run_wave``.

    The stream carries the names of new files, up to ``freq`` per entry of the listing's log, and each entry is one
    wave. Its outputs, manifest and ledger part are named after the entry, so a wave that Spark repeats after a
    failure replaces its own earlier output; one that the ledger has is not repeated.
    """
    checkpoint = checkpoint or f"{out.rstrip('/')}/_stream"
    spark.dataSource.register(ListingSource)
    source = spark.readStream.format(LISTING).option("log", f"{checkpoint}/listing").option("freq", freq)
    names = source.load(folder).withColumn("path", canonical_path(F.col("path")))

    def wave(batch: DataFrame, number: int, ledger: DataFrame) -> None:
        session, own = batch.sparkSession, part_name("stream", number)
        earlier = ledger.filter(F.col("part") != own)
        start = next_index(earlier).first()["next_index"]
        known = batch.select("path").unionAll(earlier.select("input_path"))
        table = checkpointed(shard_table_of_files(pending_shards(batch, earlier), start, max_bytes, known))
        files = table.agg(F.sum("_pieces")).first()[0]
        if files is not None:
            read = lambda paths: read_shards(session, paths, schema)
            run_wave(session, table, files, out, number, read, enrich, kind="stream", **options)

    def waves(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        with scratch_scope(session):
            listed = checkpointed(batch)
            # As many as there are entries: one for every ``freq`` files that are new.
            for entry in [row["entry"] for row in listed.select("entry").distinct().orderBy("entry").collect()]:
                ledger = recover(session, out)
                if ledger.filter(F.col("part") == part_name("stream", entry)).isEmpty():
                    with scratch_scope(session):
                        wave(listed.filter(F.col("entry") == entry).select("path", "bytes"), entry, ledger)

    return (
        names.writeStream.foreachBatch(waves)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
