"""Counts, sizes, the ledger, resumable runs and the stream."""

from pyspark.sql import functions as F

from checks.base import RECORDS, check, records, written_anew, written_once
from checks.files import RECORD, jsonl_folder, third
from shardweave.functions import text as tx
from shardweave.operators import ledger as lg
from shardweave.operators import shards as sh
from shardweave.operators.positions import global_index
from shardweave.session import scratch_path
from shardweave.sources import paths
from shardweave.sources.shards import read_shards
from shardweave.streaming.resume import stream_shards


def out_records(spark, sf):
    return records(spark, sf).withColumn("_out", F.col("_shard"))


@check("shard_counts", f"WITH {RECORDS} SELECT _shard AS shard, count(*)::BIGINT AS num_uids FROM records GROUP BY 1")
def _(spark, sf):
    return sh.shard_counts(out_records(spark, sf))


@check("dataset_total", "SELECT count(*)::BIGINT AS total_uids FROM documents")
def _(spark, sf):
    return sh.dataset_total(sh.shard_counts(out_records(spark, sf)))


@check(
    "sorted_manifest",
    f"""WITH {RECORDS}, c AS (SELECT _shard AS shard, count(*) AS num_uids FROM records GROUP BY 1)
    SELECT shard, num_uids::BIGINT AS num_uids, (row_number() OVER (ORDER BY shard) - 1)::BIGINT AS place FROM c""",
)
def _(spark, sf):
    ordered = sh.sorted_manifest(sh.shard_counts(out_records(spark, sf)))
    return global_index(ordered, ["shard"], "place")


@check(
    "shard_sizes",
    f"""WITH {RECORDS} SELECT _shard AS shard, count(*)::BIGINT AS num_uids, sum(strlen(text) + strlen(lang))::BIGINT AS bytes,
      round(sum(strlen(text) + strlen(lang)) / 1048576.0::DOUBLE, 9) AS mib FROM records GROUP BY 1""",
)
def _(spark, sf):
    sizes = sh.shard_sizes(records(spark, sf), ["text", "lang"])
    return sizes.withColumn("mib", F.round("mib", 9))


# The ledger of an earlier run: the sources whose name's digest is in the lower half are done.
LEDGER = f"""{RECORDS}, sources AS (SELECT _shard, count(*) AS n, sum(n_chars) AS chars, min(_pos) AS begun,
      row_number() OVER (ORDER BY _shard) - 1 AS place FROM records GROUP BY 1),
    ledger AS (SELECT place // 4 AS wave, _shard AS input_path, 'out/' || _shard AS output_path, n AS num_uids,
      chars / 1000.0::DOUBLE AS time_seconds, begun FROM sources WHERE md5(_shard) < '8')"""


def ledger_of(spark, sf):
    sources = records(spark, sf).groupBy("_shard").agg(
        F.count(F.lit(1)).alias("num_uids"), F.sum("n_chars").alias("chars"), F.min("_pos").alias("at")
    )
    placed = global_index(sources, ["_shard"], "place").filter(F.md5(F.col("_shard").cast("binary")) < "8")
    spent = F.col("chars") / 1000.0
    return placed.select(
        F.floor(F.col("place") / 4).alias("wave"),
        F.col("_shard").alias("input_path"),
        F.concat(F.lit("out/"), "_shard").alias("output_path"),
        "num_uids",
        spent.alias("time_seconds"),
        (spent * 4).alias("cpu_seconds"),
        F.lit(0.0).alias("gpu_seconds"),
        F.timestamp_seconds(F.col("at") + 1_700_000_000).alias("finished_at"),
    )


def ledger_writer(spark, sf):
    def write(out):
        rows = ledger_of(spark, sf)
        # Repeating a wave, as after a crash, must not count it twice.
        for wave in [0, *[r["wave"] for r in rows.select("wave").distinct().orderBy("wave").toLocalIterator()]]:
            lg.append_ledger(spark, out, wave, rows.filter(F.col("wave") == wave))

    return write


def ledger_folder(spark, sf):
    return written_once(spark, sf, "ledger", ledger_writer(spark, sf))


@check(
    "pending_shards",
    f"WITH {LEDGER} SELECT DISTINCT _shard AS path FROM records WHERE _shard NOT IN (SELECT input_path FROM ledger)",
)
def _(spark, sf):
    inputs = records(spark, sf).select(F.col("_shard").alias("path"))
    return lg.pending_shards(inputs, ledger_of(spark, sf))


@check(
    "append_ledger",
    f"""WITH {LEDGER} SELECT input_path, num_uids::BIGINT AS num_uids,
      (sum(num_uids) OVER w)::BIGINT AS total_uids, round(sum(time_seconds) OVER w, 4) AS total_time_s,
      round(4 * sum(time_seconds) OVER w, 4) AS total_cpu_s FROM ledger
    WINDOW w AS (ORDER BY wave, begun, input_path ROWS UNBOUNDED PRECEDING)""",
)
def _(spark, sf):
    totals = lg.running_totals(lg.recover(spark, written_anew(spark, "ledger", ledger_writer(spark, sf))))
    return totals.select(
        "input_path",
        "num_uids",
        "total_uids",
        F.round("total_time_s", 4).alias("total_time_s"),
        F.round("total_cpu_s", 4).alias("total_cpu_s"),
    )


@check(
    "recover",
    f"""WITH {LEDGER} SELECT input_path, output_path, num_uids::BIGINT AS num_uids, wave::BIGINT AS wave,
      (SELECT count(*) FROM ledger)::BIGINT AS next_index, 0::BIGINT AS fresh FROM ledger""",
)
def _(spark, sf):
    ledger = lg.recover(spark, ledger_folder(spark, sf))
    fresh = lg.next_index(lg.recover(spark, scratch_path(spark, "no-such-run"))).first()["next_index"]
    following = lg.next_index(ledger).first()["next_index"]
    return ledger.select(
        "input_path", "output_path", "num_uids", "wave", F.lit(following).cast("bigint").alias("next_index"), F.lit(fresh).cast("bigint").alias("fresh")
    )


@check(
    "ledger_summary",
    f"""WITH {LEDGER} SELECT count(*)::BIGINT AS shards, sum(num_uids)::BIGINT AS total_uids, round(sum(time_seconds) / 3600, 6) AS total_time_h,
      round(4 * sum(time_seconds) / 3600, 6) AS total_cpu_h, 0.0::DOUBLE AS total_gpu_h FROM ledger""",
)
def _(spark, sf):
    s = lg.ledger_summary(lg.recover(spark, ledger_folder(spark, sf)))
    return s.select("shards", "total_uids", *[F.round(c, 6).alias(c) for c in ("total_time_h", "total_cpu_h", "total_gpu_h")])


@check(
    "progress_report",
    f"""WITH {LEDGER}, s AS (SELECT count(*) AS done, sum(time_seconds) AS spent FROM ledger), t AS (SELECT count(*) AS total FROM sources)
    SELECT done::BIGINT AS done, (total - done)::BIGINT AS "left", round(spent, 4) AS elapsed_s,
      round((total - done) * spent / done, 4) AS remaining_s FROM s, t""",
)
def _(spark, sf):
    total = records(spark, sf).agg(F.count_distinct("_shard").alias("total_shards"))
    report = lg.progress_report(lg.recover(spark, ledger_folder(spark, sf)), total)
    return report.select("done", "left", F.round("elapsed_s", 4).alias("elapsed_s"), F.round("remaining_s", 4).alias("remaining_s"))


@check(
    "full_manifest",
    f"""WITH {LEDGER} SELECT split_part(input_path, '.', 1) AS shard, num_uids::BIGINT AS num_uids FROM ledger""",
)
def _(spark, sf):
    return lg.full_manifest(lg.recover(spark, ledger_folder(spark, sf)))


def marked(df):
    return df.withColumn("n_words", F.size(F.split("text", " ")))


def run_folder(spark, sf):
    """A run that is stopped after its first wave and taken up again by two more calls."""
    inputs = paths.list_files(spark, jsonl_folder(spark, sf), [".jsonl"])

    def write(out):
        for limit in (1, 1, None):
            lg.run_waves(
                spark, inputs, out, lambda p: read_shards(spark, p, RECORD), marked, 7, limit
            )

    return written_anew(spark, "run", write)


@check(
    "run_waves",
    f"""WITH {RECORDS}, named AS (SELECT *, lpad((dense_rank() OVER (ORDER BY _shard) - 1)::VARCHAR, 8, '0') AS shard FROM records)
    SELECT shard, split_part(_shard, '.', 1) AS source, (first(place) // 7)::BIGINT AS wave, count(*)::BIGINT AS num_uids,
      sum(len(string_split(text, ' ')))::BIGINT AS n_words
    FROM (SELECT *, dense_rank() OVER (ORDER BY _shard) - 1 AS place FROM named) GROUP BY 1, 2""",
)
def _(spark, sf):
    folder = run_folder(spark, sf)
    ledger = lg.recover(spark, folder).select(
        tx.basename(F.col("output_path")).alias("_file"), tx.basename(F.col("input_path")).alias("_input"), "wave", "num_uids"
    )
    data = read_shards(spark, paths.list_files(spark, folder, [".jsonl"]), RECORD + ", n_words BIGINT")
    words = data.groupBy(tx.basename(F.col("_shard")).alias("_file")).agg(F.sum("n_words").alias("n_words"))
    return ledger.join(words, "_file").select(
        F.substring_index("_file", ".", 1).alias("shard"),
        F.substring_index("_input", ".", 1).alias("source"),
        "wave",
        "num_uids",
        "n_words",
    )


def stream_folder(spark, sf):
    """The stream, started twice: the second start finds nothing new."""

    folder = jsonl_folder(spark, sf)
    limit = third(paths.list_files(spark, folder, [".jsonl"]))

    def write(out):
        for _ in range(2):
            query = stream_shards(spark, folder, out, RECORD, marked, freq=7, max_bytes=limit, naming="orig")
            query.awaitTermination()

    return written_anew(spark, "stream", write)


@check(
    "stream_shards",
    f"""WITH {RECORDS} SELECT source, 1 AS split, count(*)::BIGINT AS num_uids, count(*)::BIGINT AS read_back,
      sum(len(string_split(text, ' ')))::BIGINT AS n_words FROM records GROUP BY 1""",
)
def _(spark, sf):
    folder = stream_folder(spark, sf)
    ledger = lg.recover(spark, folder).groupBy(
        F.substring_index(tx.basename(F.col("input_path")), ".", 1).alias("source")
    ).agg(
        (F.count_distinct("output_path") > 1).cast("int").alias("split"), F.sum("num_uids").alias("num_uids")
    )
    data = read_shards(spark, paths.list_files(spark, folder, [".jsonl"]), RECORD + ", n_words BIGINT")
    words = data.groupBy(F.regexp_extract(tx.basename(F.col("_shard")), "^[^-.]+", 0).alias("source")).agg(
        F.count(F.lit(1)).alias("read_back"), F.sum("n_words").alias("n_words")
    )
    return ledger.join(words, "source")
