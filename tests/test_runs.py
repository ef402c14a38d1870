"""Whole runs: resuming, crashes between data and ledger, large shards, both jobs end to end."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardweave.functions import tensor as px
from shardweave.functions.text import basename
from shardweave.operators import ledger as lg
from shardweave.operators import runs
from shardweave.operators import shards as sh
from shardweave.operators.teachers import HashCaption, HashClip, TeacherSpec
from shardweave.plans.augment_plan import decompress_draws
from shardweave.plans.config import steps_from_config
from shardweave.session import BROADCAST_ROWS, balanced, join_small, scratch_root
from shardweave.sources import paths
from shardweave.sources.shards import read_shards
from shardweave.sources.sink import write_jsonl, write_tar_samples
from shardweave.streaming.resume import stream_shards

SCHEMA = "uid STRING, text STRING, image STRING, n BIGINT"


def write_input(spark, folder, n=60, shards=6):
    text = F.concat(F.lit("a picture "), F.col("id"), F.lit(". more"))
    df = spark.range(n).select(
        F.col("id").cast("string").alias("uid"),
        text.alias("text"),
        F.when(F.col("id") % 10 == 3, "@@@").otherwise(F.base64(F.encode(text, "UTF-8"))).alias("image"),
        F.col("id").alias("n"),
        F.format_string("in%02d.jsonl", F.col("id") % shards).alias("_shard"),
        F.col("id").alias("_pos"),
    )
    write_jsonl(sh.name_shards(df, "orig"), str(folder))


def listing(spark, folder):
    return paths.list_files(spark, str(folder), [".jsonl"])


def run(spark, source, out, enrich=lambda df: df, **options):
    return lg.run_waves(spark, listing(spark, source), str(out), lambda p: read_shards(spark, p, SCHEMA), enrich, **options)


def contents(spark, folder):
    rows = read_shards(spark, listing(spark, folder), SCHEMA).select(basename(F.col("_shard")).alias("s"), "uid").collect()
    return sorted((r["s"], r["uid"]) for r in rows)


def test_stopped_and_whole_runs_give_the_same(spark, tmp_path):
    write_input(spark, tmp_path / "in")
    assert run(spark, tmp_path / "in", tmp_path / "whole") == 1
    assert run(spark, tmp_path / "in", tmp_path / "parts", freq=2, max_waves=1) == 1
    assert lg.pending_shards(listing(spark, tmp_path / "in"), lg.recover(spark, str(tmp_path / "parts"))).count() == 4
    assert run(spark, tmp_path / "in", tmp_path / "parts", freq=2) == 2
    assert run(spark, tmp_path / "in", tmp_path / "parts", freq=2) == 0
    assert contents(spark, tmp_path / "whole") == contents(spark, tmp_path / "parts")
    summary = lg.ledger_summary(lg.recover(spark, str(tmp_path / "parts"))).first()
    assert (summary["shards"], summary["total_uids"]) == (6, 60)


def test_inputs_of_one_name_and_hidden_names(spark, tmp_path):
    """Equal base names in two folders, compressed twins and hidden names: no output takes another's place."""
    inputs = ["a/0.jsonl", "b/0.jsonl", "b/_x.jsonl", "c/.y.jsonl", "c/1.jsonl"]
    for n, name in enumerate(inputs):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text(json.dumps({"uid": str(n)}) + "\n")
    assert run(spark, tmp_path / "in", tmp_path / "out", naming="orig", freq=1, max_waves=2) == 2
    (tmp_path / "in" / "d").mkdir()
    (tmp_path / "in" / "d" / "1.jsonl").write_text(json.dumps({"uid": "5"}) + "\n")
    assert run(spark, tmp_path / "in", tmp_path / "out", naming="orig", freq=1) == 4
    found = contents(spark, tmp_path / "out")
    assert sorted(uid for _, uid in found) == list("012345") and len({name for name, _ in found}) == 6
    ledger = lg.recover(spark, str(tmp_path / "out"))
    assert ledger.select("output_path").distinct().count() == 6 and ledger.agg(F.sum("num_uids")).first()[0] == 6


def test_stale_pieces_go_and_inputs_stay(spark, tmp_path):
    (tmp_path / "out").mkdir()
    for name in ("old.jsonl", "kept.jsonl"):
        (tmp_path / "out" / name).write_text("{}\n")
    outputs = spark.createDataFrame(
        [("elsewhere", "old.jsonl", 0), (str(tmp_path / "out" / "kept.jsonl"), "kept.jsonl", 0)], "_shard STRING, _out STRING, num_uids LONG"
    )
    sh.remove_stale(outputs, str(tmp_path / "out"))
    assert os.listdir(tmp_path / "out") == ["kept.jsonl"]


def test_crash_between_data_and_ledger(spark, tmp_path, monkeypatch):
    write_input(spark, tmp_path / "in")
    with monkeypatch.context() as m:
        m.setattr(lg, "append_ledger", lambda *a: (_ for _ in ()).throw(OSError("power cut")))
        with pytest.raises(OSError):
            run(spark, tmp_path / "in", tmp_path / "out", freq=4)
    assert lg.recover(spark, str(tmp_path / "out")).count() == 0
    run(spark, tmp_path / "in", tmp_path / "out", freq=4)
    assert len(contents(spark, tmp_path / "out")) == 60
    assert lg.full_manifest(lg.recover(spark, str(tmp_path / "out"))).agg(F.sum("num_uids")).first()[0] == 60
    sh.require_verified(spark, str(tmp_path / "out"), [".jsonl"])


def test_crash_in_the_middle_of_a_wave(spark, tmp_path):
    write_input(spark, tmp_path / "in")

    def break_late(df):
        return df.withColumn("text", F.when(F.col("n") == 59, F.raise_error(F.lit("lost"))).otherwise(F.col("text")))

    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path / "in", tmp_path / "out", break_late, freq=3)
    done = lg.recover(spark, str(tmp_path / "out")).count()
    assert done == 3  # the first wave is kept
    run(spark, tmp_path / "in", tmp_path / "out", freq=3)
    assert len(contents(spark, tmp_path / "out")) == 60


def test_large_and_empty_input_files(spark, tmp_path):
    write_input(spark, tmp_path / "in", 300, 3)
    (tmp_path / "in" / "in01a.jsonl").write_text("")
    limit = os.path.getsize(tmp_path / "in" / "in00.jsonl") // 4
    # Left over from an attempt that split the files otherwise: the name is planned, but now empty.
    (tmp_path / "out").mkdir()
    for i in range(15):
        (tmp_path / "out" / f"{i:08d}.jsonl").write_text('{"uid": "7"}\n')
    run(spark, tmp_path / "in", tmp_path / "out", max_bytes=limit, freq=3)
    ledger = lg.recover(spark, str(tmp_path / "out"))
    rows = [(os.path.basename(r["input_path"]), os.path.basename(r["output_path"]), r["num_uids"])
            for r in ledger.orderBy("output_path").collect()]
    assert [o for _, o, _ in rows] == [f"{i:08d}.jsonl" for i in range(len(rows))]
    assert all((tmp_path / "out" / o).exists() == (n > 0) for _, o, n in rows)
    assert ("in01a.jsonl", 0) in {(i, n) for i, _, n in rows} and sum(n for _, _, n in rows) == 300
    assert max(n for _, _, n in rows) < 60
    assert len({u for _, u in contents(spark, tmp_path / "out")}) == 300
    assert run(spark, tmp_path / "in", tmp_path / "out") == 0


def test_unknown_naming_and_format(spark, tmp_path):
    write_input(spark, tmp_path / "in", 6, 2)
    with pytest.raises(ValueError):
        run(spark, tmp_path / "in", tmp_path / "out", naming="random")
    with pytest.raises(ValueError):
        run(spark, tmp_path / "in", tmp_path / "out", output_format="zip")


def test_caption_run(spark, tmp_path):
    write_input(spark, tmp_path / "in")
    pattern = f"{tmp_path}/in/in{{00..05}}.jsonl"
    teacher = TeacherSpec(HashCaption)
    manifest = runs.caption_run(
        spark, pattern, str(tmp_path / "out"), teacher, SCHEMA, 3, "_v1", "jsonl", freq=4, batch_size=5, verify=True
    )
    assert manifest.count() == 6
    back = read_shards(spark, f"{tmp_path}/out/info.json".replace("info.json", "{00000000..00000005}.jsonl"),
                       SCHEMA + ", syn_text_v1 ARRAY<STRING>")
    rows = {r["uid"]: r for r in back.collect()}
    assert len(rows) == 60
    for uid, r in rows.items():
        if int(uid) % 10 == 3:
            assert r["syn_text_v1"] is None and r["image"] == "@@@"
        else:
            assert len(r["syn_text_v1"]) == 3 and set(r["syn_text_v1"]) <= {f"a picture {uid}", " more"}
    info = json.loads((tmp_path / "out" / "info.json").read_text())
    assert info["totalLength"] == "60" and len(info["lengths"]) == 6 and set(info["lengths"].values()) == {"10"}
    # Again from the manifest just written, into tar shards.
    name = info["name"]
    (tmp_path / "copy").mkdir()
    fixed = {"lengths": {"/" + k if not k.startswith("/") else k: 0 for k in info["lengths"]}, "name": name}
    (tmp_path / "copy" / "info.json").write_text(json.dumps(fixed))
    again = runs.caption_run(spark, f"{tmp_path}/copy/info.json", str(tmp_path / "tar"), teacher, SCHEMA, 2)
    assert again.agg(F.sum("num_uids")).first()[0] == 60
    lines = [json.loads(x) for x in (tmp_path / "tar" / "manifest.jsonl").read_text().splitlines()]
    assert lines == [{"shard": f"{i:08d}", "num_uids": 10} for i in range(6)]


CONFIG = {
    "normalize": {"mean": [0.5], "std": [0.25]},
    "rand_augment": {"enable": True, "p": 0.7},
    "random_resized_crop": {"interpolation": "bicubic", "size": 6},
    "to_rgb": {"enable": True},
    "to_tensor": {"enable": True},
}


def decode():
    """The first 64 bytes as pixels, for want of a picture."""
    codes = F.transform(F.sequence(F.lit(1), F.lit(16)), lambda i: F.ascii(F.substr(F.col("_image").cast("string"), i, F.lit(1))).cast("float"))
    return F.when(F.length("_image") > 0, px.tensor(codes, 4, 4, 1))


@pytest.mark.parametrize("bfloat16", [False, True])
def test_embedding_run(spark, tmp_path, bfloat16):
    write_input(spark, tmp_path / "in", 30, 3)
    teachers = [TeacherSpec(HashClip, {"dim": 4}, (6, 6), (0.5,)), TeacherSpec(HashClip, {"dim": 2}, (4, 4))]
    runs.embedding_run(
        spark, f"{tmp_path}/in/in{{00..02}}.jsonl", str(tmp_path / "out"), teachers, SCHEMA, CONFIG, decode(), 2, "_v1",
        bfloat16=bfloat16, freq=2, batch_size=4,
    )
    assert json.loads((tmp_path / "out" / "config.json").read_text()) == CONFIG
    schema = "uid STRING, n BIGINT, text STRING, image_emb_v1 ARRAY<ARRAY<FLOAT>>, text_emb_v1 ARRAY<ARRAY<FLOAT>>, param_aug ARRAY<STRING>"
    files = paths.list_files(spark, str(tmp_path / "out"), [".tar"])
    rows = read_shards(spark, files, schema)
    for r in rows.collect():
        if r["n"] % 10 == 3:
            assert r["image_emb_v1"] is None and r["text_emb_v1"] is None and r["param_aug"] is None
        else:
            assert np.array(r["image_emb_v1"]).shape == (2, 6) and np.array(r["text_emb_v1"]).shape == (1, 6)
            assert len(r["param_aug"]) == 2
    # The stored parameters are enough to draw the same boxes again.
    steps = steps_from_config(CONFIG)
    read = rows.filter("param_aug IS NOT NULL").select(F.explode(decompress_draws(F.col("param_aug"), steps)).alias("p"))
    assert read.filter("p.random_resized_crop.h BETWEEN 1 AND 4").count() == read.count() == 54


def test_a_teacher_that_does_not_fit_is_refused_before_anything_is_written(spark, tmp_path):
    with pytest.raises(ValueError):
        runs.embedding_run(
            spark, "x{0..1}.tar", str(tmp_path / "out"), [TeacherSpec(HashClip, {"dim": 4}, (8, 8))], SCHEMA, CONFIG, decode()
        )
    assert not (tmp_path / "out").exists()


def test_the_stream_takes_new_shards_only(spark, tmp_path):
    def start():
        query = stream_shards(
            spark, str(tmp_path / "in"), str(tmp_path / "out"), SCHEMA, lambda df: df.withColumn("m", F.col("n") + 1), freq=2, naming="orig"
        )
        query.awaitTermination()

    write_input(spark, tmp_path / "in", 40, 4)
    start()
    assert len(contents(spark, tmp_path / "out")) == 40
    (tmp_path / "in" / "late.jsonl").write_text('{"uid": "late", "n": 5}\n')
    start()
    start()
    ledger = lg.recover(spark, str(tmp_path / "out"))
    assert ledger.count() == 5 and ledger.agg(F.sum("num_uids")).first()[0] == 41
    late = spark.read.text(str(tmp_path / "out" / "late.jsonl")).first()["value"]
    assert json.loads(late) == {"uid": "late", "n": 5, "m": 6}


def test_the_stream_takes_every_name_and_repeats_no_wave(spark, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    for name in ("_x.jsonl", ".x.jsonl", "plain.jsonl", "_SUCCESS", ".x.jsonl.crc"):
        (folder / name).write_text(json.dumps({"uid": name, "n": 1}) + "\n")
    calls = []

    def start(fail=None):
        def enrich(df):
            calls.append(1)
            return df.withColumn("m", F.when(F.col("uid") == fail, F.raise_error(F.lit("broken"))).otherwise(F.col("n")))

        query = stream_shards(spark, str(folder), str(out), SCHEMA, enrich, freq=1, naming="orig")
        query.awaitTermination()

    with pytest.raises(Exception, match="broken"):
        start("plain.jsonl")  # the third entry of the batch: the first two are in the ledger
    assert {r["part"] for r in lg.recover(spark, str(out)).collect()} == {"stream-00000001", "stream-00000002"}
    calls.clear()
    start()
    assert len(calls) == 1
    (folder / "_late.jsonl").write_text('{"uid": "late", "n": 1}\n')
    start()
    start()
    found = read_shards(spark, listing(spark, out), SCHEMA).select("uid").collect()
    assert sorted(r["uid"] for r in found) == [".x.jsonl", "_x.jsonl", "late", "plain.jsonl"]
    assert sorted(r["part"] for r in lg.recover(spark, str(out)).collect()) == [f"stream-{n:08d}" for n in range(1, 5)]


def test_runs_leave_nothing_in_the_scratch_folder(spark, tmp_path):
    root = scratch_root(spark)

    def held():
        return {os.path.join(folder, name) for folder, _, names in os.walk(root) for name in names}

    write_input(spark, tmp_path / "in", 20, 4)
    files = listing(spark, tmp_path / "in")
    before = held()
    assert lg.run_waves(spark, files, str(tmp_path / "out"), lambda p: read_shards(spark, p, SCHEMA), lambda df: df, freq=2) == 2
    assert held() == before
    stream_shards(spark, str(tmp_path / "in"), str(tmp_path / "stream"), SCHEMA, lambda df: df, freq=3).awaitTermination()
    assert held() == before
    runs.caption_run(spark, f"{tmp_path}/in/in{{00..03}}.jsonl", str(tmp_path / "captions"), TeacherSpec(HashCaption), SCHEMA, 2, verify=True)
    assert held() == before


def test_the_stream_reads_every_format_and_skips_what_a_run_has_done(spark, tmp_path):
    write_input(spark, tmp_path / "in", 20, 2)
    run(spark, tmp_path / "in", tmp_path / "out", freq=1, max_waves=1)
    df = spark.range(5).select(F.format_string("t%d", "id").alias("uid"), F.lit("tar").alias("text"), F.lit("x").alias("_shard"), F.col("id").alias("_pos"))
    write_tar_samples(sh.name_shards(df, "count", "tar"), str(tmp_path / "in"))
    stream_shards(spark, str(tmp_path / "in"), str(tmp_path / "out"), SCHEMA, lambda df: df).awaitTermination()
    found = contents(spark, tmp_path / "out")
    assert len(found) == 25 and {s for s, _ in found} == {f"{i:08d}.jsonl" for i in range(3)}
    assert lg.recover(spark, str(tmp_path / "out")).count() == 3


def test_large_tables_are_not_broadcast(spark):
    big = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    small = spark.range(3).withColumnRenamed("id", "k")
    plan = lambda rows: join_small(big, small, "k", rows)._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(3).lower() and "broadcast" not in plan(BROADCAST_ROWS + 1).lower()


def test_balanced_leaves_wide_inputs_alone(spark):
    wide = spark.range(0, 100, 1, 64)
    assert balanced(wide, ["id"]) is wide
    narrow = balanced(spark.range(0, 100, 1, 1), ["id"])
    assert narrow.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError):
        scratch_root(Session())
