"""Shard files: dirty input, odd members, splitting, checksums, failures while writing."""

import gzip
import io
import json
import os
import re
import tarfile
import time

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from checks.files import _example
from shardweave.operators import shards as sh
from shardweave.operators.records import unwrap_features
from shardweave.session import BATCH_BYTES
from shardweave.sources import jsonl, paths, tar, tfrecord
from shardweave.sources.files import OPEN_BYTES, RANGES, TASK_BYTES, packed
from shardweave.sources.shards import paths_by_format, read_shards
from shardweave.sources.sink import dealt, read_manifest, write_chunks, write_jsonl, write_tar_samples

SCHEMA = "uid STRING, text STRING, n BIGINT"


def records(spark, n, shards=3):
    return spark.range(n).select(
        F.col("id").cast("string").alias("uid"),
        F.concat(F.lit("Text é "), "id").alias("text"),
        F.col("id").alias("n"),
        F.format_string("s%d.jsonl", F.col("id") % shards).alias("_shard"),
        F.col("id").alias("_pos"),
    )


@pytest.mark.parametrize("suffix", [".jsonl", ".jsonl.gz", ".jsonl.zst", ".json.zstd"])
def test_dirty_json_lines(spark, tmp_path, suffix):
    lines = ['{"uid": "a", "text": "x", "n": 1}', "not json", "[1, 2]", "7", '"s"', "", "null", '{"uid": "b", "n": "w"}',
             ' \t{"uid": "c", "other": {"k": [1]}}', '{"uid": "d"', '[{"uid": "e"}]']
    data = ("\n".join(lines) + "\n").encode()
    if suffix.endswith("gz"):
        data = gzip.compress(data)
    elif "zst" in suffix:
        data = zstandard.ZstdCompressor().compress(data)
    path = tmp_path / f"part{suffix}"
    path.write_bytes(data)
    rows = {r["uid"]: r for r in jsonl.read_jsonl(spark, [str(path)], SCHEMA).collect()}
    assert set(rows) == {"a", "b", "c"} and rows["b"]["n"] is None and rows["a"]["n"] == 1
    rejects = jsonl.read_jsonl_rejects(spark, [str(path)]).first()
    assert rejects["rejected"] == len(lines) - 3
    assert rejects["_shard"] == str(path)
    open_keys = jsonl.read_jsonl(spark, [str(path)])
    assert open_keys.select(F.try_variant_get("record", "$.other.k[0]", "int").alias("k")).filter("k = 1").count() == 1


def test_line_order_survives_file_splits(spark, tmp_path, monkeypatch):
    """Places are offsets: the same for every size of ranges and blocks."""
    path = tmp_path / "_long.jsonl"  # a name that Spark's own sources pass over
    path.write_text("".join(json.dumps({"uid": str(i), "n": i}) + "\r\n" * (1 + i % 3 % 2) for i in range(2000)))
    places = []
    for size, block in ((64 << 20, 4 << 20), (3000, 4 << 20), (7001, 11)):
        monkeypatch.setattr(jsonl, "RANGE", size)
        monkeypatch.setattr(jsonl, "BLOCK", block)
        rows = jsonl.read_jsonl(spark, [str(path)], SCHEMA).select("n", "_pos").orderBy("_pos").collect()
        assert [r["n"] for r in rows] == list(range(2000))
        places.append([r["_pos"]["line"] for r in rows])
    assert places[0] == places[1] == places[2] and places[0][:2] == [0, len('{"uid": "0", "n": 0}\r\n')]


def test_records_pass_through_whole(spark, tmp_path):
    """Keys outside the schema, nulls, misfits, and ids that are missing, repeated or dotted."""
    records = [
        {"uid": "a.b", "text": "x", "extra": {"k": [1, None, {"z": "ü"}]}, "n": None, "f": 1.5},
        {"uid": "a.b", "text": None, "n": 7},
        {"uid": None, "t": "%25"},
        {"uid": "q", "n": "seven"},
        {"uid": "%2E%r1", "arr": []},
    ]
    path = tmp_path / ".hidden.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in records))
    read = jsonl.read_jsonl(spark, [str(path)], "uid STRING, n BIGINT")
    write_jsonl(sh.name_shards(read, "orig"), str(tmp_path / "lines"))
    again = (tmp_path / "lines" / ".hidden.jsonl").read_text().splitlines()
    assert [json.loads(line) for line in again] == records
    write_tar_samples(sh.name_shards(read, "count", "tar"), str(tmp_path / "tar"))
    back = tar.read_tar_samples(spark, [str(tmp_path / "tar" / "00000000.tar")], "uid STRING, n BIGINT").orderBy("_pos").collect()
    assert [(r["uid"], r["n"]) for r in back] == [("a.b", None), ("a.b", 7), (None, None), ("q", None), ("%2E%r1", None)]
    rests = [json.loads(r["_rest"]) if r["_rest"] else {} for r in back]
    assert rests[0] == {"text": "x", "extra": {"k": [1, None, {"z": "ü"}]}, "n": None, "f": 1.5}
    assert rests[1] == {"text": None} and rests[3] == {"n": "seven"} and rests[4] == {"arr": []}


def test_features_by_declared_type(spark):
    rows = [({
        "one": ([], [], [7]), "big": ([], [], [2**60 + 1]), "words": ([b"a", b"\xc3\xbc"], [], []), "x": ([], [1.5], []), "left": ([b"l"], [], []),
    },)]
    df = spark.createDataFrame(rows, "features MAP<STRING, STRUCT<bytes: ARRAY<BINARY>, floats: ARRAY<FLOAT>, ints: ARRAY<BIGINT>>>")
    out = unwrap_features(df, "one ARRAY<BIGINT>, big BIGINT, words ARRAY<STRING>, x DOUBLE, none STRING").first()
    assert (out["one"], out["big"], out["words"], out["x"], out["none"]) == ([7], 2**60 + 1, ["a", "ü"], 1.5, None)
    assert json.loads(out["_rest"]) == {"left": "l"}


def write_tar(path, members, pax=False):
    with tarfile.open(path, "w", format=tarfile.PAX_FORMAT if pax else tarfile.GNU_FORMAT) as archive:
        for name, content in members:
            info = tarfile.TarInfo(name)
            if content is None:
                info.type = tarfile.DIRTYPE
                archive.addfile(info)
            else:
                info.size = len(content)
                archive.addfile(info, io.BytesIO(content))


@pytest.mark.parametrize("pax", [False, True])
def test_tar_members(spark, tmp_path, pax):
    arrays = io.BytesIO()
    np.savez(arrays, image_emb=np.float32([[1, 2], [3, 4]]))
    deep = "d" * 120  # needs an extended header
    write_tar(
        tmp_path / "a.tar",
        [
            ("dir.x", None),
            ("dir.x/k1.url.txt", b"http://u"),
            ("dir.x/k1.txt", "é".encode()),
            ("dir.x/k1.jpg", b"\xff\xd8"),
            ("dir.x/k1.json", b'{"n": 1, "lang": "fr"}'),
            ("dir.x/k1.syn.json", b'{"n": 2}'),
            ("dir.x/k1.npz", arrays.getvalue()),
            (f"{deep}/k2.txt", b"two"),
            ("dir.x/k1.txt", b"again"),
        ],
        pax,
    )
    df = tar.read_tar_samples(spark, [str(tmp_path / "a.tar")], split_bytes=512)
    rows = df.orderBy("_pos").collect()
    assert [r["uid"] for r in rows] == ["dir.x/k1", f"{deep}/k2", "dir.x/k1"]
    assert rows[0]["url"] == "http://u" and rows[0]["text"] == "é" and bytes(rows[0]["image"]) == b"\xff\xd8"
    assert json.loads(rows[0]["json"]) == {"n": 2, "lang": "fr"}
    assert rows[0]["arrays"]["image_emb"] == [[1, 2], [3, 4]] and rows[2]["text"] == "again"
    shaped = tar.read_tar_samples(
        spark, [str(tmp_path / "a.tar")], "uid STRING, text STRING, n INT, image_emb ARRAY<ARRAY<FLOAT>>"
    )
    assert shaped.filter("n = 2 AND image_emb[1][0] = 3").count() == 1


def test_unknown_member_is_an_error(spark, tmp_path):
    write_tar(tmp_path / "a.tar", [("k.exe", b"x")])
    with pytest.raises(Exception, match="unsupported member"):
        tar.read_tar_samples(spark, [str(tmp_path / "a.tar")]).collect()


def test_empty_shards(spark, tmp_path):
    write_tar(tmp_path / "a.tar", [])
    (tmp_path / "b.jsonl").write_text("")
    (tmp_path / "c.tfrecord").write_bytes(b"")
    (tmp_path / "d.tar").write_bytes(b"")
    listed = paths.list_files(spark, str(tmp_path), [".tar", ".jsonl", ".tfrecord"])
    assert listed.count() == 4 and read_shards(spark, listed, SCHEMA).count() == 0
    assert read_shards(spark, listed.limit(0), SCHEMA).columns == ["uid", "text", "n", "_shard", "_pos", "_rest"]


def test_a_missing_shard_is_an_error(spark, tmp_path):
    for read in (tar.read_tar_samples, tfrecord.read_tfrecord, jsonl.read_lines):
        with pytest.raises(Exception, match="gone"):
            read(spark, [str(tmp_path / "gone.x")]).count()


def test_unknown_format_is_an_error(spark):
    listed = spark.createDataFrame([("a/x.tar",), ("a/y.parquet",)], "path STRING")
    with pytest.raises(ValueError, match="y.parquet"):
        paths_by_format(listed)


def test_tfrecord_pieces_and_truncation(spark, tmp_path):
    data = b"".join(_example(str(i), "en", i * 1000, b"\x00img", [i / 4, -1.0]) for i in range(200))
    (tmp_path / "a.tfrecord").write_bytes(data)
    (tmp_path / "b.tfrecord-00001").write_bytes(data[:-20])
    for split in (1 << 30, 2000):
        r = tfrecord.read_tfrecord(spark, [str(tmp_path / "a.tfrecord")], split_bytes=split)
        got = r.orderBy("_pos").select(F.col("features")["n_chars"]["ints"][0], F.col("features")["weights"]["floats"][0])
        assert [tuple(x) for x in got.collect()] == [(i * 1000, i / 4) for i in range(200)]
    shuffled = []
    for seed, split in ((5, 1 << 30), (5, 2000), (6, 2000)):
        r = tfrecord.read_tfrecord(spark, [str(tmp_path / "a.tfrecord")], seed, split)
        shuffled.append([x[0] for x in r.orderBy("_pos").select(F.col("features")["n_chars"]["ints"][0]).collect()])
    assert shuffled[0] == shuffled[1] != shuffled[2]
    assert sorted(shuffled[0]) == sorted(shuffled[2]) == [i * 1000 for i in range(200)] != shuffled[0]
    with pytest.raises(Exception, match="ends inside a record"):
        tfrecord.read_tfrecord(spark, [str(tmp_path / "b.tfrecord-00001")]).collect()


def test_large_shards_are_split_and_nothing_is_lost(spark, tmp_path):
    # One shard holds two thirds of the records.
    r = records(spark, 900).withColumn("_shard", F.when(F.col("n") % 3 > 0, "hot.jsonl").otherwise(F.col("_shard")))
    named = sh.name_shards(r, "orig", max_records=100)
    manifest = write_jsonl(named, str(tmp_path))
    sizes = {m["shard"]: m["num_uids"] for m in manifest.collect()}
    assert sum(sizes.values()) == 900 and max(sizes.values()) < 200
    assert sorted(s for s in sizes if s.startswith("hot")) == [*(f"hot-0000{k}.jsonl" for k in range(1, 6)), "hot.jsonl"]
    back = jsonl.read_jsonl(spark, [str(tmp_path)], SCHEMA)
    assert back.select("uid", "text", "n").exceptAll(r.select("uid", "text", "n")).count() == 0 and back.count() == 900
    for part in spark.read.text(str(tmp_path)).select(F.input_file_name().alias("f")).distinct().collect():
        order = [json.loads(line)["n"] for line in open(part["f"].replace("file://", ""))]
        assert order == sorted(order)


@pytest.mark.parametrize("naming", ["count", "orig"])
def test_one_layout_rule_for_shards_of_every_size(spark, naming):
    """Pieces follow positions: no gap, no mixing, and the first ones stay when a shard grows."""
    sizes = {"a.jsonl": 7, "b.jsonl": 1000, "c.jsonl": 101, "one.jsonl": 1}
    rows = [(s, n * n if s == "c.jsonl" else n) for s, k in sizes.items() for n in range(k)] + [("same.jsonl", 5)] * 350 + [("none.jsonl", None)]
    df = spark.createDataFrame(rows, "_shard STRING, _pos LONG").repartition(6)
    found = {}
    for r in sh.name_shards(df, naming, max_records=100).collect():
        found.setdefault(r["_shard"], {}).setdefault((r["_place"], r["_out"]), []).append(r["_pos"])
    assert sorted(p for pieces in found.values() for p, _ in pieces) == list(range(sum(map(len, found.values()))))
    for shard, pieces in found.items():
        ordered = [pieces[k] for k in sorted(pieces)]
        assert all(max(a) < min(b) for a, b in zip(ordered, ordered[1:]))
        assert max(map(len, ordered)) <= 130 or shard == "same.jsonl"
    assert len(found["b.jsonl"]) == 10 and all(len(found[s]) == 1 for s in ("a.jsonl", "one.jsonl", "same.jsonl", "none.jsonl"))
    if naming == "orig":
        assert {s: min(p)[1] for s, p in found.items()} == {s: s for s in found}


def test_one_shard_per_writing_task(spark):
    r = records(spark, 400).withColumn("_shard", F.format_string("s%03d.jsonl", F.col("n") % 37))
    placed = dealt(sh.name_shards(r, "count", start=11), 37).select("_out", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(placed) == 37 == len({p["task"] for p in placed}) == len({p["_out"] for p in placed})
    # Fewer tasks than shards: dealt in turn, not by chance.
    some = dealt(sh.name_shards(r, "orig"), 10).select("_out", F.spark_partition_id().alias("task")).distinct()
    assert sorted(n for _, n in some.groupBy("task").count().collect()) == [3, 3, 3, 4, 4, 4, 4, 4, 4, 4]


def test_the_manifest_counts_only_committed_parts(spark, tmp_path):
    out = str(tmp_path)
    named = sh.name_shards(records(spark, 60), "count")
    write_jsonl(named, out, "first")
    write_jsonl(named.withColumn("_out", F.concat(F.lit("x"), "_out")), out, "second")
    stray = '{"shard": "stray", "num_uids": 1, "run": "first"}\n'
    for run in ("first", "third"):  # left by an attempt that was lost, and by a run that was
        os.makedirs(f"{out}/_manifest_parts/{run}", exist_ok=True)
        with open(f"{out}/_manifest_parts/{run}/lost.jsonl", "w") as file:
            file.write(stray)
    assert read_manifest(spark, out).groupBy("run").agg(F.sum("num_uids").alias("n")).orderBy("run").collect() == [("first", 60), ("second", 60)]
    write_jsonl(named.where("n < 30"), out, "first")  # a repeated run replaces its own part
    assert read_manifest(spark, out).groupBy("run").agg(F.sum("num_uids").alias("n")).orderBy("run").collect() == [("first", 30), ("second", 60)]
    assert "lost.jsonl" not in os.listdir(f"{out}/_manifest_parts/first")
    write_jsonl(named.where("n < 0"), out, "first")
    assert read_manifest(spark, out).select("run").distinct().collect() == [("second",)]


@pytest.mark.parametrize("output", ["jsonl", "tar"])
def test_the_same_bytes_from_any_partitioning(spark, tmp_path, output):
    digests = []
    for k in (1, 16):
        named = sh.name_shards(records(spark, 200).repartition(k), "count", output)
        write = write_jsonl if output == "jsonl" else write_tar_samples
        manifest = write(named, str(tmp_path / str(k)))
        digests.append({m["shard"]: m["sha256"] for m in manifest.collect()})
    assert digests[0] == digests[1] and len(digests[0]) == 3


def test_verification_finds_every_kind_of_damage(spark, tmp_path):
    write_tar_samples(sh.name_shards(records(spark, 40, 4), "count", "tar"), str(tmp_path))
    sh.require_verified(spark, str(tmp_path), [".tar"])
    with open(tmp_path / "00000001.tar", "ab") as file:
        file.write(b"x")
    os.rename(tmp_path / "00000002.tar", tmp_path / "00000009.tar")
    got = {r["shard"]: r["status"] for r in sh.verify_output(spark, str(tmp_path), [".tar"]).collect()}
    assert got == {"00000000.tar": "ok", "00000001.tar": "changed", "00000002.tar": "missing", "00000003.tar": "ok", "00000009.tar": "extra"}
    with pytest.raises(ValueError):
        sh.require_verified(spark, str(tmp_path), [".tar"])


def test_a_failing_write_leaves_no_shard_half_done(spark, tmp_path):
    named = sh.name_shards(records(spark, 50), "orig").repartition(1)
    bad = F.when(F.col("n") == 40, F.raise_error(F.lit("broken record"))).otherwise(F.col("text"))
    with pytest.raises(Exception, match="broken record"):
        write_chunks(named, bad, str(tmp_path / "out"), "run", shards=1)
    out = str(tmp_path / "out")
    assert os.listdir(f"{out}/_partial") == [] and not os.path.exists(f"{out}/_manifest")
    write_jsonl(named, out)
    assert read_manifest(spark, out).agg(F.sum("num_uids")).first()[0] == 50


def test_bfloat16_and_packed_vectors_in_files(spark, tmp_path):
    vectors = F.array(F.array(F.col("n").cast("float"), F.lit(1.00390625).cast("float")))
    r = records(spark, 10).withColumn("image_embedding", F.when(F.col("n") > 0, vectors))
    write_tar_samples(sh.name_shards(r, "count", "tar"), str(tmp_path / "t"), bfloat16=True)
    files = paths.list_files(spark, str(tmp_path / "t"), [".tar"])
    back = tar.read_tar_samples(spark, files, SCHEMA + ", image_emb ARRAY<ARRAY<FLOAT>>")
    rows = {x["n"]: x["image_emb"] for x in back.collect()}
    assert rows[0] is None and rows[3] == [[3.0, 1.0]]
    write_jsonl(sh.name_shards(r, "count"), str(tmp_path / "j"))
    packed = jsonl.read_jsonl(spark, [str(tmp_path / "j")], SCHEMA + ", image_emb STRING")
    from shardweave.functions.packing import unpack_embedding

    got = {x["n"]: x["v"] for x in packed.select("n", unpack_embedding(F.col("image_emb")).alias("v")).collect()}
    assert got[0] is None and got[3] == [[3.0, 1.00390625]]
    direct = jsonl.read_jsonl(spark, [str(tmp_path / "j")], SCHEMA + ", image_emb ARRAY<ARRAY<FLOAT>>")
    assert {x["n"]: x["image_emb"] for x in direct.collect()} == got
    (tmp_path / "plain.jsonl").write_text('{"uid": "a", "x_emb": [[1, 2.5]]}\n{"uid": "b", "x_emb": "odd"}\n')
    plain = jsonl.read_jsonl(spark, [str(tmp_path / "plain.jsonl")], "uid STRING, x_emb ARRAY<ARRAY<FLOAT>>")
    assert {x["uid"]: x["x_emb"] for x in plain.collect()} == {"a": [[1.0, 2.5]], "b": None}


def test_patterns(spark):
    expand = lambda p: [r["path"] for r in paths.shards_from_pattern(spark, p).collect()]
    assert expand("b/{08..11}.tar") == ["b/08.tar", "b/09.tar", "b/10.tar", "b/11.tar"]
    assert expand("{0..10..5}x{b..a}") == ["0xb", "0xa", "5xb", "5xa", "10xb", "10xa"]
    assert expand("a.tar::{x,y}{1..2}") == ["a.tar", "x1", "x2", "y1", "y2"]
    assert expand("{99999998..100000001}") == ["99999998", "99999999", "100000000", "100000001"]
    assert expand("plain.jsonl") == ["plain.jsonl"]


def test_manifest_name_is_required(spark, tmp_path):
    with pytest.raises(ValueError):
        paths.shards_from_manifest(spark, str(tmp_path / "other.json"))
    (tmp_path / "info.json").write_text('{"lengths": {"a b.jsonl": 0, "c.jsonl": "5"}, "name": "x"}')
    assert {r["path"] for r in paths.shard_paths(spark, str(tmp_path / "info.json")).collect()} == {"a b.jsonl", "c.jsonl"}


def test_folder_groups(spark):
    files = spark.range(25).select(F.format_string("f%02d", "id").alias("path"))
    groups = {}
    for r in paths.group_into_folders(files, 2).orderBy("path").collect():
        groups.setdefault(r["folder"], []).append(r["path"])
    assert list(groups) == [f"{i:02d}" for i in range(13)] and groups["12"] == ["f24"]
    assert {r["folder"] for r in paths.group_into_folders(files, -1).collect()} == {""}


def test_key_choice_and_names_while_reading(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"uid": "a", "text": "x", "n": 1}\n')
    listed = paths.list_files(spark, str(tmp_path), [".jsonl"])
    df = read_shards(spark, listed, SCHEMA, "uid|te", {"text": "caption"})
    assert df.columns == ["uid", "caption", "_shard", "_pos", "_rest"] and df.first()["_rest"] is None and df.first()["caption"] == "x"


def test_paths_with_blanks_and_plus_signs(spark, tmp_path):
    path = tmp_path / "a b+c%d.jsonl"
    path.write_text('{"uid": "a"}\n')
    listed = paths.list_files(spark, str(tmp_path), [".jsonl"])
    assert listed.first()["path"] == str(path)
    assert jsonl.read_lines(spark, [str(path)]).first()["_shard"] == str(path)


def test_small_ranges_share_a_task(spark):
    tiny = [(f"t/{i:05d}", 0, 10_000) for i in range(10_000)]
    large = [("big", i << 30, (i + 1) << 30) for i in range(3)]
    work = spark.createDataFrame(tiny + large, RANGES)
    dealt = packed(work).withColumn("task", F.spark_partition_id()).collect()
    assert sorted(tuple(r)[:3] for r in dealt) == sorted(tiny + large)
    tasks = {}
    for r in dealt:
        tasks.setdefault(r["task"], []).append(r["stop"] - r["start"])
    assert len(tasks) <= 64
    for sizes in tasks.values():  # a bin may exceed its size by its last range only
        assert sum(s + OPEN_BYTES for s in sizes[:-1]) <= TASK_BYTES + max(sizes) + OPEN_BYTES
    assert max(sum(s >= 1 << 30 for s in sizes) for sizes in tasks.values()) == 1


def test_few_small_ranges_use_all_cores(spark):
    work = spark.createDataFrame([(f"t/{i}", 0, 100) for i in range(64)], RANGES)
    tasks = packed(work).select(F.spark_partition_id()).distinct().count()
    assert tasks >= spark.sparkContext.defaultParallelism
    assert packed(work.limit(0)).count() == 0 and packed(work.limit(0)).columns == ["path", "start", "stop"]


def test_listing_by_levels(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(paths, "PAGE", 7)
    want = {}
    deep = tmp_path
    for level in range(6):
        deep = deep / f"level{level}"
        deep.mkdir()
        for i in range(level):
            (deep / f"_{i}.jsonl").write_text("x" * i)
            want[str(deep / f"_{i}.jsonl")] = i
    for i in range(40):
        (tmp_path / f"flat{i}").mkdir()
        (tmp_path / f"flat{i}" / ".h.jsonl").write_text("ab")
        want[str(tmp_path / f"flat{i}" / ".h.jsonl")] = 2
    for i in range(20):
        (tmp_path / f"{i}.jsonl").write_text("")
        want[str(tmp_path / f"{i}.jsonl")] = 0
    (tmp_path / "level0" / "level1" / "_ledger").mkdir()
    (tmp_path / "level0" / "level1" / "_ledger" / "x.jsonl").write_text("x")
    found = paths.list_files(spark, str(tmp_path), [".jsonl"], depth=2).collect()
    assert {r["path"]: r["bytes"] for r in found} == want and len(found) == len(want)
    groups = {r["path"]: r["group"] for r in found}
    assert groups[str(tmp_path / "level0" / "level1" / "_0.jsonl")] == "level0/level1"


def test_manifest_as_a_stream(spark, tmp_path, monkeypatch):
    lengths = {f"s3://b/{i:03d},:{{}}.tar": i for i in range(300)} | {'quote " and \\\\': 1, "größe\u2028": 2, "lengths": 3, "": 4}
    whole = {"other": {"x": [{"lengths": {"no": 1}}]}, "lengths": lengths, "total": 9, "more": {"y": 1}, "list": ["a", ":"]}
    for ascii_only, indent, block in ((True, None, 1), (False, 2, 7), (True, 1, 1 << 20)):
        text = json.dumps(whole, ensure_ascii=ascii_only, indent=indent).encode()
        pieces = (text[i : i + block] for i in range(0, len(text), block))
        assert list(paths._keys_of(pieces, "lengths")) == list(lengths)
        for cut in (text[:-1], text[: len(text) // 2], b"", b"  "):
            with pytest.raises(ValueError, match="whole JSON"):
                list(paths._keys_of(iter([cut]), "lengths"))
    assert list(paths._keys_of(iter([b'{"lengths": null, "n": {"a": 1}}']), "lengths")) == []
    monkeypatch.setattr(paths, "KEYS_PER_BATCH", 50)
    (tmp_path / "info.json").write_text(json.dumps(whole))
    assert [r["path"] for r in paths.shards_from_manifest(spark, str(tmp_path / "info.json")).collect()] == list(lengths)


def test_writers_get_batches_of_bounded_bytes(spark, tmp_path):
    """However many rows a shard has; the session's setting is as it was afterwards."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)

    @arrow_udf("string")
    def size(texts):
        return pa.array([f"{texts.nbytes}\n"] * len(texts), pa.string())

    text = F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), 1 << 16))
    rows = spark.range(600).select(F.lit("a").alias("_out"), F.lit("a").alias("_shard"), F.col("id").alias("_pos"), text.alias("text"))
    write_chunks(rows, F.encode(size("text"), "UTF-8"), str(tmp_path / "out"), "run", shards=1)
    sizes = [int(line) for line in (tmp_path / "out" / "a").read_text().split()]
    assert len(sizes) == 600 and max(sizes) <= 2 * BATCH_BYTES
    assert spark.conf.get(name) == before


def shuffle_files(spark):
    """Names of the shuffle files that the session holds."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    """They went only when the driver collected its garbage, so disk grew with all waves of a run."""
    rows = records(spark, 20_000, 4).withColumn("_out", F.col("_shard"))
    before = shuffle_files(spark)
    write_jsonl(rows, str(tmp_path / "lines"))
    write_tar_samples(rows.withColumn("_out", F.concat("_shard", F.lit(".tar"))), str(tmp_path / "tar"))
    end = time.monotonic() + 30
    while (left := [f for f in shuffle_files(spark) - before if os.path.exists(f)]) and time.monotonic() < end:
        time.sleep(0.2)
    assert not left


def test_packed_lines_are_read_across_frames(spark, tmp_path):
    """One frame a line, more of them than a block of the reader holds."""
    rows = spark.range(3000, numPartitions=1).select(F.lit("a.jsonl.zst").alias("_out"), F.lit("a").alias("_shard"), F.col("id").alias("_pos"))
    line = F.concat(F.to_json(F.struct(F.col("_pos").alias("n"), F.repeat(F.lit("x"), 5000).alias("t"))), F.lit("\n"))
    frames = rows.withColumn("frame", jsonl.zstd_frames(F.when(F.col("_pos") != 7, F.encode(line, "UTF-8")).otherwise(b"\n")))
    write_chunks(frames, F.col("frame"), str(tmp_path), "run", shards=1)
    back = jsonl.read_jsonl(spark, [str(tmp_path / "a.jsonl.zst")], "n BIGINT, t STRING").orderBy("_pos").select("n", F.length("t").alias("k"))
    assert [tuple(r) for r in back.collect()] == [(n, 5000) for n in range(3000) if n != 7]
    assert os.path.getsize(tmp_path / "a.jsonl.zst") < 1_000_000


def test_open_records_keeps_one_output_on_disk(spark, tmp_path):
    """Its input lies packed and in files of bounded size, and an output goes once it has been read back."""
    import duckdb

    from checks import ORACLES, QUERIES
    from shardweave.session import scratch_root
    from tests.compare import difference

    n = 12_000
    words = F.concat_ws(" ", *[F.substring(F.sha2(F.concat("id", F.lit(f"|{k}")), 256), 1, 5) for k in range(12)])
    documents = spark.range(n).select(
        (F.col("id") - F.col("id") % 50).alias("doc_id"),  # ids may repeat
        F.when(F.col("id") % 11 != 0, F.concat(words, F.lit(". "), words, F.lit("."))).alias("text"),
        F.when(F.col("id") % 7 != 0, "en").alias("lang"),
        F.lit("all").alias("source"),
        (F.col("id") % 1000).alias("n_chars"),
    )
    documents.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    known = set(os.listdir(scratch_root(spark)))
    got = QUERIES["open_records"](spark, str(tmp_path)).toPandas()
    new = set(os.listdir(scratch_root(spark))) - known
    assert not [name for name in new if re.match(r"open-(jsonl|wds)-[0-9a-f]{32}$", name)]
    (folder,) = [name for name in new if re.match(r"open-[0-9a-f]{32}$", name)]
    folder = os.path.join(scratch_root(spark), folder)
    files = [os.path.join(folder, f) for f in os.listdir(folder) if not f.startswith("_")]
    # Each line holds the text twice.
    texts = documents.agg(F.sum(F.length("text"))).first()[0]
    assert len(files) > 1 and sum(map(os.path.getsize, files)) < 1.25 * texts
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert difference(got, con.execute(ORACLES["open_records"]).df()) is None
