"""Edge cases of record shaping."""

import base64

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardweave.functions import text as tx
from shardweave.functions.packing import npz_arrays, npz_bytes, pack_embedding, unpack_embedding
from shardweave.functions.tensor import to_bfloat16
from shardweave.operators import infer, records
from shardweave.operators.teachers import HashCaption, HashText, TeacherSpec


def test_strict_base64(spark):
    good = base64.b64encode(b"payload").decode()
    cases = {
        good: b"payload",
        "": b"",
        None: b"",
        good.rstrip("="): None,  # missing padding
        good[:4] + "\n" + good[4:]: None,
        good + "\n": None,
        "@@@@": None,
        "aGk=aGk=": None,
        base64.b64encode(bytes(300_000)).decode(): bytes(300_000),
    }
    df = spark.createDataFrame([(i, v) for i, v in enumerate(cases)], "i INT, image STRING")
    got = {r["i"]: r["b"] for r in df.select("i", tx.image_bytes(F.col("image"), "string").alias("b")).collect()}
    for i, want in enumerate(cases.values()):
        assert (None if got[i] is None else bytes(got[i])) == want


def test_images_of_other_types(spark):
    df = spark.createDataFrame([(b"raw", 5), (None, 6)], "image BINARY, n INT")
    rows = records.flag_valid(df).orderBy("n").collect()
    assert [(r["_valid"], r["_reason"]) for r in rows] == [(True, None), (False, "empty")]
    assert records.flag_valid(df.drop("image")).filter("_valid").count() == 0
    assert records.flag_valid(df, "n").filter("_valid").count() == 0


def test_caption_rules(spark):
    rows = [
        ("a", "cap", None, None),
        ("b", "cap", "text", None),
        ("c", "cap", None, ["cap"]),
        ("d", "cap", None, ["other"]),
        ("e", None, "text", ["t1"]),
        ("f", None, None, None),
    ]
    df = spark.createDataFrame(rows, "uid STRING, caption STRING, text STRING, texts ARRAY<STRING>")
    got = {r["uid"]: r for r in records.unify_text(df).collect()}
    assert {u for u, r in got.items() if not r["_valid"]} == {"b", "d"}
    assert got["a"]["text"] == got["c"]["text"] == "cap" and got["c"]["texts"] is None
    assert got["b"]["text"] == "text" and got["d"]["texts"] == ["other"]
    assert got["e"]["text"] == "text" and got["f"]["text"] is None


def test_list_captions(spark):
    df = spark.createDataFrame([("a", ["x", "y"], None), ("b", ["x"], ["x"])], "uid STRING, caption ARRAY<STRING>, texts ARRAY<STRING>")
    rows = records.unify_text(df).orderBy("uid").collect()
    assert rows[0]["text"] == ["x", "y"] and rows[1]["_valid"] and rows[1]["texts"] is None


def test_records_without_captions_are_left_alone(spark):
    df = spark.createDataFrame([("a", "t")], "uid STRING, text STRING")
    assert records.unify_text(df).columns == df.columns


def test_texts_and_their_vectors(spark):
    rows = [
        ("a", "one two", ["three"], ["s1", "s2"], True),
        ("b", None, None, None, True),
        ("c", "x", None, [], True),
        ("d", "y", ["z"], ["w"], False),
    ]
    df = spark.createDataFrame(
        rows, "uid STRING, text STRING, texts ARRAY<STRING>, syn_text ARRAY<STRING>, _valid BOOLEAN"
    )
    texts = records.collect_texts(df)
    spec = [TeacherSpec(HashText, {"dim": 4})]
    e = infer.split_text_embeddings(infer.add_text_embeddings(texts, spec, batch_size=2), ["text", "texts", "syn_text"], "_v")
    got = {r["uid"]: r for r in e.collect()}
    assert [len(got["a"][f"{k}_emb_v"]) for k in ("text", "texts", "syn_text")] == [1, 1, 2]
    assert got["a"]["syn_text_emb_v"][1] == HashText(4).embed_texts(["s2"])[0].tolist()
    assert got["b"]["text_emb_v"] is None and got["b"]["_texts"] == []
    assert got["c"]["syn_text_emb_v"] == [] and len(got["c"]["text_emb_v"]) == 1
    assert all(got["d"][f"{k}_emb_v"] is None for k in ("text", "texts", "syn_text"))


def test_models_see_full_batches(spark):
    """However small Arrow's own batches are."""
    import pyarrow as pa

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(0, 100, 1, 1).select("id")
        seen = infer.infer(df, TeacherSpec(CountRows), 30, "id LONG, rows LONG").orderBy("id").collect()
        assert [r["id"] for r in seen] == list(range(100)) and [r["rows"] for r in seen] == [30] * 90 + [10] * 10
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    batches = [(pa.array(range(k, k + n), pa.int64()), pa.array(["x"] * n, pa.string())) for k, n in ((0, 3), (3, 0), (3, 9), (12, 1))]
    found = [a.to_pylist() for a, _ in infer.full_batches(iter(batches), 5)]
    assert found == [[0, 1, 2, 3, 4], [5, 6, 7, 8, 9], [10, 11, 12]]


class CountRows:
    """Returns the size of the batch beside each row."""

    def __call__(self, pdf):
        return pdf.assign(rows=len(pdf))


def test_a_batch_without_any_valid_record(spark):
    df = spark.createDataFrame([("a", "@@@"), ("b", "")], "uid STRING, image STRING").coalesce(1)
    captioned = infer.add_captions(records.flag_valid(df), TeacherSpec(HashCaption), 2)
    assert [r["syn_text"] for r in captioned.collect()] == [None, None]


class Picky:
    """Cannot decode the image b"bad"."""

    def captions(self, images, draws):
        return [None if im == b"bad" else "seen" for im in images]


def test_an_image_the_teacher_cannot_decode(spark):
    df = spark.createDataFrame([("a", b"bad"), ("b", b"good")], "uid STRING, image BINARY").coalesce(1)
    captioned = infer.add_captions(records.flag_valid(df), TeacherSpec(Picky), 2).orderBy("uid")
    assert [r["syn_text"] for r in captioned.collect()] == [None, ["seen", "seen"]]


def test_caption_cleaning(spark):
    cases = {
        "x<start_of_text>a cat. a dog<end_of_text>junk": "a cat",
        "a cat \t\n": "a cat",
        "<start_of_text>one<start_of_text>two <end_of_text>": "two",
        "<end_of_text>gone": "",
        ".": "",
        "thin space ": "thin space",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t STRING")
    got = {r["t"]: r["c"] for r in df.select("t", tx.clean_caption(F.col("t")).alias("c")).collect()}
    assert got == cases


def test_key_choice(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "syn_text INT, my_syn INT, text INT, _shard INT")
    assert records.select_keys(df, "syn|te").columns == ["syn_text", "text", "_shard"]
    assert records.select_keys(df, ".*").columns == records.select_keys(df, None).columns == df.columns


def test_record_ids_are_never_null(spark):
    df = spark.createDataFrame([("u", "i", 1), (None, "i", 2), (None, None, 3)], "uid STRING, id STRING, n INT")
    ids = [[r["uid"] for r in records.record_id(df.repartition(k)).orderBy("n").collect()] for k in (1, 3)]
    assert ids[0] == ids[1] and ids[0][:2] == ["u", "i"] and len(ids[0][2]) == 32


def test_packed_embeddings(spark):
    df = spark.createDataFrame([([[1.5, -2.25], [0.1, 3e38]],), ([],), (None,)], "v ARRAY<ARRAY<FLOAT>>")
    rows = df.select("v", unpack_embedding(pack_embedding(F.col("v"))).alias("w")).collect()
    assert all(r["v"] == r["w"] for r in rows)


def test_bfloat16_is_the_rounded_upper_half(spark):
    rng = np.random.default_rng(1)
    x = (rng.standard_normal(4000) * np.exp2(rng.integers(-100, 100, 4000))).astype(np.float32)
    x = np.concatenate([x, np.float32([0, -0.0, 1, 1.00390625, 255.5, 3.38e38, np.inf, -np.inf])])
    bits = x.view(np.uint32).astype(np.uint64)
    want = (((bits + 0x7FFF + ((bits >> 16) & 1)) >> 16) << 16).astype(np.uint32).view(np.float32)
    want = np.where(np.isinf(x), x, want)
    df = spark.createDataFrame([(x.tolist(),)], "v ARRAY<FLOAT>")
    got = np.array(df.select(to_bfloat16(F.col("v"))).first()[0], np.float32)
    assert (got == want).all()


def test_npz_keeps_bfloat16_values_exactly():
    x = np.float32([[1.0, -0.5], [3.140625, 0.0]])
    assert (npz_arrays(npz_bytes({"a": x}, True))["a"] == x).all()
    assert (npz_arrays(npz_bytes({"a": x + np.float32(1e-3)}))["a"] == x + np.float32(1e-3)).all()


def test_members_of_a_record(spark):
    row = ("k1", "http://u", b"img", "cap", None, ["s"], ["old"], [0.5, 1.0], "[1]", 7)
    df = spark.createDataFrame(
        [row],
        "id STRING, url STRING, image BINARY, caption STRING, text STRING, syn_text ARRAY<STRING>,"
        " my_captions_v1 ARRAY<STRING>, image_embedding ARRAY<FLOAT>, param_aug STRING, extra INT",
    )
    got = records.to_members(df).first()
    m = {k: bytes(v) for k, v in got["_members"].items()}
    assert got["_key"] == "k1"
    assert set(m) == {"url.txt", "jpg", "txt", "syn.json", "npz", "paug.json", "json"}
    assert m["txt"] == b"cap" and m["json"] == b'{"extra":7}'
    assert m["syn.json"] == b'{"syn_text":["s"],"my_captions_v1":["old"]}'
    assert npz_arrays(m["npz"])["image_emb"].tolist() == [[0.5, 1.0]]


def test_caption_schema_errors():
    with pytest.raises(ValueError):
        TeacherSpec(HashText, {"dim": 0}) and infer.check_ensemble([TeacherSpec(HashText, {}, (8, 8))], [])
