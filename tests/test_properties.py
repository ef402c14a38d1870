"""Round trips on generated values."""

import io
import tarfile

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardweave.functions.packing import matrices_of, matrices_to_arrow, npz_arrays, npz_bytes, pack_matrix, unpack_matrix
from shardweave.plans import config as cf
from shardweave.plans.augment_plan import compress_draws, decompress_draws, plan_draws
from shardweave.sources.tar import TAR_TRAILER, split_member, tar_entry
from shardweave.sources.tfrecord import parse_record

floats = st.floats(width=32, allow_nan=False, allow_infinity=False)


@st.composite
def matrices(draw):
    rows, cols = draw(st.integers(0, 4)), draw(st.integers(1, 5))
    values = draw(st.lists(floats, min_size=rows * cols, max_size=rows * cols))
    return np.array(values, np.float32).reshape(rows, cols)


@given(matrices())
def test_packed_matrices(m):
    assert (unpack_matrix(pack_matrix(m)) == m).all() and pack_matrix(m) == pack_matrix(m.copy())
    if len(m):
        assert (npz_arrays(npz_bytes({"x": m}))["x"] == m).all()


@given(st.lists(st.one_of(st.none(), matrices()), max_size=6))
def test_matrices_through_arrow(ms):
    back = matrices_of(matrices_to_arrow(ms))
    for a, b in zip(ms, back, strict=True):
        assert (a is None) == (b is None)
        if a is not None and len(a):
            assert (a == b).all()


def test_sliced_arrays_keep_their_rows():
    ms = [np.full((i, 2), i, np.float32) for i in range(1, 6)]
    back = matrices_of(matrices_to_arrow(ms).slice(2, 2))
    assert [m.tolist() for m in back] == [ms[2].tolist(), ms[3].tolist()]


names = st.text(st.characters(codec="utf-8", exclude_characters="/\0", exclude_categories=("Cs",)), min_size=1, max_size=140)


@given(st.lists(st.tuples(names, st.binary(max_size=1500)), max_size=5))
def test_tar_entries_are_read_by_any_tar_reader(members):
    data = b"".join(tar_entry(name, content) for name, content in members) + TAR_TRAILER
    with tarfile.open(fileobj=io.BytesIO(data)) as archive:
        got = [(m.name, archive.extractfile(m).read()) for m in archive]
    assert [c for _, c in got] == [c for _, c in members]
    assert [n.rstrip("/") for n, _ in got] == [n.rstrip("/") for n, _ in members]


@pytest.mark.parametrize(
    "name, parts",
    [("k.syn.json", ("k", "syn.json")), ("a.b/k.jpg", ("a.b/k", "jpg")), ("k", ("k", "")), ("d/.hidden", ("d/", "hidden"))],
)
def test_member_names(name, parts):
    assert split_member(name) == parts


@given(st.text(max_size=20), st.integers(0, 2**40), st.binary(max_size=50), st.lists(floats, max_size=4))
@settings(max_examples=50)
def test_feature_records(text, number, image, weights):
    from checks.files import _example

    features = dict(parse_record(_example(text, "en", number, image, weights)[12:-4]))
    assert features["uid"]["bytes"] == [text.encode()] and features["n_chars"]["ints"] == [number]
    assert features["image"]["bytes"] == [image] and features["weights"]["floats"] == weights


STEPS = {
    "resize": {"size": 40},
    "random_crop": {"size": 32},
    "random_resized_crop": {"size": 24},
    "random_horizontal_flip": {"p": 0.3},
    "rand_augment": {"p": 0.6},
    "random_erase": {"p": 0.5},
    "mixup": {"p": 0.5},
    "cutmix": {"p": 0.5, "alpha": 0.3},
}


@pytest.mark.parametrize("names", [list(STEPS), ["rand_augment"], ["random_crop", "cutmix"], ["resize", "random_erase", "mixup"]])
@pytest.mark.parametrize("paired", [False, True])
def test_every_stored_plan_reads_back(spark, names, paired):
    config = {n: STEPS[n] for n in names}
    steps = cf.steps_from_config(config)
    ids = spark.range(60).select(F.format_string('u"%d\\', "id").alias("uid"))
    second = (48, 52) if paired else None
    planned = plan_draws(ids, config, 2, 3, "uid", 64, 56, second_shape=second)
    id2 = F.col("uid") if paired else None
    stored = planned.withColumn("text", compress_draws(F.col("params"), steps, id2))
    for row in stored.withColumn("again", decompress_draws(F.col("text"), steps, paired)).collect():
        for was, now in zip(row["params"], row["again"]):
            mixed = paired and any(was[s.name] is not None for s in steps if s.mixes)
            if paired and any(s.mixes for s in steps):
                assert now["id2"] == (row["uid"] if mixed else None)
            for step in steps:
                if step.mixes:
                    if paired:
                        assert now[step.name] == was[step.name]
                elif paired:
                    assert now[step.name]["a"] == was[step.name]["a"]
                    if mixed or not any(s.mixes for s in steps):
                        assert now[step.name]["b"] == was[step.name]["b"] or not mixed
                else:
                    assert now[step.name] == was[step.name]
