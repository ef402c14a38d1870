"""Pixel work: NumPy kernels against loops, the native form against the batch form."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardweave.functions import tensor as px
from shardweave.operators import augment, kernels
from shardweave.operators.infer import add_image_embeddings, check_ensemble, resample
from shardweave.operators.teachers import HashClip, TeacherSpec
from shardweave.plans import config as cf
from shardweave.plans.augment_plan import compress_draws, decompress_draws, plan_draws

RNG = np.random.default_rng(5)


def image(h=9, w=7, c=3):
    return RNG.integers(0, 256, (h, w, c)).astype(np.float32)


def frame(spark, arrays):
    rows = [
        (str(i), None if a is None else (a.shape[0], a.shape[1], a.shape[2], a.ravel().tolist()))
        for i, a in enumerate(arrays)
    ]
    return spark.createDataFrame(rows, f"uid STRING, image {px.TENSOR}")


def as_array(t):
    return np.array(t["data"], np.float32).reshape(t["h"], t["w"], t["c"])


def test_sharpness_by_loops():
    im = image()
    got = kernels.augment_op(im, "Sharpness", 0.5)
    h, w, c = im.shape
    for r in range(h):
        for k in range(w):
            for ch in range(c):
                blurred = float(im[r, k, ch])
                if 0 < r < h - 1 and 0 < k < w - 1:
                    total = sum(float(im[r + i, k + j, ch]) for i in (-1, 0, 1) for j in (-1, 0, 1))
                    blurred = round((total + 4 * float(im[r, k, ch])) / 13)
                want = math.floor(min(max(1.5 * float(im[r, k, ch]) - 0.5 * blurred, 0), 255))
                assert abs(got[r, k, ch] - want) <= 1e-6


def test_equalize_by_loops():
    im = np.floor(image(40, 40, 2) / 3)
    got = kernels.augment_op(im, "Equalize", 0.0)
    for ch in range(2):
        counts = [int((im[..., ch] == v).sum()) for v in range(256)]
        used = [n for n in counts if n]
        step = sum(used[:-1]) // 255
        table, before = [], 0
        for n in counts:
            table.append(min((before + step // 2) // step, 255))
            before += n
        want = np.vectorize(lambda v: table[int(v)])(im[..., ch])
        assert (got[..., ch] == want).all()


def test_color_contrast_and_autocontrast_by_loops():
    im = image(5, 4)
    grey = np.floor(im @ np.array([0.2989, 0.587, 0.114]))
    colour = np.floor(np.clip(1.4 * im - 0.4 * grey[..., None], 0, 255))
    assert np.abs(kernels.augment_op(im, "Color", 0.4) - colour).max() <= 1
    contrast = np.floor(np.clip(0.6 * im + 0.4 * grey.mean(), 0, 255))
    assert np.abs(kernels.augment_op(im, "Contrast", -0.4) - contrast).max() <= 1
    auto = kernels.augment_op(im, "AutoContrast", 0.0)
    assert (auto.min(axis=(0, 1)) == 0).all() and (auto.max(axis=(0, 1)) == 255).all()


def test_rotation_by_a_quarter_turn_is_exact():
    im = image(6, 6)
    assert (kernels.augment_op(im, "Rotate", 90.0) == np.rot90(im)).all()


@pytest.mark.parametrize("mode", ["bilinear", "bicubic", "cubic"])
def test_interpolated_operations(mode):
    im = image(6, 7)

    def value(r: float, k: float, ch: int) -> float:
        total = 0.0
        for i in range(6):
            for j in range(7):
                near = [abs(r - i), abs(k - j)]
                if mode == "bilinear":
                    total += max(0.0, 1 - near[0]) * max(0.0, 1 - near[1]) * im[i, j, ch]
                else:
                    total += float(kernels._cubic(near[0]) * kernels._cubic(near[1])) * im[i, j, ch]
        return min(max(total, 0.0), 255.0)

    got = kernels.augment_op(im, "ShearX", 0.3, mode)
    want = [[[value(i, j + 0.3 * (i + 0.5), ch) for ch in range(im.shape[2])] for j in range(7)] for i in range(6)]
    assert np.abs(got - want).max() <= 0.5 + 1e-6 and (got == np.rint(got)).all()
    # Whole shifts and quarter turns are the same in every mode, other operations do not look at it.
    square = image(6, 6)
    for op, m in (("TranslateX", 2.0), ("TranslateY", -3.0), ("Rotate", 90.0), ("Color", 0.4)):
        assert (kernels.augment_op(square, op, m, mode) == kernels.augment_op(square, op, m)).all()


def test_modes_that_cannot_warp_are_an_error():
    with pytest.raises(ValueError, match="lanczos"):
        kernels.augment_op(image(), "Rotate", 10.0, "lanczos")


def test_interpolation_of_policies(spark):
    config = {"rand_augment": {"p": 1.0}}
    assert cf.steps_from_config(config)[0].args.get("interpolation") is None
    assert cf.steps_from_config(config, cf.TEACHER_ORDER)[0].args["interpolation"] == "bilinear"
    asked = cf.steps_from_config({"trivial_augment_wide": {"interpolation": "nearest"}}, cf.TEACHER_ORDER)
    assert asked[0].args["interpolation"] == "nearest"
    im = image(6, 6)
    ops = F.array(F.struct(F.lit(5).alias("op"), F.lit(20.0).alias("magnitude")))
    for mode in ("nearest", "bilinear", "bicubic"):
        done = augment.apply_rand_augment(frame(spark, [im]).withColumn("ops", ops), "image", "ops", "out", mode)
        assert (as_array(done.first()["out"]) == kernels.augment_op(im, "Rotate", 20.0, mode)).all()


@pytest.mark.parametrize("op", ["Identity", "Solarize", "Invert"])
def test_point_operations_keep_the_range(op):
    out = kernels.augment_op(image(), op, 100.0)
    assert out.min() >= 0 and out.max() <= 255


def test_unknown_operation_is_an_error():
    with pytest.raises(ValueError):
        kernels.augment_op(image(), "Twirl", 1.0)


@pytest.mark.parametrize("mode", ["nearest", "bilinear", "bicubic"])
def test_resampling_weights_sum_to_one(mode):
    for source, target in ((8, 5), (5, 8), (7, 7)):
        weights = kernels.resample_weights(source, target, mode)
        assert np.allclose(weights.sum(axis=1), 1)
    same = image()
    assert np.allclose(kernels.resample(same, same.shape[:2], mode), same, atol=1e-3)


def test_resample_groups_shapes_and_keeps_nulls(spark):
    arrays = [image(8, 8, 1), None, image(4, 6, 1)]
    rows = resample(frame(spark, arrays), "image", (3, 3), "small").orderBy("uid").collect()
    assert rows[1]["small"] is None
    for row, a in ((rows[0], arrays[0]), (rows[2], arrays[2])):
        assert np.allclose(as_array(row["small"]), kernels.resample(a, (3, 3)), atol=1e-3)


CONFIGS = [
    {"uint8": {}, "center_crop": {"size": [5, 9]}, "random_horizontal_flip": {}},
    {"random_crop": {"size": 12, "pad_if_needed": True}, "random_erase": {"p": 1.0}},
    {"random_resized_crop": {"size": [4, 6], "interpolation": "nearest"}, "to_tensor": {}},
    {"resize": {"size": 5, "interpolation": "nearest"}, "normalize": {"mean": [1, 2, 3], "std": [4, 5, 6]}},
]


@pytest.mark.parametrize("config", CONFIGS)
def test_native_and_batch_forms_agree(spark, config):
    steps = cf.steps_from_config(config)
    df = frame(spark, [image() for _ in range(6)] + [image(11, 10)])
    df = df.withColumn("height", F.col("image.h")).withColumn("width", F.col("image.w"))
    planned = plan_draws(df, config, 3, 9, "uid", F.col("height"), F.col("width"))
    views = F.transform(F.col("params"), lambda p: augment.apply_geometry(F.col("image"), steps, p))
    both = planned.withColumn("native", views)
    for row in augment.apply_views(both, steps, "image", "params", "batch").collect():
        for a, b in zip(row["native"], row["batch"]):
            assert (a["h"], a["w"], a["c"]) == (b["h"], b["w"], b["c"])
            assert np.allclose(a["data"], b["data"], atol=1e-5)


def test_replay_from_stored_text_gives_the_same_views(spark):
    config = {"random_resized_crop": {"size": 6}, "rand_augment": {"p": 0.8}, "random_erase": {}, "to_tensor": {}}
    steps = cf.steps_from_config(config)
    planned = plan_draws(frame(spark, [image() for _ in range(20)]), config, 2, 9, "uid", 9, 7)
    stored = planned.withColumn("text", compress_draws(F.col("params"), steps))
    read = stored.withColumn("again", decompress_draws(F.col("text"), steps))
    first = augment.apply_views(read, steps, "image", "params", "v1")
    for row in augment.apply_views(first, steps, "image", "again", "v2").collect():
        assert row["v1"] == row["v2"]


def test_missing_images_have_no_views(spark):
    config = {"random_horizontal_flip": {}}
    steps = cf.steps_from_config(config)
    planned = plan_draws(frame(spark, [image(), None]), config, 2, 9, "uid", 9, 7)
    rows = augment.apply_views(planned, steps, "image", "params").orderBy("uid").collect()
    assert len(rows[0]["views"]) == 2 and rows[1]["views"] is None


def test_pair_size_override(spark):
    config = {"random_resized_crop": {"size": 6, "interpolation": "nearest"}}
    steps = cf.steps_from_config(config)
    df = frame(spark, [image(8, 8, 1)]).withColumn("image2", F.col("image"))
    planned = plan_draws(df, config, 1, 9, "uid", 8, 8, second_shape=(8, 8), second_crop=4)
    p = F.get("params", F.lit(0))
    shape = lambda replay: planned.select(
        augment.apply_pair(F.col("image"), F.col("image2"), steps, p, 4, replay).alias("v")
    ).first()["v"]["h"]
    assert shape(False) == 6  # the override goes to the second image
    assert shape(True) == 4  # on replay to the first


def test_skipped_mixing_keeps_only_the_first_image(spark):
    config = {"random_horizontal_flip": {}, "mixup": {"p": 0.0}}
    steps = cf.steps_from_config(config)
    planned = plan_draws(frame(spark, [image()]), config, 1, 9, "uid", 9, 7, second_shape=(9, 7))
    text = planned.select(compress_draws(F.col("params"), steps, F.lit("partner"))).first()[0][0]
    assert text in ("[null,true,null]", "[null,false,null]")
    alone = plan_draws(frame(spark, [image()]), config, 1, 9, "uid", 9, 7)
    assert alone.select(compress_draws(F.col("params"), steps)).first()[0][0] == text


def test_configuration_rules():
    config = {"normalize": {"mean": [0], "std": [1]}, "resize": {"size": 4, "enable": False}, "to_rgb": {"enable": True},
              "random_crop": {"enable": True, "size": 3}}
    steps = cf.steps_from_config(config)
    assert [s.name for s in steps] == ["random_crop", "normalize"]
    assert steps[0].args == {"size": 3}
    assert [s.name for s in cf.steps_from_config({"auto_augment": {}, "uint8": {}}, cf.TEACHER_ORDER)] == ["auto_augment"]
    preset = cf.preset_config({"input_size": (3, 224, 224), "test_input_size": (3, 288, 288), "crop_pct": 0.95,
                               "mean": (0.5,), "std": (0.5,), "interpolation": "bicubic"})
    assert preset["resize"]["size"] == 303 and preset["random_crop"] == {"size": 288, "pad_if_needed": True}


def test_ensemble_rules():
    steps = cf.steps_from_config({"random_resized_crop": {"size": 224}, "normalize": {"mean": [0.5], "std": [1]}})
    check_ensemble([TeacherSpec(HashClip, {"dim": 2}, (224, 224), (0.5,))], steps)
    with pytest.raises(ValueError):
        check_ensemble([TeacherSpec(HashClip, {"dim": 2}, (256, 224), (0.5,))], steps)
    with pytest.raises(ValueError):
        check_ensemble([TeacherSpec(HashClip, {"dim": 2}, (224, 224), (0.4,))], steps)


def test_every_record_gets_its_own_vectors(spark):
    config = {"random_resized_crop": {"size": 6}, "to_tensor": {}}
    arrays = [image() for _ in range(25)] + [None]
    teachers = [TeacherSpec(HashClip, {"dim": 3}), TeacherSpec(HashClip, {"dim": 2}, (4, 4))]
    results = []
    for batch_size, partitions in ((2, 1), (64, 7)):
        df = frame(spark, arrays).repartition(partitions)
        e = add_image_embeddings(df, teachers, 2, config, 3, batch_size=batch_size)
        results.append({r["uid"]: r["image_emb"] for r in e.collect()})
    assert results[0]["25"] is None and len({str(v) for v in results[0].values()}) == 26
    for uid, vectors in results[0].items():
        if vectors is not None:
            assert np.allclose(vectors, results[1][uid], atol=1e-4) and len(vectors[0]) == 5


def test_erasing_falls_back_to_the_whole_image(spark):
    from shardweave.functions.draws import Draws
    from shardweave.plans.geometry import random_erase_plan

    box = random_erase_plan(Draws(1, F.col("id"), F.lit(0)), 4, 4, p=1.0, scale=(0.99, 1.0), ratio=(0.9, 1.1))
    rows = spark.range(20).select(box.alias("b")).collect()
    assert all(tuple(r["b"]) == (0, 0, 4, 4) for r in rows)


def test_drawn_operations_run_in_their_order(spark):
    from shardweave.plans.policies import ALL_OPS

    config = {"rand_augment": {"p": 0.9, "num_ops": 3}, "to_tensor": {}}
    arrays = [image(6, 5) for _ in range(30)]
    planned = plan_draws(frame(spark, arrays), config, 2, 4, "uid", 6, 5)
    seen = set()
    for row in augment.apply_views(planned, cf.steps_from_config(config), "image", "params").collect():
        for view, params in zip(row["views"], row["params"]):
            want = arrays[int(row["uid"])]
            for op in params["rand_augment"] or ():
                seen.add(op["op"])
                want = kernels.augment_op(want, ALL_OPS[op["op"]], op["magnitude"])
            assert np.allclose(as_array(view), want / np.float32(255), atol=1e-6)
    assert len(seen) == 14


def test_steps_in_front_of_a_teacher(spark):
    preset = {"input_size": (3, 6, 6), "crop_pct": 0.75, "mean": (0.5,) * 3, "std": (0.25,) * 3, "interpolation": "bilinear"}
    config = {
        "timm_resize_crop_norm": {"name": "t"},
        "resize": {"size": 99},
        "auto_augment": {"policy": "cifar10"},
        "trivial_augment_wide": {},
        "to_tensor": {},
    }
    steps = cf.steps_from_config(config, cf.TEACHER_ORDER, {"t": preset})
    assert [s.name for s in steps] == ["resize", "random_crop", "auto_augment", "trivial_augment_wide", "to_tensor", "normalize"]
    assert steps[0].args == {"size": 8, "interpolation": "bilinear"}
    planned = plan_draws(frame(spark, [image(20, 11) for _ in range(8)]), steps, 2, 3, "uid", 20, 11)
    stored = planned.withColumn("again", decompress_draws(compress_draws(F.col("params"), steps), steps))
    for row in augment.apply_views(stored, steps, "image", "params").collect():
        assert row["again"] == row["params"]
        assert all((v["h"], v["w"], v["c"]) == (6, 6, 3) for v in row["views"])
        assert all(len(p["trivial_augment_wide"]) == 1 and len(p["auto_augment"]) <= 2 for p in row["params"])
