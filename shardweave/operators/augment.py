"""Applying planned parameters to images.

The same functions serve the first application and every replay: they read parameters as data, and
a null or absent parameter means that the step was skipped. The ``*_native`` forms are expressions
over tensor columns; :func:`apply_views` does the same work on Arrow batches with NumPy and also
knows the policy operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shardweave.functions import tensor as px
from shardweave.functions.draws import let
from shardweave.operators import kernels
from shardweave.plans import mixing
from shardweave.plans.config import Step, as_pair
from shardweave.plans.geometry import resize_target
from shardweave.plans.policies import ALL_OPS

# Images whose views are built before they are handed back to Spark.
SLICE = 256


def _apply_step(step: Step, image: Column, value: Column | None, size=None) -> Column:
    """One image step; ``value`` holds its parameters, ``size`` replaces the configured crop size."""
    args = step.args
    if step.name == "uint8":
        return px.to_uint8(image)
    if step.name == "to_tensor":
        return px.to_tensor(image)
    if step.name == "normalize":
        return px.normalize(image, args["mean"], args["std"])
    if step.name == "center_crop":
        return px.center_crop(image, *step.size())
    if "size" in args and step.name in ("resize", "random_resized_crop") and args.get("interpolation", "bilinear") != "nearest":
        raise ValueError(f"{step.name} resizes natively by nearest pixels only, use apply_views")
    if step.name == "resize":
        return px.resize_nearest(image, *resize_target(image["h"], image["w"], args["size"]))
    if step.name == "random_crop":
        h, w = step.size()
        pad = args.get("pad_if_needed", False)
        shift_h = F.greatest(F.lit(h) - image["h"], F.lit(0)) if pad else F.lit(0)
        shift_w = F.greatest(F.lit(w) - image["w"], F.lit(0)) if pad else F.lit(0)
        return px.crop(image, value["top"] - shift_h, value["left"] - shift_w, h, w)
    if step.name == "random_resized_crop":
        cut = px.crop(image, value["top"], value["left"], value["h"], value["w"])
        h, w = as_pair(size) if size is not None else step.size()
        return let(cut, lambda c: px.resize_nearest(c, h, w))
    if step.name == "random_horizontal_flip":
        return px.hflip(image, value)
    if step.name == "random_erase":
        return px.erase(image, value)
    raise ValueError(f"{step.name} has no native form, use apply_views")


def _guarded(step: Step, image: Column, value: Column | None, size=None) -> Column:
    applied = _apply_step(step, image, value, size)
    return applied if value is None else F.when(value.isNull(), image).otherwise(applied)


def apply_geometry(image: Column, steps: list[Step], params: Column, size=None) -> Column:
    """Run the image steps natively (nearest-pixel resizing)."""
    todo = [s for s in steps if not s.mixes]
    if not todo:
        return image
    first, rest = todo[0], todo[1:]
    value = params[first.name] if first.has_params else None
    done = _guarded(first, image, value, size)
    return let(done, lambda im: apply_geometry(im, rest, params, size)) if rest else done


def apply_pair(
    image: Column, second: Column, steps: list[Step], params: Column, size=None, replay: bool = False
) -> Column:
    """Run all steps on two images with separate parameters, then mix the second into the first.

    A crop ``size`` override reaches the second image on first application and the first image on
    replay.
    """

    def side(im: Column, which: str, override) -> Column:
        todo = [s for s in steps if not s.mixes]

        def run(current: Column, left: list[Step]) -> Column:
            if not left:
                return current
            step = left[0]
            value = params[step.name][which] if step.has_params else None
            done = _guarded(step, current, value, override)
            return let(done, lambda x: run(x, left[1:]))

        return run(im, todo)

    first = side(image, "a", size if replay else None)
    other = side(second, "b", None if replay else size)

    def mix(pair: Column) -> Column:
        mixed = pair["first"]
        for step in steps:
            if step.name == "mixup":
                mixed = mixing.mixup(mixed, pair["other"], params["mixup"])
            elif step.name == "cutmix":
                mixed = mixing.cutmix(mixed, pair["other"], params["cutmix"])
        return mixed

    return let(F.struct(first.alias("first"), other.alias("other")), mix)


def reapply(df: DataFrame, steps: list[Step], image: str, params: str, out: str = "views") -> DataFrame:
    """Add ``out``: one view per stored draw, by the same code as the first time (:func:`apply_views`), so for
    every step, policy and interpolation the same pixels."""
    return apply_views(df, steps, image, params, out)


def view_of(image: np.ndarray, steps: list[Step], params: dict) -> np.ndarray:
    """One augmented view as (h, w, c) float32."""
    for step in steps:
        value = params.get(step.name) if step.has_params else True
        if value is None or step.mixes:
            continue
        args = step.args
        if step.name == "uint8":
            image = np.floor(image * np.float32(255.0))
        elif step.name == "to_tensor":
            image = image / np.float32(255.0)
        elif step.name == "normalize":
            image = (image - np.asarray(args["mean"])) / np.asarray(args["std"])
        elif step.name == "center_crop":
            h, w = step.size()
            top, left = (
                round((n - m) / 2.0) if n >= m else -((m - n) // 2) for n, m in zip(image.shape, (h, w))
            )
            image = kernels.crop(image, top, left, h, w)
        elif step.name == "resize":
            h, w = image.shape[:2]
            size = list(value)
            if len(size) == 1:
                short = min(h, w)
                size = [size[0] * h // short, size[0] * w // short]
            image = kernels.resample(image, tuple(size), args.get("interpolation", "bilinear"))
        elif step.name == "random_crop":
            h, w = step.size()
            pad = args.get("pad_if_needed", False)
            top = value["top"] - (max(h - image.shape[0], 0) if pad else 0)
            left = value["left"] - (max(w - image.shape[1], 0) if pad else 0)
            image = kernels.crop(image, top, left, h, w)
        elif step.name == "random_resized_crop":
            box = kernels.crop(image, value["top"], value["left"], value["h"], value["w"])
            image = kernels.resample(box, step.size(), args.get("interpolation", "bilinear"))
        elif step.name == "random_horizontal_flip":
            image = image[:, ::-1] if value else image
        elif step.name in ("rand_augment", "auto_augment", "trivial_augment_wide"):
            for op in value:
                image = kernels.augment_op(
                    image, ALL_OPS[op["op"]], op["magnitude"], args.get("interpolation", "nearest")
                )
        elif step.name == "random_erase":
            image = image.copy()
            image[value["x"] : value["x"] + value["h"], value["y"] : value["y"] + value["w"]] = 0
        else:
            raise ValueError(f"unknown step: {step.name}")
        image = np.ascontiguousarray(image, dtype=np.float32)
    return image


def once(udf):
    """Keep the optimiser from repeating or moving a costly Python function.

    The results are deterministic all the same; the mark only rules out that a filter on the result
    or a second use of the column makes Spark evaluate the function again.
    """
    return udf.asNondeterministic()


def pinned(image: str, params: str) -> list[Column]:
    """Arguments (image, its height, params, their number) of an augmenting function.

    Naming each input twice keeps Spark from folding the expressions that build it, which may hold
    nested lambdas, into the call: it computes them once, in a projection below.
    """
    return [F.col(image), F.col(image)["h"], F.col(params), F.size(params)]


def images_of(array: pa.Array) -> list[np.ndarray | None]:
    """Tensor structs of an Arrow batch as NumPy views, without copying the pixels."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    shapes = [array.field(k).to_numpy(zero_copy_only=False) for k in ("h", "w", "c")]
    data = array.field("data")
    offsets, values = data.offsets.to_numpy(), data.values.to_numpy(zero_copy_only=False)
    valid = array.is_valid().to_numpy(zero_copy_only=False)
    return [
        values[offsets[i] : offsets[i + 1]].reshape(int(shapes[0][i]), int(shapes[1][i]), int(shapes[2][i]))
        if valid[i]
        else None
        for i in range(len(array))
    ]


def tensors_to_arrow(images: list[np.ndarray]) -> pa.StructArray:
    """NumPy images as an array of tensor structs."""
    lengths = np.array([0, *[im.size for im in images]])
    flat = np.concatenate([im.ravel() for im in images]) if images else np.empty(0)
    data = pa.ListArray.from_arrays(
        pa.array(np.cumsum(lengths), pa.int32()), pa.array(flat.astype(np.float32), pa.float32())
    )
    shapes = [pa.array([im.shape[axis] for im in images], pa.int32()) for axis in range(3)]
    return pa.StructArray.from_arrays([*shapes, data], ["h", "w", "c", "data"])


def _views_of(images: list, draws: list, steps: list[Step]) -> pa.Array:
    """Views of some images as one Arrow array."""
    flat, ends = [], [0]
    for image, params in zip(images, draws):
        if image is not None:
            flat.extend(view_of(image, steps, p) for p in params)
        ends.append(len(flat))
    missing = pa.array([image is None for image in images], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tensors_to_arrow(flat), mask=missing)


def apply_views(df: DataFrame, steps: list[Step], image: str, params: str, out: str = "views") -> DataFrame:
    """Add ``out``: one view per planned draw, computed on Arrow batches; null images give null."""
    @arrow_udf(f"ARRAY<{px.TENSOR}>")
    def views(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for images, _, drawn, _ in batches:
            tensors, draws = images_of(images), drawn.to_pylist()
            for start in range(0, len(tensors), SLICE):
                yield _views_of(tensors[start : start + SLICE], draws[start : start + SLICE], steps)

    return df.withColumn(out, once(views)(*pinned(image, params)))


def apply_rand_augment(df: DataFrame, image: str, ops: str, out: str, interpolation: str = "nearest") -> DataFrame:
    """Add ``out``: the image after its planned operations (array of ``{op, magnitude}``); those that move pixels
    take the nearest one, or interpolate (``bilinear``, ``bicubic``)."""
    single = F.array(F.struct(F.col(ops).alias("rand_augment")))
    planned = df.withColumn("_ops", single)
    viewed = apply_views(planned, [Step("rand_augment", {"interpolation": interpolation})], image, "_ops", "_views")
    return viewed.withColumn(out, F.get("_views", F.lit(0))).drop("_ops", "_views")


def teacher_preset(df: DataFrame, presets: DataFrame, key: str) -> DataFrame:
    """Add ``resize``, ``crop``, ``mean`` and ``std`` of each record's teacher.

    ``presets`` has one row per teacher: ``input_size`` and ``test_input_size`` as (channels, height,
    width), ``crop_pct``, ``mean`` and ``std``. Spark broadcasts it by its measured size.
    """
    sizes = F.coalesce(F.col("test_input_size"), F.col("input_size"))
    prepared = presets.select(
        key, F.element_at(sizes, -1).alias("crop"), F.col("crop_pct").alias("_pct"), "mean", "std"
    ).withColumn("resize", F.floor(F.col("crop") / F.col("_pct")).cast("int"))
    return df.join(prepared.drop("_pct"), key, "left")
