"""Pixel arithmetic on ``STRUCT<h, w, c, data ARRAY<FLOAT>>`` columns (row, column, channel order).

These are the native forms, exact and free of Python; they suit small images and the checks. For
full-size images use :mod:`shardweave.operators.augment`, which does the same on Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardweave.functions.draws import column, let

TENSOR = "STRUCT<h: INT, w: INT, c: INT, data: ARRAY<FLOAT>>"


def tensor(data: Column, h, w, c) -> Column:
    """Build a tensor column from its flat values and its shape."""
    return F.struct(
        column(h).cast("int").alias("h"),
        column(w).cast("int").alias("w"),
        column(c).cast("int").alias("c"),
        data.cast("array<float>").alias("data"),
    )


def evaluated_once(fn):
    """Compute the image argument once, not anew for every pixel that refers to it."""

    @wraps(fn)
    def call(image: Column, *args, **kwargs) -> Column:
        return let(image, lambda computed: fn(computed, *args, **kwargs))

    return call


@evaluated_once
def map_values(image: Column, fn: Callable[[Column, Column], Column]) -> Column:
    """Same shape, every value replaced by ``fn(value, channel)``."""
    data = F.transform(image["data"], lambda x, i: fn(x, F.pmod(i, image["c"])).cast("float"))
    return tensor(data, image["h"], image["w"], image["c"])


@evaluated_once
def gather(image: Column, h, w, source: Callable[[Column, Column], tuple[Column, Column]], fill=0.0) -> Column:
    """New ``h`` x ``w`` image whose pixel (r, k) is the source pixel ``source(r, k)``.

    Source pixels outside of the image give ``fill``.
    """
    h, w, c = column(h), column(w), image["c"]

    def pixel(i: Column) -> Column:
        flat = F.floor(i / c).cast("int")
        row, col = source(F.floor(flat / w).cast("int"), F.pmod(flat, w))
        inside = (row >= 0) & (row < image["h"]) & (col >= 0) & (col < image["w"])
        index = ((row * image["w"] + col) * c + F.pmod(i, c)).cast("int")
        return F.when(inside, F.get(image["data"], index)).otherwise(F.lit(fill)).cast("float")

    positions = F.sequence(F.lit(0), (h * w * c - 1).cast("int"))
    return tensor(F.transform(positions, pixel), h, w, c)


def crop(image: Column, top, left, h, w) -> Column:
    """Box of ``h`` x ``w`` at (top, left); parts outside of the image are zero."""
    top, left = column(top), column(left)
    return gather(image, h, w, lambda r, k: (r + top, k + left))


def centre_offset(length: Column, size: int) -> Column:
    """Start of a centred run of ``size`` in ``length``; negative when padding is needed."""
    inner = F.rint((length - size) / 2.0).cast("int")
    padded = (-F.floor((F.lit(size) - length) / 2.0)).cast("int")
    return F.when(length >= size, inner).otherwise(padded)


@evaluated_once
def center_crop(image: Column, h: int, w: int) -> Column:
    """Centred box, zero-padded when the image is smaller."""
    return crop(image, centre_offset(image["h"], h), centre_offset(image["w"], w), h, w)


@evaluated_once
def hflip(image: Column, flag=True) -> Column:
    """Mirror left to right where ``flag`` holds."""
    flag = F.coalesce(column(flag), F.lit(False))
    mirrored = lambda r, k: (r, F.when(flag, image["w"] - 1 - k).otherwise(k))
    return gather(image, image["h"], image["w"], mirrored)


@evaluated_once
def erase(image: Column, box: Column) -> Column:
    """Zero the box ``{x, y, h, w}`` (x counts rows); a null box changes nothing."""

    def source(r, k):
        hit = (r >= box["x"]) & (r < box["x"] + box["h"]) & (k >= box["y"]) & (k < box["y"] + box["w"])
        return F.when(F.coalesce(hit, F.lit(False)), F.lit(-1)).otherwise(r), k

    return gather(image, image["h"], image["w"], source)


@evaluated_once
def resize_nearest(image: Column, h, w) -> Column:
    """Nearest-pixel resize."""
    h, w = column(h), column(w)
    return gather(
        image,
        h,
        w,
        lambda r, k: (
            F.floor(r * image["h"] / h).cast("int"),
            F.floor(k * image["w"] / w).cast("int"),
        ),
    )


def normalize(image: Column, mean: Sequence[float], std: Sequence[float]) -> Column:
    """(x - mean) / std per channel."""
    means = F.array(*[F.lit(float(m)) for m in mean])
    stds = F.array(*[F.lit(float(s)) for s in std])
    return map_values(image, lambda x, ch: (x - F.get(means, ch)) / F.get(stds, ch))


def to_uint8(image: Column) -> Column:
    """[0, 1] to whole numbers in [0, 255], truncated."""
    return map_values(image, lambda x, ch: F.floor(x * F.lit(255.0).cast("float")))


def to_tensor(image: Column) -> Column:
    """[0, 255] to [0, 1]."""
    return map_values(image, lambda x, ch: x / F.lit(255.0))


@evaluated_once
def to_rgb(image: Column) -> Column:
    """Three channels: alpha dropped, grey repeated."""
    c = image["c"]

    def value(i: Column) -> Column:
        pixel, channel = F.floor(i / 3).cast("int"), F.pmod(i, F.lit(3))
        return F.get(image["data"], pixel * c + F.when(c >= 3, channel).otherwise(F.lit(0)))

    positions = F.sequence(F.lit(0), image["h"] * image["w"] * 3 - 1)
    return tensor(F.transform(positions, value), image["h"], image["w"], 3)


def to_bfloat16(values: Column) -> Column:
    """ARRAY<FLOAT> rounded to bfloat16 precision (eight significant bits, ties to even)."""

    def rounded(x: Column) -> Column:
        wide = x.cast("double")
        exponent = F.greatest(F.floor(F.log2(F.abs(wide))), F.lit(-126))
        step = F.pow(F.lit(2.0), exponent - 7)
        special = (wide == 0) | F.isnan(wide) | (F.abs(wide) == F.lit(float("inf")))
        return F.when(special, wide).otherwise(F.rint(wide / step) * step).cast("float")

    return F.transform(values, rounded)
