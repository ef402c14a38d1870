"""Random parameters of the geometric transforms, as columns."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardweave.functions.draws import Draws, column, let

BOX = "STRUCT<top: INT, left: INT, h: INT, w: INT>"
ERASE_BOX = "STRUCT<x: INT, y: INT, h: INT, w: INT>"
CORNER = "STRUCT<top: INT, left: INT>"
TRIES = 10


def _struct(schema: str, **fields) -> Column:
    return F.struct(*[v.cast("int").alias(k) for k, v in fields.items()]).cast(schema)


def resize_target(height, width, size) -> tuple[Column, Column]:
    """Height and width after a resize; one length resizes the shorter side and keeps the aspect."""
    height, width = column(height), column(width)
    if not isinstance(size, int):
        lengths = [int(v) for v in size]
        if len(lengths) == 2:
            return F.lit(lengths[0]), F.lit(lengths[1])
        size = lengths[0]
    portrait = height >= width
    longer = lambda a, b: F.floor(F.lit(size) * a / b).cast("int")
    return (
        F.when(portrait, longer(height, width)).otherwise(F.lit(size)),
        F.when(portrait, F.lit(size)).otherwise(longer(width, height)),
    )


def resize_plan(size) -> Column:
    """The configured size, as given: one length or height and width."""
    lengths = [size] if isinstance(size, int) else list(size)
    return F.array(*[F.lit(int(v)) for v in lengths])


def random_crop_plan(draws: Draws, height, width, size, pad_if_needed: bool = False) -> Column:
    """Corner of a random box of ``size``.

    With ``pad_if_needed`` a missing length is added on both sides before the box is drawn, and the
    corner counts from the padded edge.
    """
    target_h, target_w = size
    height, width = column(height), column(width)
    if pad_if_needed:
        height = height + 2 * F.greatest(F.lit(target_h) - height, F.lit(0))
        width = width + 2 * F.greatest(F.lit(target_w) - width, F.lit(0))
    return _struct(
        CORNER,
        top=draws.integer("random_crop.top", 0, height - target_h + 1),
        left=draws.integer("random_crop.left", 0, width - target_w + 1),
    )


def _first_fit(attempt: Callable[[Column], Column], schema: str) -> Column:
    """First of the attempts that is not null; later attempts are not evaluated."""
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(TRIES - 1)),
        F.lit(None).cast(schema),
        lambda found, i: F.coalesce(found, attempt(i)),
    )


def _area_and_aspect(draws: Draws, slot: str, height, width, scale, ratio, i):
    area = (height * width).cast("double") * draws.between(f"{slot}.area", *scale, attempt=i)
    logs = math.log(ratio[0]), math.log(ratio[1])
    aspect = F.exp(draws.between(f"{slot}.aspect", *logs, attempt=i))
    return area, aspect


def random_resized_crop_plan(
    draws: Draws, height, width, scale=(0.08, 1.0), ratio=(3.0 / 4.0, 4.0 / 3.0)
) -> Column:
    """Box of random area and aspect; after ten misfits the largest central box within the ratios."""
    height, width = column(height), column(width)
    slot = "random_resized_crop"

    def attempt(i: Column) -> Column:
        area, aspect = _area_and_aspect(draws, slot, height, width, scale, ratio, i)
        sides = F.struct(
            F.rint(F.sqrt(area / aspect)).cast("int").alias("h"),
            F.rint(F.sqrt(area * aspect)).cast("int").alias("w"),
        )

        def place(s: Column) -> Column:
            fits = (s["w"] > 0) & (s["w"] <= width) & (s["h"] > 0) & (s["h"] <= height)
            box = _struct(
                BOX,
                top=draws.integer(f"{slot}.top", 0, height - s["h"] + 1, attempt=i),
                left=draws.integer(f"{slot}.left", 0, width - s["w"] + 1, attempt=i),
                h=s["h"],
                w=s["w"],
            )
            return F.when(fits, box)

        return let(sides, place)

    shape = width / height
    central_h = F.when(shape < min(ratio), F.rint(width / F.lit(float(min(ratio))))).otherwise(height).cast("int")
    central_w = F.when(shape > max(ratio), F.rint(height * F.lit(float(max(ratio))))).otherwise(width).cast("int")
    central = _struct(
        BOX,
        top=F.floor((height - central_h) / 2),
        left=F.floor((width - central_w) / 2),
        h=central_h,
        w=central_w,
    )
    return F.coalesce(_first_fit(attempt, BOX), central)


def flip_plan(draws: Draws, p: float = 0.5) -> Column:
    """Whether to mirror the image."""
    return draws.uniform("random_horizontal_flip") < F.lit(float(p))


def random_erase_plan(
    draws: Draws, height, width, p: float = 0.5, scale=(0.02, 0.33), ratio=(0.3, 3.3)
) -> Column:
    """Box to blank, or null when skipped; after ten misfits the box is the whole image."""
    height, width = column(height), column(width)
    slot = "random_erase"

    def attempt(i: Column) -> Column:
        area, aspect = _area_and_aspect(draws, slot, height, width, scale, ratio, i)
        sides = F.struct(
            F.rint(F.sqrt(area * aspect)).cast("int").alias("h"),
            F.rint(F.sqrt(area / aspect)).cast("int").alias("w"),
        )

        def place(s: Column) -> Column:
            box = _struct(
                ERASE_BOX,
                x=draws.integer(f"{slot}.x", 0, height - s["h"] + 1, attempt=i),
                y=draws.integer(f"{slot}.y", 0, width - s["w"] + 1, attempt=i),
                h=s["h"],
                w=s["w"],
            )
            return F.when((s["h"] < height) & (s["w"] < width), box)

        return let(sides, place)

    whole = _struct(ERASE_BOX, x=F.lit(0), y=F.lit(0), h=height, w=width)
    box = F.coalesce(_first_fit(attempt, ERASE_BOX), whole)
    return F.when(draws.uniform(f"{slot}.skip") <= F.lit(float(p)), box)
