"""Mixing two images and their labels: partners, weights, boxes and the mixing itself."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardweave.functions.draws import Draws, column, let, uniform
from shardweave.functions.tensor import tensor

CUTMIX = "STRUCT<lam: DOUBLE, x1: INT, y1: INT, x2: INT, y2: INT>"
_GRID = 512


def _beta_half_quantiles(alpha: float) -> list[float]:
    """Quantiles 0 .. 1/2 of Beta(alpha, alpha), each raised to ``alpha``.

    In t = x**alpha the density is smooth down to x = 0, so a trapezoid sum is accurate and the
    quantiles are nearly linear between the grid points.
    """
    t = np.linspace(0.0, 0.5**alpha, 20_001)
    density = (1.0 - t ** (1.0 / alpha)) ** (alpha - 1.0)
    mass = np.concatenate([[0.0], np.cumsum((density[1:] + density[:-1]) / 2.0)])
    return np.interp(np.linspace(0.0, 1.0, _GRID + 1), mass / mass[-1], t).tolist()


def beta_draw(u: Column, alpha: float) -> Column:
    """Beta(alpha, alpha) value at the uniform ``u``."""
    if alpha == 1.0:
        return u
    grid = F.array(*[F.lit(v) for v in _beta_half_quantiles(alpha)])

    def lower(place: Column) -> Column:
        cell = F.floor(place).cast("int")
        low, high = F.get(grid, cell), F.get(grid, F.least(cell + 1, F.lit(_GRID)))
        return F.pow(low + (high - low) * (place - cell), F.lit(1.0 / alpha))

    def value(v: Column) -> Column:
        half = let(F.least(v, F.lit(1.0) - v) * F.lit(2.0 * _GRID), lower)
        return F.when(v < 0.5, half).otherwise(F.lit(1.0) - half)

    return let(u, value)


def mixup_plan(draws: Draws, alpha: float = 1.0, p: float = 1.0, div_by: float = 1.0) -> Column:
    """Weight of the first image, or null when skipped."""
    if alpha == 0:
        return F.lit(None).cast("double")
    weight = beta_draw(draws.uniform("mixup.lambda"), alpha) / F.lit(float(div_by))
    return F.when(draws.uniform("mixup.skip") <= F.lit(float(p)), weight)


def cutmix_plan(draws: Draws, height, width, alpha: float = 1.0, p: float = 1.0) -> Column:
    """Drawn weight and the box taken from the partner, or null when skipped; x counts rows."""
    if alpha == 0:
        return F.lit(None).cast(CUTMIX)
    height, width = column(height), column(width)

    def box(lam: Column) -> Column:
        share = F.sqrt(F.lit(1.0) - lam)
        centre_x = draws.integer("cutmix.x", 0, height)
        centre_y = draws.integer("cutmix.y", 0, width)
        half_h = F.floor(F.floor(height * share) / 2)
        half_w = F.floor(F.floor(width * share) / 2)
        clip = lambda value, top: F.least(F.greatest(value, F.lit(0)), top).cast("int")
        return F.struct(
            lam.alias("lam"),
            clip(centre_x - half_h, height).alias("x1"),
            clip(centre_y - half_w, width).alias("y1"),
            clip(centre_x + half_h, height).alias("x2"),
            clip(centre_y + half_w, width).alias("y2"),
        ).cast(CUTMIX)

    planned = let(beta_draw(draws.uniform("cutmix.lambda"), alpha), box)
    return F.when(draws.uniform("cutmix.skip") <= F.lit(float(p)), planned)


def mixup(first: Column, second: Column, lam: Column) -> Column:
    """``lam * first + (1 - lam) * second``; a null weight keeps the first image."""
    data = F.zip_with(
        first["data"], second["data"], lambda a, b: (lam * a + (F.lit(1.0) - lam) * b).cast("float")
    )
    return F.when(lam.isNull(), first).otherwise(tensor(data, first["h"], first["w"], first["c"]))


def cutmix(first: Column, second: Column, plan: Column) -> Column:
    """First image with the planned box taken from the second; a null plan keeps the first."""
    w, c = first["w"], first["c"]

    def value(a: Column, i: Column) -> Column:
        pixel = F.floor(i / c)
        row, col = F.floor(pixel / w), F.pmod(pixel, w)
        inside = (row >= plan["x1"]) & (row < plan["x2"]) & (col >= plan["y1"]) & (col < plan["y2"])
        return F.when(inside, F.get(second["data"], i)).otherwise(a)

    data = F.transform(first["data"], value)
    return F.when(plan.isNull(), first).otherwise(tensor(data, first["h"], w, c))


def mix_labels(first: Column, second: Column, weight: Column) -> Column:
    """Weighted label vectors; a null weight keeps the first."""
    mixed = F.zip_with(first, second, lambda a, b: weight * a + (F.lit(1.0) - weight) * b)
    return F.when(weight.isNull(), first).otherwise(mixed)


def cutmix_label_weight(plan: Column, height, width) -> Column:
    """Share of the first image that is left after the cut."""
    cut = (plan["x2"] - plan["x1"]) * (plan["y2"] - plan["y1"])
    return F.lit(1.0) - cut / (column(height) * column(width))


def one_hot(label: Column, classes: int) -> Column:
    """Label as a vector of zeros and a one."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(classes - 1)),
        lambda i: F.when(i == label, F.lit(1.0)).otherwise(F.lit(0.0)),
    )


def draw_pairs(df: DataFrame, keys: list[str], buckets: int, seed: int, payload: list[str]) -> DataFrame:
    """Give each record the ``payload`` columns of a partner, as ``<name>2``.

    Records fall into ``buckets`` groups by hash; inside a group they form a random cycle and each
    takes its successor. ``keys`` must identify a record (for example uid, shard and position), so
    copies of one uid spread over the groups and every group stays near count / buckets.
    """
    identity = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    placed = df.withColumn(
        "_bucket", F.floor(uniform(seed, identity, 0, "pair.bucket") * F.lit(buckets)).cast("int")
    ).withColumn("_turn", uniform(seed, identity, 0, "pair.order"))
    order = [F.col("_turn"), *[F.col(k) for k in keys]]
    following = Window.partitionBy("_bucket").orderBy(*order)
    whole = following.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.lead(F.lit(1)).over(following).isNull()
    # Column by column: a struct of them would travel through the exchange as further copies.
    taken = [F.when(last, F.first(p).over(whole)).otherwise(F.lead(p).over(following)).alias(f"{p}2") for p in payload]
    return placed.select(*df.columns, *taken)


def with_partner(df: DataFrame, others: DataFrame, partner: str, key: str, payload: list[str]) -> DataFrame:
    """Fetch the ``payload`` of stored partners by id, as ``<name>2``.

    ``others`` has one row per ``key``. A partner that very many records share is a skewed join key
    on the left only, which adaptive execution splits.
    """
    fetched = others.select(F.col(key).alias(partner), *[F.col(p).alias(f"{p}2") for p in payload])
    return df.join(fetched, partner, "left")


def mix_one_of(first: Column, second: Column, label: Column, label2: Column, draws: Draws, config: dict) -> Column:
    """One of the configured mixings, chosen evenly, as ``STRUCT<image, label>``."""
    mixed = []
    if "mixup" in config:
        lam = mixup_plan(draws, **config["mixup"])
        mixed.append(
            let(
                F.struct(lam.alias("lam")),
                lambda s: F.struct(
                    mixup(first, second, s["lam"]).alias("image"),
                    mix_labels(label, label2, s["lam"]).alias("label"),
                ),
            )
        )
    if "cutmix" in config:
        plan = cutmix_plan(draws, first["h"], first["w"], **config["cutmix"])

        def cut(s: Column) -> Column:
            box = s["box"]
            weight = F.when(box.isNotNull(), cutmix_label_weight(box, first["h"], first["w"]))
            return F.struct(
                cutmix(first, second, box).alias("image"), mix_labels(label, label2, weight).alias("label")
            )

        mixed.append(let(F.struct(plan.alias("box")), cut))
    if not mixed:
        return F.struct(first.alias("image"), label.alias("label"))
    if len(mixed) == 1:
        return mixed[0]
    return F.when(draws.uniform("mix.choice") < 0.5, mixed[0]).otherwise(mixed[1])
