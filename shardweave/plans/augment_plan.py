"""One column of augmentation parameters per record, and its compact stored form."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardweave.functions.draws import Draws, column
from shardweave.plans import geometry, mixing, policies
from shardweave.plans.config import Step, as_pair, steps_from_config

# Type of the parameters of each step that has any.
PARAM_TYPES = {
    "resize": "ARRAY<INT>",
    "random_crop": geometry.CORNER,
    "random_resized_crop": geometry.BOX,
    "random_horizontal_flip": "BOOLEAN",
    "rand_augment": policies.OPS,
    "auto_augment": policies.OPS,
    "trivial_augment_wide": policies.OPS,
    "random_erase": geometry.ERASE_BOX,
    "mixup": "DOUBLE",
    "cutmix": mixing.CUTMIX,
}


def shape_after(step: Step, height, width) -> tuple:
    """Image shape behind a step."""
    if step.name == "resize":
        return geometry.resize_target(height, width, step.args["size"])
    if step.name in ("center_crop", "random_crop", "random_resized_crop"):
        return step.size()
    return height, width


def step_params(step: Step, draws: Draws, height, width) -> Column:
    """Random parameters of one step for an image of the given shape."""
    args = step.args
    if step.name == "resize":
        planned = geometry.resize_plan(args["size"])
    elif step.name == "random_crop":
        planned = geometry.random_crop_plan(
            draws, height, width, as_pair(args["size"]), args.get("pad_if_needed", False)
        )
    elif step.name == "random_resized_crop":
        planned = geometry.random_resized_crop_plan(
            draws,
            height,
            width,
            **{k: tuple(v) for k, v in args.items() if k in ("scale", "ratio")},
        )
    elif step.name == "random_horizontal_flip":
        planned = geometry.flip_plan(draws, **args)
    elif step.name == "rand_augment":
        known = ("p", "num_ops", "magnitude", "num_magnitude_bins")
        planned = policies.rand_augment_plan(
            draws, height, width, **{k: v for k, v in args.items() if k in known}
        )
    elif step.name == "auto_augment":
        planned = policies.auto_augment_plan(draws, height, width, args.get("policy", "imagenet"))
    elif step.name == "trivial_augment_wide":
        planned = policies.trivial_augment_plan(draws, height, width, args.get("num_magnitude_bins", 31))
    elif step.name == "random_erase":
        known = ("p", "scale", "ratio")
        planned = geometry.random_erase_plan(
            draws, height, width, **{k: v for k, v in args.items() if k in known}
        )
    elif step.name == "mixup":
        planned = mixing.mixup_plan(draws, **args)
    elif step.name == "cutmix":
        planned = mixing.cutmix_plan(draws, height, width, **args)
    else:
        raise ValueError(f"step without parameters: {step.name}")
    return planned.cast(PARAM_TYPES[step.name])


def params_of_draw(
    steps: list[Step], seed: int, uid: Column, draw: Column, shape, second_shape=None, second_crop=None
) -> Column:
    """Struct of the parameters of all steps for one draw.

    With a second image each image step holds ``{a, b}``, drawn separately; ``second_crop`` is the
    crop size that the second image uses instead of the configured one.
    """
    first, second = Draws(seed, uid, draw, ""), Draws(seed, uid, draw, "b.")
    fields = []
    for step in steps:
        if step.mixes:
            if second_shape is not None:
                fields.append(step_params(step, first, *shape).alias(step.name))
            continue
        if step.has_params:
            planned = step_params(step, first, *shape)
            if second_shape is not None:
                other = step_params(step, second, *second_shape)
                planned = F.struct(planned.alias("a"), other.alias("b"))
            fields.append(planned.alias(step.name))
        shape = shape_after(step, *shape)
        if second_shape is not None:
            second_shape = shape_after(step, *second_shape)
            if step.name == "random_resized_crop" and second_crop is not None:
                second_shape = as_pair(second_crop)
    return F.struct(*fields) if fields else F.struct(F.lit(None).cast("int").alias("none"))


def plan_draws(
    df: DataFrame,
    config: Mapping | str | list[Step],
    num_samples: int,
    seed: int,
    uid: str = "uid",
    height=None,
    width=None,
    second_shape=None,
    second_crop=None,
    out: str = "params",
) -> DataFrame:
    """Add ``out``: an array with the parameters of ``num_samples`` independent draws.

    ``config`` may also be a list of steps, such as those in front of a teacher.
    """
    steps = config if isinstance(config, list) else steps_from_config(config)
    planned = F.transform(
        F.sequence(F.lit(0), F.lit(num_samples - 1)),
        lambda d: params_of_draw(
            steps, seed, F.col(uid), d, (column(height), column(width)), second_shape, second_crop
        ),
    )
    return df.withColumn(out, planned)


def _number_list(*values: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *[v.cast("string") for v in values]), F.lit("]"))


def _compact_value(name: str, value: Column) -> Column:
    if name in ("random_horizontal_flip", "mixup"):
        return value.cast("string")
    if name == "resize":
        return F.concat(F.lit("["), F.array_join(value.cast("array<string>"), ","), F.lit("]"))
    if PARAM_TYPES[name] == policies.OPS:
        ops = F.transform(value, lambda o: _number_list(o["op"], o["magnitude"]))
        return F.concat(F.lit("["), F.array_join(ops, ","), F.lit("]"))
    fields = {
        "random_crop": ("top", "left"),
        "random_resized_crop": ("top", "left", "h", "w"),
        "random_erase": ("x", "y", "h", "w"),
        "cutmix": ("lam", "x1", "y1", "x2", "y2"),
    }[name]
    return _number_list(*[value[f] for f in fields])


def _or_null(value: Column, text: Column) -> Column:
    return F.when(value.isNull(), F.lit("null")).otherwise(text)


def compress_params(params: Column, steps: list[Step], id2: Column | None = None) -> Column:
    """Parameters of one draw as a positional JSON list.

    One entry per step with parameters, in step order; the partner's id (or null) comes first when
    a mixing step is configured. ``id2`` says that the parameters hold pairs.
    """
    entries = []
    if any(s.mixes for s in steps):
        entries.append(_partner_entry(params, steps, id2))
    for step in steps:
        if not step.has_params:
            continue
        if step.mixes:
            if id2 is None:
                entries.append(F.lit("null"))
            else:
                value = params[step.name]
                entries.append(_or_null(value, _compact_value(step.name, value)))
        elif id2 is None:
            value = params[step.name]
            entries.append(_or_null(value, _compact_value(step.name, value)))
        else:
            both = [params[step.name][side] for side in ("a", "b")]
            texts = [_or_null(v, _compact_value(step.name, v)) for v in both]
            pair = F.concat(F.lit("["), F.concat_ws(",", *texts), F.lit("]"))
            mixed = _mixed(params, steps)
            entries.append(F.when(mixed, pair).otherwise(texts[0]))
    return F.concat(F.lit("["), F.concat_ws(",", *entries), F.lit("]"))


def _mixed(params: Column, steps: list[Step]) -> Column:
    """Whether any mixing step was drawn."""
    drawn = F.lit(False)
    for step in steps:
        if step.mixes:
            drawn = drawn | params[step.name].isNotNull()
    return drawn


def _partner_entry(params: Column, steps: list[Step], id2: Column | None) -> Column:
    if id2 is None:
        return F.lit("null")
    listed = F.to_json(F.array(id2.cast("string")))
    quoted = F.substr(listed, F.lit(2), F.length(listed) - 2)
    return F.when(_mixed(params, steps), quoted).otherwise(F.lit("null"))


def _read_value(name: str, at, path: str) -> Column:
    """Parameters of one step, read from position ``path`` of a compact list."""
    if name in ("random_horizontal_flip", "mixup"):
        return at(path, PARAM_TYPES[name])
    if name == "resize":
        return at(path, "ARRAY<INT>")
    if PARAM_TYPES[name] == policies.OPS:
        pairs = at(path, "ARRAY<ARRAY<DOUBLE>>")
        return F.transform(
            pairs,
            lambda p: F.struct(F.get(p, F.lit(0)).cast("int").alias("op"), F.get(p, F.lit(1)).alias("magnitude")),
        )
    schema = PARAM_TYPES[name]
    names = [part.split(":")[0].strip() for part in schema[len("STRUCT<") : -1].split(",")]
    types = [part.split(":")[1].strip() for part in schema[len("STRUCT<") : -1].split(",")]
    cells = [at(f"{path}[{i}]", t).alias(n) for i, (n, t) in enumerate(zip(names, types))]
    return F.when(at(f"{path}[0]", "DOUBLE").isNotNull(), F.struct(*cells))


def decompress_params(text: Column, steps: list[Step], paired: bool = False) -> Column:
    """Inverse of :func:`compress_params`: the struct of one draw; missing entries are null."""
    parsed = F.try_parse_json(text)

    def at(path: str, kind: str) -> Column:
        return F.try_variant_get(parsed, f"${path}", kind)

    fields, offset = [], 0
    if any(s.mixes for s in steps):
        offset = 1
        if paired:
            fields.append(at("[0]", "STRING").alias("id2"))
    for i, step in enumerate([s for s in steps if s.has_params]):
        path = f"[{i + offset}]"
        if step.mixes:
            if paired:
                fields.append(_read_value(step.name, at, path).cast(PARAM_TYPES[step.name]).alias(step.name))
            continue
        kind = PARAM_TYPES[step.name]
        if not paired:
            fields.append(_read_value(step.name, at, path).cast(kind).alias(step.name))
            continue
        # The second image's parameters are stored only with a partner, that is when something mixes.
        mixed = at("[0]", "STRING").isNotNull() if offset else F.lit(False)
        alone = _read_value(step.name, at, path).cast(kind)
        both = [_read_value(step.name, at, f"{path}[{j}]").cast(kind) for j in range(2)]
        first = F.when(mixed, both[0]).otherwise(alone)
        fields.append(F.struct(first.alias("a"), F.when(mixed, both[1]).alias("b")).alias(step.name))
    return F.struct(*fields)


def compress_draws(params: Column, steps: list[Step], id2: Column | None = None) -> Column:
    """Compact form of every draw of a record."""
    return F.transform(params, lambda p: compress_params(p, steps, id2))


def decompress_draws(texts: Column, steps: list[Step], paired: bool = False) -> Column:
    """Parameters of every draw of a record."""
    return F.transform(texts, lambda t: decompress_params(t, steps, paired))


__all__ = [
    "PARAM_TYPES",
    "compress_draws",
    "compress_params",
    "decompress_draws",
    "decompress_params",
    "params_of_draw",
    "plan_draws",
    "shape_after",
    "step_params",
]
