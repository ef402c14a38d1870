"""Augmentation configuration: a dictionary read on the driver into an ordered list of steps."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

# Steps run in this order, whatever the order of the configuration.
REPLAYABLE_ORDER = (
    "uint8",
    "resize",
    "center_crop",
    "random_crop",
    "random_resized_crop",
    "random_horizontal_flip",
    "rand_augment",
    "to_tensor",
    "random_erase",
    "normalize",
    "mixup",
    "cutmix",
)
# The same for the pipelines in front of a teacher, which are not replayed.
TEACHER_ORDER = (
    "resize",
    "center_crop",
    "random_crop",
    "random_resized_crop",
    "random_horizontal_flip",
    "rand_augment",
    "auto_augment",
    "trivial_augment_wide",
    "to_tensor",
    "random_erase",
    "normalize",
)


class Kind(NamedTuple):
    """What a step does, as far as its place in a job depends on it."""

    per_image: bool = False  # brings an image to the common shape or type, so it precedes batching
    converts: bool = False  # changes the type of values, so it holds for a batch as well
    random: bool = True  # draws parameters
    mixes: bool = False  # needs a second image


# The kinds of steps; a name that is not listed is of the plain kind.
KINDS = {
    "uint8": Kind(per_image=True, converts=True, random=False),
    "resize": Kind(per_image=True),
    "center_crop": Kind(per_image=True, random=False),
    "random_crop": Kind(per_image=True),
    "random_resized_crop": Kind(per_image=True),
    "to_tensor": Kind(per_image=True, converts=True, random=False),
    "normalize": Kind(random=False),
    "mixup": Kind(mixes=True),
    "cutmix": Kind(mixes=True),
}
# Steps made of policy operations. In front of a teacher these interpolate bilinearly unless the
# configuration says otherwise; replayed ones take the nearest pixel.
POLICY_STEPS = ("rand_augment", "auto_augment", "trivial_augment_wide")
# Fixed value: configuration entry that refers to a teacher's preset.
PRESET_KEY = "timm_resize_crop_norm"


@dataclass(frozen=True)
class Step:
    """One configured transform."""

    name: str
    args: dict = field(default_factory=dict)

    @property
    def kind(self) -> Kind:
        return kind_of(self.name)

    @property
    def has_params(self) -> bool:
        return self.kind.random

    @property
    def mixes(self) -> bool:
        return self.kind.mixes

    def size(self) -> tuple[int, int]:
        """Configured (height, width)."""
        return as_pair(self.args["size"])


def kind_of(name: str) -> Kind:
    return KINDS.get(name, Kind())


def as_pair(size) -> tuple[int, int]:
    """A single length stands for a square."""
    if isinstance(size, int):
        return size, size
    lengths = [int(v) for v in size]
    return (lengths[0], lengths[0]) if len(lengths) == 1 else (lengths[0], lengths[1])


def enabled(config: Mapping | str) -> dict[str, dict]:
    """Configuration without the entries switched off, and without the switches themselves."""
    entries = json.loads(config) if isinstance(config, str) else config
    kept = {name: dict(args) for name, args in entries.items() if args.get("enable", True)}
    for args in kept.values():
        args.pop("enable", None)
    return kept


def steps_from_config(
    config: Mapping | str, order=REPLAYABLE_ORDER, presets: Mapping[str, Mapping] | None = None
) -> list[Step]:
    """Ordered steps; names that ``order`` does not know are ignored.

    In front of a teacher the entry ``timm_resize_crop_norm`` names one of ``presets``, whose resize,
    crop and normalisation replace those of the configuration.
    """
    entries = enabled(config)
    if PRESET_KEY in entries and order == TEACHER_ORDER:
        entries.update(preset_config((presets or {})[entries[PRESET_KEY]["name"]]))
    if order == TEACHER_ORDER:
        for name in POLICY_STEPS:
            if name in entries:
                entries[name].setdefault("interpolation", "bilinear")
    return [Step(name, entries[name]) for name in order if name in entries]


def split_collate(config: Mapping) -> tuple[dict, dict]:
    """Configuration of the stage before batching, and of the rest."""
    stages: tuple[dict, dict] = {}, {}
    for name, args in config.items():
        stages[not kind_of(name).per_image][name] = args
    return stages


def after_collate_steps(steps: list[Step]) -> list[Step]:
    """Steps to run on batched images: the shape steps are done, value conversions run again."""
    return [step for step in steps if step.kind.converts or not step.kind.per_image]


def preset_config(preset: Mapping) -> dict[str, dict]:
    """Resize, crop and normalise as a teacher's published preset asks for."""
    side = int((preset.get("test_input_size") or preset["input_size"])[-1])
    return {
        "resize": {
            "size": math.floor(side / preset["crop_pct"]),
            "interpolation": preset.get("interpolation", "bicubic"),
        },
        "random_crop": {"size": side, "pad_if_needed": True},
        "normalize": {"mean": list(preset["mean"]), "std": list(preset["std"])},
    }
