"""Plans of the automatic augmentation policies: which operations, how strong, which direction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardweave.functions.draws import Draws, column, let

OPS = "ARRAY<STRUCT<op: INT, magnitude: DOUBLE>>"

# Operation numbers of stored parameters.
RAND_AUGMENT_OPS = (
    "Identity",
    "ShearX",
    "ShearY",
    "TranslateX",
    "TranslateY",
    "Rotate",
    "Brightness",
    "Color",
    "Contrast",
    "Sharpness",
    "Posterize",
    "Solarize",
    "AutoContrast",
    "Equalize",
)
# The policies know one operation more.
ALL_OPS = (*RAND_AUGMENT_OPS, "Invert")
# Operations whose strength may point either way.
SIGNED = (
    "ShearX",
    "ShearY",
    "TranslateX",
    "TranslateY",
    "Rotate",
    "Brightness",
    "Color",
    "Contrast",
    "Sharpness",
)

# Sub-policies as (operation, probability, strength bin), published with AutoAugment.
POLICIES = {
    "imagenet": (
        (("Posterize", 0.4, 8), ("Rotate", 0.6, 9)),
        (("Solarize", 0.6, 5), ("AutoContrast", 0.6, None)),
        (("Equalize", 0.8, None), ("Equalize", 0.6, None)),
        (("Posterize", 0.6, 7), ("Posterize", 0.6, 6)),
        (("Equalize", 0.4, None), ("Solarize", 0.2, 4)),
        (("Equalize", 0.4, None), ("Rotate", 0.8, 8)),
        (("Solarize", 0.6, 3), ("Equalize", 0.6, None)),
        (("Posterize", 0.8, 5), ("Equalize", 1.0, None)),
        (("Rotate", 0.2, 3), ("Solarize", 0.6, 8)),
        (("Equalize", 0.6, None), ("Posterize", 0.4, 6)),
        (("Rotate", 0.8, 8), ("Color", 0.4, 0)),
        (("Rotate", 0.4, 9), ("Equalize", 0.6, None)),
        (("Equalize", 0.0, None), ("Equalize", 0.8, None)),
        (("Invert", 0.6, None), ("Equalize", 1.0, None)),
        (("Color", 0.6, 4), ("Contrast", 1.0, 8)),
        (("Rotate", 0.8, 8), ("Color", 1.0, 2)),
        (("Color", 0.8, 8), ("Solarize", 0.8, 7)),
        (("Sharpness", 0.4, 7), ("Invert", 0.6, None)),
        (("ShearX", 0.6, 5), ("Equalize", 1.0, None)),
        (("Color", 0.4, 0), ("Equalize", 0.6, None)),
        (("Equalize", 0.4, None), ("Solarize", 0.2, 4)),
        (("Solarize", 0.6, 5), ("AutoContrast", 0.6, None)),
        (("Invert", 0.6, None), ("Equalize", 1.0, None)),
        (("Color", 0.6, 4), ("Contrast", 1.0, 8)),
        (("Equalize", 0.8, None), ("Equalize", 0.6, None)),
    ),
    "cifar10": (
        (("Invert", 0.1, None), ("Contrast", 0.2, 6)),
        (("Rotate", 0.7, 2), ("TranslateX", 0.3, 9)),
        (("Sharpness", 0.8, 1), ("Sharpness", 0.9, 3)),
        (("ShearY", 0.5, 8), ("TranslateY", 0.7, 9)),
        (("AutoContrast", 0.5, None), ("Equalize", 0.9, None)),
        (("ShearY", 0.2, 7), ("Posterize", 0.3, 7)),
        (("Color", 0.4, 3), ("Brightness", 0.6, 7)),
        (("Sharpness", 0.3, 9), ("Brightness", 0.7, 9)),
        (("Equalize", 0.6, None), ("Equalize", 0.5, None)),
        (("Contrast", 0.6, 7), ("Sharpness", 0.6, 5)),
        (("Color", 0.7, 7), ("TranslateX", 0.5, 8)),
        (("Equalize", 0.3, None), ("AutoContrast", 0.4, None)),
        (("TranslateY", 0.4, 3), ("Sharpness", 0.2, 6)),
        (("Brightness", 0.9, 6), ("Color", 0.2, 8)),
        (("Solarize", 0.5, 2), ("Invert", 0.0, None)),
        (("Equalize", 0.2, None), ("AutoContrast", 0.6, None)),
        (("Equalize", 0.2, None), ("Equalize", 0.6, None)),
        (("Color", 0.9, 9), ("Equalize", 0.6, None)),
        (("AutoContrast", 0.8, None), ("Solarize", 0.2, 8)),
        (("Brightness", 0.1, 3), ("Color", 0.7, 0)),
        (("Solarize", 0.4, 5), ("AutoContrast", 0.9, None)),
        (("TranslateY", 0.9, 9), ("TranslateY", 0.7, 9)),
        (("AutoContrast", 0.9, None), ("Solarize", 0.8, 3)),
        (("Equalize", 0.8, None), ("Invert", 0.1, None)),
        (("TranslateY", 0.7, 9), ("AutoContrast", 0.9, None)),
    ),
    "svhn": (
        (("ShearX", 0.9, 4), ("Invert", 0.2, None)),
        (("ShearY", 0.9, 8), ("Invert", 0.7, None)),
        (("Equalize", 0.6, None), ("Solarize", 0.6, 6)),
        (("Invert", 0.9, None), ("Equalize", 0.6, None)),
        (("Equalize", 0.6, None), ("Rotate", 0.9, 3)),
        (("ShearX", 0.9, 4), ("AutoContrast", 0.8, None)),
        (("ShearY", 0.9, 8), ("Invert", 0.4, None)),
        (("ShearY", 0.9, 5), ("Solarize", 0.2, 6)),
        (("Invert", 0.9, None), ("AutoContrast", 0.8, None)),
        (("Equalize", 0.6, None), ("Rotate", 0.9, 3)),
        (("ShearX", 0.9, 4), ("Solarize", 0.3, 3)),
        (("ShearY", 0.8, 8), ("Invert", 0.7, None)),
        (("Equalize", 0.9, None), ("TranslateY", 0.6, 6)),
        (("Invert", 0.9, None), ("Equalize", 0.6, None)),
        (("Contrast", 0.3, 3), ("Rotate", 0.8, 4)),
        (("Invert", 0.8, None), ("TranslateY", 0.0, 2)),
        (("ShearY", 0.7, 6), ("Solarize", 0.4, 8)),
        (("Invert", 0.6, None), ("Rotate", 0.8, 4)),
        (("ShearY", 0.3, 7), ("TranslateX", 0.9, 3)),
        (("ShearX", 0.1, 6), ("Invert", 0.6, None)),
        (("Solarize", 0.7, 2), ("TranslateY", 0.6, 7)),
        (("ShearY", 0.8, 4), ("Invert", 0.8, None)),
        (("ShearX", 0.7, 9), ("TranslateY", 0.8, 3)),
        (("ShearY", 0.8, 5), ("AutoContrast", 0.7, None)),
        (("ShearX", 0.7, 2), ("Invert", 0.1, None)),
    ),
}


def policy_name(name: str) -> str:
    """Policy meant by a free-form name."""
    lowered = name.lower()
    if "cifar" in lowered:
        return "cifar10"
    return "svhn" if "svhn" in lowered else "imagenet"


def _strength(op: str, bin_, bins: int, height, width, wide: bool) -> Column:
    """Unsigned strength of an operation at a bin; ``wide`` selects the larger ranges."""
    share = column(bin_).cast("double") / F.lit(float(bins - 1))
    if op in ("ShearX", "ShearY"):
        return share * F.lit(0.99 if wide else 0.3)
    if op == "TranslateX":
        return share * (F.lit(32.0) if wide else F.lit(150.0 / 331.0) * column(width))
    if op == "TranslateY":
        return share * (F.lit(32.0) if wide else F.lit(150.0 / 331.0) * column(height))
    if op == "Rotate":
        return share * F.lit(135.0 if wide else 30.0)
    if op in ("Brightness", "Color", "Contrast", "Sharpness"):
        return share * F.lit(0.99 if wide else 0.9)
    if op == "Posterize":
        return F.lit(8.0) - F.rint(share * F.lit(6.0 if wide else 4.0))
    if op == "Solarize":
        return (F.lit(1.0) - share) * F.lit(255.0)
    return F.lit(0.0)


def _signed(op: Column, magnitude: Column, sign: Column) -> Column:
    flags = F.array(*[F.lit(name in SIGNED) for name in ALL_OPS])
    return F.when(F.get(flags, op), magnitude * sign).otherwise(magnitude)


def _op(op: Column, magnitude: Column) -> Column:
    return F.struct(op.cast("int").alias("op"), magnitude.cast("double").alias("magnitude"))


def rand_augment_plan(
    draws: Draws, height, width, p: float = 1.0, num_ops: int = 2, magnitude: int = 9, num_magnitude_bins: int = 31
) -> Column:
    """``num_ops`` operations of one strength, or null when skipped."""
    strengths = F.array(
        *[_strength(op, magnitude, num_magnitude_bins, height, width, False) for op in RAND_AUGMENT_OPS]
    )

    def pick(i: int) -> Column:
        op = draws.integer("rand_augment.op", 0, len(RAND_AUGMENT_OPS), attempt=i)
        sign = draws.sign("rand_augment.sign", attempt=i)
        return let(op, lambda o: _op(o, _signed(o, F.get(strengths, o), sign)))

    ops = F.array(*[pick(i) for i in range(num_ops)])
    return F.when(draws.uniform("rand_augment.skip") <= F.lit(float(p)), ops).cast(OPS)


def trivial_augment_plan(draws: Draws, height, width, num_magnitude_bins: int = 31) -> Column:
    """One operation of random strength."""
    op = draws.integer("trivial_augment.op", 0, len(RAND_AUGMENT_OPS))
    bin_ = draws.integer("trivial_augment.bin", 0, num_magnitude_bins)
    sign = draws.sign("trivial_augment.sign")

    def pick(choice: Column) -> Column:
        strengths = F.array(
            *[_strength(name, choice["bin"], num_magnitude_bins, height, width, True) for name in RAND_AUGMENT_OPS]
        )
        o = choice["op"]
        return F.array(_op(o, _signed(o, F.get(strengths, o), sign)))

    return let(F.struct(op.alias("op"), bin_.alias("bin")), pick).cast(OPS)


def auto_augment_plan(draws: Draws, height, width, policy: str = "imagenet") -> Column:
    """Both operations of a random sub-policy, each kept with its own probability."""
    bins = 10
    table = []
    for pair in POLICIES[policy_name(policy)]:
        for name, probability, bin_ in pair:
            strength = F.lit(0.0) if bin_ is None else _strength(name, bin_, bins, height, width, False)
            table.append(
                F.struct(
                    F.lit(ALL_OPS.index(name)).alias("op"),
                    F.lit(float(probability)).alias("p"),
                    strength.cast("double").alias("magnitude"),
                )
            )
    rows = F.array(*table)
    subpolicy = draws.integer("auto_augment.policy", 0, len(table) // 2)

    def pick(chosen: Column) -> Column:
        def one(i: Column) -> Column:
            def entry(row: Column) -> Column:
                kept = draws.uniform("auto_augment.keep", attempt=i) <= row["p"]
                sign = draws.sign("auto_augment.sign", attempt=i)
                return F.when(kept, _op(row["op"], _signed(row["op"], row["magnitude"], sign)))

            return let(F.get(rows, chosen * 2 + i), entry)

        ops = F.transform(F.sequence(F.lit(0), F.lit(1)), one)
        return F.filter(ops, lambda o: o.isNotNull())

    return let(subpolicy, pick).cast(OPS)
