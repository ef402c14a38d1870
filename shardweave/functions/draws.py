"""Seeded draws: pure functions of (seed, record, draw, slot).

A task may run twice, so nothing here keeps generator state. Each draw is the first 52 bits of an
md5 over its coordinates; it does not depend on partitioning, order or attempt.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(value) -> Column:
    """Columns pass through, anything else becomes a literal."""
    return value if isinstance(value, Column) else F.lit(value)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (a one-element ``transform``)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def uniform(seed, uid, draw, slot) -> Column:
    """Uniform double in [0, 1)."""
    key = F.concat_ws(
        "|",
        column(seed).cast("string"),
        column(uid).cast("string"),
        column(draw).cast("string"),
        column(slot).cast("string"),
    )
    bits = F.conv(F.substring(F.md5(F.encode(key, "UTF-8")), 1, 13), 16, 10).cast("bigint")
    return bits / F.lit(float(2**52))


def uniform_int(seed, uid, draw, slot, low, high) -> Column:
    """Uniform integer in [low, high)."""
    width = column(high) - column(low)
    return (column(low) + F.floor(uniform(seed, uid, draw, slot) * width)).cast("int")


def random_sign(seed, uid, draw, slot) -> Column:
    """-1 or 1 with equal probability."""
    return F.when(uniform(seed, uid, draw, slot) < 0.5, F.lit(-1)).otherwise(F.lit(1))


@dataclass(frozen=True)
class Draws:
    """Draws of one record and one draw number; ``prefix`` separates the images of a pair."""

    seed: int
    uid: Column
    draw: Column
    prefix: str = ""

    def _slot(self, name: str, attempt=None) -> Column:
        if attempt is None:
            return F.lit(self.prefix + name)
        return F.concat(F.lit(f"{self.prefix}{name}."), column(attempt).cast("string"))

    def uniform(self, name: str, attempt=None) -> Column:
        return uniform(self.seed, self.uid, self.draw, self._slot(name, attempt))

    def between(self, name: str, low: float, high: float, attempt=None) -> Column:
        return F.lit(float(low)) + self.uniform(name, attempt) * F.lit(float(high - low))

    def integer(self, name: str, low, high, attempt=None) -> Column:
        return uniform_int(self.seed, self.uid, self.draw, self._slot(name, attempt), low, high)

    def sign(self, name: str, attempt=None) -> Column:
        return random_sign(self.seed, self.uid, self.draw, self._slot(name, attempt))
