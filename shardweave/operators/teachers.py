"""Deterministic stand-in teachers and the description under which a teacher takes part in a job.

A teacher is built on the worker by ``TeacherSpec.factory(**kwargs)`` and offers any of
``embed_images(batch)`` for (n, h, w, c) arrays, ``embed_texts(texts)`` and
``captions(images, draws)``. Real networks plug in through the same three methods.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd

from shardweave.functions.text import END_MARK, START_MARK


@dataclass(frozen=True)
class TeacherSpec:
    """What the driver must know of a teacher without loading it."""

    factory: Callable
    kwargs: dict = field(default_factory=dict)
    input_size: tuple[int, int] | None = None
    mean: tuple[float, ...] | None = None

    def key(self) -> str:
        name = f"{self.factory.__module__}.{self.factory.__qualname__}"
        return f"{name}{json.dumps(self.kwargs, sort_keys=True, default=str)}"


_LOADED: dict[str, object] = {}


def loaded(spec: TeacherSpec):
    """The teacher of this worker, built on first use and kept for later tasks."""
    key = spec.key()
    if key not in _LOADED:
        _LOADED[key] = spec.factory(**spec.kwargs)
    return _LOADED[key]


@lru_cache(maxsize=1 << 16)
def _word_hash(word: str) -> int:
    return int(hashlib.md5(word.encode()).hexdigest()[:8], 16)


class HashText:
    """Counts of lower-cased words, hashed into ``dim`` buckets."""

    def __init__(self, dim: int):
        self.dim = dim

    def embed_texts(self, texts: list[str]) -> np.ndarray:
        words = [text.lower().split(" ") for text in texts]
        rows = np.repeat(np.arange(len(texts)), [len(w) for w in words])
        codes, known = pd.factorize(np.array([w for ws in words for w in ws], dtype=object))
        buckets = np.array([_word_hash(w) % self.dim for w in known], dtype=np.int64)
        cells = np.bincount(rows * self.dim + buckets[codes], minlength=len(texts) * self.dim)
        return cells.reshape(len(texts), self.dim).astype(np.float32)


@lru_cache(maxsize=64)
def _signs(dim: int, size: int) -> np.ndarray:
    rows = [
        [1.0 if int(hashlib.md5(f"{j}|{i}".encode()).hexdigest()[0], 16) % 2 == 0 else -1.0 for i in range(size)]
        for j in range(dim)
    ]
    return np.array(rows)


class HashImage:
    """Projection of the pixels on ``dim`` fixed vectors of signs."""

    def __init__(self, dim: int):
        self.dim = dim

    def embed_images(self, batch: np.ndarray) -> np.ndarray:
        flat = batch.reshape(len(batch), -1).astype(np.float64)
        return (flat @ _signs(self.dim, flat.shape[1]).T).astype(np.float32)


class HashClip(HashText, HashImage):
    """Both of the above, as an image-text teacher."""


class HashCaption:
    """Raw decoder output around one sentence of the image's bytes, chosen by the draw."""

    def captions(self, images: list[bytes], draws: np.ndarray) -> list[str]:
        out = []
        for image, draw in zip(images, draws):
            sentences = image.decode("utf-8").split(".")
            chosen = sentences[int(draw * len(sentences))]
            out.append(f"pad{START_MARK}{chosen} .rest{END_MARK}pad")
        return out


class HashRows:
    """Row function: the non-empty word buckets of each text, one row per bucket."""

    def __init__(self, dim: int):
        self.text = HashText(dim)

    def __call__(self, batch: pd.DataFrame) -> pd.DataFrame:
        counts = self.text.embed_texts(batch["text"].tolist())
        rows, buckets = np.nonzero(counts)
        return pd.DataFrame(
            {
                "uid": batch["uid"].to_numpy()[rows],
                "bucket": buckets.astype("int32"),
                "n": counts[rows, buckets].astype("int64"),
            }
        )
