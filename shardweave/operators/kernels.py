"""NumPy pixel kernels for Arrow batches: images are (h, w, c) float32 arrays."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np


def _cubic(x: np.ndarray) -> np.ndarray:
    """Cubic convolution weight at distance ``x`` (fixed value: a = -0.75)."""
    a, x = -0.75, np.abs(x)
    near = ((a + 2) * x - (a + 3)) * x * x + 1
    far = ((a * x - 5 * a) * x + 8 * a) * x - 4 * a
    return np.where(x <= 1, near, np.where(x < 2, far, 0.0))


def _lanczos(x: np.ndarray) -> np.ndarray:
    """Windowed sinc of three lobes."""
    return np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)


def _hamming(x: np.ndarray) -> np.ndarray:
    """Sinc of one lobe under a Hamming window."""
    return np.where(np.abs(x) < 1, np.sinc(x) * (0.54 + 0.46 * np.cos(np.pi * x)), 0.0)


# Weight at a distance, and the taps around the pixel below the centre.
_FILTERS = {
    "bilinear": (lambda x: 1.0 - np.abs(x), (0, 1)),
    "bicubic": (_cubic, (-1, 0, 1, 2)),
    "box": (lambda x: ((x > -0.5) & (x <= 0.5)).astype(float), (0, 1)),
    "hamming": (_hamming, (0, 1)),
    "lanczos": (_lanczos, (-2, -1, 0, 1, 2, 3)),
}


@lru_cache(maxsize=256)
def resample_weights(source: int, target: int, mode: str) -> np.ndarray:
    """(target, source) matrix that resamples one axis; borders repeat the edge pixel."""
    out = np.zeros((target, source))
    if mode == "nearest":
        out[np.arange(target), np.arange(target) * source // target] = 1.0
        return out
    if mode not in _FILTERS:
        raise ValueError(f"unknown interpolation: {mode}")
    weight_at, taps = _FILTERS[mode]
    centre = (np.arange(target) + 0.5) * source / target - 0.5
    if mode == "bilinear":
        centre = np.maximum(centre, 0.0)
    base = np.floor(centre).astype(int)
    for tap in taps:
        np.add.at(out, (np.arange(target), np.clip(base + tap, 0, source - 1)), weight_at(centre - (base + tap)))
    return out / out.sum(axis=1, keepdims=True) if mode in ("hamming", "lanczos") else out


def resample(images: np.ndarray, size: tuple[int, int], mode: str = "bicubic") -> np.ndarray:
    """Resize (..., h, w, c) images."""
    mode = "bicubic" if mode == "cubic" else mode
    rows = resample_weights(images.shape[-3], size[0], mode)
    cols = resample_weights(images.shape[-2], size[1], mode)
    return np.einsum("ir,...rkc,jk->...ijc", rows, images, cols, optimize=True).astype(np.float32)


def crop(image: np.ndarray, top: int, left: int, h: int, w: int) -> np.ndarray:
    """Box of the image; parts outside are zero."""
    out = np.zeros((h, w, image.shape[2]), image.dtype)
    r0, r1 = max(top, 0), min(top + h, image.shape[0])
    k0, k1 = max(left, 0), min(left + w, image.shape[1])
    if r0 < r1 and k0 < k1:
        out[r0 - top : r1 - top, k0 - left : k1 - left] = image[r0:r1, k0:k1]
    return out


def warp(image: np.ndarray, row_from, col_from, mode: str = "nearest") -> np.ndarray:
    """Warp: output pixel centres, relative to the image centre, map through the two (row, column, offset)
    coefficient triples; what lies outside counts as zero. Weighted means are rounded to whole values."""
    h, w, _ = image.shape
    y = np.arange(h)[:, None] + 0.5 - h / 2
    x = np.arange(w)[None, :] + 0.5 - w / 2
    rows = row_from[0] * y + row_from[1] * x + row_from[2] + h / 2 - 0.5
    cols = col_from[0] * y + col_from[1] * x + col_from[2] + w / 2 - 0.5

    def at(r: np.ndarray, k: np.ndarray) -> np.ndarray:
        inside = (r >= 0) & (r < h) & (k >= 0) & (k < w)
        return np.where(inside[..., None], image[np.clip(r, 0, h - 1), np.clip(k, 0, w - 1)], 0.0)

    if mode == "nearest":
        return at(np.rint(rows).astype(int), np.rint(cols).astype(int)).astype(np.float32)
    mode = "bicubic" if mode == "cubic" else mode
    if mode not in ("bilinear", "bicubic"):
        raise ValueError(f"interpolation that cannot warp: {mode}")
    weight_at, taps = _FILTERS[mode]
    top, left = np.floor(rows).astype(int), np.floor(cols).astype(int)
    out = np.zeros(image.shape)
    for i in taps:
        for j in taps:
            weight = weight_at(rows - (top + i)) * weight_at(cols - (left + j))
            out += weight[..., None] * at(top + i, left + j)
    return np.rint(np.clip(out, 0, 255)).astype(np.float32)


def _blend(image: np.ndarray, other, ratio: float) -> np.ndarray:
    mixed = ratio * image.astype(np.float64) + (1.0 - ratio) * other
    return np.floor(np.clip(mixed, 0, 255)).astype(np.float32)


def _grey(image: np.ndarray) -> np.ndarray:
    if image.shape[2] < 3:
        return image[..., :1]
    r, g, b = (image[..., i : i + 1].astype(np.float64) for i in range(3))
    # Luma weights.
    return np.floor(0.2989 * r + 0.587 * g + 0.114 * b)


def _sharpness(image: np.ndarray, m: float) -> np.ndarray:
    h, w, _ = image.shape
    if h <= 2 or w <= 2:
        return image
    kernel = np.array([[1, 1, 1], [1, 5, 1], [1, 1, 1]]) / 13.0
    blurred = image.astype(np.float64).copy()
    inner = sum(
        kernel[i, j] * image[i : h - 2 + i, j : w - 2 + j].astype(np.float64) for i in range(3) for j in range(3)
    )
    blurred[1:-1, 1:-1] = np.rint(inner)
    return _blend(image, blurred, 1.0 + m)


def _autocontrast(image: np.ndarray) -> np.ndarray:
    low = image.min(axis=(0, 1)).astype(np.float64)
    high = image.max(axis=(0, 1)).astype(np.float64)
    flat = high <= low
    low = np.where(flat, 0.0, low)
    span = np.where(flat, 255.0, high - low)
    return np.floor(np.clip((image - low) * 255.0 / span, 0, 255)).astype(np.float32)


def _equalize(image: np.ndarray) -> np.ndarray:
    out = image.copy()
    for ch in range(image.shape[2]):
        values = image[..., ch].astype(np.int64)
        histogram = np.bincount(values.ravel(), minlength=256)
        used = histogram[histogram > 0]
        step = used[:-1].sum() // 255
        if step == 0:
            continue
        before = np.concatenate([[0], np.cumsum(histogram)[:-1]])
        table = np.clip((before + step // 2) // step, 0, 255)
        table[0] = 0
        out[..., ch] = table[values]
    return out


def augment_op(image: np.ndarray, op: str, m: float, mode: str = "nearest") -> np.ndarray:
    """One of the policy operations on an image with whole values 0..255; ``mode`` is how warps interpolate."""
    straight_row, straight_col = (1.0, 0.0, 0.0), (0.0, 1.0, 0.0)
    h, w, _ = image.shape
    if op == "ShearX":  # about the top left corner
        return warp(image, straight_row, (m, 1.0, m * h / 2), mode)
    if op == "ShearY":
        return warp(image, (1.0, m, m * w / 2), straight_col, mode)
    if op == "TranslateX":
        return warp(image, straight_row, (0.0, 1.0, -float(int(m))), mode)
    if op == "TranslateY":
        return warp(image, (1.0, 0.0, -float(int(m))), straight_col, mode)
    if op == "Rotate":
        sin, cos = math.sin(math.radians(m)), math.cos(math.radians(m))
        return warp(image, (cos, sin, 0.0), (-sin, cos, 0.0), mode)
    if op == "Brightness":
        return _blend(image, 0.0, 1.0 + m)
    if op == "Color":
        return image if image.shape[2] < 3 else _blend(image, _grey(image), 1.0 + m)
    if op == "Contrast":
        return _blend(image, _grey(image).mean(dtype=np.float64), 1.0 + m)
    if op == "Sharpness":
        return _sharpness(image, m)
    if op == "Posterize":
        step = 2 ** (8 - int(m))
        return np.floor(image / step).astype(np.float32) * step
    if op == "Solarize":
        return np.where(image >= m, 255.0 - image, image).astype(np.float32)
    if op == "AutoContrast":
        return _autocontrast(image)
    if op == "Equalize":
        return _equalize(image)
    if op == "Invert":
        return (255.0 - image).astype(np.float32)
    if op == "Identity":
        return image
    raise ValueError(f"unknown operation: {op}")
