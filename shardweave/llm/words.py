"""Words of a text and their 64-bit hashes, shared by the operators on word sequences."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Entries that a worker's memo of word hashes may hold before it starts anew (about 40 MB).
MEMO_ENTRIES = 200_000


class WordHashes(dict):
    """Memo from a word (bytes) to its 64-bit hash; bounded, so that it fits any vocabulary."""

    def __missing__(self, word: bytes, digest=xxhash.xxh3_64_intdigest) -> int:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        value = self[word] = digest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column one by one, empty for null.

    ``bytes.split()`` cuts exactly at [\\x20\\x09-\\x0D]+, and ``bytes.lower()`` changes A-Z alone.
    """
    for text in column.cast(pa.binary()):
        yield text.as_py() or b""


def text_slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(start, rows) of pieces of a string column that hold at most ``most`` bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(column):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop - start
        start = stop


def give_back() -> None:
    """Return freed memory to the system: workers live on, and other tasks share the machine."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run: Callable) -> Callable:
    """``run``, a function for ``mapInArrow``, whose worker keeps no memo and no freed memory after a task.

    Workers live on between tasks and stages, and those of several operators stand side by side.
    """

    @wraps(run)
    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _MEMO.clear()
            give_back()

    return outer


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Odd multiplier of the polynomial hash of a word sequence.
BASE = 0x9E3779B97F4A7C15


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash for each run of ``width`` consecutive words; empty if there are fewer words.

    A polynomial in the word hashes, put together from runs of doubled length.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    result, have = None, 0
    power, size = hashes, 1
    while size <= width:
        if width & size:
            if result is None:
                result, have = power, size
            else:
                scale = np.uint64(pow(BASE, size, 1 << 64))
                m = len(hashes) - have - size + 1
                result, have = result[:m] * scale + power[have : have + m], have + size
        if size * 2 <= width:
            scale = np.uint64(pow(BASE, size, 1 << 64))
            power = power[:-size] * scale + power[size:]
        size *= 2
    return mix(result[:n])


# Bytes whose powers of BASE are at hand; a random number for each byte.
PIECE = 1 << 16
_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(PIECE, base, np.uint64)])


_POWERS, _INVERSE = _powers(BASE), _powers(pow(BASE, -1, 1 << 64))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``data``, runs of bytes other than the space, start, and their 64-bit hashes.

    A hash is a polynomial in random numbers of the bytes, so it comes from running sums, without an object per word.
    """
    starts, hashes, low = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
    while low < len(data):
        high = len(data) if len(data) - low <= PIECE else data.rfind(b" ", low, low + PIECE) + 1
        if not high:  # a word longer than a piece
            high = data.find(b" ", low + PIECE)
            high = len(data) if high < 0 else high
            total = 0
            for at in range(low, high, PIECE):
                letters = np.frombuffer(data, np.uint8, min(PIECE, high - at), at)
                part = int((_LETTERS[letters] * _POWERS[: len(letters)]).sum(dtype=np.uint64))
                total += part * pow(BASE, at - low, 1 << 64)
            starts.append(np.array([low]))
            hashes.append(np.array([total % (1 << 64)], np.uint64))
        else:
            letters = np.frombuffer(data, np.uint8, high - low, low)
            edges = np.flatnonzero(np.diff(letters != 32, prepend=False, append=False))
            begin, end = edges[::2], edges[1::2]
            sums = np.zeros(len(letters) + 1, np.uint64)
            np.cumsum(_LETTERS[letters] * _POWERS[: len(letters)], out=sums[1:])
            starts.append(begin + low)
            hashes.append((sums[end] - sums[begin]) * _INVERSE[begin])
        low = high
    return np.concatenate(starts), mix(np.concatenate(hashes))


def texts_hashes(texts: list[bytes], table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of ``texts``, end to end, and how many words each has. ``table`` translates bytes; the
    space stands between words."""
    starts, hashes = word_hashes(b" ".join(texts).translate(table))
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)


_MEMO: list[WordHashes] = []


def memo() -> WordHashes:
    """The worker's memo of word hashes."""
    if not _MEMO:
        _MEMO.append(WordHashes())
    return _MEMO[0]
