"""Fill-in-middle: texts rearranged as prefix, suffix, middle, and put back.

A whole Arrow batch of texts is one array of bytes. Where each text is cut comes from a scan of its units; the
parts then only move: an array of differences holds, at the first byte of every part, by how much its place in
the output differs from that of the part before, the running sum of it is the shift of every byte, and one
scatter writes all outputs of the batch. Restoring finds the marks in the outputs and gathers through the shifts
the other way round. No text is handled on its own, and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardweave.llm.words import give_back, text_slices

# The marks of the parts, all of three bytes.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"], object)
# Bytes of text that are rearranged at a time; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Rates:
    """Of a hundred texts, how many are rearranged, and how many of those with the suffix first."""

    rearranged: int = 90
    suffix_first: int = 20


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row starts, with the end of the last; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def strings(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(starts, np.int64)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_string(), len(starts) - 1, buffers).cast(pa.string())


def unit_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where units begin: a run of letters A-Z and a-z, or any other single code point."""
    lower = data | 0x20
    letter = (lower >= 97) & (lower <= 122) & (data < 128)
    first = (data & 0xC0) != 0x80
    first[1:] &= ~(letter[1:] & letter[:-1])
    first[starts[:-1][starts[:-1] < len(data)]] = True
    return np.flatnonzero(first)


def marks_at(data: np.ndarray, which: bytes) -> np.ndarray:
    """Where a mark begins whose letter is one of ``which``, in ascending order."""
    if len(data) < MARK:
        return np.empty(0, np.int64)
    open_at = np.flatnonzero((data[:-2] == 60) & (data[2:] == 62))
    return open_at[np.isin(data[open_at + 1], np.frombuffer(which, np.uint8))]


def digest_numbers(ids: list) -> np.ndarray:
    """The first four groups of eight hexadecimal digits of sha256 of ``1:`` and the id, as numbers."""
    digests = b"".join(hashlib.sha256(b"1:" + (b"" if i is None else str(i).encode())).digest()[:16] for i in ids)
    return np.frombuffer(digests, ">u4").reshape(len(ids), 4).astype(np.int64)


def moved(data: np.ndarray, part_starts: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The place in the output of every byte: parts ascend by start, empty ones too, and cover ``data``."""
    difference = np.zeros(len(data) + 1, np.int64)
    np.add.at(difference, part_starts, np.diff(shifts, prepend=0))
    return np.arange(len(data)) + np.cumsum(difference[:-1])


def rearranged(ids: list, column: pa.Array, rates: Rates) -> list[pa.Array]:
    """Columns ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output`` of a batch."""
    data, starts = string_bytes(column)
    rows = len(starts) - 1
    begin, end = starts[:-1], starts[1:]
    units = unit_starts(data, starts)
    first_unit = np.searchsorted(units, starts)
    n = np.diff(first_unit)
    h = digest_numbers(ids) if rows else np.empty((0, 4), np.int64)

    owner = np.searchsorted(starts, marks := marks_at(data, b"PSM"), side="right") - 1
    marked = np.zeros(rows, bool)
    marked[owner[marks + MARK <= end[owner]]] = True
    form = np.where(h[:, 3] % 100 < rates.suffix_first, SPM, PSM)
    form[(n == 0) | marked | (h[:, 2] % 100 >= rates.rearranged)] = PLAIN

    # The cuts as bytes; n units make n + 1 places to cut, the last of which is the end.
    places = np.append(units, len(data))
    cuts = np.sort(np.stack([h[:, 0] % (n + 1), h[:, 1] % (n + 1)]), axis=0)
    low, high = (np.where(cut == n, end, places[first_unit[:-1] + np.minimum(cut, n)]) for cut in cuts)
    low, high = np.where(form == PLAIN, end, low), np.where(form == PLAIN, end, high)
    code_points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    plain = form == PLAIN
    prefix_chars = pa.array(code_points[low] - code_points[begin], pa.int64(), mask=plain)
    middle_chars = pa.array(code_points[high] - code_points[low], pa.int64(), mask=plain)

    # Every part's shift, in the order of the text: prefix, middle, suffix.
    ends = np.cumsum(np.where(plain, end - begin, end - begin + 3 * MARK))
    into = np.append(0, ends)
    prefix, middle, suffix = low - begin, high - low, end - high
    at_prefix = into[:-1] + np.select([plain, form == PSM], [0, MARK], 2 * MARK + suffix)
    at_suffix = into[:-1] + np.where(form == PSM, 2 * MARK + prefix, MARK)
    at_middle = into[:-1] + 3 * MARK + prefix + suffix
    targets = np.stack([at_prefix, at_middle, at_suffix], axis=1)
    sources = np.stack([begin, low, high], axis=1)
    output = np.empty(into[-1], np.uint8)
    output[moved(data, sources.ravel(), (targets - sources).ravel())] = data
    for at, mark in ((at_prefix, PREFIX), (at_middle, MIDDLE), (at_suffix, SUFFIX)):
        # In the suffix-first form the prefix's mark stands before the prefix as well.
        for k, byte in enumerate(mark):
            output[at[~plain] - MARK + k] = byte
    return [pa.array(n, pa.int64()), pa.array(FORMS[form], pa.string()), prefix_chars, middle_chars, strings(output, into)]


def put_back(column: pa.Array, forms: pa.Array) -> pa.Array:
    """The texts that ``rearranged`` made a batch of outputs of."""
    data, starts = string_bytes(column)
    form = pc.fill_null(pc.index_in(forms, pa.array(FORMS, pa.string())), PLAIN).to_numpy(zero_copy_only=False)
    plain = form == PLAIN
    marks = marks_at(data, b"PSM")
    owner = np.searchsorted(starts, marks, side="right") - 1
    # A plain text may hold marks; a mark that crosses into the next row is none.
    marks = marks[~plain[owner] & (marks + MARK <= starts[owner + 1])]
    if len(marks) != 3 * int((~plain).sum()):
        raise ValueError("an output of the form psm or spm must hold three marks")
    into_rows = np.where(plain, np.diff(starts), np.diff(starts) - 3 * MARK)
    into = np.append(0, np.cumsum(into_rows))
    # The parts of the restored text are taken from these places, in the order prefix, middle, suffix.
    found = marks.reshape(-1, 3)
    by_form = np.where((form[~plain] == PSM)[:, None], found[:, [0, 2, 1]], found[:, [1, 2, 0]]) + MARK
    stops = np.column_stack([found[:, 1:], starts[1:][~plain]])
    by_stop = np.where((form[~plain] == PSM)[:, None], stops[:, [0, 2, 1]], stops[:, [1, 2, 0]])
    # A plain row is one part, its prefix.
    source = np.repeat(starts[1:, None], 3, axis=1)
    source[plain, 0] = starts[:-1][plain]
    source[~plain] = by_form
    length = np.zeros((len(form), 3), np.int64)
    length[plain, 0] = into_rows[plain]
    length[~plain] = by_stop - by_form
    place = into[:-1, None] + np.cumsum(length, axis=1) - length
    out = np.empty(into[-1], np.uint8)
    out[:] = data[moved(out, place.ravel(), (source - place).ravel())]
    return strings(out, into)


NEW = {"n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output": "string"}


def transformed(df: DataFrame, id: str = "doc_id", text: str = "text", rates: Rates = Rates()) -> DataFrame:
    """``df`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output`` in place of columns of these names.

    A text is cut into units (runs of A-Z and a-z, other code points one by one); two hashes of its id say after
    how many units the prefix and the middle end, a third whether it is rearranged at all, a fourth whether the
    suffix comes first. Texts that are empty, or that hold a mark, are ``plain``: their output is the text, and
    the lengths of their parts are null. A null text counts as empty; ids are hashed as their decimal (or
    string) form, null as an empty one, so rows of one id are cut by the same hashes. One row out for each row
    in; no shuffle; an empty table stays empty. ``id`` and ``text`` must not be columns that are replaced.
    """
    df = df.drop(*NEW)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, rows in text_slices(batch.column(text), SLICE_BYTES):
                part = batch.slice(start, rows)
                made = rearranged(part.column(id).to_pylist(), part.column(text), rates)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *made], names=[*names, *NEW])
        give_back()

    schema = df.select("*", *(F.lit(None).cast(kind).alias(name) for name, kind in NEW.items())).schema
    return df.mapInArrow(run, schema)


def restored(df: DataFrame, output: str = "output", form: str = "form", into: str = "restored") -> DataFrame:
    """``df`` with the texts that were rearranged, in ``into`` (replaced), from their outputs and forms alone.

    A null output is an empty text; a null or unknown form counts as plain. An output of another form without
    its three marks was not made by ``transformed`` and is an error. One row out for each row in.
    """
    df = df.drop(into)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, rows in text_slices(batch.column(output), SLICE_BYTES):
                part = batch.slice(start, rows)
                made = put_back(part.column(output), part.column(form))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), made], names=[*names, into])
        give_back()

    return df.mapInArrow(run, df.select("*", F.lit(None).cast("string").alias(into)).schema)
