"""TFRecord shards: framed records that hold named features."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardweave.sources.files import open_fs, packed, plan_ranges

FEATURE = "STRUCT<bytes: ARRAY<BINARY>, floats: ARRAY<FLOAT>, ints: ARRAY<BIGINT>>"
RECORD = f"features MAP<STRING, {FEATURE}>, _shard STRING, _pos STRUCT<block: BIGINT, line: BIGINT>"
_ARROW = pa.schema(
    [
        (
            "features",
            pa.map_(
                pa.string(),
                pa.struct(
                    [
                        ("bytes", pa.list_(pa.binary())),
                        ("floats", pa.list_(pa.float32())),
                        ("ints", pa.list_(pa.int64())),
                    ]
                ),
            ),
        ),
        ("_shard", pa.string()),
        ("_pos", pa.struct([("block", pa.int64()), ("line", pa.int64())])),
    ]
)
# Fixed values of the framing: 8 bytes of length and 4 of checksum before the data, 4 after it.
_HEAD, _TAIL = 12, 4
BATCH_ROWS, BATCH_BYTES = 1024, 32 << 20


def record_starts(file, size: int) -> Iterator[int]:
    """Offsets of the frames."""
    at = 0
    while at < size:
        yield at
        file.seek(at)
        (length,) = struct.unpack("<Q", file.read(8))
        at += _HEAD + length + _TAIL


class Fields(NamedTuple):
    """Fields of many messages, ordered by message (its index is the owner), then by place. The span of a
    field is its content, for a number the number as it is written."""

    owner: np.ndarray
    number: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    def only(self, number: int) -> Fields:
        kept = self.number == number
        return Fields(*[column[kept] for column in self])


def _varints(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers written at the offsets ``at``, and the offsets behind them."""
    value, at = np.zeros(len(at), np.uint64), at.copy()
    unfinished = np.arange(len(at))
    for shift in range(0, 70, 7):
        if at[unfinished].max(initial=-1) >= len(data):
            break
        byte = data[at[unfinished]].astype(np.uint64)
        value[unfinished] |= (byte & np.uint64(0x7F)) << np.uint64(shift)
        at[unfinished] += 1
        unfinished = unfinished[byte >= 0x80]
        if not len(unfinished):
            return value, at
    raise ValueError("malformed number in a record")


def _fields(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> Fields:
    """Fields of the messages in the given spans: the next field of all of them at a time."""
    found: list[tuple[np.ndarray, ...]] = []
    live = np.flatnonzero(start < stop)
    at = start[live]
    while len(live):
        tag, at = _varints(data, at)
        wire = tag & np.uint64(7)
        behind = at + np.where(wire == 5, 4, 8)
        begin = at.copy()
        counted = np.flatnonzero((wire == 0) | (wire == 2))
        value, behind[counted] = _varints(data, at[counted])
        sized = wire[counted] == 2
        begin[counted[sized]] = behind[counted[sized]]
        behind[counted[sized]] += value[sized].astype(np.int64)
        if ((wire == 3) | (wire == 4) | (wire > 5) | (behind > stop[live]) | (behind < begin)).any():
            raise ValueError("malformed field in a record")
        found.append((live, (tag >> np.uint64(3)).astype(np.int64), begin, behind))
        more = behind < stop[live]
        live, at = live[more], behind[more]
    if not found:
        return Fields(*[np.empty(0, np.int64)] * 4)
    columns = [np.concatenate(column) for column in zip(*found)]
    order = np.argsort(columns[0], kind="stable")
    return Fields(*[column[order] for column in columns])


def _joined(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> bytes:
    view = memoryview(data)
    return b"".join([view[b:e] for b, e in zip(begin.tolist(), end.tolist())])


def _ends(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _binary(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer(_ends(end - begin).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(begin), [None, offsets, pa.py_buffer(_joined(data, begin, end))])


def _floats(data: np.ndarray, spans: Fields) -> tuple[pa.Array, np.ndarray]:
    """Floats of all spans, and how many each holds."""
    sizes = spans.end - spans.begin
    if (sizes % 4).any():
        raise ValueError("malformed floats in a record")
    values = np.frombuffer(_joined(data, spans.begin, spans.end), "<f4")
    return pa.array(values.astype(np.float32), pa.float32()), sizes // 4


def _ints(data: np.ndarray, spans: Fields) -> tuple[pa.Array, np.ndarray]:
    """Whole numbers of all spans, and how many each holds."""
    raw = np.frombuffer(_joined(data, spans.begin, spans.end), np.uint8)
    last = raw < 0x80
    ends = _ends(spans.end - spans.begin)
    filled = ends[1:] > ends[:-1]
    if not last[ends[1:][filled] - 1].all():
        raise ValueError("malformed number in a record")
    counts = np.diff(_ends(last)[ends])
    stops = np.flatnonzero(last) + 1
    starts = np.concatenate([[0], stops[:-1]]).astype(np.int64)[: len(stops)]
    place = np.arange(len(raw)) - np.repeat(starts, stops - starts)
    if place.max(initial=0) > 9:
        raise ValueError("malformed number in a record")
    parts = (raw & 0x7F).astype(np.uint64) << (7 * place).astype(np.uint64)
    values = np.bitwise_or.reduceat(parts, starts) if len(starts) else parts
    return pa.array(values.view(np.int64), pa.int64()), counts


def _list(data: np.ndarray, bodies: Fields, kind: int, n: int) -> pa.Array:
    """The lists of one kind of ``n`` features, null for features of another kind."""
    begin, end, there = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    mine = bodies.only(kind)
    begin[mine.owner], end[mine.owner], there[mine.owner] = mine.begin, mine.end, True  # the last one counts
    spans = _fields(data, begin, end).only(1)
    if kind == 1:
        values, counts = _binary(data, spans.begin, spans.end), np.ones(len(spans.owner), np.int64)
    else:
        values, counts = (_floats if kind == 2 else _ints)(data, spans)
    lengths = np.bincount(spans.owner, weights=counts, minlength=n).astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(_ends(lengths), pa.int32()), values, mask=pa.array(~there))


def decode(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    """Named features of the records in the given spans of a buffer, as an Arrow map.

    Each level of the nested messages is walked for all records of the buffer together. Of a name that a record
    repeats the last features count, in the place of the first. A malformed record is an error.
    """
    groups = _fields(data, start, stop).only(1)
    entries = _fields(data, groups.begin, groups.end).only(1)
    record = groups.owner[entries.owner]
    n = len(record)
    parts = _fields(data, entries.begin, entries.end)
    spans = np.zeros((2, 2, n), np.int64)
    for which, found in enumerate((parts.only(1), parts.only(2))):
        spans[which, 0, found.owner], spans[which, 1, found.owner] = found.begin, found.end
    names = _binary(data, *spans[0]).cast(pa.string())
    encoded = names.dictionary_encode()
    code = record * max(1, len(encoded.dictionary)) + encoded.indices.to_numpy()
    unique, first = np.unique(code, return_index=True)
    if len(unique) < n:
        last = n - 1 - np.unique(code[::-1], return_index=True)[1]
        kept = last[np.argsort(first)]
        names, record, spans, n = names.take(pa.array(kept)), record[kept], spans[:, :, kept], len(kept)
    bodies = _fields(data, *spans[1])
    lists = [_list(data, bodies, kind, n) for kind in (1, 2, 3)]
    kinds = _ARROW.field("features").type.item_type
    features = pa.StructArray.from_arrays(lists, fields=list(kinds))
    ends = _ends(np.bincount(record, minlength=len(start)))
    return pa.MapArray.from_arrays(pa.array(ends, pa.int32()), names, features)


def parse_record(data: bytes) -> list[tuple[str, dict]]:
    """Named features of one record."""
    return decode(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]))[0].as_py()


def _frames(path: str, start: int, stop: int) -> Iterator[tuple[int, bytes, list[int], list[int]]]:
    """Pieces of a file with where they lie in it, and the spans of the records that they hold whole."""
    fs, inner = open_fs(path)
    with fs.open_input_file(inner) as file:
        at, wanted = start, BATCH_BYTES
        while at < stop:
            file.seek(at)
            data = file.read(min(wanted, stop - at))
            begins, ends, here = [], [], 0
            while at + here < stop and here + _HEAD <= len(data):
                (length,) = struct.unpack_from("<Q", data, here)
                if here + _HEAD + length > len(data):
                    break
                begins.append(here + _HEAD)
                ends.append(here + _HEAD + length)
                here += _HEAD + length + _TAIL
            if begins:
                yield at, data, begins, ends
                at, wanted = at + here, BATCH_BYTES
            elif len(data) < wanted:
                raise ValueError(f"{path} ends inside a record at {at}")
            else:  # a record larger than a piece
                wanted = _HEAD + length


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for work in batch.to_pylist():
            for at, piece, begins, ends in _frames(work["path"], work["start"], work["stop"]):
                data = np.frombuffer(piece, np.uint8)
                for i in range(0, len(begins), BATCH_ROWS):
                    begin, end = np.array(begins[i : i + BATCH_ROWS]), np.array(ends[i : i + BATCH_ROWS])
                    n = len(begin)
                    places = pa.StructArray.from_arrays(
                        [pa.array(np.zeros(n, np.int64)), pa.array(at + begin - _HEAD)], ["block", "line"]
                    )
                    shards = pa.array([work["path"]] * n, pa.string())
                    yield pa.RecordBatch.from_arrays([decode(data, begin, end), shards, places], schema=_ARROW)


def read_tfrecord(
    spark: SparkSession,
    paths: DataFrame | list[str],
    shuffle_seed: int | None = None,
    split_bytes: int = 1 << 30,
) -> DataFrame:
    """Records of TFRecord shards as a map of named features.

    ``shuffle_seed`` puts the records of a shard in a random order: ``_pos``, by which writers sort,
    then starts with a hash. That costs no exchange, and the order does not depend on the splits.
    """
    if not isinstance(paths, DataFrame):
        paths = spark.createDataFrame([(p,) for p in paths], "path STRING")
    records = packed(plan_ranges(paths, record_starts, split_bytes)).mapInArrow(_read, RECORD)
    if shuffle_seed is None:
        return records
    drawn = F.xxhash64(F.lit(shuffle_seed), F.col("_shard"), F.col("_pos.line"))
    return records.withColumn("_pos", F.struct(drawn.alias("block"), F.col("_pos.line").alias("line")))
