"""Bounded groups of documents, and questions that such groups ask of all others.

Operators that compare word sequences across the corpus would shuffle one row per word. Here documents
are gathered into chunks of a few megabytes, written once; each chunk reduces its words to distinct keys
with NumPy, sends them in packed blocks to the key's bucket, and gets one answer per key back in the same
order. A key that fills a third of the corpus so costs a bucket one entry per chunk, not one per row, and
no task ever holds more than a bucket or a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardweave.llm.store import stored_by
from shardweave.llm.words import tidy

# Bytes of text in a chunk (a longer document is a chunk of its own).
CHUNK_BYTES = 2 << 20


_ZSTD = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))


def pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=_ZSTD) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


def planes(values: np.ndarray) -> bytes:
    """The values byte plane by byte plane, so that the zero bytes of small numbers compress away."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unplanes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def chunked(df: DataFrame, text: str, label: str, note: Callable[[pa.RecordBatch], tuple[int, bytes]]) -> DataFrame:
    """The rows of ``df`` as chunks: ``chunk``, ``payload`` (all columns), ``n_rows``, and what ``note`` gives
    for each: a number ``size`` and a block ``notes``.

    Written once, so that chunks stay what they are, and bucketed, so that answers come to them without
    another shuffle of their texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            column = batch.column(text)
            ends = np.cumsum(np.fromiter((0 if n is None else n for n in pa.compute.binary_length(column).to_pylist()), np.int64, len(batch)))
            start = 0
            while start < len(batch):
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, side="right")))
                part = batch.slice(start, stop - start)
                size, notes = note(part)
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([number], pa.int64()),
                        "n_rows": pa.array([len(part)], pa.int64()),
                        "size": pa.array([size], pa.int64()),
                        "notes": pa.array([notes], pa.binary()),
                        "payload": pa.array([pack(part)], pa.binary()),
                    }
                )
                number, start = number + 1, stop

    schema = "chunk bigint, n_rows bigint, size bigint, notes binary, payload binary"
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored_by(df.mapInArrow(tidy(run), schema), label, "chunk", buckets)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of 64-bit hashes by their high bits, ascending with the hash."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def slices(sorted_keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, start, stop) of each bucket in ascending hashes."""
    of = bucket_of(sorted_keys, buckets)
    at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)
    for start, stop in zip(at, np.r_[at[1:], len(of)]):
        yield int(of[start]), int(start), int(stop)


def asked(
    chunks: DataFrame,
    ask: Callable[[pa.RecordBatch], Iterator[tuple[int, bytes]]],
    reply: Callable[[list[bytes]], tuple[list[bytes], bytes | None]],
    parts: int,
) -> DataFrame:
    """(chunk, bucket, answer): ``ask`` turns a chunk row into blocks per bucket, ``reply`` all blocks of a
    bucket into one answer each, and a summary of the bucket, which comes as chunk -1 unless it is None.
    Only blocks are shuffled, by bucket."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                chunk = row.column("chunk")[0].as_py()
                pairs = [(bucket, squeezed(block)) for bucket, block in ask(row)]
                if pairs:
                    yield pa.RecordBatch.from_pydict(
                        {
                            "bucket": pa.array([p[0] for p in pairs], pa.int64()),
                            "chunk": pa.array([chunk] * len(pairs), pa.int64()),
                            "block": pa.array([p[1] for p in pairs], pa.binary()),
                        }
                    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in grouped(batches, "bucket"):
            answers, summary = reply([loose(block) for _, block in rows])
            answers = [squeezed(answer) for answer in answers]
            if summary is not None:
                answers, rows = [*answers, summary], [*rows, (-1, b"")]
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([chunk for chunk, _ in rows], pa.int64()),
                    "bucket": pa.array([bucket] * len(rows), pa.int64()),
                    "answer": pa.array(answers, pa.binary()),
                }
            )

    sent = chunks.mapInArrow(tidy(send), "bucket bigint, chunk bigint, block binary")
    dealt = sent.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(tidy(answer), "chunk bigint, bucket bigint, answer binary")


def squeezed(block: bytes) -> bytes:
    """Blocks lie in Arrow batches on both sides of the Python border; compressed, they take far less there."""
    return zstandard.ZstdCompressor(level=1).compress(block)


def loose(block: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(block)


def gaps(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as differences, whose high bytes compress away."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def ascending(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, "<u8"), dtype=np.uint64)


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[tuple]]]:
    """Runs of equal ``key`` over batches sorted by it; each row's other columns as a tuple."""
    current, rows = None, []
    for batch in batches:
        others = [batch.column(n).to_pylist() for n in batch.schema.names if n != key]
        for value, *rest in zip(batch.column(key).to_pylist(), *others):
            if value != current and rows:
                yield current, rows
                rows = []
            current = value
            rows.append(tuple(rest))
    if rows:
        yield current, rows


def answered(chunks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """``chunks`` with all answers of each in an array ``name`` (empty if it asked nothing).

    An array holds at most one block per bucket, together as large as the chunk's keys.
    """
    per = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "answer")).alias(name))
    return chunks.join(per, "chunk", "left")


def joined(answers: list[dict] | None) -> list[bytes]:
    """The answers of one chunk in the order of its ascending keys."""
    return [loose(a["answer"]) for a in sorted(answers or [], key=lambda a: a["bucket"])]
