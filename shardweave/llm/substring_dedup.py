"""Removing repeated passages: windows of words whose sequence starts earlier elsewhere.

Most windows occur once, so exact grouping of all of them would shuffle the corpus for little. A
count-min sketch finds the candidates first. Each chunk counts into sparse cells; the cells are merged by
slices of the sketch, and what stays is one bit per cell: met twice or more. The second pass groups
exactly only the windows whose cells are all set. Counts are only ever overestimated, so no repeated
window is lost; a sketch that is too small costs time, not results.

To count fewer items, a window stands for its minimiser: the run of ``MARK`` words with the smallest hash
within it. Equal windows have equal minimisers at different positions, so a minimiser's count is never
below the count of a window that it stands for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardweave.llm import chunks as ch
from shardweave.llm.store import everywhere
from shardweave.llm.words import WordHashes, memo, mix, tidy, utf8, windows

# Words of a minimiser; rows of the sketch; cells per row at least and at most (a bit each when broadcast,
# so at most 2 x 64 MB); cells of a slice that is merged as one piece.
MARK, ROWS, LEAST_CELLS, MOST_CELLS, SLICE = 8, 2, 1 << 20, 1 << 29, 1 << 20
# Windows per bucket of the exact pass, on average if all were candidates.
BUCKET_WINDOWS = 2_000_000
LAST = np.iinfo(np.int64).max


def running_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum over each run of ``width`` values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


class Windows:
    """The windows of a chunk's documents."""

    def __init__(self, batch: pa.RecordBatch, id: str, text: str, width: int, known: WordHashes):
        self.words = [data.split() for data in utf8(batch.column(text))]
        ids = batch.column(id).cast(pa.int64())
        self.ids = [LAST if i is None else i for i in ids.to_pylist()]
        self.width = width
        self.mark = min(MARK, width)
        self.hashes = [known.of(words) for words in self.words]

    def minimisers(self) -> np.ndarray:
        """The 32-bit marks of all positions that are the minimiser of some window, with repetitions."""
        found = []
        span = self.width - self.mark + 1
        for hashes in self.hashes:
            if len(hashes) < self.width:
                continue
            marks = windows(hashes, self.mark)
            low = running_min(marks, span)
            chosen = np.zeros(len(marks), bool)
            for offset in range(span):
                chosen[offset : offset + len(low)] |= marks[offset : offset + len(low)] == low
            found.append((marks[chosen] >> np.uint64(32)).astype(np.uint32))
        return np.sort(np.concatenate(found)) if found else np.empty(0, np.uint32)

    def candidates(self, sketch: list[np.ndarray], cells: int):
        """Hash, second hash, document number and start of all windows whose minimiser may repeat."""
        parts = []
        for n, hashes in enumerate(self.hashes):
            if len(hashes) < self.width:
                continue
            low = running_min(windows(hashes, self.mark), self.width - self.mark + 1)
            at = np.flatnonzero(repeated((low >> np.uint64(32)).astype(np.uint32), sketch, cells))
            if len(at):
                first = windows(hashes, self.width)[at]
                second = windows(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), self.width)[at]
                parts.append((first, second, np.full(len(at), n, np.int64), at))
        if not parts:
            return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
        return tuple(np.concatenate(p) for p in zip(*parts))


def cells_of(marks: np.ndarray, row: int, cells: int) -> np.ndarray:
    return mix(marks.astype(np.uint64) + np.uint64((row + 1) << 40)) & np.uint64(cells - 1)


def repeated(marks: np.ndarray, sketch: list[np.ndarray], cells: int) -> np.ndarray:
    """Whether the sketch's estimate of each mark is two or more."""
    yes = np.ones(len(marks), bool)
    for row, bits in enumerate(sketch):
        cell = cells_of(marks, row, cells)
        yes &= (bits[(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return yes


def merged_sketch(chunks: DataFrame, cells: int, parts: int) -> DataFrame:
    """(line, bits): for each slice of the sketch one bit per cell, set if the cell was met twice or more."""
    per = cells // SLICE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for notes in batch.column("notes").to_pylist():
                marks, lines, blocks = np.frombuffer(notes, np.uint32), [], []
                for row in range(ROWS if len(marks) else 0):
                    cell, times = np.unique(cells_of(marks, row, cells), return_counts=True)
                    slice_of = (cell // np.uint64(SLICE)).astype(np.int64)
                    at = np.flatnonzero(np.r_[True, slice_of[1:] != slice_of[:-1]])
                    # The cell within its slice, and above that a bit for twice or more.
                    value = ((cell % np.uint64(SLICE)) + np.uint64(SLICE) * (times > 1).astype(np.uint64)).astype("<u4")
                    for start, stop in zip(at, np.r_[at[1:], len(cell)]):
                        lines.append(row * per + int(slice_of[start]))
                        blocks.append(ch.planes(value[start:stop]))
                yield pa.RecordBatch.from_pydict({"line": pa.array(lines, pa.int64()), "block": pa.array(blocks, pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for line, rows in ch.grouped(batches, "line"):
            once, twice = np.zeros(SLICE, bool), np.zeros(SLICE, bool)
            for (block,) in rows:
                value = ch.unplanes(block, "<u4")
                cell = value % SLICE
                twice[cell] |= once[cell] | (value >= SLICE)
                once[cell] = True
            bits = np.packbits(twice, bitorder="little").tobytes()
            yield pa.RecordBatch.from_pydict({"line": pa.array([line], pa.int64()), "bits": pa.array([bits], pa.binary())})

    counted = chunks.select("notes").mapInArrow(tidy(count), "line bigint, block binary")
    return counted.repartition(parts, "line").sortWithinPartitions("line").mapInArrow(tidy(merge), "line bigint, bits binary")


def later_ones(blocks: list[bytes]) -> tuple[list[bytes], None]:
    """Answer to each block of (hash, second hash, doc, start): a bit per entry, set if the same window
    starts earlier in another block."""
    sizes = [len(b) // 32 for b in blocks]
    first = np.concatenate([ch.ascending(b[: 8 * n]) for b, n in zip(blocks, sizes)])
    second, doc, start = (
        np.concatenate([ch.unplanes(b[8 * k * n : 8 * (k + 1) * n], "<u8") for b, n in zip(blocks, sizes)]) for k in (1, 2, 3)
    )
    doc = doc.view(np.int64)
    order = np.lexsort((start, doc, second, first))
    f, s, d, p = first[order], second[order], doc[order], start[order]
    new = np.r_[True, (f[1:] != f[:-1]) | (s[1:] != s[:-1])] if len(f) else np.empty(0, bool)
    head = np.maximum.accumulate(np.where(new, np.arange(len(f)), 0))
    later = np.zeros(len(f), bool)
    later[order] = (d != d[head]) | (p != p[head])
    return [np.packbits(part, bitorder="little").tobytes() for part in np.split(later, np.cumsum(sizes)[:-1])], None


def local_firsts(w: Windows, found) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the candidates by (hash, second hash, id, start); which begin a new sequence in that order;
    which have the same id and start as the first of their sequence."""
    first, second, number, start = found
    doc = np.array(w.ids, np.int64)[number] if len(number) else number
    order = np.lexsort((start, doc, second, first))
    f, s, d, p = first[order], second[order], doc[order], start[order]
    new = np.r_[True, (f[1:] != f[:-1]) | (s[1:] != s[:-1])] if len(f) else np.empty(0, bool)
    head = np.maximum.accumulate(np.where(new, np.arange(len(f)), 0))
    return order, new, (d == d[head]) & (p == p[head])


def deduplicated(df: DataFrame, id: str = "doc_id", text: str = "text", width: int = 20) -> DataFrame:
    """``df`` with ``n_words``, ``n_removed``, ``kept_text``, in place of columns of these names.

    Words are ``[^\\x20\\x09-\\x0D]+``. Every word is removed that a window of ``width`` words covers whose
    sequence also starts earlier: in a row of smaller id, or further ahead in the same text. Kept words are
    joined by one space. Null and empty texts have no words; texts of fewer words than ``width`` stay whole.
    Rows of equal id count as one place: the same start in two of them is no repetition, a smaller one is.
    A null id comes after all others. One row out for each row in.
    """
    df = df.drop("n_words", "n_removed", "kept_text")
    spark = df.sparkSession

    def note(batch: pa.RecordBatch) -> tuple[int, bytes]:
        w = Windows(batch, id, text, width, memo())
        marks = w.minimisers()
        return sum(map(len, w.hashes)), marks.tobytes()

    chunks = ch.chunked(df, text, "dedup-chunks", note)
    totals = chunks.agg(F.sum("size").alias("words"), F.sum(F.octet_length("notes") / 4).alias("marks")).first()
    words, marks = int(totals.words or 0), int(totals.marks or 0)
    cells = min(MOST_CELLS, max(LEAST_CELLS, 1 << (max(marks, 1) * 6).bit_length()))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = merged_sketch(chunks, cells, min(max(least, 1), ROWS * cells // SLICE)).collect()
    bits = [np.zeros(cells // 8, np.uint8) for _ in range(ROWS)]
    per = cells // SLICE
    for line in lines:  # bounded by MOST_CELLS
        at = line.line % per * (SLICE // 8)
        bits[line.line // per][at : at + SLICE // 8] = np.frombuffer(line.bits, np.uint8)
    sketch = everywhere(spark, bits)
    buckets = max(least, -(-words // BUCKET_WINDOWS))

    def ask(row: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
        w = Windows(ch.unpack(row.column("payload")[0].as_py()), id, text, width, memo())
        found = w.candidates(sketch.value, cells)
        order, new, _ = local_firsts(w, found)
        firsts = order[new]
        doc = np.array(w.ids, np.int64)
        columns = [found[0][firsts], found[1][firsts], doc[found[2][firsts]].view(np.uint64), found[3][firsts].astype(np.uint64)]
        for bucket, start, stop in ch.slices(columns[0], buckets):
            yield bucket, ch.gaps(columns[0][start:stop]) + b"".join(ch.planes(c[start:stop]) for c in columns[1:])

    answers = ch.asked(chunks.select("chunk", "payload"), ask, later_ones, buckets)
    asked = ch.answered(chunks.select("chunk", "payload"), answers, "answers")
    names = df.columns

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                rows = ch.unpack(batch.column("payload")[i].as_py())
                w = Windows(rows, id, text, width, memo())
                found = w.candidates(sketch.value, cells)
                order, new, at_first = local_firsts(w, found)
                later = np.zeros(int(new.sum()), bool)
                for bucket_bits, (_, start, stop) in zip(
                    ch.joined(batch.column("answers")[i].as_py()), ch.slices(found[0][order[new]], buckets), strict=True
                ):
                    later[start:stop] = np.unpackbits(np.frombuffer(bucket_bits, np.uint8), bitorder="little")[: stop - start]
                # A window goes if its sequence is earlier in this chunk, or if even the chunk's first is later.
                goes = ~at_first | later[np.cumsum(new) - 1] if len(order) else np.empty(0, bool)
                number, start = found[2][order[goes]], found[3][order[goes]]
                by_row = np.argsort(number, kind="stable")
                number, start = number[by_row], start[by_row]
                cut = np.searchsorted(number, np.arange(len(rows) + 1))
                removed, kept = [], []
                for n, words in enumerate(w.words):
                    if cut[n] == cut[n + 1]:
                        removed.append(0)
                        kept.append(b" ".join(words))
                        continue
                    edge = np.zeros(len(words) + 1, np.int64)
                    mine = start[cut[n] : cut[n + 1]]
                    np.add.at(edge, mine, 1)
                    np.add.at(edge, mine + width, -1)
                    covered = np.cumsum(edge[:-1]) > 0
                    removed.append(int(covered.sum()))
                    kept.append(b" ".join([words[k] for k in np.flatnonzero(~covered)]))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(n) for n in names]
                    + [
                        pa.array(map(len, w.words), pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=[*names, "n_words", "n_removed", "kept_text"],
                )

    schema = df.select("*", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("kept_text"))
    return asked.mapInArrow(tidy(finish), schema.schema)
