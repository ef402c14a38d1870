"""Alignment of two tokenizers' tokens over the same bytes, and how usual each aligned pair is in the corpus.

Both tokenizers encode whole texts. Where a token of each begins with a space at the same byte, and so the tokens
before it end together, the text is cut: between two such anchors lies a window of a few token ids of either side,
mostly one word. What a window holds, its groups and its overlapping pairs, depends on its ids alone and is kept
in a memo under the two tuples of ids, so a word that occurs a million times is aligned once per worker.

Texts are gathered into chunks, of which each sends one row per distinct pair of ids to be counted, whatever
number of its texts hold that pair, and gets one row back for it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardweave.llm.byte_bpe import splits
from shardweave.llm.chunks import CHUNK_BYTES, loose, pack, planes, squeezed, unpack, unplanes
from shardweave.llm.store import everywhere, stored
from shardweave.llm.words import give_back, mix, text_slices

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
from tokenizers import Tokenizer  # noqa: E402

# Windows in a worker's memo before it starts anew, and the most ids of a window that is kept there.
MEMO_WINDOWS, MEMO_IDS = 250_000, 48
# Code points of a text from which on the library of the file encodes it.
LONG = 1 << 18
# Fixed value: how byte-level BPE splits texts.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# An id pair is one number: the first id above this many bits of the second.
SHIFT = 20
NEW = {"n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint", "count_sum": "bigint", "groups": "string"}


def file_bytes(spark: SparkSession, path: str) -> bytes:
    """A tokenizer's file, a few megabytes. ``path`` may be local to the driver or Spark's."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).first().content)
    with open(path, "rb") as file:
        return file.read()


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1 as itself, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(byte): byte for byte in shown}
    hidden = (byte for byte in range(256) if byte not in set(shown))
    return letters | {chr(0x100 + n): byte for n, byte in enumerate(hidden)}


def as_ranks(data: bytes) -> dict[bytes, int] | None:
    """The vocabulary of a byte-level BPE file as ranks, if merging by ranks is sure to give the same ids.

    That is so if every token is made by one merge, in the order of the ids, and if ranks alone take the bytes of
    each token to that very merge; and if texts are split in the usual way and changed by nothing else.
    """
    file, letters = json.loads(data), byte_letters()
    model, split = file["model"], file.get("pre_tokenizer") or {}
    usual = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    if model.get("type") != "BPE" or not usual or file.get("normalizer") or model.get("dropout") or model.get("ignore_merges"):
        return None
    special = {token["content"] for token in file.get("added_tokens", [])}
    vocabulary = {entry: number for entry, number in model["vocab"].items() if entry not in special}
    if not all(letter in letters for entry in vocabulary for letter in entry):
        return None
    ranks = {bytes(letters[letter] for letter in entry): number for entry, number in vocabulary.items()}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = {vocabulary[a + b]: (vocabulary[a], vocabulary[b]) for a, b in merges}
    one = sum(len(token) == 1 for token in ranks)
    ordered = [vocabulary[a + b] for a, b in merges] == sorted(made) and one == 256 and len(ranks) == one + len(merges)
    return ranks if ordered and splits(ranks) == made else None


class ByteLevel:
    """A byte-level BPE tokenizer from a ``tokenizers`` file; texts are encoded with a space before them.

    With ``ranks`` (see ``as_ranks``) the quicker library for these encodes, but for texts of ``LONG`` and more,
    whose runs of white space may be beyond it.
    """

    def __init__(self, data: bytes, ranks: dict[bytes, int] | None = None):
        self.tokenizer = Tokenizer.from_str(data.decode())
        self.tokenizer.encode_special_tokens = True
        self.ranks = None if ranks is None else tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        letters, ids = byte_letters(), json.loads(data)["model"]["vocab"]
        self.bytes = [b""] * (max(ids.values()) + 1)
        for entry, number in ids.items():
            if all(letter in letters for letter in entry):
                self.bytes[number] = bytes(letters[letter] for letter in entry)

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.ranks is None:
            return [e.ids for e in self.tokenizer.encode_batch_fast([" " + text for text in texts], add_special_tokens=False)]
        encode = self.ranks.encode_ordinary
        return [encode(" " + t) if len(t) < LONG else self.tokenizer.encode(" " + t, add_special_tokens=False).ids for t in texts]


class Pieces:
    """A ``sentencepiece`` model, which puts a space before each text itself."""

    def __init__(self, data: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.bytes = [self._bytes(number) for number in range(self.model.get_piece_size())]

    def _bytes(self, number: int) -> bytes:
        piece = self.model.id_to_piece(number)
        if re.fullmatch("<0x[0-9A-Fa-f]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[k], starts[k] + 1, ... of each of some ranges, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What two ascending arrays without repetitions have in common."""
    if not len(a) or not len(b):
        return a[:0]
    return a[b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a]


# Odd multiplier of the hash of a run of ids, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def run_hashes(ids: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of ids between cuts: a difference of running sums, moved to the run's own start."""
    powers, back = (np.cumprod(np.append(np.uint64(1), np.full(len(ids), base, np.uint64))) for base in (BASE, INVERSE))
    sums = np.append(np.uint64(0), np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * powers[:-1]))
    return mix((sums[cuts[1:]] - sums[cuts[:-1]]) * back[cuts[:-1]] + (cuts[1:] - cuts[:-1]).astype(np.uint64))


class Aligner:
    """Aligns texts by windows; the memo maps a window's ids to the number of its entry."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.sizes = [np.array([len(token) for token in t.bytes], np.int64) for t in (a, b)]
        self.spaced = [np.array([token.startswith(b" ") for token in t.bytes]) for t in (a, b)]
        # Ids as they are written within a group and at the end of its first and second half.
        numbers = [range(len(t.bytes)) for t in (a, b)]
        self.inner = [np.array([f"{n}," for n in side], object) for side in numbers]
        self.last = [np.array([f"{n}{mark}" for n in side], object) for side, mark in zip(numbers, "|;")]
        self.shared_ints = list(range(max(map(len, numbers))))
        self.forget()

    def forget(self) -> None:
        self.memo: dict[tuple, int] = {}
        self.texts: list[str] = []
        self.groups, self.links_at, self.links = array("q"), array("q", [0]), array("q")

    def learn(self, flat: list[np.ndarray], cuts: list[np.ndarray], fresh: np.ndarray) -> None:
        """Add the entries of some windows, all at once: their tokens side by side, cut where any token ends."""
        lengths = [cut[fresh + 1] - cut[fresh] for cut in cuts]
        a, b = (side[ranges(cut[fresh], length)] for side, cut, length in zip(flat, cuts, lengths))
        ends_a, ends_b = (np.cumsum(size[ids]) for size, ids in zip(self.sizes, (a, b)))
        window_ends = ends_a[np.cumsum(lengths[0]) - 1]
        # Between two ends, of whichever side, lies the overlap of just one pair of tokens.
        shared = both(ends_a, ends_b)
        ends = np.sort(np.concatenate([ends_a, ends_b]))
        ends = ends[np.append(True, ends[1:] != ends[:-1])]
        links = a[np.searchsorted(ends_a, ends)] << SHIFT | b[np.searchsorted(ends_b, ends)]
        self.links_at.frombytes((len(self.links) + np.searchsorted(ends, window_ends) + 1).tobytes())
        self.links.frombytes(links.tobytes())
        self.groups.frombytes(np.diff(np.searchsorted(shared, window_ends) + 1, prepend=0).tobytes())
        of_a, of_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        written = np.empty(len(a) + len(b), object)
        for side, ids, mine, place in (
            (0, a, of_a, np.arange(len(a)) + np.searchsorted(of_b, of_a)),
            (1, b, of_b, np.arange(len(b)) + np.searchsorted(of_a, of_b, side="right")),
        ):
            closes = np.append(mine[1:] != mine[:-1], True)
            written[place] = np.where(closes, self.last[side][ids], self.inner[side][ids])
        parts, stops = written.tolist(), np.cumsum(lengths[0] + lengths[1]).tolist()
        self.texts.extend("".join(parts[start:stop])[:-1] for start, stop in zip([0, *stops], stops))

    def tokens(self, texts: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of both sides; none where the text is empty or the tokens of a side are not its bytes."""
        whole = [text.decode() for text in texts]
        both = self.a.encode(whole), self.b.encode(whole)
        for n, text in enumerate(texts):
            spaced = b" " + text
            if not text or any(b"".join(map(side.bytes.__getitem__, ids[n])) != spaced for side, ids in zip((self.a, self.b), both)):
                both[0][n], both[1][n] = [], []
        return both

    def aligned(self, texts: list[bytes], digest: bool) -> tuple[dict[str, list | np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """For some texts their counts and groups, and the links: distinct id pairs in ascending order; for every
        pair and text that has it the place of the pair, the text, and how often."""
        if len(self.texts) > MEMO_WINDOWS:
            self.forget()
        sides = self.tokens(texts)
        n_a, n_b = (np.array([len(ids) for ids in side], np.int64) for side in sides)
        flat = [np.fromiter(chain.from_iterable(side), np.int64, n.sum()) for side, n in zip(sides, (n_a, n_b))]
        starts = [np.cumsum(size[f]) - size[f] for size, f in zip(self.sizes, flat)]
        # Every text begins with an anchor, as both sides begin with the space before it.
        anchors = both(*(start[mark[f]] for start, mark, f in zip(starts, self.spaced, flat)))
        cut_a, cut_b = cuts = [np.append(np.searchsorted(start, anchors), len(start)) for start in starts]
        # Windows that are alike are looked up once.
        names = mix(run_hashes(flat[0], cut_a)) ^ run_hashes(flat[1], cut_b)
        _, first, entry_of = np.unique(names, return_index=True, return_inverse=True)
        all_a, all_b = (tuple(map(self.shared_ints.__getitem__, chain.from_iterable(side))) for side in sides)
        memo, known, fresh, entries = self.memo, len(self.texts), [], []
        bounds = (cut[first + shift].tolist() for cut in cuts for shift in (0, 1))
        for n, i, j, k, m in zip(first.tolist(), *bounds):
            key = all_a[i:j], all_b[k:m]
            entry = memo.get(key)
            if entry is None:
                entry = known + len(fresh)
                fresh.append(n)
                if j - i + m - k <= MEMO_IDS:
                    memo[key] = entry
            entries.append(entry)
        if fresh:
            self.learn(flat, cuts, np.array(fresh))
        entries = np.array(entries, np.int64)[entry_of]
        # Windows of a text lie between its first token and the next text's.
        of_text = np.searchsorted(cut_a[:-1], np.append(0, np.cumsum(n_a)))
        links_at = np.frombuffer(self.links_at, np.int64)
        n_links = np.diff(links_at)[entries]
        before = np.append(0, np.cumsum(n_links))
        links = np.frombuffer(self.links, np.int64)[ranges(links_at[entries], n_links)] if len(entries) else n_links
        owner = np.repeat(np.arange(len(texts)), np.diff(before[of_text]))
        found = np.sort(links * len(texts) + owner)
        at = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.empty(0, np.int64)
        found, times = found[at], np.diff(np.append(at, len(found)))
        pair, owner = found // len(texts), found % len(texts)
        new = np.append(True, pair[1:] != pair[:-1])[: len(pair)]
        pairs, place = pair[new], np.cumsum(new) - 1
        pieces = [self.texts[entry] for entry in entries.tolist()]
        bounds = of_text.tolist()
        groups = [";".join(pieces[bounds[n] : bounds[n + 1]]) for n in range(len(texts))]
        if digest:
            groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
        so_far = np.append(0, np.cumsum(np.frombuffer(self.groups, np.int64)[entries])) if len(entries) else np.zeros(1, np.int64)
        columns = {"n_a": n_a, "n_b": n_b, "n_groups": np.diff(so_far[of_text]), "n_links": np.diff(before[of_text]), "groups": groups}
        return columns, pairs, np.stack([place, owner]), times


_LOADED: dict[str, Aligner] = {}


class Models:
    """The files of both tokenizers (a few megabytes each), broadcast; every worker builds them once."""

    def __init__(self, spark: SparkSession, byte_level: str, pieces: str):
        self.name = f"{byte_level}\n{pieces}"
        files = file_bytes(spark, byte_level), file_bytes(spark, pieces)
        self.files = everywhere(spark, (*files, as_ranks(files[0])))

    def load(self) -> Aligner:
        if self.name not in _LOADED:
            _LOADED.clear()
            byte_level, pieces, ranks = self.files.value
            _LOADED[self.name] = Aligner(ByteLevel(byte_level, ranks), Pieces(pieces))
        return _LOADED[self.name]


def gathered(docs: DataFrame, text: str, models: Models, digest: bool) -> DataFrame:
    """Chunks of aligned texts: ``chunk``, ``rows`` (all columns but the text, and the counts of each), ``pairs``
    (distinct id pairs and how many texts have each) and ``links`` (which text has which pair how often)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = models.load(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for start, rows in text_slices(batch.column(text), CHUNK_BYTES):
                part = batch.slice(start, rows)
                texts = [t or b"" for t in part.column(text).cast(pa.binary()).to_pylist()]
                columns, pairs, (place, owner), times = aligner.aligned(texts, digest)
                others = [name for name in part.schema.names if name != text]
                whole = pa.RecordBatch.from_arrays(
                    [*(part.column(name) for name in others), *map(pa.array, columns.values())], names=[*others, *columns]
                )
                per_pair = np.bincount(place, minlength=len(pairs)).astype("<u4")
                links = b"".join(planes(column.astype("<u4")) for column in (np.diff(place, prepend=0), owner, times))
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([number], pa.int64()),
                        "rows": pa.array([pack(whole)], pa.binary()),
                        "pairs": pa.array([squeezed(planes(pairs.astype("<i8")) + planes(per_pair))], pa.binary()),
                        "links": pa.array([squeezed(links)], pa.binary()),
                    }
                )
                number += 1
        aligner.forget()
        give_back()

    return docs.mapInArrow(run, "chunk bigint, rows binary, pairs binary, links binary")


def pair_rows(chunks: DataFrame) -> DataFrame:
    """(chunk, place, pair, n): one row for each distinct pair of a chunk, with the number of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, block in zip(batch.column("chunk").to_pylist(), batch.column("pairs")):
                data = loose(block.as_py())
                size = len(data) // 12
                pairs, per = unplanes(data[: 8 * size], "<i8"), unplanes(data[8 * size :], "<u4")
                yield pa.RecordBatch.from_pydict(
                    {"chunk": np.full(size, chunk), "place": np.arange(size, dtype=np.int32), "pair": pairs, "n": per.astype(np.int64)}
                )

    return chunks.select("chunk", "pairs").mapInArrow(run, "chunk bigint, place int, pair bigint, n bigint")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count, best): in how many texts each pair is linked, and whether that is the most of its first id."""
    counts = rows.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = counts.withColumn("a", F.shiftright("pair", SHIFT))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, models: Models, text: str = "text", digest: bool = False) -> DataFrame:
    """The columns of ``docs`` without the text, with ``n_a``, ``n_b`` (tokens of either side), ``n_groups``,
    ``n_links``, ``n_best``, ``count_sum`` and ``groups``, in place of columns of these names.

    Bytes at which tokens of both sides end cut the tokens into groups, which ``groups`` lists as ``a1,a2|b1;...``
    (its SHA-256 if ``digest``). A link is a pair of tokens, one of each side, whose bytes overlap; an id pair
    counts in how many rows it is linked. ``count_sum`` adds up the counts of a row's links, ``n_best`` says how
    many have the highest count of their first id, ties included. Texts that are null or empty, or whose tokens on
    either side are not exactly a space and the text, have zeros and an empty string. Rows of equal id or
    text count one by one; one row out for each row in; an empty table stays empty.
    """
    docs = docs.drop(*NEW)
    others = [name for name in docs.columns if name != text]
    chunks = stored(gathered(docs, text, models, digest), "aligned-chunks")
    rows = pair_rows(chunks)
    counts = stored(pair_counts(rows), "pair-counts")
    answers = rows.select("chunk", "place", "pair").join(counts, "pair").select("chunk", "place", "count", "best")
    schema = docs.select(*others, *(F.lit(None).cast(kind).alias(name) for name, kind in NEW.items())).schema

    def finish(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        whole = unpack(chunk.column("rows")[0].as_py())
        data = loose(chunk.column("links")[0].as_py())
        size = len(data) // 12
        gap, owner, times = (unplanes(data[4 * size * k : 4 * size * (k + 1)], "<u4").astype(np.int64) for k in range(3))
        place = np.cumsum(gap)
        count, best = np.zeros(answers.num_rows, np.int64), np.zeros(answers.num_rows, np.int64)
        at = answers.column("place").to_numpy()
        count[at], best[at] = answers.column("count").to_numpy(), answers.column("best").to_numpy()
        sums = {"n_best": np.zeros(len(whole), np.int64), "count_sum": np.zeros(len(whole), np.int64)}
        np.add.at(sums["n_best"], owner, times * best[place])
        np.add.at(sums["count_sum"], owner, times * count[place])
        columns = [pa.array(sums[name]) if name in sums else whole.column(name) for name in [*others, *NEW]]
        return pa.Table.from_arrays(columns, names=[*others, *NEW])

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, schema)
