"""Byte-level BPE encoding by backtracking over longest matches, and its decoding.

Greedy longest matching is not BPE, but BPE's result is the only token sequence whose neighbours are
all compatible: two tokens are compatible if merging the bytes of both yields them again. So the
encoder walks the text with the longest vocabulary match at each position (an Aho-Corasick automaton
over bytes mapped to Latin-1), takes the next shorter one where neighbours clash, and steps back where
none is left; positions from which no encoding goes on are marked, so each is left at most once.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shardweave.llm.store import everywhere
from shardweave.llm.words import give_back

# Entries of a worker's memos before they start anew, and the longest piece (code points) that is kept.
MEMO_PIECES, MEMO_PAIRS, MEMO_LENGTH = 250_000, 200_000, 48


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """A rank file: one ``base64(token) rank`` a line. ``path`` may be local to the driver or Spark's."""
    if "://" in path:
        lines = [row.value for row in spark.read.text(path).toLocalIterator()]
    else:
        with open(path) as file:
            lines = file.read().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def splits(ranks: dict[bytes, int]) -> dict[int, tuple[int, int]]:
    """For each token of several bytes the pair whose merge makes it; none for tokens no merge makes."""
    made = {}
    for token, rank in ranks.items():
        if len(token) == 1:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and r < rank and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            made[rank] = (ranks[parts[0]], ranks[parts[1]])
    return made


def tokens_by_id(ranks: dict[bytes, int]) -> list[bytes]:
    tokens = {rank: token for token, rank in ranks.items()}
    return [tokens.get(rank, b"") for rank in range(max(tokens) + 1)]


class _Pieces(dict):
    """Bounded memo from a piece of text to its packed ids."""

    def __init__(self, bpe: ByteBpe):
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        bpe = self.bpe
        ids = b"".join(map(bpe.packed.__getitem__, bpe.encode_piece(piece.encode())))
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class ByteBpe:
    """Encoder and decoder for one rank table; ids are the ranks."""

    def __init__(self, ranks: dict[bytes, int], made: dict[int, tuple[int, int]], pattern: str):
        self.ranks, self.made = ranks, made
        self.merged = {pair: token for token, pair in made.items()}
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.packed = {rank: rank.to_bytes(4, "little") for rank in self.tokens}
        self.by_id = tokens_by_id(ranks)
        self.pieces = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        self.latin: dict[str, int] = {}
        for token, rank in ranks.items():
            if len(token) == 1 or rank in made:
                self.latin[token.decode("latin-1")] = rank
                self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.widest = max(map(len, self.latin))
        self.shorter: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo = _Pieces(self)

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE on the bytes of both tokens yields exactly these two.

        Undoes merges on both sides of the border, latest first; if at some moment the tokens that
        touch the border could have merged earlier than the merge undone last, BPE would cross it.
        """
        a, b, limit, fine = left, right, 1 << 62, True
        while True:
            joined = self.merged.get((a, b))
            if joined is not None and joined < limit:
                fine = False
                break
            # The later merge is undone first; of equal ones BPE makes the left one first.
            undo_left = a > b
            if undo_left and a not in self.made or not undo_left and b not in self.made:
                undo_left = not undo_left
                if (a if undo_left else b) not in self.made:
                    break
            if undo_left:
                limit, a = a, self.made[a][1]
            else:
                limit, b = b + 1, self.made[b][0]
        if len(self.pairs) >= MEMO_PAIRS:
            self.pairs.clear()
        self.pairs[left, right] = fine
        return fine

    def next_shorter(self, token: int) -> int:
        """The longest token that begins ``token``'s bytes and is shorter; -1 if there is none."""
        known = self.shorter.get(token)
        if known is None:
            text, known = self.tokens[token], -1
            for n in range(len(text) - 1, 0, -1):
                rank = self.ranks.get(text[:n])
                if rank is not None and (n == 1 or rank in self.made):
                    known = rank
                    break
            self.shorter[token] = known
        return known

    def longest(self, text: str, at: int) -> int:
        """The longest token at a position: the automaton's longest path, back to where a token ends."""
        ahead = text[at : at + self.widest]
        n = self.automaton.longest_prefix(ahead)
        token = self.latin.get(ahead[:n])
        while token is None:
            n -= 1
            token = self.latin.get(ahead[:n])
        return token

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, end, size, pairs = piece.decode("latin-1"), len(piece), self.size, self.pairs
        dead = bytearray(end + 1)
        out: list[int] = []
        at, last, token = 0, -1, self.longest(text, 0)
        while at < end:
            stop = at + size[token]
            if not dead[stop]:
                fine = True if last < 0 else pairs.get((last, token))
                if fine is None:
                    fine = self.compatible(last, token)
                if fine:
                    out.append(token)
                    at, last = stop, token
                    if at < end:
                        token = self.longest(text, at)
                    continue
            token = self.next_shorter(token)
            while token < 0:
                dead[at] = 1
                token = out.pop()
                at, last = at - size[token], out[-1] if out else -1
                token = self.next_shorter(token)
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.pieces(text)))

    def decode(self, ids: bytes) -> bytes:
        return decoded(self.by_id, ids)

    def forget(self) -> None:
        """Empty the memos, so that a worker that lives on does not keep them."""
        self.memo.clear()
        self.pairs.clear()


def decoded(by_id: list[bytes], ids: bytes) -> bytes:
    """The bytes of packed ids; ``by_id`` has each id's token."""
    listed = np.frombuffer(ids, "<u4").tolist()
    return b"".join(itemgetter(*listed, 0)(by_id)[:-1])


_LOADED: dict[str, ByteBpe] = {}


class Tokenizer:
    """Encoding and decoding columns for one rank file. The table (some MB) is broadcast once."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        ranks = read_ranks(spark, path)
        self.name = f"{path}\n{pattern}"
        self.model = everywhere(spark, (ranks, splits(ranks), pattern))
        self.by_id = everywhere(spark, tokens_by_id(ranks))

    def _loader(self):
        name, model = self.name, self.model

        def load() -> ByteBpe:
            if name not in _LOADED:
                _LOADED.clear()
                _LOADED[name] = ByteBpe(*model.value)
            return _LOADED[name]

        return load

    def encode(self, text: Column) -> Column:
        """BINARY: the ids as little-endian unsigned 32-bit integers; null and empty texts give no ids.

        Each match of the pattern is encoded on its own, so a text of any length takes memory for its
        own ids only.
        """
        load = self._loader()

        @arrow_udf("binary")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            bpe = load()
            for batch in batches:
                yield pa.array([bpe.encode(t.as_py()) if t.is_valid else b"" for t in batch], pa.binary())
            bpe.forget()
            give_back()

        return encode(text)

    def decode(self, ids: Column) -> Column:
        """BINARY: the bytes of a column as ``encode`` makes it; null gives no bytes."""
        by_id = self.by_id

        @arrow_udf("binary")
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            tokens = by_id.value
            for batch in batches:
                yield pa.array([decoded(tokens, b.as_py()) if b.is_valid else b"" for b in batch], pa.binary())
            give_back()

        return decode(ids)

    def round_trip(self, text: Column) -> Column:
        """STRUCT<ids, decoded>: ``encode`` and ``decode`` by one worker, which has the tables in memory once."""
        load = self._loader()

        @arrow_udf("struct<ids: binary, decoded: binary>")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            bpe = load()
            for batch in batches:
                ids = [bpe.encode(t.as_py()) if t.is_valid else b"" for t in batch]
                columns = [pa.array(ids, pa.binary()), pa.array(map(bpe.decode, ids), pa.binary())]
                yield pa.StructArray.from_arrays(columns, ["ids", "decoded"])
            bpe.forget()
            give_back()

        return run(text)


def encoded(df: DataFrame, tokenizer: Tokenizer, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (see ``Tokenizer.encode``), ``decoded`` (the bytes back from the ids) and ``n_tokens``.

    Columns of these names are replaced. One row in, one row out, without a shuffle; null or empty
    text has no ids, no bytes and 0 tokens; repeated rows stay; an empty table stays empty.
    """
    others = [name for name in df.columns if name not in ("ids", "decoded", "n_tokens")]
    df = df.select(*others, tokenizer.round_trip(F.col(text)).alias("ids"))
    df = df.select(*others, F.col("ids.ids").alias("ids"), F.col("ids.decoded").alias("decoded"))
    return df.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))
