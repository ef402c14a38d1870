"""Token counts under a unigram vocabulary, without making the tokens.

The best segmentation maximises the sum of piece scores. For its length alone no back-pointers are
needed: dynamic programming carries, per end position, the best score and the number of pieces on the
path to it. An Aho-Corasick automaton over the pieces enumerates all matches.

Tie rules are those of the public unigram tokenizers: positions are filled from left to right, a later
candidate replaces an earlier one only with a strictly higher score, so of equal paths the one whose
last piece starts first stays. Where no piece of one character matches, the character is unknown, at
the lowest score less 10; runs of unknown characters are one piece, or with byte fallback one piece
for each of their UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shardweave.llm.store import everywhere

# Entries of a worker's memo before it starts anew, and the longest stretch (code points) that is kept.
MEMO_ENTRIES, MEMO_LENGTH = 250_000, 48
# How much worse than the worst piece an unknown character is (fixed value of the public tokenizers).
UNKNOWN_PENALTY = 10.0
SPACE = "▁"


class UnigramCounter:
    """Counts for one vocabulary: ``pieces`` from piece to score."""

    def __init__(self, pieces: dict[str, float], byte_fallback: bool = True):
        self.byte_fallback = byte_fallback
        self.unknown = min(pieces.values()) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        # If no piece holds a space mark after another character, no piece crosses the border before a
        # run of marks, so the text falls into stretches whose best paths are independent. Nor must a run of
        # unknown characters cross it, which the mark, if it is unknown itself, would join to one piece.
        crossing = any(SPACE in piece.lstrip(SPACE) for piece in pieces) or not byte_fallback and SPACE not in pieces
        self.stretches = None if crossing else re.compile(f"{SPACE}+[^{SPACE}]*").findall
        self.memo = _Stretches(self)

    def best(self, text: str) -> tuple[float, int]:
        """Score and number of pieces of the best path over a text that is normalised already."""
        n = len(text)
        score, count, open_run = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches = self.automaton.iter(text)
        found = next(matches, None)
        for end in range(1, n + 1):
            top, pieces, single = None, 0, False
            while found is not None and found[0] == end - 1:  # longest first, so earliest start first
                size, worth = found[1]
                single = single or size == 1
                worth += score[end - size]
                if top is None or worth > top:
                    top, pieces = worth, count[end - size] + 1
                found = next(matches, None)
            run = False
            if not single:
                worth = score[end - 1] + self.unknown
                if top is None or worth > top:
                    top, run = worth, True
                    if self.byte_fallback:
                        pieces = count[end - 1] + len(text[end - 1].encode())
                    else:
                        pieces = count[end - 1] + (not open_run[end - 1])
            score[end], count[end], open_run[end] = top, pieces, run
        return score[n], count[n]

    def count(self, text: str) -> tuple[float, int]:
        """Score and number of pieces of a raw text: a space mark goes before it and replaces spaces."""
        if not text:
            return 0.0, 0
        marked = SPACE + text.replace(" ", SPACE)
        if self.stretches is None:
            return self.best(marked)
        scores, counts = zip(*map(self.memo.__getitem__, self.stretches(marked)))
        return sum(scores), sum(counts)


class _Stretches(dict):
    """Bounded memo from a stretch of text to its score and count."""

    def __init__(self, counter: UnigramCounter):
        self.counter = counter

    def __missing__(self, stretch: str) -> tuple[float, int]:
        value = self.counter.best(stretch)
        if len(stretch) <= MEMO_LENGTH:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[stretch] = value
        return value


def read_pieces(path: str) -> tuple[dict[str, float], bool]:
    """The ordinary pieces of a sentencepiece model file with their scores, and whether it has byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    kinds = (model.is_control, model.is_unknown, model.is_unused, model.is_byte)
    pieces = {model.id_to_piece(i): model.get_score(i) for i in ids if not any(kind(i) for kind in kinds)}
    return pieces, any(model.is_byte(i) for i in ids)


_LOADED: dict[str, UnigramCounter] = {}


def counts(spark: SparkSession, text: Column, path: str) -> Column:
    """STRUCT<score: DOUBLE, n_tokens: BIGINT> of a text under the vocabulary in ``path``.

    The vocabulary (some MB) is broadcast. Null and empty texts have 0 tokens and score 0; a text of any
    length takes memory in proportion to its longest stretch without a space.
    """
    model = everywhere(spark, read_pieces(path))

    @arrow_udf("struct<score: double, n_tokens: bigint>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if path not in _LOADED:
            _LOADED.clear()
            _LOADED[path] = UnigramCounter(*model.value)
        counter = _LOADED[path]
        for batch in batches:
            found = [counter.count(t) if t else (0.0, 0) for t in batch.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64())],
                ["score", "n_tokens"],
            )

    return count(text)


def counted(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens`` and ``best_score``, replacing columns of these names.

    One row in, one row out, without a shuffle; repeated rows stay, an empty table stays empty.
    """
    df = df.withColumn("_counted", counts(df.sparkSession, F.col(text), path))
    return (
        df.withColumn("n_tokens", F.col("_counted.n_tokens"))
        .withColumn("best_score", F.col("_counted.score"))
        .drop("_counted")
    )
