"""A word bigram model by deleted interpolation.

The probability of a word is a mixture of maximum-likelihood estimates: after its predecessor, on its own,
and one over the vocabulary. How much each counts depends on how often the predecessor was seen, in classes
by powers of two; the weights of a class are learned by expectation-maximisation on texts that were left out
of the counts (a part of the training texts), and then used with the counts of all training texts.

Counts come from the chunk exchange: each chunk sends its distinct words and word pairs with their counts,
and gets the counts of the whole corpus back, so nothing that grows with the vocabulary is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardweave.llm import chunks as ch
from shardweave.llm.store import stored
from shardweave.llm.words import BASE, mix, texts_hashes, tidy, utf8

# Hashes of the end of a text and of the place before its first word.
END, BEGIN = np.uint64(0x9D39247E33776D41), np.uint64(0x2AF7398005AAA5C7)
# One of so many training texts is left out of the counts from which the weights are learned.
LEFT_OUT = 10
# Classes of context frequency; steps of the histogram of likelihood ratios per factor of two; rounds.
CLASSES, STEPS, ROUNDS = 40, 8, 100
# Tokens per bucket of the exchange, on average if all were distinct.
BUCKET_TOKENS = 1_000_000
NEVER = -(1 << 20)
# A-Z lowered, and every byte that stands between words as the space.
_LOWERED = bytes(32 if 9 <= c <= 13 else c for c in range(256)).lower()
COUNTED, HELD, OTHER = 0, 1, 2


class Tokens:
    """The tokens of a chunk: words with A-Z lowered, and one end per text."""

    def __init__(self, batch: pa.RecordBatch, text: str):
        hashes, counts = texts_hashes(list(utf8(batch.column(text))), _LOWERED)
        self.lengths = counts + 1
        self.starts = np.cumsum(self.lengths) - self.lengths
        tokens = np.insert(hashes, np.cumsum(counts), END)
        before = np.r_[BEGIN, tokens[:-1]].astype(np.uint64)
        before[self.starts] = BEGIN
        role = batch.column("_role").to_numpy(zero_copy_only=False).astype(np.int64)
        self.role = np.repeat(role, self.lengths)
        self.roles = role
        self.words, self.word_at = np.unique(tokens, return_inverse=True)
        # 56 bits of a pair's hash are kept: the gaps between a block's keys then take five bytes.
        self.pairs, self.pair_at = np.unique(mix(before * np.uint64(BASE) + tokens) & ~np.uint64(0xFF), return_inverse=True)
        self.before_at = np.r_[0, self.word_at[:-1]]  # meaningless at the start of a text
        self.at_start = np.zeros(len(tokens), bool)
        self.at_start[self.starts] = True

    def counts(self, at: np.ndarray, n: int) -> list[np.ndarray]:
        return [np.bincount(at[self.role == role], minlength=n).astype("<u4") for role in (COUNTED, HELD)]


def sums(blocks: list[bytes]) -> tuple[list[bytes], bytes]:
    """Total counts of each block's keys; the summary is (keys seen in training, counted, left out)."""
    sizes = [len(b) // 16 for b in blocks]
    keys = np.concatenate([ch.ascending(b[: 8 * n]) for b, n in zip(blocks, sizes)])
    every, at = np.unique(keys, return_inverse=True)
    totals = []
    for k in (8, 12):
        part = np.concatenate([ch.unplanes(b[k * n : (k + 4) * n], "<u4") for b, n in zip(blocks, sizes)])
        totals.append(np.bincount(at, weights=part, minlength=len(every)).astype("<u4"))
    ends = np.cumsum(sizes)
    answers = []
    for start, stop in zip(ends - sizes, ends):
        answers.append(b"".join(ch.planes(t[at[start:stop]]) for t in totals))
    seen = int(((totals[0] + totals[1]) > 0).sum())
    return answers, np.array([seen, int(totals[0].sum(dtype=np.int64)), int(totals[1].sum(dtype=np.int64))], "<i8").tobytes()


def totals_of(answers: list[dict] | None) -> list[np.ndarray]:
    """(counted, left out) of all keys of a chunk, ascending."""
    parts = ch.joined(answers)
    return [np.concatenate([ch.unplanes(a[k * len(a) // 2 : (k + 1) * len(a) // 2], "<u4") for a in parts]).astype(np.int64) for k in (0, 1)]


def estimates(t: Tokens, words: np.ndarray, pairs: np.ndarray, begins: int, total: int):
    """Per token: maximum-likelihood estimates after its predecessor and alone, and its context's class."""
    context = np.where(t.at_start, begins, words[t.before_at])
    after = pairs[t.pair_at] / np.maximum(context, 1)
    alone = words[t.word_at] / max(total, 1)
    kind = np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, 0)
    return after, alone, np.minimum(kind, CLASSES - 1)


def learned(cells: np.ndarray, times: np.ndarray, trained: bool = True) -> np.ndarray:
    """Weights (after predecessor, alone, uniform) per class of context frequency, by EM.

    ``cells`` has class and the rounded logarithms of both estimates over the uniform one. An estimate that
    there is none of (after an unseen predecessor; any but the uniform one without training) has no weight.
    """
    even = np.full((CLASSES, 3), 1 / 3)
    even[0] = 0, 1 / 2, 1 / 2
    if not trained:
        even[:] = 0, 0, 1
    weights = even.copy()
    ratio = np.ones((len(cells), 3))
    for k in (0, 1):
        never = cells[:, k + 1] == NEVER
        ratio[:, k] = np.where(never, 0.0, np.exp2(np.where(never, 0, cells[:, k + 1]) / STEPS))
    kind = cells[:, 0]
    whole = np.bincount(kind, weights=times, minlength=CLASSES)
    for _ in range(ROUNDS if len(cells) else 0):
        share = weights[kind] * ratio
        share *= (times / share.sum(axis=1))[:, None]
        # One token's worth of even weights keeps every component alive and settles empty classes.
        for k in range(3):
            weights[:, k] = (np.bincount(kind, weights=share[:, k], minlength=CLASSES) + even[:, k]) / (whole + 1)
    return weights


def scored(df: DataFrame, training: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``, replacing such columns.

    Learns from the rows where ``training`` is true (null counts as true). ``score`` is the model's log10
    probability of the text with its end, ``base_score`` that of single words with one added to each count.
    Null and empty texts consist of their end alone; without training rows every token has probability 1.
    Repeated rows each count and are each returned; an empty table gives an empty result.
    """
    spark = df.sparkSession
    names = [n for n in df.columns if n not in ("n_tokens", "n_known", "train_tokens", "base_score", "score", "_role")]
    left_out = F.pmod(F.xxhash64(F.col(id)), F.lit(LEFT_OUT)) == 0
    role = F.when(F.coalesce(training, F.lit(True)), F.when(left_out, HELD).otherwise(COUNTED)).otherwise(OTHER)
    rows = df.withColumn("_role", role.cast("int")).select(*names, "_role")

    def note(batch: pa.RecordBatch) -> tuple[int, bytes]:
        size = sum(len(data.split()) + 1 for data in utf8(batch.column(text)))
        roles = batch.column("_role").to_pylist()
        return size, np.array([roles.count(COUNTED), roles.count(HELD)], "<i8").tobytes()

    chunks = ch.chunked(rows, text, "lm-chunks", note)
    facts = chunks.select("size", "notes").mapInArrow(tidy(_facts), "size bigint, counted bigint, held bigint")
    facts = facts.agg(F.sum("size"), F.sum("counted"), F.sum("held")).first()
    size, begun, held = (int(v or 0) for v in facts)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-size // BUCKET_TOKENS))

    def ask(kind: str):
        def run(row: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
            t = Tokens(ch.unpack(row.column("payload")[0].as_py()), text)
            keys, at = (t.words, t.word_at) if kind == "words" else (t.pairs, t.pair_at)
            counts = t.counts(at, len(keys))
            for bucket, start, stop in ch.slices(keys, buckets):
                yield bucket, ch.gaps(keys[start:stop]) + b"".join(ch.planes(c[start:stop]) for c in counts)

        return run

    payload = chunks.select("chunk", "payload")
    words = stored(ch.asked(payload, ask("words"), sums, buckets), "lm-words")
    pairs = stored(ch.asked(payload, ask("pairs"), sums, buckets), "lm-pairs")
    summary = words.where("chunk = -1").mapInArrow(tidy(_summaries), "seen bigint, counted bigint, held bigint")
    summary = summary.agg(F.sum("seen"), F.sum("counted"), F.sum("held")).first()
    vocabulary, counted_tokens, held_tokens = (int(v or 0) for v in summary)
    known = ch.answered(ch.answered(payload, words.where("chunk >= 0"), "words"), pairs.where("chunk >= 0"), "pairs")
    uniform = 1 / (vocabulary + 1)

    def ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                t = Tokens(ch.unpack(batch.column("payload")[i].as_py()), text)
                word_counts, pair_counts = totals_of(batch.column("words")[i].as_py()), totals_of(batch.column("pairs")[i].as_py())
                after, alone, kind = estimates(t, word_counts[0], pair_counts[0], begun, counted_tokens)
                mine = t.role == HELD
                cells = [kind[mine]]
                for estimate in (after[mine], alone[mine]):
                    log = np.full(len(estimate), NEVER, np.int64)
                    log[estimate > 0] = np.rint(STEPS * np.log2(estimate[estimate > 0] / uniform))
                    cells.append(log)
                distinct, times = np.unique(np.stack(cells, axis=1), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*distinct.T.copy(), times)], names=["kind", "after", "alone", "times"])

    cells = known.mapInArrow(tidy(ratios), "kind bigint, after bigint, alone bigint, times bigint")
    # At most classes x possible rounded logarithms of both ratios, however large the corpus is.
    cells = cells.groupBy("kind", "after", "alone").agg(F.sum("times").alias("times")).toPandas()
    cells = cells.sort_values(["kind", "after", "alone"])
    weights = learned(cells[["kind", "after", "alone"]].to_numpy(np.int64), cells["times"].to_numpy(np.float64), counted_tokens > 0)
    total, begins = counted_tokens + held_tokens, begun + held

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                rows = ch.unpack(batch.column("payload")[i].as_py())
                t = Tokens(rows, text)
                word_counts = sum(totals_of(batch.column("words")[i].as_py()))
                pair_counts = sum(totals_of(batch.column("pairs")[i].as_py()))
                after, alone, kind = estimates(t, word_counts, pair_counts, begins, total)
                share = weights[kind]
                score = np.log10(share[:, 0] * after + share[:, 1] * alone + share[:, 2] * uniform)
                seen = word_counts[t.word_at]
                base = np.log10((seen + 1) / (total + vocabulary + 1))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(n) for n in names]
                    + [
                        pa.array(t.lengths, pa.int64()),
                        pa.array(np.add.reduceat(seen > 0, t.starts, dtype=np.int64), pa.int64()),
                        pa.array(np.full(len(rows), total), pa.int64()),
                        pa.array(np.add.reduceat(base, t.starts), pa.float64()),
                        pa.array(np.add.reduceat(score, t.starts), pa.float64()),
                    ],
                    names=[*names, "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    whole, real = F.lit(0).cast("long"), F.lit(0.0)
    added = {"n_tokens": whole, "n_known": whole, "train_tokens": whole, "base_score": real, "score": real}
    return known.mapInArrow(tidy(finish), df.select(*names).withColumns(added).schema)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        notes = np.array([np.frombuffer(n, "<i8") for n in batch.column("notes").to_pylist()]).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [batch.column("size"), pa.array(notes[:, 0].copy()), pa.array(notes[:, 1].copy())], names=["size", "counted", "held"]
        )


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([np.frombuffer(a, "<i8") for a in batch.column("answer").to_pylist()]).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([pa.array(c.copy()) for c in found.T], names=["seen", "counted", "held"])
