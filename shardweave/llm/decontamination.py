"""Finding benchmark items in documents, also reworded ones.

Passages (overlapping windows of words) are compared with the items in a latent space: the leading right
singular vectors of the TF-IDF vectors of the items and of passages, by randomised SVD whose products with
the matrix run on Spark. Every passage of every document whose cosine with an item reaches a threshold, which is
lower for items of which the space keeps less, is a candidate; its surroundings are then checked by the longest common subsequence of words with the whole item,
with the item's rarer words, and with the item's answer, its last sentence.

A passage is compared with items of about its length: longer items are cut into pieces, and a passage near any
piece makes the whole item a candidate. An item that fills only a small part of a passage is also looked up by its
rarest words: so many that a text which has enough of the item has one of them.

The items are the query set. They are taken in blocks of bounded size, whose vocabulary and vectors are
broadcast; words outside the vocabulary of a block cannot add to a similarity, only to a passage's length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardweave.llm.store import everywhere, stored
from shardweave.llm.words import text_slices, texts_hashes, tidy, utf8

# Words of half a passage; passages overlap by half.
HALF = 24
# Dimensions of the latent space, extra ones while it is found, and rounds of power iteration.
RANK, EXTRA, POWERS = 128, 16, 2
# The space is fitted on the items and on all passages of all documents. A passage weighs less than an item, and
# beyond so many passages less still, so that together they weigh no more than these and the space keeps the items.
PASSAGE_WEIGHT, FULL_PASSAGES = 0.1, 32_768
# Passages whose products are in a task at a time, and slices in which tasks send the sums of products.
ROWS, SLICES = 4096, 32
# Terms in most documents, which make up most of a passage and are multiplied as a dense block.
FREQUENT = 256
# Pieces of items whose vectors are in a task at a time, and bytes of the items' text.
BLOCK_ITEMS, BLOCK_BYTES = 500, 1 << 20
# Items of fewer words than SHORT, but at least LEAST_SHORT, are looked up by their rarest words as well; below
# that, a few words in order tell nothing, and only the cosine finds an item.
SHORT, LEAST_SHORT = HALF, 4
# Bytes of texts whose words' vectors are in a task at a time (a longer text is on its own).
SLAB_BYTES = 300_000
# Bytes of texts whose passages are in a task at a time.
SLICE_BYTES = 2 << 20
# Least cosine of a candidate, times the share of the item's vector that the latent space keeps; least share of the item's words in order; with a lower share, the least share
# of its rarer words and of the answer's words in order that make up for it, and how many rarer words it needs.
COSINE, WHOLE, PART, RARER, ANSWER, LEAST_RARER = 0.3, 0.8, 0.6, 0.6, 0.7, 4

_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
SENTENCE = re.compile(rb"[.!?]+\s")


def plain_words(data: bytes) -> list[bytes]:
    """Words without ASCII punctuation, A-Z lowered."""
    return data.translate(_PLAIN).split()


def common(masks: dict[bytes, int], size: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence; ``masks`` has the places of each word of one side as bits."""
    full = (1 << size) - 1
    row = full
    for word in words:
        mask = masks.get(word)
        if mask:
            both = row & mask
            row = ((row + both) | (row - both)) & full
    return size - row.bit_count()


def masks_of(words: list[bytes]) -> dict[bytes, int]:
    masks: dict[bytes, int] = {}
    for place, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << place
    return masks


class Item:
    """An item's words, and those of its answer: the last sentence, or the last quarter if there is one only."""

    def __init__(self, number, data: bytes):
        self.number, self.words = number, plain_words(data)
        sentences = [s for s in (plain_words(s) for s in SENTENCE.split(data + b" ")) if s]
        self.answer = sentences[-1] if len(sentences) > 1 else self.words[-max(1, len(self.words) // 4) :]
        self.masks, self.answer_masks = masks_of(self.words), masks_of(self.answer)
        self.rarer, self.rarer_masks = 0, {}
        # Pieces of nearly equal length, the nearest to a passage's that there is.
        count = max(1, round(len(self.words) / (2 * HALF)))
        cuts = [k * len(self.words) // count for k in range(count + 1)]
        self.pieces = [self.words[low:high] for low, high in zip(cuts, cuts[1:])]

    def keys(self, idf: np.ndarray, terms: dict[bytes, int]) -> set[bytes]:
        """Words of which every text that ``shares`` accepts has one: it has at least ``WHOLE`` of all words or
        ``RARER`` of the rarer ones, so of more words than it may lack it has some."""
        spare = lacking(len(self.words), WHOLE)
        if self.rarer >= LEAST_RARER:
            spare = max(spare, lacking(self.rarer, RARER))
        return set(sorted(self.words, key=lambda w: (-idf[terms[w]], w))[: spare + 1])

    def weigh(self, idf: np.ndarray, terms: dict[bytes, int], mean: float) -> None:
        """Name the item's rarer words: those of at least the mean weight."""
        rarer = [w for w in self.words if idf[terms[w]] >= mean]
        self.rarer, self.rarer_masks = len(rarer), masks_of(rarer)

    def shares(self, words: list[bytes]) -> tuple[float, float] | None:
        """Shares of the item's and of its answer's words that are in the words in order, if that is a find."""
        whole = common(self.masks, len(self.words), words) / len(self.words)
        if whole < PART:
            return None
        answer = common(self.answer_masks, len(self.answer), words) / len(self.answer)
        if whole < WHOLE:
            if answer < ANSWER or self.rarer < LEAST_RARER:
                return None
            if common(self.rarer_masks, self.rarer, words) < RARER * self.rarer:
                return None
        return whole, answer


def lacking(size: int, share: float) -> int:
    """How many of ``size`` words may be missing while ``share`` of them is there."""
    return max(k for k in range(size + 1) if (size - k) / size >= share)


class Vocabulary:
    """The numbers of terms by the hashes of their words."""

    def __init__(self, terms: dict[bytes, int]):
        hashes, _ = texts_hashes(list(terms), _PLAIN)
        self.numbers = np.argsort(hashes)
        self.hashes = hashes[self.numbers]

    def __len__(self):
        return len(self.hashes)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words of the texts, -1 for others, and how many words each text has."""
        hashes, lengths = texts_hashes(texts, _PLAIN)
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self)] = 0
        return np.where(self.hashes[at] == hashes, self.numbers[at], -1), lengths


class Space:
    """Vocabulary, weights, weighted term vectors, vectors of the items' pieces, and keys of the short items of one
    block."""

    def __init__(self, items: list[Item], idf: np.ndarray, terms: dict[bytes, int], vectors: np.ndarray):
        self.items, self.vocabulary = items, Vocabulary(terms)
        used = np.array([terms[w] for item in items for w in item.words])
        # A word outside the vocabulary (number -1, the last row) has no vector and the mean weight.
        mean = float(idf[used].mean())
        self.squares = (np.r_[idf, mean] ** 2).astype(np.float32)
        self.vectors = np.vstack([vectors * idf[:, None], np.zeros(vectors.shape[1])]).astype(np.float32)
        pieces = [[terms[w] for w in piece] for item in items for piece in item.pieces]
        self.owner = np.repeat(np.arange(len(items)), [len(item.pieces) for item in items])
        self.piece_of = np.cumsum([0] + [len(item.pieces) for item in items])[:-1]
        rows = np.stack([self.vectors[piece].sum(axis=0) for piece in pieces])
        self.rows = normal(rows).T.copy()
        # A copy of a piece reaches as cosine the share of the piece that the space keeps; the more pieces have to
        # share its dimensions, the less that is.
        full = []
        for piece in pieces:
            term, times = np.unique(piece, return_counts=True)
            full.append(np.sqrt(((times * idf[term]) ** 2).sum()))
        kept = np.sqrt((rows * rows).sum(axis=1)) / np.maximum(full, 1e-12)
        self.least = (COSINE * np.minimum(kept, 1.0)).astype(np.float32)
        # The short items that have a term among their keys, by the term's number.
        self.short: dict[int, list[int]] = {}
        for n, item in enumerate(items):
            item.weigh(idf, terms, mean)
            if LEAST_SHORT <= len(item.words) < SHORT:
                for word in item.keys(idf, terms):
                    self.short.setdefault(terms[word], []).append(n)
        self.is_key = np.zeros(len(idf) + 1, bool)
        self.is_key[list(self.short)] = True


def normal(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.maximum(length, 1e-12)


def leaks(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(``id``, ``item_id``, cosine, lcs_share, answer_share) for each document and item found in it.

    Found means: some passage reaches the cosine with a piece of the item (``COSINE`` of what a copy of the piece has in
    the latent space), or a short item's key stands there, and its surroundings have, in order, at least ``WHOLE`` of the
    item's words, or ``PART`` of them, ``RARER`` of the rarer ones and ``ANSWER`` of the answer's. The best
    surroundings of a pair count.
    Null and empty texts on either side find nothing; each row of repeated documents or items is found on its
    own; empty tables give an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind, item_kind = docs.schema["id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"id {kind}, item {item_kind}, cosine double, lcs_share double, answer_share double"
    names = [id, item_id, "cosine", "lcs_share", "answer_share"]
    found = spark.createDataFrame([], schema)
    for block in _blocks(items.select(F.col(item_id).alias("number"), F.col(item_text).alias("text"))):
        found = found.unionAll(_search(docs, block, schema))
    return found.toDF(*names)


def _blocks(items: DataFrame) -> Iterator[list[Item]]:
    block, size, pieces = [], 0, 0
    for row in items.where("text is not null").orderBy("number", "text").toLocalIterator():
        item = Item(row.number, row.text.encode())
        if not item.words:
            continue
        block.append(item)
        size += len(row.text)
        pieces += len(item.pieces)
        if pieces >= BLOCK_ITEMS or size > BLOCK_BYTES:
            yield block
            block, size, pieces = [], 0, 0
    if block:
        yield block


def _search(docs: DataFrame, items: list[Item], schema: str) -> DataFrame:
    spark = docs.sparkSession
    terms = {word: n for n, word in enumerate(dict.fromkeys(w for item in items for w in item.words))}
    known = everywhere(spark, Vocabulary(terms))
    total = docs.count()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents per term, and the terms of all passages, ascending (term -1)."""
        vocabulary, seen = known.value, np.zeros(len(known.value), np.int64)
        for batch in batches:
            for start, length in text_slices(batch.column("text"), SLICE_BYTES):
                numbers, lengths = vocabulary.of(list(utf8(batch.column("text").slice(start, length))))
                owner = np.repeat(np.arange(len(lengths)), lengths)
                place = np.arange(len(numbers)) - (np.cumsum(lengths) - lengths)[owner]
                passages = -(-lengths // (2 * HALF))
                at = np.flatnonzero(numbers >= 0)
                mine, owner = numbers[at], owner[at]
                seen += np.bincount(np.unique(owner * len(vocabulary) + mine) % len(vocabulary), minlength=len(vocabulary))
                # By passage, then by term.
                key = np.sort(((np.cumsum(passages) - passages)[owner] + place[at] // (2 * HALF)) * len(vocabulary) + mine)
                if not len(key):
                    continue
                ends = np.r_[0, np.flatnonzero(np.diff(key // len(vocabulary))) + 1, len(key)]
                lists = pa.ListArray.from_arrays(ends.astype(np.int32), (key % len(vocabulary)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(lists), -1)), pa.array(np.zeros(len(lists), np.int64)), lists], names=["term", "times", "passage"]
                )
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at]), pa.nulls(len(at), pa.list_(pa.int32()))], names=["term", "times", "passage"])

    facts = docs.select("text").mapInArrow(tidy(first), "term bigint, times bigint, passage array<int>")
    facts = stored(facts, "leaks-facts")
    idf = np.full(len(terms), np.log(total + 1.0))
    for row in facts.where("term >= 0").groupBy("term").agg(F.sum("times").alias("times")).collect():  # the block's vocabulary
        idf[row.term] = np.log((total + 1.0) / row.times)
    passages = facts.where("term < 0").select("passage")
    weight = PASSAGE_WEIGHT * min(1.0, FULL_PASSAGES / max(passages.count(), 1)) ** 0.5
    passages = passages.withColumn("weight", F.lit(weight))
    own = [(sorted(terms[w] for w in piece), 1.0) for item in items for piece in item.pieces]
    passages = passages.unionAll(spark.createDataFrame(own, "passage array<int>, weight double"))
    space = everywhere(spark, Space(items, idf, terms, singular_vectors(passages, idf)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("id"), list(utf8(batch.column("text")))
            hits = []
            for start, length in text_slices(batch.column("text"), SLAB_BYTES):
                hits += [(start + n, *rest) for n, *rest in _hits(texts[start : start + length], space.value)]
            if hits:
                at, item, *numbers = zip(*hits)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at)), pa.array(item), *[pa.array(x, pa.float64()) for x in numbers]],
                    names=["id", "item", "cosine", "lcs_share", "answer_share"],
                )

    return docs.mapInArrow(tidy(search), schema)


def _hits(texts: list[bytes], space: Space) -> list[tuple]:
    """(text's number, item's number, cosine, shares) of the items found in a few texts."""
    # Half passages never cross texts; a passage is a half and the next of the same text.
    numbers, lengths = space.vocabulary.of(texts)
    halves = -(-lengths // HALF)
    owner = np.repeat(np.arange(len(texts)), halves)
    first = np.cumsum(halves) - halves
    starts = (np.arange(len(owner)) - first[owner]) * HALF + (np.cumsum(lengths) - lengths)[owner]
    known = np.flatnonzero(numbers >= 0)
    bounds = np.searchsorted(known, np.r_[starts, len(numbers)])
    some = np.flatnonzero(np.diff(bounds))
    if not len(some):  # nor has any text a key
        return []
    half = np.zeros((len(starts), space.vectors.shape[1]), np.float32)
    half[some] = run_sums(space.vectors, numbers[known], bounds[some])
    square = np.add.reduceat(space.squares[numbers], starts)
    follows = owner[1:] == owner[:-1]
    passage, length = half.copy(), square.copy()
    passage[:-1][follows] += half[1:][follows]
    length[:-1][follows] += square[1:][follows]
    cosine = passage @ space.rows / np.sqrt(np.maximum(length, 1e-12))[:, None]
    near: dict[tuple[int, int], list[int]] = {}
    best_of: dict[tuple[int, int], float] = {}
    for at, piece in zip(*np.nonzero(cosine >= space.least)):
        pair = int(owner[at]), int(space.owner[piece])
        near.setdefault(pair, []).append(int(at))
        best_of[pair] = max(best_of.get(pair, -1.0), float(cosine[at, piece]))
    exact: dict[tuple[int, int], list[int]] = {}
    if space.short:
        text_starts = np.cumsum(lengths) - lengths
        for at in np.flatnonzero(space.is_key[numbers]):
            k = int(np.searchsorted(text_starts, at, side="right")) - 1
            for i in space.short[int(numbers[at])]:
                exact.setdefault((k, i), []).append(int(at - text_starts[k]))
    found, split = [], {}
    for k, i in near.keys() | exact.keys():
        places = near.get((k, i), [])
        if k not in split:
            split[k] = plain_words(texts[k])
        words = split[k]
        item, best = space.items[i], None
        runs: list[list[int]] = []
        for at in places:
            low = (at - int(first[k])) * HALF - len(item.words)
            high = low + 2 * HALF + 2 * len(item.words)
            if runs and low <= runs[-1][1]:
                runs[-1][1] = high
            else:
                runs.append([low, high])
        for low, high in runs:
            shares = item.shares(words[max(low, 0) : high])
            if shares:
                best = max(best or shares, shares)
        # Around a key there is room for the item on either side, and no more, for few words are soon found in many.
        span = 2 * len(item.words)
        for at in exact.get((k, i), []):
            shares = item.shares(words[max(at - span, 0) : at + span + 1])
            if shares:
                best = max(best or shares, shares)
                half = int(first[k]) + at // HALF
                those = cosine[max(half - 1, int(first[k])) : half + 1, space.piece_of[i]]
                best_of[k, i] = max(best_of.get((k, i), -1.0), float(those.max()))
        if best:
            found.append((k, item.number, best_of[k, i], *best))
    return found


def run_sums(matrix: np.ndarray, rows: np.ndarray, starts: np.ndarray, value: np.ndarray | None = None) -> np.ndarray:
    """The sums of ``matrix[rows]``, times ``value``, over the runs that begin at ``starts`` (ascending): what
    ``np.add.reduceat`` gives, a row of each run at a time, which takes far less time on runs of a few rows."""
    sizes = np.diff(np.r_[starts, len(rows)])
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = starts[order], sizes[order]
    total = np.zeros((len(starts), matrix.shape[1]), matrix.dtype)
    for n, live in enumerate(np.searchsorted(-sizes, -np.arange(sizes[0]))):  # so many runs have more than n rows
        at = begin[:live] + n
        part = matrix[rows[at]]
        if value is not None:
            part *= value[at, None]
        total[:live] += part
    result = np.empty_like(total)
    result[order] = total
    return result


def singular_vectors(passages: DataFrame, idf: np.ndarray) -> np.ndarray:
    """The leading right singular vectors (terms x rank) of the passages' normalised TF-IDF vectors.

    Randomised SVD: a random matrix is multiplied with the transposed matrix times the matrix a few times, each
    product being one job in which the tasks' sums (terms x rank) are added up by slices, and made orthonormal in between.
    """
    width = min(RANK + EXTRA, len(idf))
    basis = np.random.default_rng(0).standard_normal((len(idf), width))
    for _ in range(POWERS + 1):
        basis, _ = np.linalg.qr(_product(passages, idf, basis, gram=False))
    values, turns = np.linalg.eigh(_product(passages, idf, basis, gram=True))
    return basis @ turns[:, np.argsort(values)[::-1][:RANK]]


def _product(passages: DataFrame, idf: np.ndarray, basis: np.ndarray, gram: bool) -> np.ndarray:
    """A'(A basis), or (A basis)'(A basis), where A has a row for each passage, with its terms in order."""
    sums = everywhere(passages.sparkSession, (idf, basis))
    shape = (basis.shape[1],) * 2 if gram else basis.shape
    edges = np.linspace(0, shape[0], SLICES + 1).astype(int)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, matrix = sums.value
        matrix = matrix.astype(np.float32)
        total = np.zeros(shape)
        frequent = np.argsort(weights, kind="stable")[:FREQUENT]
        column = np.full(len(weights), -1)
        column[frequent] = np.arange(len(frequent))
        head = matrix[frequent]
        for whole in batches:
            for start in range(0, len(whole), ROWS):
                batch = whole.slice(start, ROWS)
                passage, sizes = batch.column("passage").flatten().to_numpy(), batch.column("passage").value_lengths().to_numpy()
                if not len(passage):
                    continue
                owner = np.repeat(np.arange(len(sizes)), sizes)
                at = np.flatnonzero(np.r_[True, (passage[1:] != passage[:-1]) | (owner[1:] != owner[:-1])])
                value = np.diff(np.r_[at, len(passage)]) * weights[passage[at]]
                term, owner = passage[at], owner[at]
                length = np.sqrt(np.bincount(owner, value * value, len(sizes)))
                value *= (batch.column("weight").to_numpy() / np.maximum(length, 1e-12))[owner]
                value = value.astype(np.float32)
                # The frequent terms as a dense block, the others one by one.
                place = column[term]
                often = place >= 0
                block = np.zeros((len(sizes), len(frequent)), np.float32)
                block[owner[often], place[often]] = value[often]
                term, owner, value = term[~often], owner[~often], value[~often]
                image = block @ head
                if len(term):
                    some = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                    image[owner[some]] += run_sums(matrix, term, some, value)
                if gram:
                    total += image.T.astype(float) @ image
                    continue
                total[frequent] += block.T @ image
                if len(term):
                    order = np.argsort(term, kind="stable")
                    term = term[order]
                    first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
                    total[term[first]] += run_sums(image, owner[order], first, value[order])
        parts = [total[low:high].tobytes() for low, high in zip(edges, edges[1:])]
        yield pa.RecordBatch.from_pydict({"part": pa.array(range(SLICES), pa.int32()), "total": pa.array(parts, pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("total")):
                totals[part] = totals.get(part, 0) + np.frombuffer(data.as_buffer())
        columns = [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "total"])

    kind = "part int, total binary"
    added = passages.mapInArrow(tidy(run), kind).repartition(8, "part").mapInArrow(tidy(add), kind)
    total = np.zeros(shape)
    for row in added.toLocalIterator():
        total[edges[row.part] : edges[row.part + 1]] = np.frombuffer(row.total).reshape(-1, shape[1])
    return total
