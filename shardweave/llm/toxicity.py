"""Toxicity by a classifier chain over word features.

Categories are predicted one after another. Each has a linear model over the features of a text and the
probabilities of the categories before it. While it is fitted, those come from models that have not seen the
row (out-of-fold), so that a later model does not trust an earlier one more than it may when applied.

A text's features are the distinct words, with the beginnings of longer ones (inflected and compound forms share
them), what clings to words as punctuation, and whether words are all upper case. The model is fitted on all labelled
rows and keeps the features that tell a category apart: in one task if these rows are few, otherwise each sum over rows
that a step of the fit needs is a job over stored blocks of them. Applying it needs no shuffle.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shardweave.llm.store import destroy, everywhere, stored
from shardweave.llm.words import give_back, text_slices, tidy, utf8
from shardweave.session import small_batches

# Labelled rows that have a text: up to so many are fitted on in one task, more by jobs over all of them.
SAMPLE_ROWS = 10_000
# Rows per task of the jobs that sum over all rows: starting a task takes as long as summing over several thousand.
TASK_ROWS = 4 * SAMPLE_ROWS
# Bytes of texts whose words are one block.
BLOCK_BYTES = 512 << 10
# Bytes of the word beginnings that are features; features kept per category; texts that must have one.
BEGINNINGS, FEATURES, LEAST_TEXTS = (4, 5, 6), 1500, 4
# Folds of the out-of-fold predictions; strength of the squared penalty; steps of the fit, and of the power
# iteration that bounds their length.
FOLDS, PENALTY, STEPS, POWERS = 5, 1e-4, 150, 15
MEMO_ENTRIES = 150_000
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def features_of(word: bytes) -> list[int]:
    """Hashes of the features that a word (as it stands in the text) gives its text."""
    digest = xxhash.xxh3_64_intdigest
    tail, bare = b"", word
    if not word.isalnum():
        tail = word[len(word.rstrip(PUNCTUATION)) :]
        bare = word.strip(PUNCTUATION)
    found = [digest(b"tail " + tail)] if tail else []
    if bare:
        low = bare.lower() if bare.isascii() else bare.decode("utf-8", "replace").lower().encode()
        found.append(digest(b"word " + low))
        found += [digest(b"from " + low[:n]) for n in BEGINNINGS if len(low) > n]
        if len(bare) > 3 and bare.isupper():
            found.append(digest(b"upper"))
    return found


def text_features(data: bytes) -> np.ndarray:
    return np.unique(np.fromiter((f for w in set(data.split()) for f in features_of(w)), np.uint64))


class Sparse:
    """A 0/1 matrix by the column numbers of its rows, end to end."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self._set(np.concatenate([np.empty(0, np.int64), *rows]), [len(r) for r in rows], width)

    @classmethod
    def of(cls, columns: np.ndarray, sizes: np.ndarray, width: int) -> Sparse:
        """The matrix by all column numbers, end to end, and how many each row has."""
        made = cls.__new__(cls)
        made._set(columns, sizes, width)
        return made

    def _set(self, columns: np.ndarray, sizes: np.ndarray | list[int], width: int) -> None:
        self.columns, self.sizes = columns, np.asarray(sizes, np.int64)
        self.owner = np.repeat(np.arange(len(sizes)), self.sizes)
        self.height, self.width = len(sizes), width

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=weights[self.columns], minlength=self.height)

    def turned(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, weights=np.repeat(values, self.sizes), minlength=self.width)


class Block(Sparse):
    """The rows of one block: sums of runs, which take half the time and round otherwise."""

    def times(self, weights: np.ndarray) -> np.ndarray:
        out, some = np.zeros(self.height), np.flatnonzero(self.sizes)
        if len(some):
            out[some] = np.add.reduceat(np.ascontiguousarray(weights).take(self.columns), (np.cumsum(self.sizes) - self.sizes)[some])
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def sums(kind: str, x: Sparse, earlier: np.ndarray, y: np.ndarray, mine: np.ndarray, w: np.ndarray | None) -> np.ndarray:
    """What the rows add to each weight of several models, one for each column of ``mine`` and ``w``: the sums of the
    inputs' ``squares``, of the inputs times the ``moments`` of their sums, or the ``slopes`` of the loss."""
    width, out = x.width, []
    for f in range(mine.shape[1]):
        z = mine[:, f]
        if kind == "squares":
            out.append(np.r_[x.turned(z), z @ earlier**2, z.sum()])
            continue
        at = x.times(w[:width, f]) + earlier @ w[width:-1, f] + w[-1, f]
        z = z * (sigmoid(at) - y if kind == "slopes" else at)
        out.append(np.r_[x.turned(z), z @ earlier, z.sum()])
    return np.stack(out, axis=1)


def descended(total: Callable[[str, np.ndarray | None], np.ndarray]) -> np.ndarray:
    """Weights of the features, of earlier probabilities, and the constant (rows) of logistic models (columns) with a
    squared penalty; accelerated gradient steps scaled by each input's frequency. ``total`` gives ``sums`` over all rows."""
    squares = total("squares", None)
    rows = np.maximum(squares[-1], 1)
    scale = 1 / np.sqrt(np.vstack([squares[:-1] / rows + 1e-4, np.ones((1, len(rows)))]))
    at = ahead = np.zeros(scale.shape)
    # The curvature is at most a quarter of the largest eigenvalue of the scaled second moments.
    v = np.ones(scale.shape)
    for _ in range(POWERS):
        v = v / np.sqrt((v * v).sum(axis=0))
        v = total("moments", v * scale) / rows * scale
    step = 4 / (1.2 * np.maximum(np.sqrt((v * v).sum(axis=0)), 1e-6))
    for k in range(STEPS):
        slope = total("slopes", ahead * scale) / rows * scale + PENALTY * np.vstack([ahead[:-1], np.zeros((1, len(rows)))])
        new = ahead - step * slope
        ahead = new + k / (k + 3) * (new - at)
        at = new
    return at * scale


def fit(x: Sparse, earlier: np.ndarray, y: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """The parts of ``descended`` for one model, on the rows ``mine``."""
    w = descended(lambda kind, w: sums(kind, x, earlier, y, mine[:, None], w))[:, 0]
    return w[: x.width], w[x.width : -1], float(w[-1])


class Chain:
    """A chain: feature hashes (ascending), per category the weights, and whether any row was there to fit it on."""

    def __init__(self, hashes: np.ndarray, links: list[tuple[np.ndarray, np.ndarray, float]], learned: bool = True):
        self.hashes, self.links, self.learned = hashes, links, learned
        self.weights = np.stack([link[0] for link in links], axis=1) if links else np.empty((0, 0))
        self.number = {int(h): n for n, h in enumerate(hashes)}
        self.memo: dict[bytes, tuple[int, ...]] = {}

    def __getstate__(self):
        return self.hashes, self.links, self.learned

    def __setstate__(self, state):
        self.__init__(*state)

    def known(self, word: bytes) -> tuple[int, ...]:
        number = self.number
        found = tuple([number[f] for f in features_of(word) if f in number])
        if len(self.memo) >= MEMO_ENTRIES:
            self.memo.clear()
        self.memo[word] = found
        return found

    def probabilities(self, data: bytes) -> np.ndarray:
        mine: set[int] = set()
        get, known = self.memo.get, self.known
        for word in set(data.split()):
            found = get(word)
            if found is None:
                found = known(word)
            if found:
                mine.update(found)
        sums = self.weights[sorted(mine)].sum(axis=0)
        out = np.zeros(len(self.links))
        for k, (_, chain, constant) in enumerate(self.links):
            out[k] = sigmoid(sums[k] + chain @ out[:k] + constant)
        return out


def chosen(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Ascending hashes of the features that tell some category best apart, by the chi-squared statistic."""
    flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    kept: list[np.ndarray] = []
    scores: list[np.ndarray] = []
    n = len(rows)
    for part in range(16):  # by high bits, for the memory
        at = np.flatnonzero(flat >> np.uint64(60) == np.uint64(part))
        hashes, of = np.unique(flat[at], return_inverse=True)
        times = np.bincount(of, minlength=len(hashes))
        enough = (times >= LEAST_TEXTS) & (times < n)
        score = []
        for k in range(labels.shape[1]):
            y = labels[:, k]
            both = np.bincount(of, weights=y[owner[at]], minlength=len(hashes))
            expected = times * y.mean()
            with np.errstate(divide="ignore", invalid="ignore"):
                chi = (both - expected) ** 2 / (expected * (1 - y.mean()) * (1 - times / n))
            score.append(np.where(enough, np.nan_to_num(chi, posinf=0.0), 0.0))
        kept.append(hashes)
        scores.append(np.stack(score, axis=1))
    hashes, score = np.concatenate(kept), np.concatenate(scores)
    best: set[int] = set()
    for k in range(score.shape[1]):
        order = np.lexsort((hashes, -score[:, k]))[:FEATURES]
        # 10.8 is the value that chance exceeds once in a thousand.
        best.update(int(h) for h in hashes[order[score[order, k] > 10.8]])
    return np.array(sorted(best), np.uint64)


def train(rows: list[np.ndarray], labels: list[list[int]]) -> Chain:
    """The chain for rows of feature hashes and their 0/1 marks per category."""
    y = np.array(labels, float).reshape(len(rows), -1)
    hashes = chosen(rows, y)
    numbers = []
    for row in rows:
        at = np.searchsorted(hashes, row)
        at[at == len(hashes)] = 0
        numbers.append(at[hashes[at] == row] if len(hashes) else np.empty(0, np.int64))
    x = Sparse(numbers, len(hashes))
    fold = np.arange(len(rows)) % FOLDS
    earlier, links = np.empty((len(rows), 0)), []
    everyone = np.ones(len(rows))
    for k in range(y.shape[1]):
        unseen = np.zeros(len(rows))
        for f in range(FOLDS if k < y.shape[1] - 1 else 0):
            w, chain, constant = fit(x, earlier, y[:, k], (fold != f).astype(float))
            z = x.times(w) + earlier @ chain + constant
            unseen[fold == f] = sigmoid(z)[fold == f]
        links.append(fit(x, earlier, y[:, k], everyone))
        earlier = np.column_stack([earlier, unseen])
    return Chain(hashes, links)


class Words(dict):
    """Memo from a word to its features; bounded."""

    def __missing__(self, word: bytes) -> list[int]:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        found = self[word] = features_of(word)
        return found


def word_block(texts: Iterator[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The distinct words of some texts, joined by spaces, the numbers of each text's words, and how many it has."""
    number: dict[bytes, int] = {}
    at = [[number.setdefault(w, len(number)) for w in set(data.split())] for data in texts]
    kind = np.uint16 if len(number) <= 1 << 16 else np.uint32
    return b" ".join(number), np.array([n for mine in at for n in mine], kind), np.array([len(mine) for mine in at], np.uint32)


def text_pairs(at: np.ndarray, sizes: np.ndarray, features: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, feature) of a block, ascending, as the texts' numbers and places in the features, which come
    last: those of all words once, ascending. ``features`` has a sequence for each word."""
    counts = np.fromiter(map(len, features), np.int64, len(features))
    flat = np.fromiter(itertools.chain.from_iterable(features), np.uint64, int(counts.sum()))
    distinct, place = np.unique(flat, return_inverse=True)
    # The features of each word that a text has, end to end.
    length = counts[at]
    before = np.cumsum(counts) - counts
    of = np.repeat(before[at] - np.cumsum(length) + length, length) + np.arange(length.sum())
    owner = np.repeat(np.repeat(np.arange(len(sizes)), sizes), length)
    pairs = np.sort(owner * len(distinct) + place[of])
    pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] if len(pairs) else pairs
    return pairs // max(len(distinct), 1), pairs % max(len(distinct), 1), distinct


# A table with a bit for each hash of an id: bits an id has at least, bits at most (8 MB), 64-bit words of a row.
BITS_EACH, MOST_BITS, LINE = 16, 1 << 26, 1024


def likely(texts: DataFrame, marked: DataFrame, count: int) -> DataFrame:
    """``texts`` with all rows whose ``_id`` is among the ``count`` of ``marked`` and few others, so that a join need not
    shuffle the texts of the others. Ids are looked up in a table of bits of bounded size, which is broadcast."""
    kinds = {df.schema["_id"].dataType.simpleString() for df in (texts, marked)}
    if not (kinds <= {"tinyint", "smallint", "int", "bigint"} or kinds == {"string"}):
        return texts  # equal values may be written differently
    size = min(MOST_BITS, max(64 * LINE, 1 << (BITS_EACH * count).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[int, np.ndarray] = {}
        for batch in batches:
            place = batch.column("place").to_numpy()
            for line in np.unique(batch.column("line").to_numpy()):
                bits = lines.setdefault(int(line), np.zeros(64 * LINE, bool))
                bits[place[batch.column("line").to_numpy() == line]] = True
        for line, bits in lines.items():
            words = np.packbits(bits, bitorder="little").view("<i8")
            yield pa.RecordBatch.from_arrays([pa.array([line], pa.int64()), pa.array([words], pa.list_(pa.int64()))], names=["line", "bits"])

    hashed = F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(size))
    line, place = F.floor(hashed / (64 * LINE)), F.pmod(hashed, F.lit(64 * LINE))
    places = marked.select(line.alias("line"), place.alias("place")).repartition(-(-size // (64 << 16)), "line")
    table = places.mapInArrow(tidy(run), "line bigint, bits array<bigint>")
    is_set = F.getbit(F.get("bits", F.floor(place / 64).cast("int")), F.pmod(place, F.lit(64)).cast("int")) == 1
    return texts.join(F.broadcast(table), (F.col("line") == line) & is_set, "left_semi")


def fitted_by_jobs(rows: DataFrame, names: list[str]) -> Chain:
    """The chain of ``train`` for all ``rows`` (``_id``, ``_text`` and marks), each sum over them being a job.

    Folds go by the hash of the id, so that rows of one id share one. A task holds a block of rows at a time; blocks are
    stored as words, in less room than the texts and far less than their features. The driver gets the chosen features,
    and per job and task one sum for each weight.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("_fold", F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(FOLDS)))
    kinds = "words binary, at binary, sizes binary, marks binary, fold binary"
    wide = len(names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in text_slices(batch.column("_text"), BLOCK_BYTES):
                part = batch.slice(start, length)
                words, at, sizes = word_block(utf8(part.column("_text")))
                marks = np.stack([part.column(n).to_numpy() for n in names], axis=1).astype(np.uint8)
                values = [words, at.tobytes(), sizes.tobytes(), marks.tobytes(), part.column("_fold").to_numpy().astype(np.uint8).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], names=["words", "at", "sizes", "marks", "fold"])

    blocks = stored(rows.select("_text", "_fold", *names).mapInArrow(tidy(pack), kinds), "toxicity-blocks")

    def parts_of(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, ...]:
        """The numbers of the texts' words or features, how many each has, marks and folds."""
        at, sizes, marks, fold = (memoryview(batch.column(n)[i].as_buffer()) for n in ("at", "sizes", "marks", "fold"))
        sizes = np.frombuffer(sizes, np.uint32)
        kind = np.uint16 if len(at) == 2 * int(sizes.sum()) else np.uint32
        return np.frombuffer(at, kind), sizes, np.frombuffer(marks, np.uint8).reshape(-1, wide), np.frombuffer(fold, np.uint8)

    def times(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows per feature, and those in each category; ``whole`` marks the totals."""
        memo = Words()
        for batch in batches:
            for i in range(len(batch)):
                at, sizes, marks, _ = parts_of(batch, i)
                owner, place, hashes = text_pairs(at, sizes, [memo[w] for w in batch.column("words")[i].as_py().split()])
                found = [np.bincount(place, minlength=len(hashes))] + [np.bincount(place[marks[owner, k] > 0], minlength=len(hashes)) for k in range(wide)]
                # Signed, in the order of the unsigned hashes.
                signed = (hashes ^ np.uint64(1 << 63)).view(np.int64)
                whole = [len(sizes), *marks.sum(axis=0, dtype=np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[signed, 0]), pa.array(np.r_[np.zeros(len(hashes), bool), True])] + [pa.array(np.r_[f, w]) for f, w in zip(found, whole)],
                    names=["hash", "whole", "times", *names],
                )

    marks = ", ".join(f"{n} bigint" for n in names)
    counts = blocks.mapInArrow(tidy(times), f"hash bigint, whole boolean, times bigint, {marks}").groupBy("hash", "whole")
    counts = counts.agg(F.sum("times").alias("times"), *[F.sum(n).alias(n) for n in names])
    counts = stored(counts.where(F.col("whole") | (F.col("times") >= LEAST_TEXTS)), "toxicity-features")
    whole = counts.where("whole").first()
    n, best = whole.times, set()
    enough = counts.where(~F.col("whole") & (F.col("times") < n))
    for name in names:
        mean = whole[name] / n
        if 0 < mean < 1:
            expected = F.col("times") * F.lit(mean)
            gap = F.col(name) - expected
            score = gap * gap / (expected * F.lit(1 - mean) * (F.lit(1.0) - F.col("times") / F.lit(float(n))))
            some = enough.select("hash", score.alias("score")).where("score > 10.8").orderBy(F.desc("score"), "hash").limit(FEATURES)
            best.update(r.hash for r in some.collect())
    chosen = np.array(sorted(best), np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    features = everywhere(spark, chosen)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Chain(features.value, [])
        get, known = model.memo.get, model.known
        kind = np.uint16 if len(features.value) <= 1 << 16 else np.uint32
        for batch in batches:
            for i in range(len(batch)):
                at, sizes, _, _ = parts_of(batch, i)
                words = batch.column("words")[i].as_py().split()
                owner, place, columns = text_pairs(at, sizes, [found if (found := get(w)) is not None else known(w) for w in words])
                sizes = np.bincount(owner, minlength=len(sizes))
                values = [columns[place].astype(kind).tobytes(), sizes.astype(np.uint32).tobytes()]
                values = [pa.array([v], pa.binary()) for v in values] + [batch.column(n).slice(i, 1) for n in ("marks", "fold")]
                yield pa.RecordBatch.from_arrays(values, names=["at", "sizes", "marks", "fold"])

    matrix = stored(blocks.mapInArrow(tidy(narrow), "at binary, sizes binary, marks binary, fold binary"), "toxicity-matrix")
    matrix = matrix.coalesce(-(-n // TASK_ROWS))
    unseen: list[np.ndarray] = []  # per category before, the weights (rows) of the folds' models (columns)
    links = []
    for k in range(wide):
        models = FOLDS + 1 if k < wide - 1 else 1

        def total(kind: str, w: np.ndarray | None) -> np.ndarray:
            sent = everywhere(spark, (w, unseen))

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                w, before = sent.value
                out = np.zeros((len(chosen) + k + 1, models))
                for batch in batches:
                    for i in range(len(batch)):
                        at, sizes, marks, fold = parts_of(batch, i)
                        x = Block.of(at.astype(np.int64), sizes, len(chosen))
                        earlier = np.empty((len(sizes), 0))
                        for weights in before:
                            z = np.bincount(x.owner, weights=weights[x.columns, fold[x.owner]], minlength=x.height)
                            z += (earlier * weights[x.width : -1].T[fold]).sum(axis=1) + weights[-1, fold]
                            earlier = np.column_stack([earlier, sigmoid(z)])
                        mine = np.ones((len(sizes), models))
                        mine[:, 1:] = fold[:, None] != np.arange(models - 1)
                        out += sums(kind, x, earlier, marks[:, k].astype(float), mine, w)
                yield pa.RecordBatch.from_pydict({"total": pa.array([out.tobytes()], pa.binary())})

            found = matrix.mapInArrow(run, "total binary").collect()  # one row per task
            destroy([sent])
            return sum(np.frombuffer(r.total).reshape(-1, models) for r in found)

        w = descended(total)
        links.append((w[: len(chosen), 0], w[len(chosen) : -1, 0], float(w[-1, 0])))
        unseen.append(w[:, 1:])
    return Chain(chosen, links)


def fitted(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id: str = "doc_id", text: str = "text") -> Chain:
    """A chain for ``categories``, in their order: names with boolean conditions on ``labels``.

    Fitted on all labelled rows that have a text. Rows without id or with an undecided category are left out, as are ids
    that ``docs`` does not have; a repeated id counts as often as it is there. Without any row the chain is not
    ``learned``, and every category has probability one half.
    """
    conditions = [c.cast("int").alias(f"_y{n}") for n, c in enumerate(categories.values())]
    names = [f"_y{n}" for n in range(len(categories))]
    marked = labels.select(F.col(id).alias("_id"), *conditions).dropna()
    order = F.xxhash64("_id")
    texts = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    rows = texts.join(marked, "_id").select("_id", "_text", *names)
    if rows.limit(SAMPLE_ROWS + 1).count() > SAMPLE_ROWS:
        rows = likely(texts, marked, marked.count()).join(marked, "_id").select("_id", "_text", *names)
        with small_batches(docs.sparkSession):
            return fitted_by_jobs(rows, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks: list[list[int]] = []

        def texts() -> Iterator[bytes]:
            for batch in batches:
                marks.extend(zip(*[batch.column(n).to_pylist() for n in names]))
                yield from utf8(batch.column("_text"))

        rows = [text_features(data) for data in texts()]
        if rows:
            chain = train(rows, marks)
            yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(chain)], pa.binary())})

    one = rows.repartition(1).sortWithinPartitions(order, "_id", "_text", *names)
    models = one.mapInArrow(run, "model binary").collect()
    if not models:
        return Chain(np.empty(0, np.uint64), [(np.empty(0), np.zeros(k), 0.0) for k in range(len(categories))], learned=False)
    return pickle.loads(models[0].model)


def probabilities(docs: DataFrame, chain: Chain, categories: list[str], text: str = "text") -> DataFrame:
    """``docs`` with a column ``p_<category>`` for each, replacing columns of these names.

    One row in, one row out; null and empty texts have no features and get the chain's constants.
    """
    model = everywhere(docs.sparkSession, chain)
    width = len(categories)

    @arrow_udf("array<double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        chain = model.value
        for batch in batches:
            flat = np.concatenate([np.empty(0), *[chain.probabilities(data) for data in utf8(batch)]])
            yield pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, width, dtype=np.int32), flat)
        chain.memo.clear()
        give_back()

    docs = docs.withColumn("_p", predict(F.col(text)))
    return docs.withColumns({f"p_{name}": F.col("_p")[n] for n, name in enumerate(categories)}).drop("_p")
