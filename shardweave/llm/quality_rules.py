"""Document quality by a sparse ensemble of rules.

Trees are grown on statistics of labelled texts; every path from a root to a node is a rule, a conjunction of
bounds on statistics. A logistic model with a lasso penalty picks few of the rules and weighs them, and the
statistics themselves for what is plainly linear. What is left is compiled into one Spark column over the
statistics, so scoring runs in generated code.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shardweave.llm.store import stored
from shardweave.llm.words import utf8

# Labelled rows, those with the least hashes of their ids, that the model is fitted on.
SAMPLE_ROWS = 20_000
# Trees, their depth, the share of rows each sees, and the strength of the lasso penalty.
TREES, DEPTH, ROWS, PENALTY = 24, 3, 0.6, 0.002

STATISTICS = (
    "chars words word_length longest_word distinct_words top_word upper lower digits spaces marks other_symbols beyond_ascii"
    " lines line_length repeated_lines runs_of_symbols entropy long_words short_words"
).split()
Bound = tuple[int, str, float]

_KIND = np.zeros(256, np.int64)
for _code in range(256):
    _char = chr(_code)
    _KIND[_code] = (
        0 if 65 <= _code <= 90 else 1 if 97 <= _code <= 122 else 2 if 48 <= _code <= 57 else 3 if _code == 32 or 9 <= _code <= 13
        else 4 if _char in ".,;:'\"-()?" else 6 if _code > 127 else 5
    )
_RUNS = re.compile(rb"[^\w\s\x80-\xff]{2,}")


def statistics(data: bytes) -> list[float]:
    """The statistics of a text by its UTF-8 bytes; all 0 for an empty one."""
    if not data:
        return [0.0] * len(STATISTICS)
    times = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=times, minlength=7) / len(data)
    share = times[times > 0] / len(data)
    words, lines = data.split(), [line for line in data.split(b"\n") if line.strip()]
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counts = Counter(words)
    return [
        math.log1p(len(data)),
        math.log1p(len(words)),
        float(lengths.mean()),
        math.log1p(int(lengths.max())),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        *kinds[[0, 1, 2, 3, 4, 5, 6]].tolist(),
        math.log1p(len(lines)),
        math.log1p(len(data) / max(len(lines), 1)),
        1 - len(set(lines)) / max(len(lines), 1),
        len(_RUNS.findall(data)) / n,
        float(-(share * np.log2(share)).sum()),
        float((lengths > 12).mean()),
        float((lengths <= 3).mean()),
    ]


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``id``, and one column for each of ``STATISTICS``), one row for each of ``docs``; null counts as empty."""

    @arrow_udf("array<double>")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        width = len(STATISTICS)
        for batch in batches:
            flat = np.array([x for data in utf8(batch) for x in statistics(data)], float)
            yield pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, width, dtype=np.int32), flat)

    rows = docs.select(F.col(id).alias("_id"), measure(F.col(text)).alias("_s"))
    return rows.select(F.col("_id").alias(id), *[F.col("_s")[n].alias(f"_{name}") for n, name in enumerate(STATISTICS)])


def statistic(n: int) -> Column:
    return F.col(f"_{STATISTICS[n]}")


_LINE = re.compile(r"( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)")


def paths(described: str) -> list[tuple[Bound, ...]]:
    """The conjunctions on the way to each node of a tree but its root, from the tree's description."""
    found, stack = [], []
    for line in described.splitlines():
        match = _LINE.match(line)
        if match:
            depth = len(match[1])
            stack = [s for s in stack if s[0] < depth]
            stack.append((depth, (int(match[3]), match[4], float(match[5]))))
            found.append(narrowed([bound for _, bound in stack]))
    return found


def narrowed(bounds: list[Bound]) -> tuple[Bound, ...]:
    """The same conjunction with one bound per statistic and side, in a fixed order."""
    tight: dict[tuple[int, str], float] = {}
    for n, side, value in bounds:
        pick = min if side == "<=" else max
        tight[n, side] = pick(value, tight.get((n, side), value))
    return tuple(sorted((n, side, value) for (n, side), value in tight.items()))


def compiled(rule: tuple[Bound, ...]) -> Column:
    """1.0 where the statistics meet all bounds of the rule, else 0.0."""
    condition = F.lit(True)
    for n, side, value in rule:
        condition &= statistic(n) <= value if side == "<=" else statistic(n) > value
    return F.when(condition, 1.0).otherwise(0.0)


class Ensemble:
    """Weighted rules, weighted statistics (clipped to the range of the middle 98 percent) and a constant."""

    def __init__(self, rules: list[tuple[tuple[Bound, ...], float]], linear: list[tuple[int, float, float, float]], constant: float):
        self.rules, self.linear, self.constant = rules, linear, constant

    def score(self) -> Column:
        total = F.lit(self.constant)
        for rule, weight in self.rules:
            total += compiled(rule) * weight
        for n, low, high, weight in self.linear:
            total += clipped(n, low, high) * weight
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def clipped(n: int, low: float, high: float) -> Column:
    return F.least(F.greatest(statistic(n), F.lit(low)), F.lit(high))


def fitted(rows: DataFrame) -> Ensemble:
    """The ensemble for ``rows`` (statistics and a column ``label`` of 0 and 1), which must be few enough to be
    written and read many times. With one kind of label, or none, every score is that label's share, or 1/2."""
    n, ones = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or ones in (0, n):
        return Ensemble([], [], math.log((ones + 0.5) / (n - ones + 0.5)) if n else 0.0)
    every = [statistic(k) for k in range(len(STATISTICS))]
    features = rows.select(array_to_vector(F.array(*every)).alias("features"), F.col("label").cast("double").alias("label"))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, subsamplingRate=ROWS, featureSubsetStrategy="0.5", maxBins=64, seed=1, minInstancesPerNode=5
    ).fit(features)
    rules = sorted({path for tree in forest.trees for path in paths(tree.toDebugString)})
    ends = rows.select(*[F.percentile(c, F.array(F.lit(0.01), F.lit(0.99))).alias(f"e{k}") for k, c in enumerate(every)]).first()
    lines = [(k, *ends[k]) for k in range(len(STATISTICS)) if ends[k][0] < ends[k][1]]
    columns = [compiled(rule) for rule in rules] + [clipped(*line) for line in lines]
    design = rows.select(array_to_vector(F.array(*columns)).alias("features"), F.col("label").cast("double").alias("label"))
    design = stored(design.repartition(4), "quality-design")
    lasso = LogisticRegression(regParam=PENALTY, elasticNetParam=1.0, maxIter=60, tol=1e-5).fit(design)
    weights = lasso.coefficients.toArray()
    kept = [(rule, float(w)) for rule, w in zip(rules, weights) if w]
    linear = [(*line, float(w)) for line, w in zip(lines, weights[len(rules) :]) if w]
    return Ensemble(kept, linear, float(lasso.intercept))


def scored(docs: DataFrame, labels: DataFrame, label: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``id``, score) for each row of ``docs``: how likely the boolean ``label`` is true by the text alone.

    Fitted on at most ``SAMPLE_ROWS`` labelled rows, those with the least hashes of their id; rows without id or label
    are left out before these are taken, as are ids that ``docs`` does not have. Null and empty texts have statistics of 0 and the score
    that follows from them. Repeated rows are each scored; an empty table gives an empty result.
    """
    measures = stored(measured(docs, id, text), "quality-statistics")
    marked = labels.select(F.col(id), F.col(label).cast("int").alias("label")).dropna()
    known = marked.join(measures.select(id), id, "left_semi")
    sample = known.orderBy(F.xxhash64(id), id, "label").limit(SAMPLE_ROWS)
    # Bounded by SAMPLE_ROWS, so it may be broadcast whatever the size of the tables; an id may be on many rows.
    rows = measures.join(F.broadcast(sample), id)
    ordered = rows.orderBy(F.xxhash64(id), id, "label", F.xxhash64(*(F.col(c) for c in measures.columns)))
    rows = ordered.limit(SAMPLE_ROWS).drop(id).repartition(4)
    model = fitted(stored(rows, "quality-sample"))
    return measures.select(id, model.score().alias("score"))
