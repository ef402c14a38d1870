"""Substring deduplication and the language model against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardweave.llm import chunks, language_model, substring_dedup
from shardweave.llm.queries import QUERIES
from shardweave.llm.words import BASE, PIECE, WordHashes, mix, texts_hashes, windows
from tests.llm.fixtures import LOWER, SF, collected, empty_table, odd_rows, odd_table, words


def kept(rows, width):
    """Brute force: (id, words, removed, kept text); equal ids are one place."""
    first = {}
    key = lambda i: (i is None, i or 0)
    for doc_id, text in rows:
        w = words(text)
        for k in range(len(w) - width + 1):
            place = (*key(doc_id), k)
            window = tuple(w[k : k + width])
            first[window] = min(first.get(window, place), place)
    out = []
    for doc_id, text in rows:
        w = words(text)
        covered = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < (*key(doc_id), k):
                covered[k : k + width] = [True] * width
        out.append((doc_id, len(w), sum(covered), b" ".join(x for x, c in zip(w, covered) if not c).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [20, 5])
@pytest.mark.parametrize("small", [False, True])
def test_dedup_odd_rows(spark, monkeypatch, width, small):
    if small:  # one document a chunk, and a sketch so full that nearly all windows are candidates
        monkeypatch.setattr(chunks, "CHUNK_BYTES", 1)
        monkeypatch.setattr(substring_dedup, "LEAST_CELLS", 1 << 20)
    found = substring_dedup.deduplicated(odd_table(spark), width=width)
    assert set(found.columns) == set("doc_id text chunk payload score n_words n_removed kept_text".split())
    assert collected(found, "doc_id", "n_words", "n_removed", "kept_text") == kept(odd_rows(), width)


def test_dedup_empty(spark):
    assert substring_dedup.deduplicated(empty_table(spark)).count() == 0


def test_dedup_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = [(i, n, r, hashlib.sha256(t.encode()).hexdigest()) for i, n, r, t in kept(rows, 20)]
    found = QUERIES["op6_substring_dedup"](spark, SF)
    assert collected(found, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(expected, key=repr)


def test_sketch_never_underestimates():
    rng = np.random.default_rng(1)
    marks = rng.integers(0, 3000, 4000).astype(np.uint32)
    value, times = np.unique(marks, return_counts=True)
    cells, sketch = 1 << 20, []
    for row in range(substring_dedup.ROWS):
        count = np.bincount(substring_dedup.cells_of(marks, row, cells).astype(np.int64), minlength=cells)
        sketch.append(np.packbits(count >= 2, bitorder="little"))
    assert substring_dedup.repeated(value[times >= 2], sketch, cells).all()
    assert substring_dedup.repeated(value, sketch, cells).mean() < 0.6


def test_window_hashes_are_polynomials():
    h = np.array([5, 7, 11, 13, 17, 19, 23], np.uint64)
    for width in range(1, 8):
        wanted = [sum(int(x) * pow(BASE, width - 1 - k) for k, x in enumerate(h[i : i + width])) % 2**64 for i in range(8 - width)]
        assert (windows(h, width) == mix(np.array(wanted, np.uint64))).all()
    assert len(windows(h, 8)) == 0


def test_equal_windows_share_minimisers():
    memo = WordHashes()
    import pyarrow as pa

    text = " ".join(["a", "b", "c"] * 30)
    w = substring_dedup.Windows(pa.record_batch({"id": [1], "t": [text]}), "id", "t", 20, memo)
    value, times = np.unique(w.minimisers(), return_counts=True)
    assert (times >= 2).all()


def tokens(text):
    return [*(text or "").encode().translate(LOWER).split(), None]


def base_rows(rows, trained):
    counts = Counter(t for (i, text), yes in zip(rows, trained) if yes for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        mine = tokens(text)
        out.append((i, len(mine), sum(counts[t] > 0 for t in mine), n, round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in mine), 6)))
    return sorted(out, key=repr)


def test_model_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 1000)
    rows = odd_rows()
    trained = [i is None or i % 3 != 0 for i, _ in rows]
    found = language_model.scored(odd_table(spark), F.col("doc_id") % 3 != 0)
    names = ("doc_id", "n_tokens", "n_known", "train_tokens", "base")
    assert collected(found.withColumn("base", F.round("base_score", 6)), *names) == base_rows(rows, trained)
    assert found.where("score is null or isnan(score) or score > 0 or score < -1e9").count() == 0
    assert {"chunk", "payload", "n_words"} <= set(found.columns)


def test_model_empty_and_untrained(spark):
    assert language_model.scored(empty_table(spark), F.lit(True)).count() == 0
    found = language_model.scored(odd_table(spark), F.lit(False)).collect()
    assert len(found) == len(odd_rows()) and all(row.score == 0 and row.base_score == 0 and row.n_known == 0 for row in found)


def test_model_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    trained = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    found = QUERIES["op9_language_model"](spark, SF)
    names = ("doc_id", "n_tokens", "n_known", "train_tokens", "base")
    assert collected(found.withColumn("base", F.round("base_score", 6)), *names) == base_rows(rows, trained)
    means = found.where("held_out").agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()
    assert means[0] > means[1]


def test_probabilities_sum_to_one_and_em_improves():
    rng = np.random.default_rng(2)
    cells = np.stack([rng.integers(0, 3, 500), rng.integers(-20, 60, 500), rng.integers(-20, 60, 500)], axis=1)
    cells[::5, 1] = language_model.NEVER
    times = rng.integers(1, 9, 500).astype(float)
    weights = language_model.learned(cells, times)
    assert np.allclose(weights.sum(axis=1), 1) and (weights[1:] > 0).all() and weights[0, 0] == 0
    ratio = np.ones((500, 3))
    for k in (0, 1):
        ratio[:, k] = np.where(cells[:, k + 1] == language_model.NEVER, 0, 2.0 ** (cells[:, k + 1] / language_model.STEPS))
    gain = lambda w: (times * np.log((w * ratio).sum(axis=1))).sum()
    assert gain(weights[cells[:, 0]]) > gain(np.full((500, 3), 1 / 3))


def test_hashes_of_words_come_from_running_sums():
    """Words are cut as ``bytes.split`` does and equal where their bytes are, across pieces and for very long words."""
    rng = random.Random(31)
    texts = [bytes(rng.choice(b"abAB \t\x0b\x0c\x1c\xc3\xa9z") for _ in range(rng.randrange(300))) for _ in range(500)]
    texts += [b"", b" ", b"x" * (PIECE + 3), b" ".join(b"w%d" % rng.randrange(9999) for _ in range(30_000)), b"y " + b"x" * PIECE + b"xxx"]
    hashes, counts = texts_hashes(texts, language_model._LOWERED)
    split = [text.lower().split() for text in texts]
    assert counts.tolist() == [len(s) for s in split]
    seen = {}
    assert all(seen.setdefault(word, value) == value for word, value in zip([w for s in split for w in s], hashes.tolist()))
    assert len(set(seen.values())) == len(seen)
    assert [len(x) for x in texts_hashes([], language_model._LOWERED)] == [0, 0]
