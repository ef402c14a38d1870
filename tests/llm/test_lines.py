"""Line deduplication that can be taken back, and its cuckoo filters."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardweave.llm import cuckoo, line_dedup
from shardweave.llm.cuckoo import Cuckoo
from shardweave.llm.line_dedup import LineIndex
from shardweave.llm.queries import QUERIES
from tests.llm.fixtures import SF, collected, empty_table, odd_rows, odd_table

COLUMNS = ["doc_id", "n_lines", "n_dropped", "kept_text"]
LAST = 1 << 63


def key(line):
    key = line.strip(" \t\n\r\x0b\x0c").translate({c: c + 32 for c in range(65, 91)})
    return key if len(key) >= 10 else None


def plain(rows):
    first = {}
    for number, text in rows:
        for line in (text or "").split("\n"):
            if key(line) is not None:
                first[key(line)] = min(first.get(key(line), LAST), LAST if number is None else number)
    out = []
    for number, text in rows:
        lines = (text or "").split("\n")
        mine = LAST if number is None else number
        kept = [line for line in lines if key(line) is None or first[key(line)] >= mine]
        out.append((number, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def corpus(seed, ids, lines=40):
    rng = random.Random(seed)
    pool = [f"line number {n} of the pool" for n in range(lines)] + ["short", "", " \t", "Seite é中文🙂 zwei", "exactly10!", "only nine", "ｆｕｌｌ ｗｉｄｔｈ"]
    return [(i, "\n".join(rng.choice((str.upper, str, lambda x: f"\t{x} \r"))(rng.choice(pool)) for _ in range(rng.randint(1, 12)))) for i in ids]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)


def keys_in(index):
    """All fingerprints of the filters, and those of the keys in the tables."""
    filters = {r.shard: Cuckoo(bytes(r["filter"])) for r in index._filters().collect()}
    held = index._read(index.refs).select("k1", "k2").distinct().collect()
    first, second = (np.array([r[k] for r in held], np.int64).view(np.uint64) for k in (0, 1))
    shard = ((first >> np.uint64(32)) * np.uint64(index.shards)) >> np.uint64(32)
    assert all(filters[int(s)].has(first[i : i + 1], second[i : i + 1])[0] for i, s in enumerate(shard))
    return sum(map(len, filters.values())), len(held)


@pytest.mark.parametrize("load", [0.3, 0.9, 0.99])
def test_filter_keeps_every_key(monkeypatch, load):
    monkeypatch.setattr(cuckoo, "BUCKETS", 256)
    monkeypatch.setattr(cuckoo, "ROUNDS", 60)
    rng = np.random.default_rng(4)
    first, second = (rng.integers(0, 1 << 63, int(1024 * load), np.uint64) for _ in range(2))
    table = Cuckoo()
    for part in np.array_split(np.arange(len(first)), 7):
        table.add(first[part], second[part])
    table = Cuckoo(table.tobytes())
    assert len(table) == len(first) and table.has(first, second).all()
    gone = np.arange(len(first)) % 3 == 0
    table.remove(first[gone], second[gone])
    assert len(table) == (~gone).sum() and table.has(first[~gone], second[~gone]).all()
    table.remove(first[~gone], second[~gone])
    assert len(table) == 0 and not table.has(first, second).any()


def test_filter_with_one_fingerprint_many_times(monkeypatch):
    """Keys that share fingerprint and bucket fill both buckets and then lie beside the table."""
    monkeypatch.setattr(cuckoo, "BUCKETS", 64)
    monkeypatch.setattr(cuckoo, "ROUNDS", 20)
    first, second = np.full(30, 5, np.uint64), np.arange(30, dtype=np.uint64) << np.uint64(16) | np.uint64(9)
    table = Cuckoo()
    table.add(first, second)
    assert len(table) == 30
    for n in range(30):
        assert table.has(first[:1], second[:1])[0]
        table.remove(first[:1], second[n : n + 1])
    assert not table.has(first[:1], second[:1])[0] and len(table) == 0


def test_one_insertion(spark):
    rows = corpus(1, range(200)) + [(None, "line number 3 of the pool\nof no document"), (None, "of no document\n"), (7, "line number 3 of the pool"), (7, None)]
    index = LineIndex(spark)
    index.insert(table(spark, rows))
    assert collected(index.kept(table(spark, rows)), *COLUMNS) == plain(rows)
    filled, keys = keys_in(index)
    assert filled == keys


def test_insertions_and_deletions(spark, monkeypatch):
    """After each change the index gives what a new one over the same documents would give."""
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 60)
    index = LineIndex(spark)
    present = {}
    for step, (kind, ids) in enumerate(
        [("insert", range(50, 100)), ("insert", range(50)), ("delete", range(0, 20)), ("delete", [60, 61, 999]), ("insert", range(0, 5)), ("delete", range(100))]
    ):
        if kind == "insert":
            rows = corpus(10 + step, ids, lines=30 + 40 * step)
            present |= dict(rows)
            index.insert(table(spark, rows))
        else:
            present = {i: t for i, t in present.items() if i not in set(ids)}
            index.delete(spark.createDataFrame([(i,) for i in ids], "doc_id bigint"))
        index = LineIndex(spark, index.root)  # opened again, it goes on from the last state
        index.tidy()
        if present:
            assert collected(index.kept(table(spark, list(present.items()))), *COLUMNS) == plain(list(present.items()))
        filled, keys = keys_in(index)
        assert filled == keys == len({key(line) for text in present.values() for line in text.split("\n")} - {None})
        assert {(r.k1, r.k2): (r.n, r.owner) for r in index.repeated().collect()} == {
            (r.k1, r.k2): (r.n, r.owner) for r in index._read(index.refs).groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("doc").alias("owner")).where("n > 1").collect()
        }
    assert index.shards > 1


def test_odd_rows_and_clashing_columns(spark):
    index = LineIndex(spark)
    docs = odd_table(spark).withColumn("doc", F.lit("d")).withColumn("kept_text", F.lit(3)).withColumn("row", F.lit("r"))
    index.insert(docs)
    found = index.kept(docs)
    assert collected(found, *COLUMNS) == plain(odd_rows())
    assert [tuple(r) for r in found.select("doc", "row", "chunk", "payload").distinct().collect()] == [("d", "r", "mine", b"z")]


def test_empty_table_and_unknown_rows(spark):
    index = LineIndex(spark)
    index.insert(empty_table(spark))
    index.delete(spark.createDataFrame([(1,)], "doc_id bigint"))
    assert index.kept(empty_table(spark)).collect() == []
    index.insert(spark.createDataFrame([(1, None), (2, "short"), (None, "")], "doc_id bigint, text string"))
    rows = [(5, "a line that nobody has inserted\nx"), (6, None)]
    assert collected(index.kept(table(spark, rows)), *COLUMNS) == [(5, 2, 0, rows[0][1]), (6, 1, 0, "")]
    assert index.repeated().collect() == []


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    expected = [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in plain(rows)]
    assert collected(QUERIES["op11_line_dedup"](spark, SF), *COLUMNS[:3], "kept_sha256") == sorted(expected, key=repr)
