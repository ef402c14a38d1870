"""Texts rearranged for filling in the middle, and put back."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardweave.llm import fill_middle
from shardweave.llm.fill_middle import Rates, put_back, rearranged, restored, transformed
from shardweave.llm.queries import QUERIES
from tests.llm.fixtures import SF, collected, empty_table, odd_rows, odd_table

COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


def plain(number, text, rates=Rates()):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, digest = len(units), hashlib.sha256(b"1:" + (b"" if number is None else str(number).encode())).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rates.rearranged:
        return number, n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(part) for part in (units[:low], units[low:high], units[high:]))
    if h[3] % 100 < rates.suffix_first:
        return number, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return number, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def made(rows, rates=Rates()):
    column = pa.array([text for _, text in rows], pa.string())
    columns = rearranged([number for number, _ in rows], column, rates)
    return columns, [(number, *values) for (number, _), *values in zip(rows, *(c.to_pylist() for c in columns))]


PARTS = ["a", "B", "z ", "<", "P", ">", "S", "<P", "é", "中", "\n", "🙂", "<M>", "@", "[", "`", "{", "\x00", "ab cd"]
rows_of_texts = st.lists(st.tuples(st.none() | st.integers(-5, 10**9), st.none() | st.lists(st.sampled_from(PARTS), max_size=25).map("".join)), max_size=25)


@settings(max_examples=300, deadline=None)
@given(rows_of_texts)
def test_any_batch(rows):
    columns, found = made(rows)
    assert found == [plain(*row) for row in rows]
    assert put_back(columns[4], columns[1]).to_pylist() == [text or "" for _, text in rows]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=8), st.integers(0, 100), st.integers(0, 100))
def test_any_text_and_rate(texts, often, first):
    rows = [(n, t.encode("utf-8", "ignore").decode()) for n, t in enumerate(texts)]
    rates = Rates(often, first)
    columns, found = made(rows, rates)
    assert found == [plain(*row, rates) for row in rows]
    assert put_back(columns[4], columns[1]).to_pylist() == [text for _, text in rows]


def test_part_of_a_batch():
    rows = [(n, f"text {n} é") for n in range(40)]
    column = pa.array([t for _, t in rows], pa.string()).slice(11, 17)
    columns = rearranged([n for n, _ in rows[11:28]], column, Rates())
    assert columns[4].to_pylist() == [plain(*row)[5] for row in rows[11:28]]


def test_odd_rows_and_clashing_columns(spark, monkeypatch):
    docs = odd_table(spark).withColumn("form", F.lit(1)).withColumn("restored", F.lit("r")).withColumn("n", F.lit(False))
    found = restored(transformed(docs))
    assert collected(found, *COLUMNS, "restored") == sorted(((*plain(*row), row[1] or "") for row in odd_rows()), key=repr)
    assert [tuple(r) for r in found.select("chunk", "payload").distinct().collect()] == [("mine", b"z")]


def test_empty_table_long_text_and_string_ids(spark, monkeypatch):
    assert restored(transformed(empty_table(spark))).collect() == []
    rng = random.Random(2)
    rows = [(n, "".join(rng.choice(PARTS[:11]) for _ in range(size))) for n, size in enumerate((400_000, 0, 3, 200_000, 1))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert collected(transformed(docs), *COLUMNS) == sorted((plain(*row) for row in rows), key=repr)
    named = docs.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text")
    assert collected(transformed(named), *COLUMNS) == sorted((plain(f"d{n}", text) for n, text in rows), key=repr)


def test_outputs_without_marks_are_refused():
    with pytest.raises(ValueError):
        put_back(pa.array(["no marks"]), pa.array(["psm"]))
    with pytest.raises(ValueError):
        put_back(pa.array(["<P>a<S>b<M>c<M>"]), pa.array(["psm"]))
    assert put_back(pa.array(["<P>x", None, "y"]), pa.array(["plain", None, "other"])).to_pylist() == ["<P>x", "", "y"]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    digest = lambda text: hashlib.sha256((text or "").encode()).hexdigest()
    expected = sorted(((*plain(*row)[:5], digest(plain(*row)[5]), digest(row[1])) for row in rows), key=repr)
    found = collected(QUERIES["op12_fill_middle"](spark, SF), *COLUMNS[:5], "output_sha256", "restored_sha256")
    assert found == expected
    forms = [f[2] for f in found]
    assert 0.6 < forms.count("psm") / len(forms) < 0.85 and 0.05 < forms.count("plain") / len(forms) < 0.2
