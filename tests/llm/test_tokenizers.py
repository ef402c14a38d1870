"""Byte-level BPE and unigram counts against the public libraries."""

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardweave.llm import byte_bpe, token_counts
from shardweave.llm.queries import BPE_PATTERN, BPE_RANKS, PIECES, QUERIES
from tests.llm.fixtures import SF, collected, empty_table, odd_rows, odd_table


def ranks():
    with open(BPE_RANKS, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=BPE_PATTERN, mergeable_ranks=ranks(), special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    table = ranks()
    return byte_bpe.ByteBpe(table, byte_bpe.splits(table), BPE_PATTERN)


def ids(bpe, text):
    return np.frombuffer(bpe.encode(text), "<u4").tolist()


def test_bpe_random_texts(bpe, library):
    rng = random.Random(3)
    for alphabet in ("abet ", "etaoin shrdluETAOIN\n'sdt", "eéüñ中文日本한국🙂𝒳  \t0123456789!.,#<|endoftext|>"):
        for _ in range(600):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80)))
            assert ids(bpe, text) == library.encode_ordinary(text)
            assert bpe.decode(bpe.encode(text)) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_bpe_any_text(bpe, library, text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids(bpe, text) == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9000, " " * 9999, "1" * 9999, "the" * 6000])
def test_bpe_long_pieces(bpe, library, text):
    assert ids(bpe, text) == library.encode_ordinary(text)


def test_bpe_unreachable_tokens():
    """A token that no merge makes is used for a whole piece only."""
    table = {bytes([b]): b for b in range(256)} | {b"xyz": 256, b"ab": 257, b"abc": 258}
    bpe = byte_bpe.ByteBpe(table, byte_bpe.splits(table), r"\S+|\s+")
    library = tiktoken.Encoding("small", pat_str=r"\S+|\s+", mergeable_ranks=table, special_tokens={})
    for text in ("xyz", "xyza", "axyz", "abc", "aabcc", "xyz abc"):
        assert ids(bpe, text) == library.encode_ordinary(text)


def test_bpe_table(spark, library):
    tokenizer = byte_bpe.Tokenizer(spark, BPE_RANKS, BPE_PATTERN)
    found = byte_bpe.encoded(odd_table(spark).withColumn("ids", F.lit(1)), tokenizer)
    expected = []
    for doc_id, text in odd_rows():
        codes = library.encode_ordinary(text or "")
        expected.append((doc_id, len(codes), bytearray(np.array(codes, "<u4").tobytes()), bytearray((text or "").encode())))
    assert collected(found, "doc_id", "n_tokens", "ids", "decoded") == sorted(expected, key=repr)
    assert byte_bpe.encoded(empty_table(spark), tokenizer).count() == 0


def test_bpe_query_round_trip(spark):
    found = QUERIES["op5_byte_bpe"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("wanted"))
    assert found.join(docs, "doc_id").where("decoded_sha256 = wanted").count() == docs.count()


@pytest.fixture(scope="module")
def counter():
    return token_counts.UnigramCounter(*token_counts.read_pieces(PIECES))


def unigram_library(pieces, byte_fallback):
    from tokenizers import Tokenizer, models

    extra = [(f"<0x{b:02X}>", -1e9) for b in range(256)] if byte_fallback else []
    vocabulary = [("<unk>", 0.0), *extra, *pieces.items()]
    return Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_fallback))


def test_unigram_against_library():
    rng = random.Random(8)
    alphabet = "abcd▁"
    for trial in range(40):
        pieces = {c: float(-rng.randint(1, 4)) for c in "abc▁"[: rng.randint(2, 4)]}
        for _ in range(12):
            piece = "".join(rng.choice(alphabet[:4]) for _ in range(rng.randint(2, 4)))
            pieces[piece] = float(-rng.randint(1, 6))
        pieces |= {"▁" + p.replace("▁", ""): float(-rng.randint(2, 6)) for p in list(pieces)[-3:]}
        for byte_fallback in (False, True):
            low = min(pieces.values())
            if byte_fallback:  # the library's lowest score is over all entries, so give it the same
                pieces.setdefault("zzzz", -1e9)
                low = -1e9
            mine = token_counts.UnigramCounter(pieces, byte_fallback)
            assert mine.unknown == low - 10
            library = unigram_library(pieces, byte_fallback)
            for _ in range(60):
                text = "".join(rng.choice("aabbccd é") for _ in range(rng.randint(1, 14)))
                wanted = len(library.encode("▁" + text.replace(" ", "▁")).ids)
                assert mine.count(text)[1] == wanted, (pieces, text)


def test_unigram_stretches_equal_whole(counter):
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("the and of  in,é中\n🙂xyz") for _ in range(rng.randint(0, 60)))
        whole = counter.best("▁" + text.replace(" ", "▁")) if text else (0.0, 0)
        assert counter.count(text) == pytest.approx(whole)


def test_unigram_brute_force():
    pieces = {"a": -1.0, "b": -1.5, "ab": -2.0, "aba": -3.0, "▁": -1.0, "▁a": -2.0}
    counter = token_counts.UnigramCounter(pieces, byte_fallback=False)

    def best(text):
        if not text:
            return 0.0
        found = [pieces[p] + best(text[len(p) :]) for p in pieces if text.startswith(p)]
        return max(found)

    for text in ("a", "abab", "abba ab", "aabab aba"):
        assert counter.count(text)[0] == best("▁" + text.replace(" ", "▁"))


def test_unigram_table(spark, counter):
    found = token_counts.counted(odd_table(spark), PIECES)
    expected = [(doc_id, counter.count(text or "")[1]) for doc_id, text in odd_rows()]
    assert collected(found, "doc_id", "n_tokens") == sorted(expected, key=repr)
    assert token_counts.counted(empty_table(spark), PIECES).count() == 0
    assert found.where("text is null or text = ''").agg(F.sum("n_tokens")).first()[0] == 0


def test_parameters_are_paths():
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECES
