"""Token alignment against a plain version over byte ranges."""

import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shardweave.llm import token_alignment
from shardweave.llm.queries import BYTE_LEVEL, PIECES, QUERIES
from tests.llm.fixtures import SF, collected, empty_table, odd_rows, odd_table

COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups".split()


def letters():
    """The published table of byte-level vocabularies."""
    table, extra = {}, 0
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            table[chr(byte)] = byte
        else:
            table[chr(256 + extra)], extra = byte, extra + 1
    return table


def piece_bytes(piece):
    return bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") and len(piece) == 6 else piece.replace("▁", " ").encode()


def plain(rows):
    """The same by comparing every byte range with those that it meets, text by text."""
    a, b = Tokenizer.from_file(BYTE_LEVEL), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    table = letters()
    linked, holders = [], Counter()
    for _, text in rows:
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        bytes_a = [bytes(table[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [piece_bytes(b.id_to_piece(i)) for i in ids_b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == b" " + text.encode():
            linked.append(([], [], []))
            continue
        spans = []
        for ids, parts in ((ids_a, bytes_a), (ids_b, bytes_b)):
            at, mine = 0, []
            for i, part in zip(ids, parts):
                mine.append((i, at, at + len(part)))
                at += len(part)
            spans.append(mine)
        links, low = [], 0
        for i, start, stop in spans[0]:
            while spans[1][low][2] <= start:
                low += 1
            k = low
            while k < len(spans[1]) and spans[1][k][1] < stop:
                links.append((i, spans[1][k][0]))
                k += 1
        shared = sorted({s for _, _, s in spans[0]} & {s for _, _, s in spans[1]})
        groups, before = [], 0
        for end in shared:
            groups.append("|".join(",".join(str(i) for i, s, e in mine if before <= s and e <= end) for mine in spans) if len(text) < 3000 else None)
            before = end
        linked.append((spans, links, groups))
        holders.update(set(links))
    most = {}
    for (i, _), n in holders.items():
        most[i] = max(most.get(i, 0), n)
    out = []
    for (number, _), (spans, links, groups) in zip(rows, linked):
        sizes = [len(s) for s in spans] if spans else [0, 0]
        best = sum(holders[link] == most[link[0]] for link in links)
        whole = None if None in groups else ";".join(groups)
        out.append((number, *sizes, len(groups), len(links), best, sum(holders[link] for link in links), whole))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def models(spark):
    return token_alignment.Models(spark, BYTE_LEVEL, PIECES)


def hard_texts():
    rng = random.Random(8)
    alphabets = ("ab ", "the of\n\t  and", "é中文🙂 x1", "<|endoftext|> <s> </s> <unk> <0x41> ▁", " ﬁ é 　\x00q")
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for alphabet in alphabets for _ in range(40)]
    return texts + ["<|endoftext|>", " lead", "trail ", "  ", "a" * 500, "same words", "same words", "<s>", "▁", "x▁y"]


def assert_same(found, expected):
    assert [f[:-1] for f in found] == [e[:-1] for e in expected]
    assert all(e[-1] is None or f[-1] == e[-1] for f, e in zip(found, expected))


def test_hard_texts(spark, models):
    rows = list(enumerate(hard_texts()))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert_same(collected(token_alignment.aligned(docs, models), *COLUMNS), plain(rows))


def test_odd_rows_and_clashing_columns(spark, models):
    docs = odd_table(spark).withColumn("groups", F.lit(1)).withColumn("pairs", F.lit("p")).withColumn("rows", F.lit(2.5))
    found = token_alignment.aligned(docs, models)
    assert_same(collected(found, *COLUMNS), plain(odd_rows()))
    kept = found.select("chunk", "n_words", "payload", "score", "pairs", "rows").distinct().collect()
    assert [tuple(row) for row in kept] == [("mine", 7, b"z", 1.5, "p", 2.5)]


def test_empty_table(spark, models):
    assert token_alignment.aligned(empty_table(spark), models).collect() == []


def test_small_memo_and_chunks(spark, models, monkeypatch):
    """The result is the same whatever the worker remembers, and however texts are gathered."""
    aligner = token_alignment.Aligner(*(kind(token_alignment.file_bytes(spark, path)) for kind, path in ((token_alignment.ByteLevel, BYTE_LEVEL), (token_alignment.Pieces, PIECES))))
    texts = [t.encode() for t in hard_texts()]
    columns, pairs, found, times = aligner.aligned(texts, False)
    monkeypatch.setattr(token_alignment, "MEMO_WINDOWS", 3)
    monkeypatch.setattr(token_alignment, "MEMO_IDS", 2)
    again = token_alignment.Aligner(aligner.a, aligner.b)
    one_by_one = [again.aligned([text], False) for text in texts]
    for name in columns:
        assert list(columns[name]) == [single[0][name][0] for single in one_by_one]
    assert sorted(set(pairs.tolist())) == sorted({p for single in one_by_one for p in single[1].tolist()})
    assert times.sum() == sum(single[3].sum() for single in one_by_one)


def test_ranks_stand_for_merges(spark):
    """Ids by ranks are those of the file's own library, for every code point; other files are left to it."""
    data = token_alignment.file_bytes(spark, BYTE_LEVEL)
    ranks = token_alignment.as_ranks(data)
    quick, own = token_alignment.ByteLevel(data, ranks), token_alignment.ByteLevel(data)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0)]
    texts = [f"x{c}x1{c}1 {c} {c}{c}  {c}!{c}" for c in points] + hard_texts() + [" " * 300_000, "a" * 300_000]
    assert quick.ranks is not None and quick.encode(texts) == own.encode(texts)
    changed = json.loads(data)
    changed["model"]["merges"][40], changed["model"]["merges"][41] = changed["model"]["merges"][41], changed["model"]["merges"][40]
    assert token_alignment.as_ranks(json.dumps(changed).encode()) is None
    changed = json.loads(data)
    changed["normalizer"] = {"type": "Lowercase"}
    assert token_alignment.as_ranks(json.dumps(changed).encode()) is None


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    expected = plain(rows)
    found = collected(QUERIES["op13_token_alignment"](spark, SF), *COLUMNS[:-1], "groups_sha256")
    assert [f[:-1] for f in found] == [e[:-1] for e in expected]
    digests = [None if e[-1] is None else hashlib.sha256(e[-1].encode()).hexdigest() if e[-1] else "" for e in expected]
    assert all(d is None or f[-1] == d for f, d in zip(found, digests))
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE_LEVEL
