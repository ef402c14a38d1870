"""Small tables for the tests of the training-data operators, and their plain-Python counterparts."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def sentence(rng: random.Random, n: int, size: int = 400) -> str:
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def odd_rows() -> list[tuple]:
    """(doc_id, text): null and empty texts, blanks, short, long, repeated and nearly repeated ones, no id."""
    rng = random.Random(5)
    long, base, passage = sentence(rng, 20_000, 5000), sentence(rng, 120), sentence(rng, 40)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "One"),
        (5, "one TWO"),
        (6, long),
        (7, base),
        (8, base),
        (8, base),
        (9, " ".join(near)),
        (10, base.upper()),
        (11, sentence(rng, 30) + "\n" + passage + "  " + sentence(rng, 25)),
        (12, passage + " é ü 中文 🙂 " + sentence(rng, 21)),
        (13, " ".join(["same"] * 70)),
        (14, sentence(rng, 19)),
        (15, sentence(rng, 20)),
        (None, sentence(rng, 50)),
        (None, None),
        (16, "x" * 3000),
        (17, sentence(rng, 300)),
        (18, "one two"),
    ]
    rng.shuffle(rows)
    return rows


def odd_table(spark):
    """The rows with columns that clash with names the operators use."""
    rows = [(i, t, "mine", 7, b"z", 1.5) for i, t in odd_rows()]
    schema = "doc_id bigint, text string, chunk string, n_words int, payload binary, score double"
    return spark.createDataFrame(rows, schema).repartition(3)


def empty_table(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


def collected(df, *names: str) -> list[tuple]:
    """Rows as tuples, in an order that nulls do not disturb."""
    return sorted((tuple(row[n] for n in names) for row in df.select(*names).collect()), key=repr)
