"""Document fingerprints by SimHash, and all pairs of fingerprints within a Hamming radius.

Each term of a text, weighted by how often it stands there, votes with its hash: for a set bit up, else
down; the fingerprint has the bits voted up. Texts that share most terms differ in few bits. Fingerprints
within a radius are found by cutting the bits into blocks: with ``radius`` bits wrong, at least ``blocks -
radius`` blocks are untouched, so for each choice of that many blocks a table keyed by them finds the pairs
that agree there, whatever the other bits are.

Everything here is DataFrame operations. Votes are counted for two bits at a time in one 64-bit sum.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardweave.llm.store import stored

# Words of a term, bits of a fingerprint, radius and blocks of the search for near ones.
TERM_WORDS, BITS, RADIUS, BLOCKS = 3, 64, 3, 6
HALF = BITS // 2
# Rows of a part in which rows meet their successors, and parts there are at most.
PART_ROWS, PARTS = 2000, 1 << 16


def terms(text: Column) -> Column:
    """ARRAY<STRUCT> of a text's terms: at each word, the run of up to ``TERM_WORDS`` words from there on."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    parts = [words] + [F.slice(words, k + 1, F.greatest(F.size(words) - k, F.lit(0))) for k in range(1, TERM_WORDS)]
    return F.arrays_zip(*[p.alias(f"w{k}") for k, p in enumerate(parts)])


def fingerprinted(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per distinct ``keys`` (which must determine the text), with BIGINT ``fingerprint``.

    Null, empty and blank texts have no terms and fingerprint 0; ties of votes give 0. The terms are counted
    where they are read, so the shuffle has a row per text (none if ``df`` is partitioned by some of the keys).
    """
    exploded = df.select(*keys, F.explode_outer(terms(F.col(text))).alias("t"))
    hashed = exploded.select(
        *keys,
        F.when(F.col("t").isNotNull(), F.xxhash64(*[F.col(f"t.w{k}") if k else F.col("t.w0") for k in range(TERM_WORDS)])).alias("h"),
    )
    lanes = F.lit((1 << 32) + 1).cast("long")
    votes = [F.sum(F.shiftrightunsigned("h", k).bitwiseAND(lanes)).alias(f"v{k}") for k in range(HALF)]
    counted = hashed.groupBy(*keys).agg(F.count("h").alias("n"), *votes)
    bits = F.lit(0).cast("long")
    for k in range(HALF):
        low, high = F.col(f"v{k}").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")), F.shiftrightunsigned(f"v{k}", 32)
        for votes_up, at in ((low, k), (high, k + HALF)):
            bits = bits.bitwiseOR(F.when(2 * votes_up > F.col("n"), F.shiftleft(F.lit(1).cast("long"), at)).otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, bits.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """The share of bits in which two fingerprints agree."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), BITS // 4, "0"))


def block_masks(blocks: int) -> list[int]:
    edges = [round(k * BITS / blocks) for k in range(blocks + 1)]
    return [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def near_pairs(fingerprints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(a, b), a < b, of all distinct values of ``fingerprint`` that differ in at most ``radius`` bits.

    Every pair comes once: from the table of the first blocks in which it agrees. Equal fingerprints are one
    value, so copies do not multiply pairs; null is left out.
    """
    if not 0 < radius < blocks:
        raise ValueError("there must be more blocks than the radius")
    masks, keep = block_masks(blocks), blocks - radius
    values = fingerprints.select("fingerprint").where("fingerprint is not null").distinct()
    tables = []
    for chosen in combinations(range(blocks), keep):
        mask, ids = sum(masks[k] for k in chosen), sum(1 << k for k in chosen)
        tables.append(F.struct(F.lit(ids).alias("ids"), F.col("fingerprint").bitwiseAND(_signed(mask)).alias("key")))
    rows = values.select("fingerprint", F.explode(F.array(*tables)).alias("t")).select("fingerprint", "t.ids", "t.key")
    left, right = rows.withColumnRenamed("fingerprint", "a"), rows.withColumnRenamed("fingerprint", "b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    agree = F.lit(0)
    for k, mask in enumerate(masks):
        agree = agree.bitwiseOR(F.when(differ.bitwiseAND(_signed(mask)) == 0, F.lit(1 << k)).otherwise(F.lit(0)))
    rest = agree
    for _ in range(keep):  # clear the lowest set bit: what goes are the first blocks that agree
        rest = rest.bitwiseAND(rest - 1)
    first = agree.bitwiseXOR(rest) == F.col("ids")
    close = F.bit_count(differ) <= radius
    return left.join(right, ["ids", "key"]).where((F.col("a") < F.col("b")) & close & first).select("a", "b")


def near_counts(fingerprints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(fingerprint, n_texts, n_near): texts with that very fingerprint, and texts with another one within the radius."""
    sizes = stored(fingerprints.where("fingerprint is not null").groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_texts")), "fp-sizes")
    pairs = near_pairs(sizes, radius, blocks)
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weighed = both.join(sizes.withColumnRenamed("fingerprint", "b"), "b").groupBy("a").agg(F.sum("n_texts").alias("n_near"))
    weighed = weighed.withColumnRenamed("a", "fingerprint")
    return sizes.join(weighed, "fingerprint", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)))


def with_next(df: DataFrame, id: str, text: str) -> DataFrame:
    """(part, place, copy, ``id``, ``text``, next_text): each row beside its successor in descending ``id``.

    After the last row comes the first. Equal ids are ordered by their texts, null ids come last. The range of
    ids is cut into parts of equal width, about one for ``PART_ROWS`` rows, at most ``PARTS``. A text is shuffled
    once, to its part; the first row of each part goes also to the part before, as a ``copy`` behind the last
    row there, which it follows. ``place`` numbers a part's rows in order. The texts of null are empty.
    """
    rows = df.select(F.col(id).alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
    total, low, high = rows.agg(F.count(F.lit(1)), F.min("_id"), F.max("_id")).first()
    parts = max(1, min(-(-total // PART_ROWS), PARTS))
    width = float(max(1, -(-(high - low + 1) // parts))) if high is not None else 1.0
    part = F.floor((F.lit(high).cast("double") - F.col("_id").cast("double")) / F.lit(width))
    rows = rows.withColumn("part", F.coalesce(part, F.lit(parts + 1)).cast("long"))
    # One row for each part that has rows: bounded by PARTS.
    heads = rows.groupBy("part").agg(F.max("_id").alias("_id")).orderBy("part").collect()
    before = [(head._id, heads[k - 1].part) for k, head in enumerate(heads)]
    moves = df.sparkSession.createDataFrame(before, f"_id {rows.schema['_id'].dataType.simpleString()}, before bigint")
    copies = rows.join(F.broadcast(moves), rows["_id"].eqNullSafe(moves["_id"])).select(rows["_id"], "_text", F.col("before").alias("part"))
    placed = rows.select("_id", "_text", "part", F.lit(False).alias("copy")).unionAll(copies.select("_id", "_text", "part", F.lit(True)))
    order = Window.partitionBy("part").orderBy("copy", F.col("_id").desc_nulls_last(), F.xxhash64("_text"), "_text")
    return placed.select(
        "part",
        F.row_number().over(order).alias("place"),
        "copy",
        F.col("_id").alias(id),
        F.col("_text").alias(text),
        F.lead("_text").over(order).alias("next_text"),
    )


def compared(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``id``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_texts, n_near)
    for each row of ``df``.

    The edited text has the last half (code points, rounded down) replaced by as many first ones of the next
    row's text in descending id, or by all of it. ``near_edited`` and ``near_next`` are the likeness of the
    fingerprint to the edited and to the next text's. ``n_texts`` rows have the same fingerprint, ``n_near`` others
    one within ``RADIUS``. Null texts are empty. A table of one row follows itself; an empty one gives no rows.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = with_next(df, id, text).withColumn("n_chars", F.length(text).cast("long"))
    edited = F.concat(F.substring(text, F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", F.when(~F.col("copy"), F.when(half > 0, edited).otherwise(F.col(text))))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["part", "place", "copy", id, "n_chars", "edited_sha256"]
    versions = F.array(F.struct(F.lit(0).alias("version"), F.col(text).alias("t")), F.struct(F.lit(1).alias("version"), F.col("edited").alias("t")))
    versions = F.filter(versions, lambda v: (v["version"] == 0) | ~F.col("copy"))
    each = rows.select(*keys, F.explode(versions).alias("v")).select(*keys, "v.version", "v.t")
    found = fingerprinted(each, [*keys, "version"], "t")
    mine, its = (F.max(F.when(F.col("version") == v, F.col("fingerprint"))) for v in (0, 1))
    found = found.groupBy(*keys).agg(mine.alias("f"), its.alias("e"))
    found = found.withColumn("next", F.lead("f").over(Window.partitionBy("part").orderBy("place"))).where(~F.col("copy"))
    found = stored(found.select(id, "n_chars", "edited_sha256", F.col("f").alias("fingerprint"), "e", "next"), "fingerprints")
    return found.join(near_counts(found), "fingerprint").select(
        id,
        "n_chars",
        "edited_sha256",
        hexadecimal(F.col("fingerprint")).alias("fingerprint"),
        hexadecimal(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("e")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
        "n_texts",
        "n_near",
    )
