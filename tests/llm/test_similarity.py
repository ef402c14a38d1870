"""The Jaccard join, its components, and fingerprints against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shardweave.llm import fingerprints, similarity_join
from shardweave.llm.components import components
from shardweave.llm.queries import QUERIES
from tests.llm.fixtures import LOWER, SF, collected, empty_table, odd_rows, odd_table, sentence


def joined(rows, shingle, num):
    """(id, size, component, links) of every row."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().translate(LOWER).split()
        sets.append({tuple(w[k : k + shingle]) for k in range(max(len(w) - shingle, 0) + 1)} if w else set())
    parent, links = list(range(len(rows))), Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = defaultdict(list)
    for i, mine in enumerate(sets):
        met = Counter(j for s in mine for j in inverted[s])
        for j, both in met.items():
            if 100 * both >= num * (len(mine) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
        for s in mine:
            inverted[s].append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        root = find(i)
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    return sorted(((d, len(sets[i]), least.get(find(i)), links[i]) for i, (d, _) in enumerate(rows)), key=repr)


NAMES = ("doc_id", "n_shingles", "component_id", "n_links")


@pytest.mark.parametrize("shingle, num", [(3, 90), (5, 80)])
def test_join_odd_rows(spark, shingle, num):
    found = similarity_join.joined(odd_table(spark), shingle=shingle, num=num)
    assert collected(found, *NAMES) == joined(odd_rows(), shingle, num)


def near_copies():
    """Families whose members differ from each other by more and less than the threshold, with a frequent passage."""
    rng, rows = random.Random(11), []
    passage = sentence(rng, 15)
    for family in range(6):
        base = sentence(rng, 80 + 20 * family, 5000).split()
        for _ in range(40):
            copy = list(base)
            for _ in range(rng.randrange(12)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy) + (" " + passage if family % 2 else "")))
    rows += [(len(rows) + k, sentence(rng, 10) + " " + passage) for k in range(60)]
    return rows


@pytest.mark.parametrize("frequent, elements", [(24, 1_000_000), (2, 500)])
def test_join_families(spark, monkeypatch, frequent, elements):
    """With clusters in one block, and cut into many."""
    monkeypatch.setattr(similarity_join, "FREQUENT", frequent)
    monkeypatch.setattr(similarity_join, "UNIT_ELEMENTS", elements)
    rows = near_copies()
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = similarity_join.joined(table, shingle=3, num=80)
    assert collected(found, *NAMES) == joined(rows, 3, 80)


def test_join_empty(spark):
    assert similarity_join.joined(empty_table(spark)).count() == 0


def test_join_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert collected(QUERIES["op8_similarity_join"](spark, SF), *NAMES) == joined(rows, 3, 90)


def test_prefixes_lose_no_link():
    rule = similarity_join.Rule(3, 90, 100)
    for a in range(9, 60):
        for b in range(a, 70):
            overlap = rule.overlap(a, b)
            if overlap <= a:  # a link is possible: then both prefixes reach the shared elements that are asked for
                assert rule.prefix(a) >= a - overlap + rule.shared and rule.prefix(b) >= b - overlap + rule.shared
    with pytest.raises(ValueError):
        similarity_join.Rule(3, 100, 100)


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, 501), (501, 502), (700, 700)]
    random.Random(1).shuffle(edges)
    found = dict(components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert found == {k: 0 for k in range(201)} | {500: 500, 501: 500, 502: 500}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def edited(rows):
    """(id, n_chars, digest of the edited text) with ids descending, nulls last."""
    order = sorted(rows, key=lambda r: -r[0])
    out = []
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("part_rows", [2000, 3])
def test_fingerprints_of_edited_texts(spark, monkeypatch, part_rows):
    monkeypatch.setattr(fingerprints, "PART_ROWS", part_rows)
    rows = list({i: (i, t) for i, t in odd_rows() if i is not None}.values()) + [(10**9, "far away"), (-5, "é🙂" * 9)]
    found = fingerprints.compared(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert collected(found, "doc_id", "n_chars", "edited_sha256") == edited(rows)
    assert found.where("near_edited not between 0 and 1 or near_next not between 0 and 1").count() == 0
    blank = found.where("doc_id in (1, 2, 3)").select("fingerprint").distinct().collect()
    assert [r.fingerprint for r in blank] == ["0" * 16]


def test_fingerprints_odd_rows(spark):
    found = fingerprints.compared(odd_table(spark))
    assert found.count() == len(odd_rows())
    by_text = defaultdict(set)
    texts = odd_table(spark).select("doc_id", "text").where("doc_id is not null").dropDuplicates()
    for row in found.join(texts, "doc_id").collect():
        by_text[(row.text or "").lower().strip()].add(row.fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())
    assert fingerprints.compared(empty_table(spark)).count() == 0
    one = fingerprints.compared(spark.createDataFrame([(3, "ab cd")], "doc_id bigint, text string")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"ab ab").hexdigest()


@pytest.mark.parametrize("radius, blocks", [(3, 6), (2, 4), (5, 7)])
def test_near_pairs_against_all(spark, radius, blocks):
    rng = random.Random(radius)
    values = set()
    for _ in range(30):
        base = rng.getrandbits(64)
        for _ in range(12):
            x = base
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            values.add(x - (1 << 64) if x >> 63 else x)
    table = spark.createDataFrame([(v,) for v in [*values, *list(values)[:20], None]], "fingerprint bigint")
    found = [tuple(r) for r in fingerprints.near_pairs(table, radius, blocks).collect()]
    wanted = {(a, b) for a in values for b in values if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= radius}
    assert len(found) == len(set(found)) and set(found) == wanted


def test_votes_of_terms(spark):
    """A fingerprint has the bits that most of the terms' hashes have."""
    table = spark.createDataFrame([(1, "a b c a b c d"), (2, "z")], "doc_id bigint, text string")
    terms = table.select("doc_id", F.explode(fingerprints.terms(F.col("text"))).alias("t")).select("doc_id", F.xxhash64("t.w0", "t.w1", "t.w2").alias("h"))
    votes = defaultdict(list)
    for row in terms.collect():
        votes[row.doc_id].append(row.h & (2**64 - 1))
    for row in fingerprints.fingerprinted(table, ["doc_id"], "text").collect():
        hashes = votes[row.doc_id]
        wanted = sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))
        assert row.fingerprint & (2**64 - 1) == wanted


def test_fingerprint_query_is_native(spark):
    frame = QUERIES["op1_simhash"](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and frame.count() == 200


def test_rows_of_a_passage_that_fills_many_texts_grow_with_their_number(spark):
    """Texts that are mostly one passage meet in its lists without being copies; their pairs are compared in their
    cluster and no row is sent for each."""
    rng, rule = random.Random(17), similarity_join.Rule(3, 90, 100)
    passage, met = sentence(rng, 60), []
    texts = [(n, f"{sentence(rng, 4 + n % 7, 100_000)} {passage} {sentence(rng, 4, 100_000)}") for n in range(320)]
    for size in (160, 320):
        docs = spark.createDataFrame(texts[:size], "id bigint, text string").withColumn("text_hash", F.xxhash64("text"))
        table, entries, frequent = similarity_join._prefixes(docs, rule)
        lists = similarity_join._lists(table, 4, similarity_join.LONG * frequent)
        clusters = similarity_join._clusters(lists)
        met.append(similarity_join._met(lists, clusters, rule, 4).count())
        assert met[-1] <= entries
    assert met[1] <= 3 * met[0]
    rows = texts[:320]
    found = similarity_join.joined(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle=3, num=90)
    assert collected(found, *NAMES) == joined(rows, 3, 90)
