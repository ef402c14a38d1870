"""Quality rules, the toxicity chain, decontamination and extraction."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardweave.llm import decontamination, html_text, quality_rules, toxicity
from shardweave.llm.queries import QUERIES, remainder, toxic_marks
from tests.llm.fixtures import SF, collected, empty_table, odd_rows, odd_table, sentence

LARGER = "/root/testdata/sf0.01"


def area(scores, truth):
    """Area under the ROC curve."""
    order = np.argsort(np.argsort(scores, kind="stable"))
    truth = np.asarray(truth, bool)
    return (order[truth].sum() - truth.sum() * (truth.sum() - 1) / 2) / (truth.sum() * (~truth).sum())


def test_quality_held_out(spark):
    found = QUERIES["op4_quality_rules"](spark, LARGER)
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    assert found.count() == docs.count()
    assert found.where("score not between 0 and 1 or predicted <> int(score >= 0.7)").count() == 0
    assert found.where(F.col("held_out") != (remainder(4) == 2)).count() == 0
    rows = found.join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").where("held_out").collect()
    assert area([r.score for r in rows], [r.quality == 1 for r in rows]) > 0.95


def test_quality_odd_rows_and_no_labels(spark):
    labels = spark.createDataFrame([(7, True), (8, None), (None, True), (99, False)], "doc_id bigint, good boolean")
    found = quality_rules.scored(odd_table(spark), labels, "good").collect()
    assert len(found) == len(odd_rows()) and all(0 <= r.score <= 1 for r in found)
    nothing = quality_rules.scored(odd_table(spark), labels.limit(0), "good").collect()
    assert {r.score for r in nothing} == {0.5}
    assert quality_rules.scored(empty_table(spark), labels, "good").count() == 0


def test_rules_from_a_tree():
    described = """Tree
  If (feature 3 <= 0.5)
   If (feature 1 <= 2.0)
    Predict: 0.0
   Else (feature 1 > 2.0)
    If (feature 3 <= 0.25)
     Predict: 1.0
    Else (feature 3 > 0.25)
     Predict: 0.0
  Else (feature 3 > 0.5)
   Predict: 1.0"""
    assert quality_rules.paths(described) == [
        ((3, "<=", 0.5),),
        ((1, "<=", 2.0), (3, "<=", 0.5)),
        ((1, ">", 2.0), (3, "<=", 0.5)),
        ((1, ">", 2.0), (3, "<=", 0.25)),
        ((1, ">", 2.0), (3, "<=", 0.5), (3, ">", 0.25)),
        ((3, ">", 0.5),),
    ]


def test_statistics_of_odd_texts():
    width = len(quality_rules.STATISTICS)
    for _, text in odd_rows():
        found = quality_rules.statistics((text or "").encode())
        assert len(found) == width and all(np.isfinite(found))


def test_toxicity_held_out(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    rows = toxic_marks(docs, docs, labels.where(remainder(4) != 2)).join(labels.where(remainder(4) == 2).select("doc_id", F.col("toxic").alias("truth")), "doc_id").collect()
    toxic = [r for r in rows if r.truth]
    assert sum(r.toxic for r in toxic) >= 0.65 * len(toxic)
    assert sum(r.toxic for r in rows if not r.truth) <= 0.02 * len(rows)


def test_toxicity_odd_rows_and_no_labels(spark):
    labels = spark.createDataFrame([(7, 1, 0), (9, 0, 1), (None, 1, 1), (6, None, 0), (99, 0, 0)], "doc_id bigint, quality int, toxic int")
    found = toxic_marks(odd_table(spark).withColumn("p_toxic", F.lit("x")), odd_table(spark), labels)
    assert found.count() == len(odd_rows())
    assert found.where("p_poor is null or p_toxic is null or p_toxic not between 0 and 1").count() == 0
    nothing = toxic_marks(odd_table(spark), odd_table(spark), labels.limit(0))
    assert {(r.p_poor, r.p_toxic) for r in nothing.collect()} == {(0.5, 0.5)}
    assert toxic_marks(empty_table(spark), empty_table(spark), labels).count() == 0


def test_toxicity_fits_on_labels_that_have_a_text(spark, monkeypatch):
    """More labels than the sample holds, of which the documents have few."""
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 50)
    rng = random.Random(4)
    texts = [(n, sentence(rng, 40) + (" vile" if n % 2 else "")) for n in range(40)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame([(n, 1 - n % 2, n % 2) for n in range(5000)], "doc_id bigint, quality int, toxic int")
    assert {(r.doc_id % 2, r.toxic) for r in toxic_marks(docs, docs, labels).collect()} == {(0, 0), (1, 1)}


def test_blocks_of_words_give_the_features_of_each_text():
    texts = [(t or "").encode() for _, t in odd_rows()]
    words, at, sizes = toxicity.word_block(iter(texts))
    owner, place, hashes = toxicity.text_pairs(at, sizes, [toxicity.features_of(w) for w in words.split()])
    for n, text in enumerate(texts):
        assert hashes[place[owner == n]].tolist() == toxicity.text_features(text).tolist()
    assert [len(a) for a in toxicity.text_pairs(np.empty(0, np.uint16), np.zeros(2, int), [])] == [0, 0, 0]


def test_toxicity_stores_less_than_the_texts(spark, monkeypatch):
    """Blocks of the labelled rows' features took several times the room of their texts."""
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 50)
    folders = []
    real = toxicity.stored
    monkeypatch.setattr(toxicity, "stored", lambda df, label: folders.append(real(df, label)) or folders[-1])
    rng = random.Random(4)
    rows = [(n, " ".join(f"{rng.choice(['', '(', '*'])}{rng.getrandbits(40):x}" for _ in range(300)) + (" vile" if n % 2 else "")) for n in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(n, 1 - n % 2, n % 2) for n in range(200)], "doc_id bigint, quality int, toxic int")
    found = toxic_marks(docs, docs, labels).collect()
    assert {(r.doc_id % 2, r.toxic) for r in found} == {(0, 0), (1, 1)}
    size = sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for df in folders for f in df.inputFiles())
    assert size < 1.5 * sum(len(t) for _, t in rows)


@pytest.mark.parametrize("kind, most", [("bigint", 1 << 26), ("string", 1 << 26), ("double", 1 << 26), ("bigint", 1 << 16)])
def test_rows_without_a_label_are_left_out_before_the_join(spark, monkeypatch, kind, most):
    monkeypatch.setattr(toxicity, "MOST_BITS", most)
    texts = spark.range(20_000).selectExpr(f"cast(id as {kind}) as _id", "'x' as _text").unionAll(spark.sql(f"select cast(null as {kind}), 'x'"))
    marked = spark.range(0, 40_000, 10).selectExpr(f"cast(id as {kind}) as _id")
    found = [r._id for r in toxicity.likely(texts, marked, marked.count()).collect()]
    assert {r._id for r in marked.where("_id < 20000").collect()} <= set(found) and len(found) == len(set(found))
    assert len(found) == 20_001 if kind == "double" else len(found) < 4000


def test_chain_uses_earlier_categories():
    """The second category is the first one's, turned round: only the chain's link can carry it."""
    rng = random.Random(2)
    texts, marks = [], []
    for _ in range(600):
        bad = rng.random() < 0.4
        texts.append((sentence(rng, 30, 60) + (" vile" if bad else "")).encode())
        marks.append([int(bad), int(not bad)])
    chain = toxicity.train([toxicity.text_features(t) for t in texts], marks)
    right = [(chain.probabilities(t) > 0.5).astype(int).tolist() == m for t, m in zip(texts, marks)]
    assert np.mean(right) > 0.97 and chain.links[1][1][0] < 0


def benchmark(rng):
    return [(n, ". ".join(sentence(rng, 14, 3000).capitalize() for _ in range(3)) + ".") for n in range(30)]


def test_leaks_found_and_clean_texts_left(spark):
    rng = random.Random(6)
    items = benchmark(rng)
    docs, wanted = [], set()
    for n in range(300):
        w = sentence(rng, rng.randrange(20, 400), 3000).split()
        if n % 5 == 0:
            item = items[n % 30][1].split()
            if n % 10 == 0:  # reworded: every seventh word replaced
                item = [x if k % 7 else f"w{rng.randrange(3000)}" for k, x in enumerate(item)]
            at = rng.randrange(len(w))
            w[at:at] = item
            wanted.add((n, n % 30))
        docs.append((n, " ".join(w)))
    docs += [(1000, None), (1001, ""), (None, docs[0][1])]
    wanted.add((None, 0))
    table = spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id bigint, text string, cosine double").repartition(3)
    reference = spark.createDataFrame([*items, (77, None), (78, " ... ")], "item_id bigint, text string")
    found = decontamination.leaks(table, reference)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == wanted
    assert decontamination.leaks(table, reference.limit(0)).count() == 0
    assert decontamination.leaks(empty_table(spark), reference).count() == 0


def test_leaks_do_not_depend_on_how_many_items_there_are(spark):
    """Copies with every sixth word replaced, in documents of other words, are found among 30 items and among 500."""
    rng = random.Random(8)
    items = [(n, sentence(rng, rng.randrange(20, 50), 6000)) for n in range(500)]
    docs = []
    for n in range(30):
        copy = [x if k % 6 else f"w{rng.randrange(6000)}" for k, x in enumerate(items[n][1].split(), 1)]
        docs.append((n, " ".join([sentence(rng, 60 + n, 6000), *copy, sentence(rng, 90, 6000)])))
    docs += [(n, sentence(rng, 300, 6000)) for n in range(30, 200)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    for some in (items[:30], items):
        found = decontamination.leaks(table, spark.createDataFrame(some, "item_id bigint, text string")).collect()
        assert {(r.doc_id, r.item_id) for r in found} == {(n, n) for n in range(30)}, len(found)


def test_leaks_of_long_and_short_items(spark):
    """Items copied word for word are found whatever their length, in a block with many others."""
    rng = random.Random(9)
    lengths = [4, 6, 8, 12, 40, 150, 300, 600, 1200]
    items = [(n, sentence(rng, lengths[n % 9], 6000)) for n in range(90)]
    others = [(n, sentence(rng, 40, 6000)) for n in range(1000, 1250)]
    docs = [(n, " ".join([sentence(rng, 60 + n, 6000), text, sentence(rng, 90, 6000)])) for n, text in items]
    docs += [(n, sentence(rng, 300, 6000)) for n in range(100, 200)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = decontamination.leaks(table, spark.createDataFrame(items + others, "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(n, n) for n in range(90)}, sorted(lengths[r.item_id % 9] for r in found)


def test_keys_of_an_item_are_in_every_find():
    rng = random.Random(10)
    for _ in range(300):
        item = decontamination.Item(1, sentence(rng, rng.randrange(1, 24), 30).encode())
        terms = {w: n for n, w in enumerate(dict.fromkeys(item.words))}
        idf = np.array([rng.random() + 0.5 for _ in terms])
        item.weigh(idf, terms, float(np.mean([idf[terms[w]] for w in item.words])))
        keys = item.keys(idf, terms)
        for _ in range(20):
            words = [w if rng.random() < 0.7 else b"other" for w in item.words]
            assert not item.shares(words) or keys & set(words)


def test_the_space_is_fitted_on_all_passages(spark, monkeypatch):
    """Also on those of long texts, and its products are those of the whole matrix."""
    rng, seen = random.Random(23), []
    rows = [(n, sentence(rng, 2 * decontamination.HALF * 12, 60)) for n in range(20)]
    real = decontamination.singular_vectors

    def spy(passages, idf):
        seen.append([(r.passage, r.weight) for r in passages.collect()])
        basis = np.random.default_rng(1).standard_normal((len(idf), 5))
        matrix = np.zeros((len(seen[0]), len(idf)))
        for n, (terms, weight) in enumerate(seen[0]):
            np.add.at(matrix[n], terms, 1.0)
            matrix[n] *= idf
            matrix[n] *= weight / max(np.sqrt(matrix[n] @ matrix[n]), 1e-12)
        image = matrix @ basis
        assert np.allclose(decontamination._product(passages, idf, basis, gram=False), matrix.T @ image, rtol=1e-4, atol=1e-4)
        assert np.allclose(decontamination._product(passages, idf, basis, gram=True), image.T @ image, rtol=1e-4, atol=1e-4)
        return real(passages, idf)

    monkeypatch.setattr(decontamination, "singular_vectors", spy)
    items = spark.createDataFrame([(1, sentence(rng, 40, 60))], "item_id bigint, text string")
    decontamination.leaks(spark.createDataFrame(rows, "doc_id bigint, text string"), items).count()
    assert len(seen[0]) == 20 * 12 + 1


def test_sums_of_runs():
    rng = np.random.default_rng(3)
    matrix, rows, value = rng.random((40, 7)), rng.integers(0, 40, 500), rng.random(500)
    starts = np.r_[0, np.sort(rng.choice(np.arange(1, 500), 90, replace=False))]
    assert np.allclose(decontamination.run_sums(matrix, rows, starts), np.add.reduceat(matrix[rows], starts, axis=0))
    assert np.allclose(decontamination.run_sums(matrix, rows, starts, value), np.add.reduceat(matrix[rows] * value[:, None], starts, axis=0))


def test_leaks_recall_against_brute_force(spark):
    """Of all pairs that the subsequence check accepts anywhere, the search finds at least nine in ten."""
    docs = {r.doc_id: decontamination.plain_words(r.text.encode()) for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    items = [decontamination.Item(r.item_id, r.text.encode()) for r in spark.read.parquet(f"{LARGER}/benchmark.parquet").collect()]
    wanted = set()
    for doc_id, words in docs.items():
        present = set(words)
        for item in items:
            if sum(w in present for w in item.words) < decontamination.WHOLE * len(item.words):
                continue
            span = len(item.words)
            for at in range(0, len(words), span):
                if decontamination.common(item.masks, span, words[at : at + 2 * span]) >= decontamination.WHOLE * span:
                    wanted.add((doc_id, item.number))
                    break
    found = {(r.doc_id, r.item_id) for r in QUERIES["op3_decontamination"](spark, LARGER).collect()}
    assert len(wanted) > 10 and len(wanted & found) >= 0.9 * len(wanted)


def test_subsequence_length():
    rng = random.Random(1)
    for _ in range(200):
        a = [b"%d" % rng.randrange(5) for _ in range(rng.randrange(1, 12))]
        b = [b"%d" % rng.randrange(6) for _ in range(rng.randrange(0, 15))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.common(decontamination.masks_of(a), len(a), b) == table[-1][-1]


ARTICLE = "<h1>Title &amp; more</h1><p>First  <b>bold</b>\n text with <a href='x'>a link</a>.</p><p>Short.</p><ul><li>one<li>two</ul>"
TEXT = "Title & more First bold text with a link. Short. one two"
JUNK = "<script>var a='<p>no</p>';</script><style>p{}</style><nav><a href=1>Home</a></nav>"


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("plain &lt;text&gt;", "plain <text>"),
        (f"<html><body>{JUNK}<article>{ARTICLE}</article><footer>f f f f</footer></body></html>", TEXT),
        (f"<body>{JUNK}<div class='post'>{ARTICLE}</div><div id='sidebar'><p>{'junk ' * 90}</p></div>", TEXT),
        (f"<body><main>{ARTICLE}</main><section class='comments'><p>{'I think so. ' * 50}</p></section>", TEXT),
        (f"<div>{ARTICLE}<div class='ad'>Buy now</div><form><p>mail</p></form><aside>notes</aside></div>", TEXT),
        (f"<body><header>Site</header><article><header><h1>Title &amp; more</h1></header>{ARTICLE[25:]}</article>", TEXT),
        (f"<div class='page has-sidebar'><div class='post'>{ARTICLE}</div></div>", TEXT),
        (f"<div class='widget-page'><article>{ARTICLE}</article></div>", TEXT),
        (f"<article>{ARTICLE}</article><div id='comments'><article class='comment'><p>{'me too ' * 60}</p></article></div>", TEXT),
        (f"<div id='header'><p>Site name</p></div><div class='c1'>{ARTICLE}</div><div class='newsletter-box'>Join</div>", TEXT),
        (f"<article>{ARTICLE}</article><div class='c2'>{'Some other dense text. ' * 3}</div>", TEXT),
        ("<p>a<p>b<br>c<!-- d --><p>e", "a b c e"),
        ("<p>a &nbsp; b</p>", "a b"),
        ("<div>" * 3000 + "deep", "deep"),
        ("<p>if a < b and c > d</p>", "if a < b and c > d"),
        ("<table><tr><td>x<td>y</table>", "x y"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_text_beside_the_largest_article():
    one, two, lead = (f"{'Some words of ' + x + ', '} and more of them. " * n for x, n in (("one", 30), ("two", 20), ("lead", 25)))
    articles = f"<article><p>{one}</p><p>{one}</p></article><article><p>{two}</p></article>"
    both = " ".join((one + one + two).split())
    links = "<ul>" + "<li><a href='/'>other story</a></li>" * 30 + "</ul>"
    for page in (f"<main>{articles}{links}</main>", f"<body><div><div>{articles}</div></div>{links}</body>"):
        assert html_text.main_text(page) == both
    page = f"<body><main><p>{lead}</p><article><p>{one}</p><p>{one}</p></article>{links}</main></body>"
    assert html_text.main_text(page) == " ".join((lead + one + one).split())


def test_density_prefers_text_to_links():
    links = "".join(f"<li><a href='/{n}'>Read this other story number {n}</a></li>" for n in range(40))
    body = "".join(f"<p>{sentence(random.Random(n), 60)}</p>" for n in range(6))
    text = html_text.main_text(f"<body><div><ul>{links}</ul></div><div>{body}</div></body>")
    assert "Read this" not in text and text.split()[:60] == sentence(random.Random(0), 60).split()


def test_pages(spark):
    found = QUERIES["op7_main_text"](spark, SF)
    assert found.count() == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert found.where("text = '' or n_chars <> length(text) or text rlike '<|  '").count() == 0
    odd = spark.createDataFrame([(1, None, "old"), (2, "", "old"), (2, "<p>x</p>", "old")], "page_id int, html string, text string")
    assert collected(html_text.extracted(odd), "page_id", "text") == [(1, ""), (2, ""), (2, "x")]
