"""Bounded samples of labelled rows: taken among the documents at hand, whatever else is labelled."""

import random

from pyspark.sql import functions as F

from shardweave.llm import quality_rules, toxicity
from shardweave.llm.queries import toxic_marks


def documents(spark, n=200):
    rng = random.Random(7)
    good = "A calm sentence with several plain words, which ends here. "
    rows = [(i, (good * rng.randint(3, 9)) if i % 2 else "!!! BUY $$$ 99 " * rng.randint(3, 30)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def labels(spark, n):
    return spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 2 == 1).alias("good"))


def test_labels_of_other_documents_do_not_crowd_out(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "SAMPLE_ROWS", 50)
    docs = documents(spark)
    scores = {r.doc_id: r.score for r in quality_rules.scored(docs, labels(spark, 5000), "good").collect()}
    assert sum((scores[i] >= 0.5) == (i % 2 == 1) for i in range(200)) >= 190


def test_a_repeated_id_stays_within_the_bound(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "SAMPLE_ROWS", 60)
    docs = documents(spark)
    many = docs.unionAll(docs.where("doc_id = 3").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(2000)))).drop("k"))
    seen, real = [], quality_rules.fitted
    monkeypatch.setattr(quality_rules, "fitted", lambda rows: seen.append(rows.count()) or real(rows))
    assert quality_rules.scored(many, labels(spark, 200), "good").count() == 2200 and seen[0] <= 60
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 60)
    marks = labels(spark, 200).select("doc_id", F.lit(1).alias("quality"), F.col("good").cast("int").alias("toxic"))
    found = toxic_marks(many, many, marks)
    assert found.count() == 2200


def test_the_chain_is_fitted_on_all_labels(spark, monkeypatch):
    """More labels than one task takes: a word that only few texts have is learned wherever they are, and the model is
    that of one task over all rows, but for its folds."""
    rng = random.Random(5)
    texts = [(i, " ".join(rng.choice(["plain", "calm", "word", "text", "line"]) for _ in range(12)) + (" vile" if i % 40 == 7 else "")) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, 1 - i % 2, int(i % 40 == 7)) for i in range(400)], "doc_id bigint, quality int, toxic int")
    categories = {"toxic": F.col("toxic") == 1}
    whole = toxicity.fitted(docs, marks, categories)
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 12)
    jobs = toxicity.fitted(docs, marks, categories)
    assert jobs.hashes.tolist() == whole.hashes.tolist() and len(whole.hashes)
    assert abs(jobs.weights - whole.weights).max() < 1e-9 and abs(jobs.links[0][2] - whole.links[0][2]) < 1e-9
    assert all((jobs.probabilities(text.encode())[0] > 0.5) == (i % 40 == 7) for i, text in texts)
