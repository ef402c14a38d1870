"""The pipeline on the smallest tables, and on odd rows."""

import os

import corpus_pipeline
from tests.llm.fixtures import SF, odd_rows


def test_stages_filter_and_keep_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, SF)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == corpus_pipeline.COLUMNS
        path = str(tmp_path / name)
        result.write.parquet(path)
        docs = spark.read.parquet(path)
        assert 0.6 * before <= docs.count() <= before
        before = docs.count()
    assert corpus_pipeline.run(spark, SF).count() == before


def test_toxicity_stage_without_matching_labels(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, some in (("empty", labels.limit(0)), ("unmatched", labels.withColumn("doc_id", -1 - labels["doc_id"]))):
        some.write.parquet(str(tmp_path / name / "labels.parquet"))
        assert corpus_pipeline.toxicity(spark, docs, str(tmp_path / name)).count() == docs.count()


def test_stages_on_odd_and_empty_rows(spark, tmp_path):
    rows = [(i, t, "en", None, None if t is None else len(t), "extra") for i, t in odd_rows()]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id string"
    for label, docs in (("odd", spark.createDataFrame(rows, schema)), ("empty", spark.createDataFrame([], schema))):
        for name, stage in corpus_pipeline.STAGES:
            path = os.path.join(tmp_path, f"{label}-{name}")
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
            if label == "odd" and name == "near_duplicates":
                kept = sorted(r.doc_id for r in docs.collect() if r.doc_id is not None)
                assert kept == [1, 2, 3, 4, 5, 6, 7, 11, 12, 13, 14, 15, 16, 17]
        assert (docs.count() > 10) == (label == "odd")
