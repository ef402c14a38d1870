"""One query per operator over the whole of its table, and the SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardweave.llm import byte_bpe, decontamination, fill_middle, fingerprints, html_text, language_model, line_dedup, quality_rules, similarity_join, substring_dedup, token_alignment, token_counts, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Parameters of the tokenizers; any other file of the same kind may be named instead.
BPE_RANKS, BPE_PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
# The probability from which a document is toxic: below one half, for a toxic one kept is the worse mistake.
TOXIC_FROM = 0.35
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


def remainder(n: int) -> Column:
    """crc32 of doc_id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string")) % n


@query
def op1_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how near they are."""
    return fingerprints.compared(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces and best score of every document under the piece vocabulary."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return token_counts.counted(docs, PIECES).select("doc_id", "n_tokens", "best_score")


@query
def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Every document in which an item of the benchmark is found, with the item."""
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    return decontamination.leaks(docs.select("doc_id", "text"), items.select("item_id", "text"))


@query
def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of every document, learned from labelled rows whose remainder is not 2."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").where(remainder(4) != 2).select("doc_id", (F.col("quality") == 1).alias("good"))
    scores = quality_rules.scored(docs, labels, "good")
    held_out = F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out")
    return scores.select("doc_id", held_out, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op5_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document and the bytes decoded from them, as digests."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bpe_digests(docs)


def bpe_digests(docs: DataFrame) -> DataFrame:
    tokenizer = byte_bpe.Tokenizer(docs.sparkSession, BPE_RANKS, BPE_PATTERN)
    return byte_bpe.encoded(docs, tokenizer).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the words of 20-word windows that start earlier elsewhere."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    kept = F.sha2("kept_text", 256).alias("kept_sha256")
    return substring_dedup.deduplicated(docs).select("doc_id", "n_words", "n_removed", kept)


@query
def op7_main_text(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return html_text.extracted(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op8_similarity_join(spark: SparkSession, sf: str) -> DataFrame:
    """Classes and link counts of all documents at a Jaccard similarity of 0.9 on 3-word shingles."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = similarity_join.joined(docs, shingle=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


@query
def op9_language_model(spark: SparkSession, sf: str) -> DataFrame:
    """Log10 probability of every document, learned from those whose remainder is not 2."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", F.coalesce(remainder(7) == 2, F.lit(False)))
    columns = "doc_id held_out n_tokens n_known train_tokens base_score score".split()
    return language_model.scored(docs, ~F.col("held_out")).select(*columns)


@query
def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Probabilities of poor quality and, given that, of toxicity for every document."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return toxic_marks(docs, docs, table(spark, sf, "labels")).drop("text")


@query
def op11_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the lines that a document of smaller id holds too."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    index = line_dedup.LineIndex(spark)
    index.insert(docs)
    kept = F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256")
    return index.kept(docs).select("doc_id", "n_lines", "n_dropped", kept)


ORACLES["op11_line_dedup"] = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line),
owned AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT k.*, coalesce(o.owner < k.doc_id, false) AS goes FROM keyed k LEFT JOIN owned o ON o.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT goes), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op12_fill_middle(spark: SparkSession, sf: str) -> DataFrame:
    """Every document rearranged for filling in the middle, and put back."""
    made = fill_middle.restored(fill_middle.transformed(table(spark, sf, "documents").select("doc_id", "text")))
    digests = [F.sha2(F.encode(name, "UTF-8"), 256).alias(f"{name}_sha256") for name in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLES["op12_fill_middle"] = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || doc_id) AS h
  FROM documents),
drawn AS (
  SELECT *, len(units) AS n,
         ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS h1, ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS h2,
         ('0x' || h[17:24])::BIGINT % 100 AS h3, ('0x' || h[25:32])::BIGINT % 100 AS h4
  FROM cut),
formed AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
                 WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[1:least(h1, h2)], '') AS prefix,
         array_to_string(units[least(h1, h2) + 1:greatest(h1, h2)], '') AS middle,
         array_to_string(units[greatest(h1, h2) + 1:], '') AS suffix
  FROM drawn)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM formed
"""


@query
def op13_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document by two tokenizers, aligned, with how usual the aligned pairs are."""
    models = token_alignment.Models(spark, BYTE_LEVEL, PIECES)
    found = token_alignment.aligned(table(spark, sf, "documents").select("doc_id", "text"), models, digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def toxic_marks(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``p_poor``, ``p_toxic`` and the decision ``toxic``; fitted on the texts of ``labelled``.

    Where no label has a text nothing is known, and nothing is called toxic."""
    categories = {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    chain = toxicity.fitted(labelled, labels, categories)
    marked = toxicity.probabilities(docs, chain, list(categories))
    return marked.withColumn("toxic", ((F.col("p_toxic") >= TOXIC_FROM) & F.lit(chain.learned)).cast("int"))
