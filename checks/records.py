"""Record shaping and scalar functions."""

from pyspark.sql import functions as F

from checks.base import RECORDS, check, checksum, dirty_images, records, sql_checksum, table
from shardweave.functions import tensor as px
from shardweave.functions import text as tx
from shardweave.operators import records as shape

_DIRTY = f"""{RECORDS}, dirty AS (
  SELECT *, CASE WHEN lang = 'de' THEN '@@@' WHEN lang = 'es' THEN '' ELSE base64(encode(text)) END AS image,
    CASE WHEN lang = 'de' THEN 'undecodable' WHEN lang = 'es' THEN 'empty' ELSE NULL END AS reason
  FROM records)"""


@check(
    "select_keys",
    f"""WITH {RECORDS} SELECT uid, text, list_aggregate(syn_text, 'string_agg', '|') AS syn_text,
    'syn_text=' || len(syn_text) || ',text=' || length(text) AS kept FROM records""",
)
def _(spark, sf):
    r = records(spark, sf)
    columns = shape.select_keys(r, "uid|text|syn_text").select("uid", "text", F.array_join("syn_text", "|").alias("syn_text"))
    as_map = r.select(
        "uid",
        F.create_map(
            F.lit("syn_text"), F.size("syn_text").cast("string"),
            F.lit("text"), F.length("text").cast("string"),
            F.lit("has_text"), F.col("lang"),
        ).alias("keys"),
    )
    kept = shape.select_keys(as_map, "syn_|text", "keys").select(
        "uid", F.array_join(F.transform(F.map_entries("keys"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("kept")
    )
    return columns.join(kept, "uid")


@check(
    "rename_keys",
    f"""WITH {RECORDS} SELECT uid, text AS caption, lang AS language, 'lang=' || lang || ',origin=' || source AS keys
    FROM records""",
)
def _(spark, sf):
    r = records(spark, sf).withColumn(
        "keys", F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    )
    renamed = shape.rename_keys(r, {"text": "caption", "lang": "language"})
    renamed = shape.rename_keys(renamed, {"source": "origin"}, "keys")
    entries = F.transform(F.map_entries("keys"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return renamed.select("uid", "caption", "language", F.array_join(entries, ",").alias("keys"))


@check(
    "image_bytes",
    f"""WITH {_DIRTY} SELECT uid, CASE WHEN lang = 'de' THEN -1 WHEN lang = 'es' THEN 0 ELSE strlen(text) END::BIGINT AS n,
    CASE WHEN lang = 'de' THEN 'null' WHEN lang = 'es' THEN md5('') ELSE md5(text) END AS digest FROM dirty""",
)
def _(spark, sf):
    d = dirty_images(spark, sf).withColumn("b", tx.image_bytes(F.col("image"), "string"))
    return d.select("uid", F.coalesce(F.octet_length("b").cast("bigint"), F.lit(-1).cast("bigint")).alias("n"), F.coalesce(F.md5("b"), F.lit("null")).alias("digest"))


@check(
    "flag_valid",
    f"WITH {_DIRTY} SELECT uid, (reason IS NULL)::INT AS valid, coalesce(reason, 'null') AS reason FROM dirty",
)
def _(spark, sf):
    flagged = shape.flag_valid(dirty_images(spark, sf))
    return flagged.select("uid", F.col("_valid").cast("int").alias("valid"), F.coalesce("_reason", F.lit("null")).alias("reason"))


# French records carry a caption instead of a text, German ones both (a conflict), Spanish ones a
# caption that equals their texts.
_CAPTIONED = f"""{RECORDS}, captioned AS (
  SELECT uid, lang,
    CASE WHEN lang IN ('fr', 'es') THEN NULL ELSE text END AS text,
    CASE WHEN lang IN ('fr', 'de', 'es') THEN source || ' ' || lang END AS caption,
    CASE WHEN lang = 'es' THEN [source || ' ' || lang] END AS texts
  FROM records)"""


def captioned(spark, sf):
    about = F.concat_ws(" ", "source", "lang")
    return records(spark, sf).select(
        "uid",
        "lang",
        F.when(~F.col("lang").isin("fr", "es"), F.col("text")).alias("text"),
        F.when(F.col("lang").isin("fr", "de", "es"), about).alias("caption"),
        F.when(F.col("lang") == "es", F.array(about)).alias("texts"),
    )


@check(
    "unify_text",
    f"""WITH {_CAPTIONED} SELECT uid, (lang <> 'de')::INT AS valid,
      CASE WHEN lang IN ('fr', 'es') THEN caption ELSE text END AS text,
      'null' AS texts FROM captioned""",
)
def _(spark, sf):
    unified = shape.unify_text(captioned(spark, sf))
    return unified.select(
        "uid", F.col("_valid").cast("int").alias("valid"), "text", F.coalesce(F.to_json("texts"), F.lit("null")).alias("texts")
    )


@check(
    "collect_texts",
    f"""WITH {RECORDS} SELECT uid, md5(array_to_string(list_concat([text], [source, lang], syn_text), '|')) AS digest,
    'text:1,texts:2,syn_text:' || len(syn_text) AS lengths FROM records""",
)
def _(spark, sf):
    r = records(spark, sf).withColumn("texts", F.array("source", "lang"))
    r = r.select("uid", "text", "texts", "syn_text")
    c = shape.collect_texts(r)
    entries = F.transform("_text_lengths", lambda e: F.concat_ws(":", e["key"], e["len"].cast("string")))
    return c.select("uid", F.md5(F.array_join("_texts", "|")).alias("digest"), F.array_join(entries, ",").alias("lengths"))


@check(
    "match_syn_keys",
    f"""WITH {RECORDS} SELECT uid, len(syn_text)::BIGINT AS n_syn, 'syn_text,syn_text_b' AS keys FROM records""",
)
def _(spark, sf):
    r = records(spark, sf).withColumn("syn_text_b", F.array("lang")).withColumn("old_syn_text", F.array("lang"))
    keys = shape.match_syn_keys(r, "syn_text")
    exact = shape.match_syn_keys(r, "^syn_text$")
    return r.select(
        "uid", F.size(exact[0]).cast("bigint").alias("n_syn"), F.lit(",".join(keys)).alias("keys")
    )


@check(
    "clean_caption",
    f"""WITH {RECORDS}, raw AS (
      SELECT uid, source || '<start_of_text>' || lang || '<start_of_text>' || text || ' \t<end_of_text>' || lang AS raw
      FROM records)
    SELECT uid, regexp_replace(split_part(string_split(split_part(raw, '<end_of_text>', 1), '<start_of_text>')[-1],
      '.', 1), '\\s+$', '') AS caption FROM raw""",
)
def _(spark, sf):
    raw = F.concat(
        F.col("source"), F.lit(tx.START_MARK), F.col("lang"), F.lit(tx.START_MARK), F.col("text"),
        F.lit(" \t" + tx.END_MARK), F.col("lang"),
    )
    return records(spark, sf).select("uid", tx.clean_caption(raw).alias("caption"))


@check(
    "attach_column",
    f"""WITH {_DIRTY} SELECT uid, CASE WHEN reason IS NULL THEN len(syn_text) ELSE -1 END::BIGINT AS n_attached,
    md5(text) AS text_digest FROM dirty""",
)
def _(spark, sf):
    flagged = shape.flag_valid(dirty_images(spark, sf))
    attached = shape.attach_column(flagged, "syn_text", F.col("syn_text"), "_v2")
    n = F.when(F.col("syn_text_v2").isNotNull(), F.size("syn_text_v2")).otherwise(-1).cast("bigint")
    return attached.select("uid", n.alias("n_attached"), F.md5("text").alias("text_digest"))


@check(
    "to_members",
    f"""WITH {RECORDS}, members AS (
      SELECT uid AS key, 'txt' AS ext, text AS content FROM records
      UNION ALL SELECT uid, 'jpg', text FROM records WHERE lang <> 'de'
      UNION ALL SELECT uid, 'url.txt', 'http://' || source FROM records
      UNION ALL SELECT uid, 'syn.json', to_json({{'syn_text': syn_text}})::VARCHAR FROM records
      UNION ALL SELECT uid, 'json', CASE WHEN lang = 'de' THEN to_json({{'lang': lang, 'n_chars': n_chars, 'image': '@@@'}})
        ELSE to_json({{'lang': lang, 'n_chars': n_chars}}) END::VARCHAR FROM records)
    SELECT key, ext, strlen(content)::BIGINT AS bytes, md5(content) AS digest FROM members""",
)
def _(spark, sf):
    r = records(spark, sf).select(
        "uid",
        F.concat(F.lit("http://"), "source").alias("url"),
        F.when(F.col("lang") == "de", "@@@").otherwise(tx.base64_text(F.encode("text", "UTF-8"))).alias("image"),
        F.lit("unused").alias("caption"),
        "text",
        "syn_text",
        "lang",
        "n_chars",
    )
    m = shape.to_members(r).select(F.col("_key").alias("key"), F.explode_outer("_members").alias("ext", "content"))
    return m.select("key", "ext", F.octet_length("content").cast("bigint").alias("bytes"), F.md5("content").alias("digest"))


@check(
    "normalise_emb_names",
    "SELECT vec_id, label, len(embedding)::BIGINT AS image_emb, label + 1 AS emb_text FROM embeddings",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings").select(
        "vec_id", "label", F.size("embedding").cast("bigint").alias("image_embedding"), (F.col("label") + 1).alias("emb_text")
    )
    return shape.normalise_emb_names(e)


@check(
    "record_id",
    f"""WITH {RECORDS} SELECT n_chars, source, CASE WHEN lang = 'en' THEN uid WHEN lang = 'fr' THEN 'id-' || uid
      ELSE md5(to_json({{'n_chars': n_chars, 'source': source}})) END AS uid FROM records""",
)
def _(spark, sf):
    r = records(spark, sf).select(
        F.when(F.col("lang") == "en", F.col("uid")).alias("uid"),
        F.when(F.col("lang") == "fr", F.concat(F.lit("id-"), "uid")).alias("id"),
        "n_chars",
        "source",
    )
    return shape.record_id(r).select("uid", "n_chars", "source")


@check(
    "to_rgb",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS px FROM embeddings)
    SELECT vec_id, """
    + sql_checksum("list_transform(range(48), lambda i: px[(i // 3) * 4 + i % 3 + 1])", 4)
    + " AS rgba_sum, "
    + sql_checksum("list_transform(range(192), lambda i: px[i // 3 + 1])", 4)
    + " AS grey_sum FROM v",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    rgba, grey = px.tensor(F.col("embedding"), 4, 4, 4), px.tensor(F.col("embedding"), 8, 8, 1)
    return e.select(
        "vec_id", checksum(px.to_rgb(rgba), 4).alias("rgba_sum"), checksum(px.to_rgb(grey), 4).alias("grey_sum")
    )

