"""Model inference with the hash teachers."""

from pyspark.sql import functions as F

from checks.augment import CHAIN, CHAIN_SQL, DRAWS, SEED
from checks.base import IMAGES, RECORDS, balanced_records, check, checksum, dirty_images, images, sql_u, written_once
from shardweave.operators import infer as inf
from shardweave.operators import records as shape
from shardweave.operators.runs import caption_run
from shardweave.operators.shards import name_shards
from shardweave.operators.teachers import HashCaption, HashClip, HashRows, HashText, TeacherSpec
from shardweave.session import scratch_path
from shardweave.sources.jsonl import read_jsonl
from shardweave.sources.paths import list_files
from shardweave.sources.sink import read_manifest, write_jsonl


def sql_bucket(word: str, dim: int) -> str:
    return f"(('0x' || substr(md5({word}), 1, 8))::BIGINT % {dim})"


@check(
    "infer",
    f"""WITH {RECORDS}, words AS (SELECT uid, unnest(string_split(lower(text), ' ')) AS word FROM records)
    SELECT uid, {sql_bucket("word", 16)} AS bucket, count(*)::BIGINT AS n FROM words GROUP BY 1, 2""",
)
def _(spark, sf):
    rows = inf.infer(
        balanced_records(spark, sf).select("uid", "text"), TeacherSpec(HashRows, {"dim": 16}), 256, "uid STRING, bucket INT, n LONG"
    )
    return rows.withColumn("bucket", F.col("bucket").cast("bigint"))


_CAPTIONS = f"""WITH {RECORDS}, samples AS (SELECT uid, unnest(range(5)) AS k, string_split(text, '.') AS parts FROM records
      WHERE lang NOT IN ('de', 'es')),
    captions AS (SELECT uid, k, regexp_replace(parts[floor({sql_u(3, "uid", "k", "'caption'")} * len(parts))::INT + 1], '\\s+$', '') AS caption
      FROM samples)
    SELECT uid, r.lang, coalesce(string_agg(caption, '|' ORDER BY k), 'null') AS captions, count(caption)::BIGINT AS n
    FROM records r LEFT JOIN captions USING (uid) GROUP BY uid, r.lang"""


@check("add_captions", _CAPTIONS)
def _(spark, sf):
    flagged = shape.flag_valid(dirty_images(spark, sf))
    c = inf.add_captions(flagged, TeacherSpec(HashCaption), 5, "_v1", seed=3)
    return c.select(
        "uid",
        "lang",
        F.coalesce(F.array_join("syn_text_v1", "|"), F.lit("null")).alias("captions"),
        F.when(F.col("syn_text_v1").isNotNull(), F.size("syn_text_v1")).otherwise(0).cast("bigint").alias("n"),
    )


@check("caption_run", _CAPTIONS)
def _(spark, sf):
    """The whole job from shards to shards; ``lang`` is not in its schema and passes through."""

    def write(out):
        r = dirty_images(spark, sf).select("uid", "text", "lang", "image", "_shard", "_pos")
        write_jsonl(name_shards(r, "count"), out)

    folder = written_once(spark, sf, "to-caption", write)
    last = read_manifest(spark, folder).agg(F.max("shard")).first()[0].removesuffix(".jsonl")
    out = scratch_path(spark, "captioned")
    source = f"{folder}/{{{0:08d}..{last}}}.jsonl"
    caption_run(spark, source, out, TeacherSpec(HashCaption), "uid STRING, image STRING", 5, "_v1", "jsonl", seed=3)
    back = read_jsonl(spark, list_files(spark, out, [".jsonl"]), "uid STRING, lang STRING, syn_text_v1 ARRAY<STRING>")
    return back.select(
        "uid",
        "lang",
        F.coalesce(F.array_join("syn_text_v1", "|"), F.lit("null")).alias("captions"),
        F.when(F.col("syn_text_v1").isNotNull(), F.size("syn_text_v1")).otherwise(0).cast("bigint").alias("n"),
    )


def _signs(dim: int, size: int) -> str:
    return f"""(SELECT j, p, CASE WHEN ('0x' || substr(md5(j || '|' || p), 1, 1))::INT % 2 = 0 THEN 1 ELSE -1 END AS s
      FROM (SELECT unnest(range({dim})) AS j), (SELECT unnest(range({size})) AS p))"""


@check(
    "add_image_embeddings",
    f"""WITH {CHAIN_SQL}, pixels AS (SELECT uid, draw, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS p FROM views)
    SELECT uid, draw::BIGINT AS draw, (base + j)::BIGINT AS j, sum(x * s)::BIGINT AS value
    FROM pixels JOIN (SELECT 0 AS base, j, p, s FROM {_signs(4, 36)} UNION ALL SELECT 4, j, p, s FROM {_signs(3, 36)}) USING (p)
    GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    teachers = [TeacherSpec(HashClip, {"dim": 4}, (6, 6)), TeacherSpec(HashClip, {"dim": 3}, (6, 6))]
    e = inf.add_image_embeddings(images(spark, sf), teachers, DRAWS, CHAIN, SEED, suffix="_v1")
    draws = e.select("uid", F.posexplode_outer("image_emb_v1").alias("draw", "vector"))
    return draws.select("uid", F.col("draw").cast("bigint").alias("draw"), F.posexplode_outer("vector").alias("j", "value")).select(
        "uid", "draw", F.col("j").cast("bigint").alias("j"), F.col("value").cast("bigint").alias("value")
    )


_TEXTS = f"""{RECORDS}, texts AS (SELECT uid, 'text' AS key, text AS t FROM records
      UNION ALL SELECT uid, 'syn_text', unnest(syn_text) FROM records),
    words AS (SELECT uid, key, unnest(string_split(lower(t), ' ')) AS word FROM texts)"""


def embedded_texts(spark, sf, teachers):
    r = balanced_records(spark, sf).withColumn("_valid", F.lit(True))
    texts = shape.collect_texts(r)
    return inf.split_text_embeddings(inf.add_text_embeddings(texts, teachers), ["text", "syn_text"])


@check(
    "add_text_embeddings",
    f"""WITH {_TEXTS} SELECT uid, key, {sql_bucket("word", 16)} AS bucket, count(*)::BIGINT AS n FROM words GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    e = embedded_texts(spark, sf, [TeacherSpec(HashText, {"dim": 16})])
    # Both keys at once, so that the teacher reads every text once.
    keyed = F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"{k}_emb").alias("vectors")) for k in ("text", "syn_text")])
    long = e.select("uid", F.explode_outer(keyed).alias("e")).select("uid", "e.key", F.explode_outer("e.vectors").alias("v"))
    each = long.select("uid", "key", F.posexplode_outer("v").alias("bucket", "n"))
    sums = each.groupBy("uid", "key", F.col("bucket").cast("bigint").alias("bucket"))
    return sums.agg(F.sum("n").cast("bigint").alias("n")).filter("n > 0")


@check(
    "ensemble",
    f"""WITH {_TEXTS}, own AS (SELECT * FROM words WHERE key = 'text')
    SELECT uid, bucket, count(*)::BIGINT AS n, 1 AS same FROM (
      SELECT uid, {sql_bucket("word", 8)} AS bucket FROM own UNION ALL SELECT uid, 8 + {sql_bucket("word", 5)} FROM own) GROUP BY 1, 2""",
)
def _(spark, sf):
    both = [TeacherSpec(HashText, {"dim": 8}), TeacherSpec(HashText, {"dim": 5})]
    r = balanced_records(spark, sf).select("uid", F.array("text").alias("texts"))
    e = r.select(
        "uid",
        inf.embed_texts(F.col("texts"), both).alias("joint"),
        inf.embed_texts(F.col("texts"), both[:1]).alias("a"),
        inf.embed_texts(F.col("texts"), both[1:]).alias("b"),
    )
    e = e.withColumn("same", inf.ensemble([F.col("a"), F.col("b")]).eqNullSafe(F.col("joint")).cast("int"))
    long = e.select("uid", "same", F.posexplode_outer(F.get("joint", F.lit(0))).alias("bucket", "n")).filter("n > 0")
    return long.select("uid", "same", F.col("bucket").cast("bigint").alias("bucket"), F.col("n").cast("bigint").alias("n"))


def _cubic(target: int, source: int) -> str:
    """(o, i, w): weights of one axis, from the cubic convolution formula."""
    d = "abs(c - (floor(c) + t))"
    return f"""(SELECT o, greatest(0, least({source - 1}, floor(c)::INT + t)) AS i,
      CASE WHEN {d} <= 1 THEN (1.25::DOUBLE * {d} - 2.25) * {d} * {d} + 1
        ELSE ((-0.75::DOUBLE * {d} + 3.75) * {d} - 6) * {d} + 3 END AS w
      FROM (SELECT o, (o + 0.5::DOUBLE) * {source} / {target} - 0.5 AS c FROM (SELECT unnest(range({target})) AS o)),
        (SELECT unnest([-1, 0, 1, 2]) AS t))"""


@check(
    "resample",
    f"""WITH {IMAGES}, pixels AS (SELECT uid, unnest(px) AS x, generate_subscripts(px, 1) - 1 AS p FROM images),
    big AS (SELECT uid, r.o * 5 + k.o AS p, sum(x * r.w * k.w)::FLOAT::DOUBLE AS y FROM pixels
      JOIN {_cubic(3, 8)} r ON r.i = p // 8 JOIN {_cubic(5, 8)} k ON k.i = p % 8 GROUP BY 1, 2)
    SELECT uid, round(sum(y * (p + 1)), 1) AS view_sum FROM big GROUP BY uid""",
)
def _(spark, sf):
    i = inf.resample(images(spark, sf), "image", (3, 5), "small")
    return i.select("uid", checksum(F.col("small"), 1).alias("view_sum"))


@check(
    "enrich_texts",
    f"""WITH {_TEXTS}, named AS (SELECT uid, lpad((dense_rank() OVER (ORDER BY _shard) - 1)::VARCHAR, 8, '0') AS shard FROM records),
    sums AS (SELECT shard, {sql_bucket("word", 16)} AS bucket, count(*) AS n FROM words JOIN named USING (uid)
      GROUP BY 1, 2)
    SELECT shard, (SELECT count(*) FROM named m WHERE m.shard = s.shard)::BIGINT AS num_uids,
      sum(n)::BIGINT AS words, sum(n * (bucket + 1))::BIGINT AS weighted FROM sums s GROUP BY shard""",
)
def _(spark, sf):
    """Flagship: collect texts, embed them, name the output shards, sum up per shard."""
    r = name_shards(balanced_records(spark, sf).withColumn("_valid", F.lit(True)), "count", "jsonl")
    e = inf.add_text_embeddings(shape.collect_texts(r), [TeacherSpec(HashText, {"dim": 16})])
    flat = F.flatten("_text_emb")
    weights = F.transform(F.flatten(F.transform("_text_emb", lambda v: F.transform(v, lambda x, i: i + 1))), lambda i: i.cast("double"))
    counted = e.select(
        F.substring_index("_out", ".", 1).alias("shard"),
        F.aggregate(flat, F.lit(0.0), lambda a, x: a + x.cast("double")).alias("words"),
        F.aggregate(F.zip_with(flat, weights, lambda x, w: x.cast("double") * w), F.lit(0.0), lambda a, x: a + x).alias("weighted"),
    )
    return counted.groupBy("shard").agg(
        F.count(F.lit(1)).alias("num_uids"),
        F.sum("words").cast("bigint").alias("words"),
        F.sum("weighted").cast("bigint").alias("weighted"),
    )

