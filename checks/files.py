"""Reading and writing shards: paths, formats, round trips, names, manifests."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from checks.base import RECORDS, balanced_records, check, list_sum, records, table, written_anew, written_once
from shardweave.functions import text as tx
from shardweave.operators import shards as sh
from shardweave.operators.records import unwrap_features
from shardweave.session import delete_folder, scratch_path
from shardweave.sources import jsonl, paths, tar, tfrecord
from shardweave.sources.shards import read_shards
from shardweave.sources.sink import write_chunks, write_jsonl, write_tar_samples

RECORD = "uid STRING, text STRING, lang STRING, n_chars BIGINT, syn_text ARRAY<STRING>"
STORED = ["uid", "text", "lang", "n_chars", "syn_text"]


def stored(df):
    return df.select(*STORED, "_shard", "_pos")


def digests(df):
    """Contents of read records, and their order within the input shard."""
    return df.select(
        "uid",
        F.md5("text").alias("text_digest"),
        "lang",
        "n_chars",
        F.md5(F.array_join("syn_text", "|")).alias("syn_digest"),
    )


_DIGESTS = f"""WITH {RECORDS} SELECT uid, md5(text) AS text_digest, lang, n_chars,
    md5(array_to_string(syn_text, '|')) AS syn_digest FROM records"""


def jsonl_writer(spark, sf):
    return lambda out: write_jsonl(sh.name_shards(stored(balanced_records(spark, sf)), "orig"), out)


def tar_writer(spark, sf):
    return lambda out: write_tar_samples(sh.name_shards(stored(balanced_records(spark, sf)), "count", "tar"), out)


def jsonl_folder(spark, sf):
    return written_once(spark, sf, "jsonl", jsonl_writer(spark, sf))


def tar_folder(spark, sf):
    return written_once(spark, sf, "tar", tar_writer(spark, sf))


@check("write_jsonl", _DIGESTS)
def _(spark, sf):
    return digests(jsonl.read_jsonl(spark, [written_anew(spark, "jsonl", jsonl_writer(spark, sf))], RECORD))


@check("write_tar_samples", _DIGESTS)
def _(spark, sf):
    files = paths.list_files(spark, written_anew(spark, "tar", tar_writer(spark, sf)), [".tar"])
    return digests(tar.read_tar_samples(spark, files, RECORD))


def third(files):
    """Range size that cuts an average file in about three."""
    return int(files.agg(F.avg("bytes") / 3).first()[0])


@check(
    "read_tar_samples",
    f"""WITH {RECORDS}, numbered AS (SELECT *, lpad((dense_rank() OVER (ORDER BY _shard) - 1)::VARCHAR, 8, '0') || '.tar' AS shard,
      row_number() OVER (PARTITION BY _shard ORDER BY _pos) AS place FROM records)
    SELECT uid, shard, place::BIGINT AS place, md5(text) AS text_digest, len(syn_text)::BIGINT AS n_syn FROM numbered""",
)
def _(spark, sf):
    """Order within the shard, with shards split into ranges that different tasks read."""
    from pyspark.sql import Window

    files = paths.list_files(spark, tar_folder(spark, sf), [".tar"])
    samples = tar.read_tar_samples(spark, files, split_bytes=third(files))
    place = F.row_number().over(Window.partitionBy("_shard").orderBy("_pos"))
    keys = F.from_json("json", "syn_text ARRAY<STRING>")
    return samples.select(
        "uid",
        tx.basename(F.col("_shard")).alias("shard"),
        place.cast("bigint").alias("place"),
        F.md5("text").alias("text_digest"),
        F.size(keys["syn_text"]).cast("bigint").alias("n_syn"),
    )


def raw_lines(spark, sf):
    """Records as lines; German ones are no JSON, Spanish ones no object."""
    line = (
        F.when(F.col("lang") == "de", F.lit("not json"))
        .when(F.col("lang") == "es", F.lit("[1]"))
        .otherwise(F.to_json(F.struct(*STORED)))
    )
    return balanced_records(spark, sf).select(line.alias("value"), "lang", "_shard", "_pos")


def raw_folder(spark, sf):
    def write(out):
        lines = raw_lines(spark, sf).withColumn("_out", F.col("_shard"))
        write_chunks(lines, F.encode(F.concat("value", F.lit("\n")), "UTF-8"), out, "raw")

    return written_once(spark, sf, "raw", write)


def raw_gzip_folder(spark, sf):
    def write(out):
        raw_lines(spark, sf).select("value").write.option("compression", "gzip").text(out)

    return written_once(spark, sf, "raw-gzip", write)


@check(
    "read_jsonl",
    f"""WITH {RECORDS}, good AS (SELECT * FROM records WHERE lang NOT IN ('de', 'es'))
    SELECT codec, uid, md5(text) AS text_digest, n_chars, len(syn_text)::BIGINT AS n_syn, -1::BIGINT AS lang
    FROM good, (SELECT unnest(['plain', 'gzip']) AS codec)""",
)
def _(spark, sf):
    # lang is read as a number on purpose: the value does not fit, the record stays.
    schema = "uid STRING, text STRING, n_chars BIGINT, syn_text ARRAY<STRING>, lang BIGINT"
    parts = [
        jsonl.read_jsonl(spark, [folder], schema).withColumn("codec", F.lit(codec))
        for codec, folder in (("plain", raw_folder(spark, sf)), ("gzip", raw_gzip_folder(spark, sf)))
    ]
    return parts[0].unionByName(parts[1]).select(
        "codec", "uid", F.md5("text").alias("text_digest"), "n_chars", F.size("syn_text").cast("bigint").alias("n_syn"),
        F.coalesce("lang", F.lit(-1).cast("bigint")).alias("lang"),
    )


@check(
    "read_jsonl_rejects",
    f"""WITH {RECORDS} SELECT _shard AS shard, count(*) FILTER (lang IN ('de', 'es'))::BIGINT AS rejected FROM records GROUP BY 1""",
)
def _(spark, sf):
    rejects = jsonl.read_jsonl_rejects(spark, [raw_folder(spark, sf)])
    return rejects.select(tx.basename(F.col("_shard")).alias("shard"), "rejected")


def manifest_file(spark, sf):
    def write(out):
        manifest = sh.shard_manifest(records(spark, sf).withColumn("_out", F.col("_shard")))
        sh.write_info_manifest(manifest, out, "data/set")
        sh.write_manifest(manifest, out)

    return written_once(spark, sf, "manifest", write)


@check("shards_from_manifest", f"WITH {RECORDS} SELECT DISTINCT 'data/set/' || _shard AS path FROM records")
def _(spark, sf):
    return paths.shards_from_manifest(spark, f"{manifest_file(spark, sf)}/info.json")


# One pattern per source and language, with as many shards as there are documents.
@check(
    "shards_from_pattern",
    """WITH n AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL),
    i AS (SELECT source, lang, unnest(range(n)) AS i FROM n)
    SELECT source || '/' || lang || '-' || lpad((i + 95)::VARCHAR, 6, '0') || '.' || ext AS path FROM i, (SELECT unnest(['tar', 'jsonl']) AS ext)
    UNION ALL SELECT source || '-' || (i + 8) FROM i""",
)
def _(spark, sf):
    n = table(spark, sf, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    pattern = F.concat(
        F.format_string("%s/%s-{%06d..%06d}.{tar,jsonl}", "source", "lang", F.lit(95), F.col("n") + 94),
        F.lit("::"),
        F.format_string("%s-{%d..%d}", "source", F.lit(8), F.col("n") + 7),
    )
    return paths.expand_patterns(n.select(pattern.alias("pattern"))).select("path")


def nested_folder(spark, sf):
    def write(out):
        d = records(spark, sf).withColumn("_out", F.concat_ws("/", "lang", "_shard"))
        write_chunks(d, F.encode(F.concat("uid", F.lit("\n")), "UTF-8"), out, "nested")

    return written_once(spark, sf, "nested", write)


@check(
    "list_files",
    f"""WITH {RECORDS}, f AS (SELECT lang, _shard, sum(strlen(uid) + 1)::BIGINT AS bytes FROM records GROUP BY ALL)
    SELECT 1::BIGINT AS depth, lang AS "group", _shard AS name, bytes FROM f
    UNION ALL SELECT 0, '', _shard, bytes FROM f""",
)
def _(spark, sf):
    folder = nested_folder(spark, sf)
    parts = []
    for depth in (0, 1):
        listed = paths.list_files(spark, folder, ["jsonl", "7.jsonl", ".tar"], depth)
        parts.append(
            listed.select(
                F.lit(depth).cast("bigint").alias("depth"), "group", tx.basename(F.col("path")).alias("name"), "bytes"
            )
        )
    return parts[0].unionByName(parts[1])


_DOCUMENT_PATHS = "paths AS (SELECT source || '/' || lpad(doc_id::VARCHAR, 9, '0') || '.tar' AS path FROM documents)"


def document_paths(spark, sf):
    name = F.concat("source", F.lit("/"), F.format_string("%09d", "doc_id"), F.lit(".tar"))
    return table(spark, sf, "documents").select(name.alias("path"))


@check(
    "group_into_folders",
    f"""WITH {_DOCUMENT_PATHS}, n AS (SELECT path, (row_number() OVER (ORDER BY path) - 1) // 7 AS f, count(*) OVER () AS n FROM paths)
    SELECT path, lpad(f::VARCHAR, floor(greatest(0, log10(n / 7.0::DOUBLE)) + 1)::INT, '0') AS folder, '' AS single FROM n""",
)
def _(spark, sf):
    p = document_paths(spark, sf)
    grouped = paths.group_into_folders(p, 7)
    single = paths.group_into_folders(p, -1).withColumnRenamed("folder", "single")
    return grouped.join(single, "path")


# Suffixes that documents get in turn.
_SUFFIXES = [".jsonl", ".json", ".jsonl.gz", ".json.gz", ".jsonl.zst", ".json.zstd", ".tar", ".tfrecord-00001", ".txt", ".gz"]


@check(
    "with_format",
    f"""WITH p AS (SELECT source || '/' || doc_id || {_SUFFIXES!r}[n_chars % 10 + 1] AS path, n_chars % 10 AS k FROM documents)
    SELECT path, CASE WHEN k < 2 THEN 'jsonl' WHEN k < 4 THEN 'jsonl_gzip' WHEN k < 6 THEN 'jsonl_zstd'
      WHEN k = 6 THEN 'tar' WHEN k = 7 THEN 'tfrecord' ELSE 'unknown' END AS format FROM p""",
)
def _(spark, sf):
    suffix = F.get(F.array(*[F.lit(s) for s in _SUFFIXES]), F.pmod("n_chars", F.lit(10)).cast("int"))
    p = table(spark, sf, "documents").select(F.concat("source", F.lit("/"), "doc_id", suffix).alias("path"))
    return paths.with_format(p)


def _example(uid: str, lang: str, n_chars: int, image: bytes, weights: list, payload: str = "image") -> bytes:
    """One record in the wire format of named features, framed; checksums are left zero."""

    def varint(n: int) -> bytes:
        out = bytearray()
        while n > 0x7F:
            out.append(n & 0x7F | 0x80)
            n >>= 7
        return bytes(out) + bytes([n])

    def block(number: int, body: bytes) -> bytes:
        return varint(number << 3 | 2) + varint(len(body)) + body

    def entry(name: str, feature: bytes) -> bytes:
        return block(1, block(1, name.encode()) + block(2, feature))

    features = entry("uid", block(1, block(1, uid.encode())))
    features += entry("lang", block(1, block(1, lang.encode())))
    features += entry(payload, block(1, block(1, image)))
    features += entry("n_chars", block(3, block(1, varint(n_chars))))
    features += entry("weights", block(2, block(1, pa.array(weights, pa.float32()).buffers()[1].to_pybytes()[: 4 * len(weights)])))
    features += entry("broken", block(1, block(1, b"\xff\xfe")))
    body = block(1, features)
    return len(body).to_bytes(8, "little") + bytes(4) + body + bytes(4)


def tfrecord_folder(spark, sf):
    def write(out):
        @arrow_udf("BINARY")
        def encode(uid: pa.Array, lang: pa.Array, n: pa.Array, image: pa.Array) -> pa.Array:
            rows = zip(uid.to_pylist(), lang.to_pylist(), n.to_pylist(), image.to_pylist())
            return pa.array([_example(u, g, k, i, [k / 2, 1.5, -2.0]) for u, g, k, i in rows], pa.binary())

        r = balanced_records(spark, sf).withColumn("_out", F.concat("source", F.lit(".tfrecord")))
        frame = encode("uid", "lang", "n_chars", F.encode("text", "UTF-8"))
        write_chunks(r.select("_out", "_shard", "_pos", frame.alias("frame")), F.col("frame"), out, "tfrecord")

    return written_once(spark, sf, "tfrecord", write)


_FEATURES = "uid STRING, lang STRING, image STRING, n_chars BIGINT, weights ARRAY<FLOAT>, broken STRING, absent STRING"


@check(
    "read_tfrecord",
    f"""WITH {RECORDS} SELECT uid, source || '.tfrecord' AS shard, md5(text) AS image_digest, n_chars,
      row_number() OVER (PARTITION BY source ORDER BY _pos)::BIGINT AS place FROM records""",
)
def _(spark, sf):
    from pyspark.sql import Window

    files = paths.list_files(spark, tfrecord_folder(spark, sf), [".tfrecord"])
    r = tfrecord.read_tfrecord(spark, files, split_bytes=third(files))
    feature = lambda name, kind: F.get(F.col("features")[name][kind], F.lit(0))
    place = F.row_number().over(Window.partitionBy("_shard").orderBy("_pos"))
    return r.select(
        feature("uid", "bytes").cast("string").alias("uid"),
        tx.basename(F.col("_shard")).alias("shard"),
        F.md5(feature("image", "bytes")).alias("image_digest"),
        feature("n_chars", "ints").alias("n_chars"),
        place.cast("bigint").alias("place"),
    )


@check(
    "unwrap_features",
    f"""WITH {RECORDS} SELECT uid, lang, n_chars, md5(base64(encode(text))) AS image_digest, round(n_chars / 2.0 - 0.5, 2)::DOUBLE AS weight_sum,
      'null' AS broken, 'null' AS absent FROM records""",
)
def _(spark, sf):
    files = paths.list_files(spark, tfrecord_folder(spark, sf), [".tfrecord"])
    r = unwrap_features(tfrecord.read_tfrecord(spark, files, shuffle_seed=5), _FEATURES)
    return r.select(
        "uid", "lang", "n_chars", F.md5("image").alias("image_digest"), F.round(list_sum(F.col("weights")), 2).alias("weight_sum"),
        *[F.coalesce(c, F.lit("null")).alias(c) for c in ("broken", "absent")],
    )


def mixed_folder(spark, sf):
    """English records as JSON lines, French as tar, the others as TFRecord."""

    def write(out):
        r = stored(balanced_records(spark, sf))
        write_jsonl(sh.name_shards(r.filter("lang = 'en'"), "orig"), f"{out}/a")
        write_tar_samples(sh.name_shards(r.filter("lang = 'fr'"), "count", "tar"), f"{out}/b")

        @arrow_udf("BINARY")
        def encode(uid: pa.Array, lang: pa.Array, n: pa.Array, text: pa.Array) -> pa.Array:
            rows = zip(uid.to_pylist(), lang.to_pylist(), n.to_pylist(), text.to_pylist())
            return pa.array([_example(u, g, k, t, [0.0], "text") for u, g, k, t in rows], pa.binary())

        rest = r.filter("lang NOT IN ('en', 'fr')").withColumn("_out", F.concat("_shard", F.lit(".tfrecord")))
        frame = encode("uid", "lang", "n_chars", F.encode("text", "UTF-8"))
        write_chunks(rest.select("_out", "_shard", "_pos", frame.alias("frame")), F.col("frame"), f"{out}/c", "c")

    return written_once(spark, sf, "mixed", write)


@check("read_shards", f"WITH {RECORDS} SELECT uid, lang, n_chars, md5(text) AS text_digest FROM records")
def _(spark, sf):
    listed = paths.list_files(spark, mixed_folder(spark, sf), [".jsonl", ".tar", ".tfrecord"])
    r = read_shards(spark, listed, "uid STRING, text STRING, lang STRING, n_chars BIGINT")
    return r.select("uid", "lang", "n_chars", F.coalesce(F.md5("text"), F.lit("null")).alias("text_digest"))


@check(
    "open_records",
    f"""WITH {RECORDS} SELECT format, uid, md5(text) AS text_digest, lang, n_chars, md5(array_to_string(syn_text, '|')) AS syn_digest,
      CASE WHEN n_chars % 3 = 0 THEN 'null' ELSE 'absent' END AS nothing, '[1,null,"x"]' AS nested
    FROM records, (SELECT unnest(['jsonl', 'tar']) AS format)""",
)
def _(spark, sf):
    """Records of which the schema names two keys only, through a run into either format: all keys are there."""
    from shardweave.operators.ledger import run_waves

    def write(out):
        r = stored(balanced_records(spark, sf))
        nested = F.lit('"nested":{"deep":[1,null,"x"]}')
        nothing = F.when(F.col("n_chars") % 3 == 0, F.lit('"nothing":null'))
        object_of = F.to_json(F.struct(*STORED))
        line = F.concat(F.lit("{"), F.concat_ws(",", nested, nothing, F.substr(object_of, F.lit(2))))
        # Packed line by line, before the shuffle; as a packed file has one reader, files are of some ten thousand records.
        named = sh.name_shards(r, "count", "jsonl.zst", max_records=10_000)
        packed = jsonl.zstd_frames(F.encode(F.concat(line, F.lit("\n")), "UTF-8"))
        write_chunks(named.select("_out", "_place", "_shard", "_pos", packed.alias("frame")), F.col("frame"), out, "open")

    folder = written_once(spark, sf, "open", write)
    listed = paths.list_files(spark, folder, [".jsonl.zst"])
    rest = F.try_parse_json("_rest")
    parts = []
    for kind, suffix in (("jsonl", ".jsonl"), ("wds", ".tar")):
        out = scratch_path(spark, f"open-{kind}")
        run_waves(spark, listed, out, lambda p: read_shards(spark, p, "uid STRING, n_chars BIGINT"), lambda df: df, output_format=kind)
        back = read_shards(spark, paths.list_files(spark, out, [suffix]), "uid STRING, text STRING, lang STRING, n_chars BIGINT, syn_text ARRAY<STRING>")
        digested = back.select(
            F.lit(suffix[1:]).alias("format"),
            "uid",
            F.md5("text").alias("text_digest"),
            "lang",
            "n_chars",
            F.md5(F.array_join("syn_text", "|")).alias("syn_digest"),
            F.when(F.array_contains(F.map_keys(rest.cast("map<string,variant>")), "nothing"), "null").otherwise("absent").alias("nothing"),
            F.to_json(F.try_variant_get(rest, "$.nested.deep", "variant")).alias("nested"),
        )
        kept = written_anew(spark, f"open-{kind}-digests", digested.write.parquet)
        parts.append(spark.read.schema(digested.schema).parquet(kept))
        delete_folder(spark, out)  # read back whole, so that the two outputs never take disk at once
    return parts[0].unionByName(parts[1])


@check(
    "duplicate_ids",
    f"""WITH {RECORDS}, again AS (SELECT _shard, CASE WHEN n_chars % 5 = 0 THEN 'a.b' WHEN n_chars % 7 = 0 THEN NULL ELSE uid END AS uid FROM records
      UNION ALL SELECT _shard, uid FROM records WHERE n_chars % 2 = 0)
    SELECT _shard AS shard, coalesce(uid, 'none') AS uid, count(*)::BIGINT AS times FROM again GROUP BY _shard, again.uid HAVING count(*) > 1""",
)
def _(spark, sf):
    """Missing, dotted and repeated ids, written to tar shards and read back."""

    def write(out):
        r = balanced_records(spark, sf)
        uid = F.when(F.col("n_chars") % 5 == 0, "a.b").when(F.col("n_chars") % 7 != 0, F.col("uid"))
        again = r.withColumn("uid", uid).unionByName(r.where("n_chars % 2 = 0"))
        write_tar_samples(again.select("uid", "text", "_shard", "_pos", F.concat("_shard", F.lit(".tar")).alias("_out")), out)

    folder = written_once(spark, sf, "ids", write)
    samples = tar.read_tar_samples(spark, paths.list_files(spark, folder, [".tar"]))
    found = sh.duplicate_ids(samples)
    return found.select(F.regexp_replace(tx.basename(F.col("shard")), r"\.tar$", "").alias("shard"), F.coalesce("uid", F.lit("none")).alias("uid"), "times")


@check(
    "name_shards",
    f"""WITH {RECORDS}, spans AS (SELECT _shard, min(_pos) AS low, greatest((max(_pos) - min(_pos) + 1) * 20 // (count(*) * 16), 1) AS step
      FROM records GROUP BY 1),
    buckets AS (SELECT _shard, (_pos - low) // step AS bucket, count(*) AS n FROM records JOIN spans USING (_shard) GROUP BY 1, 2),
    turns AS (SELECT _shard, bucket, coalesce(sum(n) OVER
      (PARTITION BY _shard ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 20 AS turn FROM buckets),
    pieces AS (SELECT _shard, bucket, dense_rank() OVER (PARTITION BY _shard ORDER BY turn) - 1 AS piece FROM turns),
    firsts AS (SELECT _shard, coalesce(sum(max(piece) + 1) OVER
      (ORDER BY _shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 5 AS first,
      row_number() OVER (ORDER BY _shard) - 1 AS whole FROM pieces GROUP BY 1)
    SELECT uid, lpad(whole::VARCHAR, 8, '0') || '.jsonl' AS counted, r._shard AS original,
      lpad((first + piece)::BIGINT::VARCHAR, 8, '0') || '.tar' AS spread,
      CASE piece WHEN 0 THEN r._shard ELSE replace(r._shard, '.jsonl', '-' || lpad(piece::VARCHAR, 5, '0') || '.jsonl') END AS parts
    FROM records r JOIN spans USING (_shard) JOIN firsts USING (_shard)
    JOIN pieces p ON p._shard = r._shard AND p.bucket = (r._pos - low) // step""",
)
def _(spark, sf):
    r = records(spark, sf).select("uid", "_shard", "_pos")
    counted = sh.name_shards(r, "count").select("uid", "_pos", "_shard", F.col("_out").alias("counted"))
    both = sh.name_shards(counted, "orig").withColumnRenamed("_out", "original")
    spread = sh.name_shards(both, "count", "tar", start=5, max_records=20).withColumnRenamed("_out", "spread")
    parts = sh.name_shards(spread, "orig", max_records=20)
    return parts.select("uid", "counted", "original", "spread", F.col("_out").alias("parts"))


@check(
    "shard_manifest",
    f"WITH {RECORDS} SELECT source AS shard, count(*)::BIGINT AS num_uids FROM records GROUP BY 1",
)
def _(spark, sf):
    folder = manifest_file(spark, sf)
    return spark.read.schema("shard STRING, num_uids LONG").json(f"{folder}/manifest.jsonl")


@check(
    "info_manifest",
    f"""WITH {RECORDS}, c AS (SELECT _shard, count(*) AS n FROM records GROUP BY 1)
    SELECT 'data/set' AS name, (SELECT count(*) FROM records)::VARCHAR AS total, 'data/set/' || _shard AS path, n::VARCHAR AS num_uids,
      1 AS dated FROM c""",
)
def _(spark, sf):
    whole = spark.read.text(f"{manifest_file(spark, sf)}/info.json", wholetext=True)
    schema = "name STRING, totalLength STRING, date STRING, lengths MAP<STRING, STRING>"
    info = whole.select(F.from_json("value", schema).alias("i"))
    entries = info.select("i.name", "i.totalLength", "i.date", F.explode("i.lengths").alias("path", "num_uids"))
    dated = F.col("date").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$").cast("int")
    return entries.select("name", F.col("totalLength").alias("total"), "path", "num_uids", dated.alias("dated"))


@check(
    "verify_output",
    f"""WITH {RECORDS} SELECT shard, count(*)::BIGINT AS num_uids, 'ok' AS status FROM
      (SELECT lpad((dense_rank() OVER (ORDER BY _shard) - 1)::VARCHAR, 8, '0') || '.tar' AS shard FROM records) GROUP BY 1""",
)
def _(spark, sf):
    return sh.verify_output(spark, tar_folder(spark, sf), [".tar"])
