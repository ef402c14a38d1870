"""Embedding storage."""

from pyspark.sql import functions as F

from checks.base import check, table
from shardweave.functions.packing import pack_embedding, unpack_embedding
from shardweave.functions.tensor import to_bfloat16


def matrices(spark, sf):
    """Each embedding as a matrix of vectors of eight, whatever its length."""
    last = F.ceil(F.size("embedding") / 8).cast("int") - 1
    rows = F.transform(F.sequence(F.lit(0), last), lambda r: F.slice(F.col("embedding"), r * 8 + 1, F.lit(8)))
    return table(spark, sf, "embeddings").select("vec_id", rows.alias("matrix"))


@check("pack_embedding", "SELECT vec_id, 'H4sI' AS magic, 1 AS restored, 1 AS shorter_than_text FROM embeddings")
def _(spark, sf):
    m = matrices(spark, sf).withColumn("packed", pack_embedding(F.col("matrix")))
    m = m.withColumn("restored", unpack_embedding(F.col("packed")))
    return m.select(
        "vec_id",
        F.substring("packed", 1, 4).alias("magic"),
        F.col("restored").eqNullSafe(F.col("matrix")).cast("int").alias("restored"),
        (F.length("packed") < F.length(F.to_json("matrix"))).cast("int").alias("shorter_than_text"),
    )


@check(
    "unpack_embedding",
    """SELECT vec_id, ceil(len(embedding) / 8.0)::BIGINT AS rows, len(embedding)::BIGINT AS "values",
    round(list_sum(list_transform(embedding, lambda x, i: x::DOUBLE * i)), 6) AS weighted FROM embeddings""",
)
def _(spark, sf):
    m = matrices(spark, sf).withColumn("restored", unpack_embedding(pack_embedding(F.col("matrix"))))
    flat = F.flatten("restored")
    weighted = F.aggregate(
        F.transform(flat, lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, x: a + x
    )
    return m.select(
        "vec_id",
        F.size("restored").cast("bigint").alias("rows"),
        F.size(flat).cast("bigint").alias("values"),
        F.round(weighted, 6).alias("weighted"),
    )


@check(
    "to_bfloat16",
    """WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    q AS (SELECT *, CASE WHEN x = 0 THEN 1 ELSE pow(2, floor(log2(abs(x))) - 7) END AS q FROM v)
    SELECT vec_id, i::BIGINT AS i, round(round_even(x / q, 0) * q, 9) + 0.0 AS x FROM q""",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.posexplode_outer(to_bfloat16(F.col("embedding"))).alias("i", "x"))
    return e.select(
        "vec_id", (F.col("i") + 1).cast("bigint").alias("i"), F.round(F.col("x").cast("double"), 9).alias("x")
    )
