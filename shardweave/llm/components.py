"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardweave.llm.store import stored


def _star(edges: DataFrame) -> DataFrame:
    """Each ``u`` with its neighbours ``v`` and the least of both, ``m``; minima are aggregated before the
    shuffle, and the join lets Spark split a node with very many neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of the undirected ``edges`` (u, v) the least node it is connected with.

    Alternates between linking each node's greater neighbours to its least one and each node's lesser
    neighbours likewise, until nothing changes; the number of rounds grows with the logarithm of the
    size, also for long chains. Each round is a written table. Loops are ignored; no edges, no rows.
    """
    edges = stored(edges.select("u", "v").where("u <> v").distinct(), "edges")
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        star = _star(down)
        small = star.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(star.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
