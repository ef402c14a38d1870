"""Draws: range, distribution, independence of the partitioning."""

import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shardweave.functions.draws import Draws, uniform
from shardweave.plans import mixing, policies
from shardweave.plans.augment_plan import plan_draws


def test_uniform_is_the_digest(spark):
    got = spark.range(50).select("id", uniform(3, F.col("id"), 2, "slot").alias("u")).collect()
    for row in got:
        digest = hashlib.md5(f"3|{row['id']}|2|slot".encode()).hexdigest()
        assert row["u"] == int(digest[:13], 16) / 2**52


def test_uniform_spreads_evenly(spark):
    u = np.array([r["u"] for r in spark.range(4000).select(uniform(1, F.col("id"), 0, "x").alias("u")).collect()])
    assert 0 <= u.min() and u.max() < 1
    assert abs(u.mean() - 0.5) < 0.02
    assert abs(np.histogram(u, 10, (0, 1))[0] - 400).max() < 80


def test_integer_draws_cover_their_range(spark):
    d = Draws(1, F.col("id"), F.lit(0))
    got = Counter(r[0] for r in spark.range(3000).select(d.integer("k", -2, 4)).collect())
    assert set(got) == set(range(-2, 4))
    assert min(got.values()) > 400


def test_rand_augment_uses_every_operation(spark):
    plan = policies.rand_augment_plan(Draws(1, F.col("id"), F.lit(0)), 224, 224, p=0.5)
    rows = spark.range(3000).select(plan.alias("p")).collect()
    skipped = sum(r["p"] is None for r in rows)
    assert abs(skipped - 1500) < 150
    ops = Counter(o["op"] for r in rows if r["p"] for o in r["p"])
    assert set(ops) == set(range(14))
    assert max(ops.values()) < 2 * min(ops.values())


def test_plans_do_not_depend_on_partitions(spark):
    config = {"random_resized_crop": {"size": 32}, "rand_augment": {}, "random_erase": {}}
    ids = spark.range(200).select(F.col("id").cast("string").alias("uid"))
    plans = [
        {r["uid"]: r["params"] for r in plan_draws(ids.repartition(n), config, 2, 5, "uid", 64, 48).collect()}
        for n in (1, 16)
    ]
    assert plans[0] == plans[1]


def test_beta_draws_have_the_right_moments(spark):
    for alpha in (0.2, 0.4, 1.0, 2.0):
        lam = mixing.beta_draw(uniform(1, F.col("id"), 0, "b"), alpha)
        x = np.array([r[0] for r in spark.range(6000).select(lam).collect()])
        assert 0 <= x.min() and x.max() <= 1
        assert abs(x.mean() - 0.5) < 0.02
        assert abs(x.var() - 1 / (4 * (2 * alpha + 1))) < 0.01


def test_beta_quantiles_match_a_numeric_integral():
    alpha = 2.0
    x = np.linspace(0, 1, 200_001)
    cumulative = np.cumsum(x * (1 - x))
    cumulative /= cumulative[-1]
    grid = np.array(mixing._beta_half_quantiles(alpha)) ** (1 / alpha)
    want = np.interp(np.linspace(0, 0.5, len(grid)), cumulative, x)
    assert np.abs(grid - want).max() < 1e-3


def test_alpha_zero_never_mixes(spark):
    d = Draws(1, F.col("id"), F.lit(0))
    row = spark.range(1).select(mixing.mixup_plan(d, alpha=0).alias("m"), mixing.cutmix_plan(d, 8, 8, alpha=0).alias("c"))
    assert tuple(row.first()) == (None, None)


def test_copies_of_one_record_spread_over_the_pair_buckets(spark):
    # A third of the rows share one uid; the position tells them apart.
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("uid"), F.col("id").alias("_pos")
    )
    paired = mixing.draw_pairs(rows, ["uid", "_pos"], 30, 7, ["uid", "_pos"])
    pairs = [(r["_pos"], r["_pos2"]) for r in paired.collect()]
    assert sorted(p for p, _ in pairs) == sorted(q for _, q in pairs) == list(range(900))
    assert sum(a == b for a, b in pairs) < 5


def test_partner_payload_may_be_null(spark):
    rows = spark.range(20).select("id", F.lit(None).cast("string").alias("note"))
    assert mixing.draw_pairs(rows, ["id"], 1, 7, ["note"]).filter("note2 IS NULL").count() == 20
