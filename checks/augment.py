"""Draws, augmentation plans, their storage, and their application to images."""

import math

from pyspark.sql import functions as F

from checks.base import IMAGES, check, checksum, images, list_sum, sql_checksum, sql_int, sql_u, table
from shardweave.functions import draws as dr
from shardweave.functions import tensor as px
from shardweave.operators import augment
from shardweave.plans import augment_plan as ap
from shardweave.plans import config as cf
from shardweave.plans import geometry, mixing, policies

SEED = 7
DRAWS = 3


def drawn(spark, sf, n=DRAWS):
    """One row per image and draw number."""
    return images(spark, sf).withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def draws_of(prefix=""):
    return dr.Draws(SEED, F.col("uid"), F.col("draw"), prefix)


def or_minus_one(value):
    """Whole numbers without nulls, which some data frames would turn into floats."""
    return F.coalesce(value.cast("bigint"), F.lit(-1).cast("bigint"))


def f8(x) -> str:
    """Exact double literal."""
    return f"'{float(x)!r}'::DOUBLE"


D = f"d AS (SELECT uid, unnest(range({DRAWS})) AS draw FROM images)"


def u(slot: str) -> str:
    return sql_u(SEED, "uid", "draw", slot)


def between(slot: str, low: float, high: float) -> str:
    return f"({f8(low)} + {u(slot)} * {f8(high - low)})"


def integer(slot: str, low: str, high: str) -> str:
    return sql_int(SEED, "uid", "draw", slot, low, high)


@check(
    "uniform",
    f"""WITH {IMAGES}, {D} SELECT uid, draw::BIGINT AS draw, round({u("'a'")}, 12) AS u,
      {integer("'b'", "3", "17")} AS k, CASE WHEN {u("'c'")} < 0.5 THEN -1 ELSE 1 END::BIGINT AS s FROM d""",
)
def _(spark, sf):
    d = draws_of()
    return drawn(spark, sf).select(
        "uid",
        F.col("draw").cast("bigint").alias("draw"),
        F.round(d.uniform("a"), 12).alias("u"),
        d.integer("b", 3, 17).cast("bigint").alias("k"),
        d.sign("c").cast("bigint").alias("s"),
    )


# Parts stand for images of p_size + 1 by retail price pixels.
@check(
    "resize_plan",
    """WITH s AS (SELECT p_partkey, p_size + 1 AS h, floor(p_retailprice)::BIGINT AS w FROM part)
    SELECT p_partkey, '[224]' AS size,
      CASE WHEN h >= w THEN floor(224::DOUBLE * h / w) ELSE 224 END::BIGINT AS new_h,
      CASE WHEN h >= w THEN 224 ELSE floor(224::DOUBLE * w / h) END::BIGINT AS new_w,
      '[120,160]' AS fixed FROM s""",
)
def _(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", (F.col("p_size") + 1).alias("h"), F.floor("p_retailprice").alias("w")
    )
    new_h, new_w = geometry.resize_target(F.col("h"), F.col("w"), 224)
    return p.select(
        "p_partkey",
        F.to_json(geometry.resize_plan(224)).alias("size"),
        new_h.cast("bigint").alias("new_h"),
        new_w.cast("bigint").alias("new_w"),
        F.to_json(geometry.resize_plan([120, 160])).alias("fixed"),
    )


def sql_crop(top, left, h, w, source="px", sh=8, sw=8) -> str:
    """Values of a zero-padded box of a one-channel image."""
    row, col = f"(({top}) + i // {w})", f"(({left}) + i % {w})"
    inside = f"{row} >= 0 AND {row} < {sh} AND {col} >= 0 AND {col} < {sw}"
    return (
        f"list_transform(range({h} * {w}), lambda i: CASE WHEN {inside} THEN {source}[({row} * {sw} + {col}) + 1] ELSE 0 END)"
    )


@check(
    "center_crop",
    f"""WITH {IMAGES} SELECT uid, {sql_checksum(sql_crop(2, 2, 5, 4))} AS inner_sum,
      {sql_checksum(sql_crop(-1, -1, 10, 11))} AS padded_sum FROM images""",
)
def _(spark, sf):
    i = images(spark, sf)
    return i.select(
        "uid",
        checksum(px.center_crop(F.col("image"), 5, 4)).alias("inner_sum"),
        checksum(px.center_crop(F.col("image"), 10, 11)).alias("padded_sum"),
    )


@check(
    "random_crop_plan",
    f"""WITH {IMAGES}, {D} SELECT uid, draw::BIGINT AS draw,
      {integer("'random_crop.top'", "0", "480 - 224 + 1")} AS top,
      {integer("'random_crop.left'", "0", "640 - 224 + 1")} AS left,
      {integer("'random_crop.top'", "0", "200 + 2 * 24 - 224 + 1")} AS padded_top,
      {integer("'random_crop.left'", "0", "640 - 224 + 1")} AS padded_left FROM d""",
)
def _(spark, sf):
    plain = geometry.random_crop_plan(draws_of(), 480, 640, (224, 224))
    padded = geometry.random_crop_plan(draws_of(), 200, 640, (224, 224), pad_if_needed=True)
    return drawn(spark, sf).select(
        "uid",
        F.col("draw").cast("bigint").alias("draw"),
        plain["top"].cast("bigint").alias("top"),
        plain["left"].cast("bigint").alias("left"),
        padded["top"].cast("bigint").alias("padded_top"),
        padded["left"].cast("bigint").alias("padded_left"),
    )


def sql_boxes(name, slot, h, w, scale, ratio, erase=False, source="d", prefix="") -> str:
    """CTEs that draw ten boxes per row of ``source`` and keep the first that fits."""
    slot_of = lambda part: f"'{prefix}{slot}.{part}.' || i"
    tall, wide = ("*", "/") if erase else ("/", "*")
    fits = f"bh < {h} AND bw < {w}" if erase else f"bw > 0 AND bw <= {w} AND bh > 0 AND bh <= {h}"
    first, second = ("x", "y") if erase else ("top", "left")
    if erase:
        fallback = (0, 0, h, w)
    else:
        fw = round(h * max(ratio)) if w / h > max(ratio) else w
        fh = round(w / min(ratio)) if w / h < min(ratio) else h
        fallback = ((h - fh) // 2, (w - fw) // 2, fh, fw)
    keys = "uid, draw"
    return f"""{name}_t AS (SELECT {keys}, unnest(range(10)) AS i FROM {source}),
    {name}_s AS (SELECT *, ({f8(h * w)} * {between(slot_of("area"), *scale)}) AS area,
      exp({between(slot_of("aspect"), math.log(ratio[0]), math.log(ratio[1]))}) AS aspect FROM {name}_t),
    {name}_b AS (SELECT *, round_even(sqrt(area {tall} aspect), 0)::BIGINT AS bh,
      round_even(sqrt(area {wide} aspect), 0)::BIGINT AS bw FROM {name}_s),
    {name}_f AS (SELECT *, {integer(slot_of(first), "0", f"{h} - bh + 1")} AS a,
      {integer(slot_of(second), "0", f"{w} - bw + 1")} AS b FROM {name}_b WHERE {fits}),
    {name}_p AS (SELECT {keys}, arg_min(a, i) AS a, arg_min(b, i) AS b, arg_min(bh, i) AS bh, arg_min(bw, i) AS bw
      FROM {name}_f GROUP BY {keys}),
    {name} AS (SELECT s.uid, s.draw, coalesce(p.a, {fallback[0]})::BIGINT AS a, coalesce(p.b, {fallback[1]})::BIGINT AS b,
      coalesce(p.bh, {fallback[2]})::BIGINT AS bh, coalesce(p.bw, {fallback[3]})::BIGINT AS bw
      FROM {source} s LEFT JOIN {name}_p p USING (uid, draw))"""


RATIO = (3.0 / 4.0, 4.0 / 3.0)


@check(
    "random_resized_crop_plan",
    f"""WITH {IMAGES}, {D}, {sql_boxes("box", "random_resized_crop", 480, 640, (0.08, 1.0), RATIO)},
    {sql_boxes("long", "random_resized_crop", 20, 640, (0.9, 1.0), RATIO)}
    SELECT uid, draw::BIGINT AS draw, box.a AS top, box.b AS "left", box.bh AS h, box.bw AS w,
      long.a AS strip_top, long.b AS strip_left, long.bh AS strip_h, long.bw AS strip_w
    FROM box JOIN long USING (uid, draw)""",
)
def _(spark, sf):
    box = geometry.random_resized_crop_plan(draws_of(), 480, 640)
    strip = geometry.random_resized_crop_plan(draws_of(), 20, 640, scale=(0.9, 1.0))
    d = drawn(spark, sf).withColumn("box", box).withColumn("strip", strip)
    return d.select(
        "uid",
        F.col("draw").cast("bigint").alias("draw"),
        *[F.col(f"box.{k}").cast("bigint").alias(k) for k in ("top", "left", "h", "w")],
        *[F.col(f"strip.{k}").cast("bigint").alias(f"strip_{k}") for k in ("top", "left", "h", "w")],
    )


@check(
    "flip_plan",
    f"""WITH {IMAGES}, {D} SELECT uid, draw::BIGINT AS draw, ({u("'random_horizontal_flip'")} < 0.5)::INT AS half,
      ({u("'random_horizontal_flip'")} < 0.9)::INT AS often FROM d""",
)
def _(spark, sf):
    return drawn(spark, sf).select(
        "uid",
        F.col("draw").cast("bigint").alias("draw"),
        geometry.flip_plan(draws_of()).cast("int").alias("half"),
        geometry.flip_plan(draws_of(), 0.9).cast("int").alias("often"),
    )


@check(
    "random_erase_plan",
    f"""WITH {IMAGES}, {D}, {sql_boxes("box", "random_erase", 224, 160, (0.02, 0.33), (0.3, 3.3), erase=True)},
    kept AS (SELECT uid, draw, {u("'random_erase.skip'")} <= 0.5 AS kept FROM d)
    SELECT uid, draw::BIGINT AS draw, CASE WHEN kept THEN a ELSE -1 END AS x, CASE WHEN kept THEN b ELSE -1 END AS y,
      CASE WHEN kept THEN bh ELSE -1 END AS h, CASE WHEN kept THEN bw ELSE -1 END AS w FROM box JOIN kept USING (uid, draw)""",
)
def _(spark, sf):
    d = drawn(spark, sf).withColumn("box", geometry.random_erase_plan(draws_of(), 224, 160))
    return d.select(
        "uid",
        F.col("draw").cast("bigint").alias("draw"),
        *[or_minus_one(F.col(f"box.{k}")).alias(k) for k in ("x", "y", "h", "w")],
    )


def sql_strength(op: str, share: str, h: str, w: str, wide: bool) -> str:
    """Strength of one operation, as published."""
    if op.startswith("Shear"):
        return f"{share} * {f8(0.99 if wide else 0.3)}"
    if op in ("TranslateX", "TranslateY"):
        side = w if op.endswith("X") else h
        return f"{share} * " + (f8(32.0) if wide else f"({f8(150.0 / 331.0)} * {side})")
    if op == "Rotate":
        return f"{share} * {f8(135.0 if wide else 30.0)}"
    if op in ("Brightness", "Color", "Contrast", "Sharpness"):
        return f"{share} * {f8(0.99 if wide else 0.9)}"
    if op == "Posterize":
        return f"8 - round_even({share} * {6 if wide else 4}, 0)"
    if op == "Solarize":
        return f"255 * (1 - {share})"
    return "0"


def sql_ops_table(share: str, h: str, w: str, wide: bool) -> str:
    """CASE over ``op`` with the unsigned strengths."""
    cases = " ".join(
        f"WHEN {i} THEN ({sql_strength(name, share, h, w, wide)})::DOUBLE"
        for i, name in enumerate(policies.RAND_AUGMENT_OPS)
    )
    return f"CASE op {cases} END"


SIGNED = ", ".join(str(policies.ALL_OPS.index(name)) for name in policies.SIGNED)


def sql_signed(sign: str) -> str:
    return f"CASE WHEN op IN ({SIGNED}) THEN m * {sign} ELSE m END"


def sql_rand_augment(name: str, p: float, h: str, w: str, num_ops=2, magnitude=9, bins=31, prefix="") -> str:
    """CTE with one row per image, draw and operation; skipped draws have none."""
    slot = lambda part: f"'{prefix}rand_augment.{part}.' || i"
    share = f"({f8(magnitude)} / {f8(bins - 1)})"
    sign = f"(CASE WHEN {u(slot('sign'))} < 0.5 THEN -1 ELSE 1 END)"
    skip = f"'{prefix}rand_augment.skip'"
    return f"""{name}_i AS (SELECT uid, draw, unnest(range({num_ops})) AS i FROM d WHERE {u(skip)} <= {f8(p)}),
    {name}_o AS (SELECT *, {integer(slot("op"), "0", "14")} AS op FROM {name}_i),
    {name}_m AS (SELECT *, {sql_ops_table(share, h, w, False)} AS m FROM {name}_o),
    {name} AS (SELECT uid, draw, i, op, {sql_signed(sign)} AS magnitude FROM {name}_m)"""


def exploded_ops(df, plan):
    ops = df.withColumn("_ops", plan)
    each = ops.select("uid", F.col("draw").cast("bigint").alias("draw"), F.posexplode_outer("_ops").alias("i", "o"))
    return each.filter("o IS NOT NULL").select(
        "uid",
        "draw",
        F.col("i").cast("bigint").alias("i"),
        F.col("o.op").cast("bigint").alias("op"),
        F.round("o.magnitude", 9).alias("magnitude"),
    )


_OPS_OUT = "uid, draw::BIGINT AS draw, i::BIGINT AS i, op::BIGINT AS op, round(magnitude, 9) + 0.0 AS magnitude"


@check(
    "rand_augment_plan",
    f"WITH {IMAGES}, {D}, {sql_rand_augment('ops', 0.7, '480', '640')} SELECT {_OPS_OUT} FROM ops",
)
def _(spark, sf):
    return exploded_ops(drawn(spark, sf), policies.rand_augment_plan(draws_of(), 480, 640, p=0.7))


@check(
    "trivial_augment_plan",
    f"""WITH {IMAGES}, {D},
    o AS (SELECT *, {integer("'trivial_augment.op'", "0", "14")} AS op, {integer("'trivial_augment.bin'", "0", "31")} AS bin FROM d),
    m AS (SELECT *, 0 AS i, {sql_ops_table("(bin::DOUBLE / 30.0::DOUBLE)", "480", "640", True)} AS m FROM o),
    ops AS (SELECT *, {sql_signed(f"(CASE WHEN {u(chr(39) + 'trivial_augment.sign' + chr(39))} < 0.5 THEN -1 ELSE 1 END)")} AS magnitude FROM m)
    SELECT {_OPS_OUT} FROM ops""",
)
def _(spark, sf):
    return exploded_ops(drawn(spark, sf), policies.trivial_augment_plan(draws_of(), 480, 640))


def _policy_rows() -> str:
    rows = []
    for name, pairs in policies.POLICIES.items():
        for s, pair in enumerate(pairs):
            for i, (op, p, bin_) in enumerate(pair):
                m = "0" if bin_ is None else sql_strength(op, f"({f8(bin_)} / 9.0::DOUBLE)", "480", "640", False)
                rows.append(f"('{name}', {s}, {i}, {policies.ALL_OPS.index(op)}, {f8(p)}, ({m})::DOUBLE)")
    return ", ".join(rows)


@check(
    "auto_augment_plan",
    f"""WITH {IMAGES}, {D}, rows(policy, s, i, op, p, m) AS (VALUES {_policy_rows()}),
    chosen AS (SELECT *, CASE draw WHEN 0 THEN 'imagenet' WHEN 1 THEN 'cifar10' ELSE 'svhn' END AS policy,
      {integer("'auto_augment.policy'", "0", "25")} AS s FROM d),
    kept AS (SELECT uid, draw, i, op, m FROM chosen JOIN rows USING (policy, s)
      WHERE {u("'auto_augment.keep.' || i")} <= p),
    ops AS (SELECT uid, draw, row_number() OVER (PARTITION BY uid, draw ORDER BY i) - 1 AS i, op,
      {sql_signed("(CASE WHEN " + u("'auto_augment.sign.' || i") + " < 0.5 THEN -1 ELSE 1 END)")} AS magnitude FROM kept)
    SELECT {_OPS_OUT} FROM ops""",
)
def _(spark, sf):
    plans = [policies.auto_augment_plan(draws_of(), 480, 640, p) for p in ("ImageNet", "cifar", "SVHN")]
    plan = F.when(F.col("draw") == 0, plans[0]).when(F.col("draw") == 1, plans[1]).otherwise(plans[2])
    return exploded_ops(drawn(spark, sf), plan)


@check(
    "normalize",
    f"""WITH {IMAGES} SELECT uid, round(list_sum(list_transform(px, lambda x, i:
      ((x - [10.0, 20.0, 30.0, 40.0][(i - 1) % 4 + 1]) / [2.0, 4.0, 8.0, 16.0][(i - 1) % 4 + 1])::FLOAT::DOUBLE)), 3) AS total
    FROM images""",
)
def _(spark, sf):
    n = px.normalize(F.col("image"), [10, 20, 30, 40], [2, 4, 8, 16])
    return images(spark, sf, 4, 4, 4).select("uid", F.round(list_sum(n["data"]), 3).alias("total"))


@check(
    "to_uint8",
    """SELECT vec_id, list_sum(list_transform(embedding, lambda x: floor(greatest(x, 0::FLOAT)::DOUBLE * 255)))::BIGINT AS total
    FROM embeddings""",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    unit = px.tensor(F.transform("embedding", lambda x: F.greatest(x, F.lit(0.0).cast("float"))), 8, 8, 1)
    wide = px.map_values(unit, lambda x, ch: x)
    return e.select("vec_id", list_sum(px.to_uint8(wide)["data"]).cast("bigint").alias("total"))


@check(
    "to_tensor",
    f"WITH {IMAGES} SELECT uid, round(list_sum(list_transform(px, lambda x: (x / 255.0::DOUBLE)::FLOAT::DOUBLE)), 4) AS total FROM images",
)
def _(spark, sf):
    t = px.to_tensor(F.col("image"))
    return images(spark, sf).select("uid", F.round(list_sum(t["data"]), 4).alias("total"))


# The chain that most checks below use: crop and resize, mirror, blank a box.
CHAIN = {
    "random_erase": {"p": 0.5},
    "random_horizontal_flip": {},
    "random_resized_crop": {"size": 6, "interpolation": "nearest"},
    "mixup": {"enable": False},
    "no_such_step": {"size": 3},
}
CHAIN_SQL = f"""{IMAGES}, {D}, {sql_boxes("crop", "random_resized_crop", 8, 8, (0.08, 1.0), RATIO)},
    {sql_boxes("hole", "random_erase", 6, 6, (0.02, 0.33), (0.3, 3.3), erase=True)},
    plan AS (SELECT c.uid, c.draw, c.a AS top, c.b AS "left", c.bh AS h, c.bw AS w,
      {sql_u(SEED, "c.uid", "c.draw", "'random_horizontal_flip'")} < 0.5 AS flip,
      {sql_u(SEED, "c.uid", "c.draw", "'random_erase.skip'")} <= 0.5 AS erased,
      e.a AS ex, e.b AS ey, e.bh AS eh, e.bw AS ew FROM crop c JOIN hole e USING (uid, draw)),
    views AS (SELECT plan.*, list_transform(range(36), lambda i:
        CASE WHEN erased AND i // 6 >= ex AND i // 6 < ex + eh AND i % 6 >= ey AND i % 6 < ey + ew THEN 0
        ELSE px[(top + (i // 6) * h // 6) * 8 + "left" + (CASE WHEN flip THEN 5 - i % 6 ELSE i % 6 END) * w // 6 + 1] END) AS v
      FROM plan JOIN images USING (uid))"""


def planned_chain(spark, sf):
    return ap.plan_draws(images(spark, sf), CHAIN, DRAWS, SEED, "uid", 8, 8)


def long_views(df, views="views"):
    each = df.select("uid", F.posexplode_outer(views).alias("draw", "view"))
    return each.select("uid", F.col("draw").cast("bigint").alias("draw"), checksum(F.col("view")).alias("view_sum"))


_VIEW_SUMS = f"WITH {CHAIN_SQL} SELECT uid, draw::BIGINT AS draw, {sql_checksum('v')} AS view_sum FROM views"


@check(
    "plan_draws",
    f"""WITH {CHAIN_SQL} SELECT uid, draw::BIGINT AS draw, top, "left", h, w, flip::INT AS flip,
      CASE WHEN erased THEN ex ELSE -1 END AS x, CASE WHEN erased THEN ew ELSE -1 END AS erased_w FROM plan""",
)
def _(spark, sf):
    each = planned_chain(spark, sf).select("uid", F.posexplode_outer("params").alias("draw", "p"))
    return each.select(
        "uid",
        F.col("draw").cast("bigint").alias("draw"),
        *[F.col(f"p.random_resized_crop.{k}").cast("bigint").alias(k) for k in ("top", "left", "h", "w")],
        F.col("p.random_horizontal_flip").cast("int").alias("flip"),
        or_minus_one(F.col("p.random_erase.x")).alias("x"),
        or_minus_one(F.col("p.random_erase.w")).alias("erased_w"),
    )


@check("apply_geometry", _VIEW_SUMS)
def _(spark, sf):
    steps = cf.steps_from_config(CHAIN)
    views = F.transform(F.col("params"), lambda p: augment.apply_geometry(F.col("image"), steps, p))
    return long_views(planned_chain(spark, sf).withColumn("views", views))


@check("apply_views", _VIEW_SUMS)
def _(spark, sf):
    steps = cf.steps_from_config(CHAIN)
    return long_views(augment.apply_views(planned_chain(spark, sf), steps, "image", "params"))


COMPACT = dict(CHAIN, rand_augment={"p": 0.7})


def compacted(spark, sf):
    steps = cf.steps_from_config(COMPACT)
    planned = ap.plan_draws(images(spark, sf), COMPACT, DRAWS, SEED, "uid", 8, 8)
    return planned.withColumn("param_aug", ap.compress_draws(F.col("params"), steps)), steps


_COMPACT_SQL = f"""{CHAIN_SQL}, {sql_rand_augment("ops", 0.7, "6", "6")},
    listed AS (SELECT uid, draw, string_agg('[' || op || ',' || magnitude || ']', ',' ORDER BY i) AS ra FROM ops GROUP BY uid, draw),
    full_plan AS (SELECT plan.*, ra FROM plan LEFT JOIN listed USING (uid, draw))"""


@check(
    "compress_params",
    f"""WITH {_COMPACT_SQL} SELECT uid, draw::BIGINT AS draw,
      '[[' || top || ',' || "left" || ',' || h || ',' || w || '],' || flip::VARCHAR || ',' ||
      coalesce('[' || ra || ']', 'null') || ',' ||
      CASE WHEN erased THEN '[' || ex || ',' || ey || ',' || eh || ',' || ew || ']' ELSE 'null' END || ']' AS compact
    FROM full_plan""",
)
def _(spark, sf):
    each = compacted(spark, sf)[0].select("uid", F.posexplode_outer("param_aug").alias("draw", "compact"))
    return each.select("uid", F.col("draw").cast("bigint").alias("draw"), "compact")


@check(
    "decompress_params",
    f"""WITH {_COMPACT_SQL}, strength AS (SELECT uid, draw, sum(op) AS op_sum, round(sum(magnitude), 6) + 0.0 AS m FROM ops GROUP BY uid, draw)
    SELECT uid, draw::BIGINT AS draw, top, "left", h, w, flip::INT AS flip, CASE WHEN erased THEN ey ELSE -1 END AS y,
      coalesce(op_sum, -1)::BIGINT AS op_sum, coalesce(m, -1000) AS magnitude_sum FROM full_plan LEFT JOIN strength USING (uid, draw)""",
)
def _(spark, sf):
    df, steps = compacted(spark, sf)
    read = df.select("uid", F.posexplode_outer(ap.decompress_draws(F.col("param_aug"), steps)).alias("draw", "p"))
    ops = F.col("p.rand_augment")
    return read.select(
        "uid",
        F.col("draw").cast("bigint").alias("draw"),
        *[F.col(f"p.random_resized_crop.{k}").cast("bigint").alias(k) for k in ("top", "left", "h", "w")],
        F.col("p.random_horizontal_flip").cast("int").alias("flip"),
        or_minus_one(F.col("p.random_erase.y")).alias("y"),
        or_minus_one(F.aggregate(ops, F.lit(0).cast("bigint"), lambda a, o: a + o["op"])).alias("op_sum"),
        F.coalesce(F.round(F.aggregate(ops, F.lit(0.0), lambda a, o: a + o["magnitude"]), 6), F.lit(-1000.0)).alias("magnitude_sum"),
    )


@check("reapply", _VIEW_SUMS)
def _(spark, sf):
    steps = cf.steps_from_config(CHAIN)
    stored = planned_chain(spark, sf).withColumn("param_aug", ap.compress_draws(F.col("params"), steps))
    read = stored.withColumn("params", ap.decompress_draws(F.col("param_aug"), steps))
    return long_views(augment.reapply(read, steps, "image", "params"))


# The default interpolation, and a policy.
SMOOTH = {"random_resized_crop": {"size": 6}, "random_horizontal_flip": {}, "rand_augment": {"p": 0.7}, "random_erase": {"p": 0.5}}


@check(
    "replay_is_exact",
    f"WITH {IMAGES} SELECT uid, draw::BIGINT AS draw, 1 AS same FROM images, (SELECT unnest(range({DRAWS})) AS draw)",
)
def _(spark, sf):
    """Views from stored parameters against those of the first application, pixel by pixel."""
    steps = cf.steps_from_config(SMOOTH)
    planned = ap.plan_draws(images(spark, sf), SMOOTH, DRAWS, SEED, "uid", 8, 8)
    seen = augment.apply_views(planned, steps, "image", "params", "first")
    stored = seen.withColumn("param_aug", ap.compress_draws(F.col("params"), steps))
    read = stored.withColumn("params", ap.decompress_draws(F.col("param_aug"), steps))
    both = augment.reapply(read, steps, "image", "params", "again")
    each = both.select("uid", F.posexplode_outer(F.arrays_zip("first", "again")).alias("draw", "v"))
    same = F.col("v.first").eqNullSafe(F.col("v.again")) & F.col("v.first").isNotNull()
    return each.select("uid", F.col("draw").cast("bigint").alias("draw"), same.cast("int").alias("same"))


STAGED = {"random_crop": {"size": 6}, "to_tensor": {}, "random_horizontal_flip": {"p": 0.5}, "normalize": {"mean": [0.5], "std": [0.25]}}


@check(
    "split_collate",
    f"""WITH {IMAGES}, {D}, plan AS (SELECT *, {integer("'random_crop.top'", "0", "3")} AS top,
      {integer("'random_crop.left'", "0", "3")} AS "left", {u("'random_horizontal_flip'")} < 0.5 AS flip FROM d),
    views AS (SELECT plan.*, list_transform(range(36), lambda i:
        ((px[(top + i // 6) * 8 + "left" + (CASE WHEN flip THEN 5 - i % 6 ELSE i % 6 END) + 1] / 255.0::DOUBLE)::FLOAT - 0.5) / 0.25) AS v
      FROM plan JOIN images USING (uid))
    SELECT uid, draw::BIGINT AS draw, {sql_checksum("v", 2)} AS staged_sum, {sql_checksum("v", 2)} AS whole_sum FROM views""",
)
def _(spark, sf):
    before, after = cf.split_collate(STAGED)
    planned = ap.plan_draws(images(spark, sf), STAGED, DRAWS, SEED, "uid", 8, 8)
    first = [s for s in cf.steps_from_config(before) if s.name != "to_tensor"]
    second = cf.after_collate_steps(cf.steps_from_config(STAGED))
    assert {s.name for s in second} - {"to_tensor"} == set(after)
    whole = cf.steps_from_config(STAGED)
    each = planned.select("uid", "image", F.posexplode_outer("params").alias("draw", "p"))
    shaped = each.withColumn("shaped", augment.apply_geometry(F.col("image"), first, F.col("p")))
    staged = shaped.withColumn("staged", augment.apply_geometry(F.col("shaped"), second, F.col("p")))
    return staged.select(
        "uid",
        F.col("draw").cast("bigint").alias("draw"),
        checksum(F.col("staged"), 2).alias("staged_sum"),
        checksum(augment.apply_geometry(F.col("image"), whole, F.col("p")), 2).alias("whole_sum"),
    )


# Each nation's pixels of customers are prepared for that nation's teacher.
@check(
    "teacher_preset",
    """WITH presets AS (SELECT n_nationkey, 160 + 16 * n_regionkey + n_nationkey AS side, 0.8 + 0.01 * n_regionkey AS pct FROM nation)
    SELECT c_custkey, CASE WHEN n_nationkey < 10 THEN side + 32 ELSE side END::BIGINT AS crop,
      floor(CASE WHEN n_nationkey < 10 THEN side + 32 ELSE side END::DOUBLE / pct::DOUBLE)::BIGINT AS resize,
      round(0.4 + 0.01 * n_nationkey, 4)::DOUBLE AS mean FROM customer JOIN presets ON c_nationkey = n_nationkey""",
)
def _(spark, sf):
    side = 160 + 16 * F.col("n_regionkey") + F.col("n_nationkey")
    presets = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("teacher"),
        F.array(F.lit(3), side, side).alias("input_size"),
        F.when(F.col("n_nationkey") < 10, F.array(F.lit(3), side + 32, side + 32)).alias("test_input_size"),
        F.round(0.8 + 0.01 * F.col("n_regionkey"), 2).alias("crop_pct"),
        F.array(F.round(0.4 + 0.01 * F.col("n_nationkey"), 4)).alias("mean"),
        F.array(F.lit(0.25)).alias("std"),
    )
    customers = table(spark, sf, "customer").withColumn("teacher", F.col("c_nationkey"))
    return augment.teacher_preset(customers, presets, "teacher").select(
        "c_custkey",
        F.col("crop").cast("bigint").alias("crop"),
        F.col("resize").cast("bigint").alias("resize"),
        F.get("mean", F.lit(0)).alias("mean"),
    )


# Pixel operations whose result is exact; one row per image and operation.
POINT_OPS = {
    "Identity": (0.0, "px"),
    "ShearX": (0.25, None),
    "ShearY": (-0.25, None),
    "TranslateX": (2.7, None),
    "TranslateY": (-3.2, None),
    "Rotate": (20.0, None),
    "Brightness": (0.5, "list_transform(px, lambda x: floor(least(1.5 * x, 255)))"),
    "Contrast": (
        -0.5,
        "list_transform(px, lambda x: floor(0.5::DOUBLE * x + 0.5::DOUBLE * (list_sum(px) / 64)))",
    ),
    "Posterize": (4.0, "list_transform(px, lambda x: floor(x / 16) * 16)"),
    "Solarize": (120.0, "list_transform(px, lambda x: CASE WHEN x >= 120 THEN 255 - x ELSE x END)"),
    "AutoContrast": (
        0.0,
        """list_transform(px, lambda x: CASE WHEN list_max(px) > list_min(px)
        THEN floor((x - list_min(px)) * 255 / (list_max(px) - list_min(px))) ELSE x END)""",
    ),
    "Invert": (0.0, "list_transform(px, lambda x: 255 - x)"),
}


def _warped(row: str, col: str) -> str:
    """Nearest-pixel warp; the expressions give source coordinates from pixel centres y, x."""
    y, x = "(i // 8 + 0.5 - 4)", "(i % 8 + 0.5 - 4)"
    r = f"round_even({row.format(x=x, y=y)} + 3.5, 0)::BIGINT"
    k = f"round_even({col.format(x=x, y=y)} + 3.5, 0)::BIGINT"
    return (
        f"list_transform(range(64), lambda i: CASE WHEN {r} BETWEEN 0 AND 7 AND {k} BETWEEN 0 AND 7 "
        f"THEN px[{r} * 8 + {k} + 1] ELSE 0 END)"
    )


_SIN, _COS = f8(math.sin(math.radians(20.0))), f8(math.cos(math.radians(20.0)))
_WARPS = {
    "ShearX": _warped("{y}", "{x} + 0.25 * ({y} + 4)"),
    "ShearY": _warped("{y} - 0.25 * ({x} + 4)", "{x}"),
    "TranslateX": _warped("{y}", "{x} - 2"),
    "TranslateY": _warped("{y} + 3", "{x}"),
    "Rotate": _warped(f"{_COS} * {{y}} + {_SIN} * {{x}}", f"{_COS} * {{x}} - {_SIN} * {{y}}"),
}


@check(
    "apply_rand_augment",
    f"WITH {IMAGES} "
    + " UNION ALL ".join(
        f"SELECT uid, '{op}' AS op, {sql_checksum(sql or _WARPS[op])} AS view_sum FROM images"
        for op, (_, sql) in POINT_OPS.items()
    ),
)
def _(spark, sf):
    plans = F.array(
        *[
            F.struct(F.lit(op).alias("name"), F.lit(policies.ALL_OPS.index(op)).alias("op"), F.lit(m).alias("magnitude"))
            for op, (m, _) in POINT_OPS.items()
        ]
    )
    each = images(spark, sf).withColumn("plan", F.explode(plans))
    each = each.withColumn("ops", F.array(F.struct("plan.op", "plan.magnitude")))
    done = augment.apply_rand_augment(each, "image", "ops", "view")
    return done.select("uid", F.col("plan.name").alias("op"), checksum(F.col("view")).alias("view_sum"))


def _interpolated(row: str, col: str) -> str:
    """Bilinear warp, rounded to whole values; pixels outside count as zero."""
    y, x = "(i // 8 + 0.5 - 4)", "(i % 8 + 0.5 - 4)"
    r, k = f"({row.format(x=x, y=y)} + 3.5)::DOUBLE", f"({col.format(x=x, y=y)} + 3.5)::DOUBLE"
    taps = []
    for down in (0, 1):
        for right in (0, 1):
            a, b = f"(floor({r})::BIGINT + {down})", f"(floor({k})::BIGINT + {right})"
            pixel = f"(CASE WHEN {a} BETWEEN 0 AND 7 AND {b} BETWEEN 0 AND 7 THEN px[{a} * 8 + {b} + 1] ELSE 0 END)"
            taps.append(f"(1 - abs({r} - {a})) * (1 - abs({k} - {b})) * {pixel}")
    return f"list_transform(range(64), lambda i: round_even({' + '.join(taps)}, 0))"


_SHIFTS = {
    "ShearX": ("{y}", "{x} + 0.3125 * ({y} + 4)"),
    "ShearY": ("{y} - 0.3125 * ({x} + 4)", "{x}"),
    "Rotate": (f"{_COS} * {{y}} + {_SIN} * {{x}}", f"{_COS} * {{x}} - {_SIN} * {{y}}"),
}
# Magnitudes that belong to them.
SHIFTS = {"ShearX": 0.3125, "ShearY": -0.3125, "Rotate": 20.0}


@check(
    "policy_interpolation",
    f"WITH {IMAGES} "
    + " UNION ALL ".join(f"SELECT uid, '{op}' AS op, {sql_checksum(_interpolated(*at))} AS view_sum FROM images" for op, at in _SHIFTS.items()),
)
def _(spark, sf):
    """Operations in front of a teacher interpolate, as its configuration says or by default."""
    config = {"auto_augment": {}}
    steps = cf.steps_from_config(config, cf.TEACHER_ORDER)
    plans = [
        F.struct(
            F.lit(op).alias("name"),
            F.array(F.struct(F.lit(policies.ALL_OPS.index(op)).alias("op"), F.lit(m).alias("magnitude"))).alias("auto_augment"),
        )
        for op, m in SHIFTS.items()
    ]
    each = images(spark, sf).withColumn("plan", F.explode(F.array(*plans)))
    drawn_ops = each.withColumn("params", F.array(F.struct("plan.auto_augment")))
    done = augment.apply_views(drawn_ops, steps, "image", "params")
    return done.select("uid", F.col("plan.name").alias("op"), checksum(F.get("views", F.lit(0))).alias("view_sum"))


# Operations that look at neighbours, channels or the whole image: 32 x 32 pixels, three channels.
RGB_OPS = {"Color": 0.4, "Contrast": -0.5, "Sharpness": 0.5, "AutoContrast": 0.0, "Equalize": 0.0}


def sql_blend(op: str, other: str) -> str:
    ratio = 1.0 + RGB_OPS[op]
    return f"floor(greatest(0, least(255, {f8(ratio)} * x + {f8(1.0 - ratio)} * {other})))"


RGB_SQL = f"""{IMAGES}, cells AS (SELECT uid, unnest(range(1024)) AS p, px FROM images),
    rgb AS (SELECT uid, p // 32 AS r, p % 32 AS k, [px[(p // 256) * 16 + (p % 32 // 8) * 4 + c] FOR c IN [1, 2, 3]] AS rgb FROM cells),
    grey AS (SELECT *, floor(0.2989::DOUBLE * rgb[1] + 0.587::DOUBLE * rgb[2] + 0.114::DOUBLE * rgb[3]) AS grey FROM rgb),
    mean AS (SELECT *, avg(grey) OVER (PARTITION BY uid) AS mean FROM grey),
    wide AS (SELECT uid, r, k, c, rgb[c + 1] AS x, grey, mean, min(rgb[c + 1]) OVER w AS lo, max(rgb[c + 1]) OVER w AS hi
      FROM mean, (SELECT unnest(range(3)) AS c) WINDOW w AS (PARTITION BY uid, c)),
    blur AS (SELECT *, sum(x) OVER (PARTITION BY uid, c, r ORDER BY k ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS line FROM wide),
    sharp AS (SELECT *, CASE WHEN r IN (0, 31) OR k IN (0, 31) THEN x ELSE round_even((4 * x +
      sum(line) OVER (PARTITION BY uid, c, k ORDER BY r ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)) / 13.0::DOUBLE, 0) END AS soft FROM blur),
    hist AS (SELECT uid, c, x, count(*) AS n FROM wide GROUP BY ALL),
    cum AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY uid, c ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
      (1024 - arg_max(n, x) OVER (PARTITION BY uid, c)) // 255 AS step FROM hist),
    lut AS (SELECT uid, c, x, CASE WHEN step = 0 THEN x ELSE least(255, (before + step // 2) // step) END AS y FROM cum),
    done AS (SELECT s.uid, r * 96 + k * 3 + c + 1 AS weight, {{'Color': {sql_blend("Color", "grey")}, 'Contrast': {sql_blend("Contrast", "mean")},
      'Sharpness': {sql_blend("Sharpness", "soft")},
      'AutoContrast': CASE WHEN hi > lo THEN floor((x - lo) * 255.0::DOUBLE / (hi - lo)) ELSE x END, 'Equalize': y}} AS v
      FROM sharp s JOIN lut USING (uid, c, x))"""


@check(
    "apply_rand_augment_rgb",
    f"WITH {RGB_SQL} "
    + " UNION ALL ".join(
        f"SELECT uid, '{op}' AS op, round(sum(v['{op}'] * weight), 0)::DOUBLE AS view_sum FROM done GROUP BY uid" for op in RGB_OPS
    ),
)
def _(spark, sf):
    plans = F.array(
        *[
            F.struct(F.lit(op).alias("name"), F.lit(policies.ALL_OPS.index(op)).alias("op"), F.lit(m).alias("magnitude"))
            for op, m in RGB_OPS.items()
        ]
    )
    rgb = images(spark, sf, 4, 4, 4).withColumn("image", px.resize_nearest(px.to_rgb(F.col("image")), 32, 32))
    each = rgb.withColumn("plan", F.explode(plans)).withColumn("ops", F.array(F.struct("plan.op", "plan.magnitude")))
    done = augment.apply_rand_augment(each, "image", "ops", "view")
    return done.select("uid", F.col("plan.name").alias("op"), checksum(F.col("view"), 0).alias("view_sum"))


@check("rand_augment_views")
def _(spark, sf):
    """All fourteen operations as drawn, on three-channel images."""
    config = {"rand_augment": {"p": 0.9, "num_ops": 3}, "to_tensor": {}}
    rgb = images(spark, sf, 4, 4, 4).withColumn("image", px.to_rgb(F.col("image")))
    planned = ap.plan_draws(rgb, config, DRAWS, SEED, "uid", 4, 4)
    return long_views(augment.apply_views(planned, cf.steps_from_config(config), "image", "params"))


# Mixing: partners by buckets of about 32 records.
BATCH = 32


def buckets_of(df) -> int:
    return max(1, math.ceil(df.count() / BATCH))


def paired(spark, sf):
    i = images(spark, sf)
    return mixing.draw_pairs(i, ["uid"], buckets_of(i), SEED, ["uid", "image", "label"])


PAIRS = f"""{IMAGES}, placed AS (SELECT *, floor({sql_u(SEED, "uid", "0", "'pair.bucket'")} *
      (SELECT ceil(count(*) / {BATCH}.0) FROM images))::BIGINT AS bucket, {sql_u(SEED, "uid", "0", "'pair.order'")} AS turn FROM images),
    turned AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY turn, uid) AS r, count(*) OVER (PARTITION BY bucket) AS n FROM placed),
    pairs AS (SELECT a.uid, a.label, a.px, b.uid AS uid2, b.label AS label2, b.px AS px2, 0 AS draw
      FROM turned a JOIN turned b ON a.bucket = b.bucket AND b.r = a.r % a.n + 1)"""


@check("draw_pairs", f"WITH {PAIRS} SELECT uid, uid2, label::BIGINT AS label, label2::BIGINT AS label2 FROM pairs")
def _(spark, sf):
    # Partners are kept as ids and fetched again, as a replay does.
    stored = paired(spark, sf).select("uid", "label", F.col("uid2").alias("id2"))
    fetched = mixing.with_partner(stored, images(spark, sf), "id2", "uid", ["label"])
    return fetched.select(
        "uid",
        F.col("id2").alias("uid2"),
        F.col("label").cast("bigint").alias("label"),
        F.col("label2").cast("bigint").alias("label2"),
    )


def mix_draws():
    return dr.Draws(SEED, F.col("uid"), F.lit(0))


@check(
    "mixup_plan",
    f"""WITH {IMAGES}, {D} SELECT uid, draw::BIGINT AS draw, CASE WHEN {u("'mixup.skip'")} <= 0.8 THEN round({u("'mixup.lambda'")} / 2, 12) ELSE -1 END AS lam,
      1 AS off FROM d""",
)
def _(spark, sf):
    d = draws_of()
    return drawn(spark, sf).select(
        "uid",
        F.col("draw").cast("bigint").alias("draw"),
        F.coalesce(F.round(mixing.mixup_plan(d, 1.0, 0.8, 2.0), 12), F.lit(-1.0)).alias("lam"),
        mixing.mixup_plan(d, alpha=0).isNull().cast("int").alias("off"),
    )


_GRID = "[" + ", ".join(f8(v) for v in mixing._beta_half_quantiles(0.2)) + "]"


@check(
    "mixup_plan_beta",
    f"""WITH {IMAGES}, {D}, v AS (SELECT *, {u("'mixup.lambda'")} AS v FROM d), cell AS (SELECT *, least(v, 1 - v) * 1024 AS place FROM v),
    half AS (SELECT *, {_GRID} AS grid, floor(place)::INT AS cell FROM cell),
    low AS (SELECT *, pow(grid[cell + 1] + (grid[least(cell + 1, 512) + 1] - grid[cell + 1]) * (place - cell), 5.0::DOUBLE) AS low FROM half)
    SELECT uid, draw::BIGINT AS draw, round(CASE WHEN v < 0.5 THEN low ELSE 1 - low END, 9) + 0.0 AS lam FROM low""",
)
def _(spark, sf):
    """Weights of a Beta distribution other than the uniform one."""
    lam = F.round(mixing.mixup_plan(draws_of(), 0.2), 9)
    return drawn(spark, sf).select("uid", F.col("draw").cast("bigint").alias("draw"), lam.alias("lam"))


_MIX = sql_u(SEED, "uid", "0", "'mixup.lambda'")


@check(
    "mixup",
    f"""WITH {PAIRS}, w AS (SELECT *, {_MIX} AS lam FROM pairs)
    SELECT uid, {sql_checksum("list_transform(range(64), lambda i: (lam * px[i + 1] + (1 - lam) * px2[i + 1])::FLOAT)", 1)} AS view_sum,
      round(list_sum(list_transform(range(10), lambda i: i * (lam * (label = i)::INT + (1 - lam) * (label2 = i)::INT))), 6) AS label_mean
    FROM w""",
)
def _(spark, sf):
    lam = mixing.mixup_plan(mix_draws())
    p = paired(spark, sf).withColumn("lam", lam)
    label = mixing.mix_labels(mixing.one_hot(F.col("label"), 10), mixing.one_hot(F.col("label2"), 10), F.col("lam"))
    mean = F.aggregate(F.transform(label, lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x)
    return p.select(
        "uid",
        checksum(mixing.mixup(F.col("image"), F.col("image2"), F.col("lam")), 1).alias("view_sum"),
        F.round(mean, 6).alias("label_mean"),
    )


def sql_cutmix(h: int, w: int, source: str) -> str:
    """CTE ``cut`` with the box of each row of ``source``."""
    return f"""cut_c AS (SELECT *, {u("'cutmix.lambda'")} AS lam, {integer("'cutmix.x'", "0", str(h))} AS cx,
      {integer("'cutmix.y'", "0", str(w))} AS cy FROM {source}),
    cut_s AS (SELECT *, floor(floor({h} * sqrt(1.0::DOUBLE - lam)) / 2)::BIGINT AS hh, floor(floor({w} * sqrt(1.0::DOUBLE - lam)) / 2)::BIGINT AS hw FROM cut_c),
    cut AS (SELECT *, greatest(cx - hh, 0) AS x1, greatest(cy - hw, 0) AS y1, least(cx + hh, {h}) AS x2, least(cy + hw, {w}) AS y2 FROM cut_s)"""


@check(
    "cutmix_plan",
    f"""WITH {IMAGES}, {D}, {sql_cutmix(224, 160, "d")}
    SELECT uid, draw::BIGINT AS draw, CASE WHEN kept THEN round(lam, 12) ELSE -1 END AS lam, CASE WHEN kept THEN x1 ELSE -1 END AS x1,
      CASE WHEN kept THEN y1 ELSE -1 END AS y1, CASE WHEN kept THEN x2 ELSE -1 END AS x2, CASE WHEN kept THEN y2 ELSE -1 END AS y2
    FROM (SELECT *, {u("'cutmix.skip'")} <= 0.6 AS kept FROM cut)""",
)
def _(spark, sf):
    d = drawn(spark, sf).withColumn("cut", mixing.cutmix_plan(draws_of(), 224, 160, p=0.6))
    return d.select(
        "uid",
        F.col("draw").cast("bigint").alias("draw"),
        F.coalesce(F.round("cut.lam", 12), F.lit(-1.0)).alias("lam"),
        *[or_minus_one(F.col(f"cut.{k}")).alias(k) for k in ("x1", "y1", "x2", "y2")],
    )


_IN_BOX = "(i // 8 >= x1 AND i // 8 < x2 AND i % 8 >= y1 AND i % 8 < y2)"


@check(
    "cutmix",
    f"""WITH {PAIRS}, {sql_cutmix(8, 8, "pairs")}, w AS (SELECT *, 1 - (x2 - x1) * (y2 - y1) / 64.0::DOUBLE AS weight FROM cut)
    SELECT uid, {sql_checksum(f"list_transform(range(64), lambda i: CASE WHEN {_IN_BOX} THEN px2[i + 1] ELSE px[i + 1] END)")} AS view_sum,
      round(weight * label + (1 - weight) * label2, 6) AS label_mean FROM w""",
)
def _(spark, sf):
    p = paired(spark, sf).withColumn("cut", mixing.cutmix_plan(mix_draws(), 8, 8))
    weight = mixing.cutmix_label_weight(F.col("cut"), 8, 8)
    label = mixing.mix_labels(mixing.one_hot(F.col("label"), 10), mixing.one_hot(F.col("label2"), 10), weight)
    mean = F.aggregate(F.transform(label, lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x)
    return p.select(
        "uid",
        checksum(mixing.cutmix(F.col("image"), F.col("image2"), F.col("cut"))).alias("view_sum"),
        F.round(mean, 6).alias("label_mean"),
    )


@check(
    "one_hot",
    "SELECT vec_id, array_to_string(list_transform(range(10), lambda i: (label = i)::INT), '') AS vector FROM embeddings",
)
def _(spark, sf):
    vector = mixing.one_hot(F.col("label"), 10).cast("array<int>").cast("array<string>")
    return table(spark, sf, "embeddings").select("vec_id", F.array_join(vector, "").alias("vector"))


@check(
    "mix_one_of",
    f"""WITH {PAIRS}, {sql_cutmix(8, 8, "pairs")}, w AS (SELECT *, {sql_u(SEED, "uid", "0", "'mix.choice'")} < 0.5 AS soft,
      {_MIX} AS m, 1 - (x2 - x1) * (y2 - y1) / 64.0::DOUBLE AS weight FROM cut)
    SELECT uid, CASE WHEN soft THEN {sql_checksum("list_transform(range(64), lambda i: (m * px[i + 1] + (1 - m) * px2[i + 1])::FLOAT)", 1)}
      ELSE {sql_checksum(f"list_transform(range(64), lambda i: CASE WHEN {_IN_BOX} THEN px2[i + 1] ELSE px[i + 1] END)", 1)} END AS view_sum,
      round(CASE WHEN soft THEN m * label + (1 - m) * label2 ELSE weight * label + (1 - weight) * label2 END, 6) AS label_mean FROM w""",
)
def _(spark, sf):
    p = paired(spark, sf)
    mixed = mixing.mix_one_of(
        F.col("image"),
        F.col("image2"),
        mixing.one_hot(F.col("label"), 10),
        mixing.one_hot(F.col("label2"), 10),
        mix_draws(),
        {"mixup": {}, "cutmix": {}},
    )
    p = p.withColumn("mixed", mixed)
    mean = F.aggregate(F.transform("mixed.label", lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x)
    return p.select("uid", checksum(F.col("mixed.image"), 1).alias("view_sum"), F.round(mean, 6).alias("label_mean"))


PAIR_CONFIG = {"random_crop": {"size": 6}, "random_horizontal_flip": {"p": 0.5}, "mixup": {}}


def _side(name: str, source: str, prefix: str) -> str:
    top = sql_int(SEED, "uid", "0", f"'{prefix}random_crop.top'", "0", "3")
    left = sql_int(SEED, "uid", "0", f"'{prefix}random_crop.left'", "0", "3")
    flip = f"{sql_u(SEED, 'uid', '0', chr(39) + prefix + 'random_horizontal_flip' + chr(39))} < 0.5"
    return (
        f"list_transform(range(36), lambda i: {source}[({top} + i // 6) * 8 + {left} + "
        f"(CASE WHEN {flip} THEN 5 - i % 6 ELSE i % 6 END) + 1]) AS {name}"
    )


@check(
    "apply_pair",
    f"""WITH {PAIRS}, sides AS (SELECT uid, uid2, {_MIX} AS lam, {_side("va", "px", "")}, {_side("vb", "px2", "b.")} FROM pairs)
    SELECT uid, {sql_checksum("list_transform(range(36), lambda i: (lam * va[i + 1] + (1 - lam) * vb[i + 1])::FLOAT)", 1)} AS view_sum,
      {sql_checksum("list_transform(range(36), lambda i: (lam * va[i + 1] + (1 - lam) * vb[i + 1])::FLOAT)", 1)} AS replayed_sum,
      uid2 AS id2 FROM sides""",
)
def _(spark, sf):
    steps = cf.steps_from_config(PAIR_CONFIG)
    p = paired(spark, sf)
    planned = ap.plan_draws(p, PAIR_CONFIG, 1, SEED, "uid", 8, 8, second_shape=(8, 8))
    stored = planned.withColumn("param_aug", ap.compress_draws(F.col("params"), steps, F.col("uid2")))
    read = stored.withColumn("again", F.get(ap.decompress_draws(F.col("param_aug"), steps, paired=True), F.lit(0)))
    first = F.get("params", F.lit(0))
    return read.select(
        "uid",
        checksum(augment.apply_pair(F.col("image"), F.col("image2"), steps, first), 1).alias("view_sum"),
        checksum(augment.apply_pair(F.col("image"), F.col("image2"), steps, F.col("again"), replay=True), 1).alias("replayed_sum"),
        F.col("again.id2").alias("id2"),
    )
