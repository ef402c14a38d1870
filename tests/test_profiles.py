"""Teachers on executors of their own: stage-level resources around an enrichment."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import functions as F

from shardweave.functions import tensor as px
from shardweave.operators import infer, runs
from shardweave.operators.teachers import HashCaption, HashClip, HashText, TeacherSpec

CONFIG = {"random_resized_crop": {"size": 4}, "uint8": {}}


def gpu_profile():
    return ResourceProfileBuilder().require(TaskResourceRequests().cpus(1).resource("gpu", 1)).build


def images(spark, n=50):
    pixels = F.transform(F.sequence(F.lit(1), F.lit(36)), lambda k: (k * F.col("id") % 251).cast("float"))
    return spark.range(n).select(
        F.col("id").cast("string").alias("uid"),
        px.tensor(pixels, 6, 6, 1).alias("image"),
        F.encode(F.col("id").cast("string"), "UTF-8").alias("_image"),
        (F.col("id") % 5 > 0).alias("_valid"),
        F.when(F.col("id") % 7 > 0, F.array(F.col("id").cast("string"), F.lit("b c"))).alias("_texts"),
        F.struct(F.col("id").alias("block")).alias("_pos"),
        F.create_map(F.lit("k"), "id").alias("_rest"),
    )


def enriched(df, profile=None):
    """The three enrichments, in batches that do not divide the partitions."""
    df = infer.add_captions(df, TeacherSpec(HashCaption), 3, batch_size=7, profile=profile)
    df = infer.add_image_embeddings(df, [TeacherSpec(HashClip, {"dim": 4})], 2, CONFIG, 3, batch_size=9, profile=profile)
    return infer.add_text_embeddings(df, [TeacherSpec(HashText, {"dim": 4})], 11, profile=profile)


def plan_of(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_each_enrichment_carries_the_profile(spark):
    plain, asked = enriched(images(spark)), enriched(images(spark), gpu_profile())
    assert plan_of(asked).count("gpu -> name: gpu, amount: 1.0") == 3
    assert "MapInArrow" not in plan_of(plain)
    assert dict(asked.dtypes) == dict(plain.dtypes)
    assert not [name for name in asked.columns if name.startswith("_input")]


@pytest.mark.parametrize("job", ["captions", "embeddings"])
def test_jobs_hand_the_profile_on(spark, job):
    rows = spark.createDataFrame([("1", "a b", "aGVsbG8=", "in.jsonl", 0)], "uid STRING, text STRING, image STRING, _shard STRING, _pos LONG")
    if job == "captions":
        found = runs.caption_records(rows, TeacherSpec(HashCaption), 2, "", 0, 4, gpu_profile())
        assert plan_of(found).count("gpu -> name") == 1
    else:
        decode = px.tensor(F.array_repeat(F.lit(1.0), 36), 6, 6, 1)
        teachers = [TeacherSpec(HashClip, {"dim": 4})]
        found = runs.embed_records(rows, teachers, CONFIG, 2, "", "syn_text", decode, 0, 4, gpu_profile())
        assert plan_of(found).count("gpu -> name") == 2


SCRIPT = """
import json, sys
from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import SparkSession
from tests.test_profiles import enriched, images
spark = SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.ui.enabled", "false").config(
    "spark.driver.host", "127.0.0.1").config("spark.executorEnv.PYTHONPATH", sys.argv[1]).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
profile = ResourceProfileBuilder().require(TaskResourceRequests().cpus(2)).build
both = [sorted(json.dumps(r.asDict(True), default=str, sort_keys=True) for r in enriched(images(spark), p).collect()) for p in (None, profile)]
print(json.dumps({"same": both[0] == both[1], "rows": len(both[0])}))
"""


def test_rows_are_the_same_on_executors_of_the_profile():
    """A profile needs a cluster, so this runs in a session of its own, with one executor."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = os.pathsep.join([root, os.environ.get("PYTHONPATH", "")])
    done = subprocess.run([sys.executable, "-c", SCRIPT, paths], capture_output=True, text=True, timeout=300, cwd=root, env={**os.environ, "PYTHONPATH": paths})
    assert done.returncode == 0, done.stderr[-2000:]
    assert json.loads(done.stdout.strip().splitlines()[-1]) == {"same": True, "rows": 50}
