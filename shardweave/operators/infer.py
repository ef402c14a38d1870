"""Model inference as part of a DataFrame: models are built once per worker, rows go in batches.

Only the model's inputs cross to Python (iterator Arrow UDFs); all other columns stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shardweave.functions.draws import uniform
from shardweave.functions.packing import matrices_to_arrow
from shardweave.functions.tensor import TENSOR
from shardweave.functions.text import clean_caption
from shardweave.operators import kernels
from shardweave.operators.augment import images_of, once, pinned, tensors_to_arrow, view_of
from shardweave.operators.teachers import TeacherSpec, loaded
from shardweave.plans.augment_plan import plan_draws
from shardweave.plans.config import Step, as_pair, steps_from_config

VECTORS = "ARRAY<ARRAY<FLOAT>>"


def full_batches(batches: Iterator[tuple[pa.Array, ...]], rows: int) -> Iterator[tuple[pa.Array, ...]]:
    """The same rows in batches of exactly ``rows`` (the last may be smaller), across Arrow's own batches.

    At most ``rows`` rows and one of Arrow's batches are held.
    """
    held: list[tuple[pa.Array, ...]] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch[0])
        if size < rows:
            continue
        whole = tuple(pa.concat_arrays(column) for column in zip(*held))
        start = 0
        while size - start >= rows:
            yield tuple(column.slice(start, rows) for column in whole)
            start += rows
        held, size = [tuple(column.slice(start) for column in whole)], size - start
    if size:
        yield tuple(pa.concat_arrays(column) for column in zip(*held))


def infer(
    df: DataFrame, model: TeacherSpec, batch_size: int, out_schema: str, profile: ResourceProfile | None = None
) -> DataFrame:
    """Rows in, rows out: call the worker's model on batches of ``batch_size`` rows, the last of a partition
    with what is left.

    The model is called with a pandas DataFrame and returns one; it may return any number of rows.
    ``profile`` asks for executors with the resources (GPUs) that the model needs. All columns of
    ``df`` go to Python, so select the model's inputs first.
    """

    def run(batches):
        fn = loaded(model)
        held, size = [], 0
        for pdf in batches:
            held.append(pdf)
            size += len(pdf)
            if size < batch_size:
                continue
            whole = pd.concat(held, ignore_index=True)
            full = size - size % batch_size
            for start in range(0, full, batch_size):
                yield fn(whole.iloc[start : start + batch_size].reset_index(drop=True))
            held, size = [whole.iloc[full:]], size - full
        if size:
            yield fn(pd.concat(held, ignore_index=True))

    return df.mapInPandas(run, out_schema, profile=profile)


def column_of(fn: Callable[..., pa.Array], kind: str, inputs: list[Column], batch_size: int) -> Column:
    """What ``fn`` returns for the ``inputs``, in batches of exactly ``batch_size`` rows (the last of a partition may be
    smaller); only the inputs cross to Python."""

    def results(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in full_batches((b if isinstance(b, tuple) else (b,) for b in batches), batch_size):
            yield fn(*batch)

    return once(arrow_udf(results, kind))(*inputs)


def with_result(
    df: DataFrame,
    out: str,
    kind: str,
    fn: Callable[..., pa.Array],
    inputs: list[Column],
    batch_size: int,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Add ``out``: what ``fn`` returns for the ``inputs``, see ``column_of``.

    A ``profile`` asks for executors with the resources
    (GPUs) that the model needs; Spark schedules whole stages by it, so the rows pass through one Arrow map,
    with the inputs beside them, and get their result in the same pass. What stands before that map up to the last
    shuffle runs in the same stage, on the same executors.
    """
    if profile is None:
        return df.withColumn(out, column_of(fn, kind, inputs, batch_size))
    names = [f"_input{k}" for k in range(len(inputs))]
    rows = df.drop(out)
    kept, width = rows.columns, len(rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in full_batches((tuple(batch.columns) for batch in batches), batch_size):
            yield pa.RecordBatch.from_arrays([*columns[:width], fn(*columns[width:])], names=[*kept, out])

    wide = df.withColumns(dict(zip(names, inputs))).select(*kept, *names)
    schema = rows.select("*", F.lit(None).cast(kind).alias(out)).schema
    return wide.mapInArrow(run, schema, profile=profile)


def _text_vectors(teachers: list[TeacherSpec], batch_size: int) -> Callable[[pa.Array], pa.Array]:
    """From lists of texts to their vectors; no teacher sees more than ``batch_size`` texts at once."""

    def vectors_of(batch: pa.Array) -> pa.Array:
        models, lists = [loaded(t) for t in teachers], batch.to_pylist()
        flat = ["" if t is None else t for texts in lists if texts is not None for t in texts]
        rows = [
            np.concatenate([m.embed_texts(flat[i : i + batch_size]) for m in models], axis=1)
            for i in range(0, len(flat), batch_size)
        ]
        vectors = np.concatenate(rows) if rows else np.empty((0, 0), np.float32)
        ends = np.cumsum([0 if t is None else len(t) for t in lists])
        parts = np.split(vectors, ends[:-1])
        return matrices_to_arrow([None if t is None else part for t, part in zip(lists, parts)])

    return vectors_of


def embed_texts(texts: Column, teachers: list[TeacherSpec], batch_size: int = 1024) -> Column:
    """One vector per text of an ARRAY<STRING>; the vectors of all teachers are joined in order."""
    return column_of(_text_vectors(teachers, batch_size), VECTORS, [texts], batch_size)


def add_text_embeddings(
    df: DataFrame,
    teachers: list[TeacherSpec],
    batch_size: int = 1024,
    out: str = "_text_emb",
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Add ``out``: the vectors of all texts of a valid record, in the order of ``_texts``; the vectors of all
    teachers are joined in order."""
    texts = F.when(F.col("_valid"), F.col("_texts"))
    return with_result(df, out, VECTORS, _text_vectors(teachers, batch_size), [texts], batch_size, profile)


def _span(lengths: Column, key: str) -> Column:
    """Where the texts of ``key`` start among all texts of a record (from 1), and how many they are."""

    def advance(acc: Column, entry: Column) -> Column:
        here = entry["key"] == key
        return F.struct(
            (acc["next"] + entry["len"]).alias("next"),
            F.when(here, acc["next"]).otherwise(acc["start"]).alias("start"),
            F.when(here, entry["len"]).otherwise(acc["n"]).alias("n"),
        )

    begin = F.struct(F.lit(1).alias("next"), F.lit(None).cast("int").alias("start"), F.lit(0).alias("n"))
    return F.aggregate(lengths, begin, advance)


def split_text_embeddings(
    df: DataFrame, keys: list[str], suffix: str = "", vectors: str = "_text_emb"
) -> DataFrame:
    """Give each source key its slice of the vectors, as ``<key>_emb<suffix>``.

    ``_text_lengths`` lists (key, length) in the order in which the texts were collected; a key that
    a record does not have stays null.
    """
    spans = {f"_span_{key}": _span(F.col("_text_lengths"), key) for key in keys}
    sliced = {}
    for key in keys:
        span = F.col(f"_span_{key}")
        present = F.col(vectors).isNotNull() & span["start"].isNotNull()
        own = F.slice(F.col(vectors), F.coalesce(span["start"], F.lit(1)), span["n"])
        sliced[f"{key}_emb{suffix}"] = F.when(present, own)
    return df.withColumns(spans).withColumns(sliced).drop(*spans)


def check_ensemble(teachers: list[TeacherSpec], steps: list[Step]) -> None:
    """Refuse a plan whose crop is smaller than a teacher's input or whose mean is not the teacher's."""
    crops = [s.size() for s in steps if s.name == "random_resized_crop"]
    means = [s.args["mean"] for s in steps if s.name == "normalize"]
    for teacher in teachers:
        if teacher.input_size is not None:
            if not crops or as_pair(teacher.input_size)[0] > crops[0][0]:
                raise ValueError("the crop must be at least as large as every teacher's input")
        if teacher.mean is not None and (not means or not np.allclose(teacher.mean, means[0], rtol=1e-7)):
            raise ValueError("normalisation mean differs from the teacher's")


def ensemble(parts: list[Column]) -> Column:
    """Join the vectors of several teachers, draw by draw."""
    joined = parts[0]
    for part in parts[1:]:
        joined = F.zip_with(joined, part, lambda a, b: F.concat(a, b))
    return joined


def _embed_views(views: list[np.ndarray], teachers: list[TeacherSpec]) -> np.ndarray:
    """Vectors of equally shaped views, all teachers side by side."""
    batch, parts = np.stack(views), []
    for spec in teachers:
        sized = batch
        if spec.input_size is not None and batch.shape[2] != as_pair(spec.input_size)[1]:
            sized = kernels.resample(batch, as_pair(spec.input_size), "bicubic")
        parts.append(loaded(spec).embed_images(sized))
    return np.concatenate(parts, axis=1)


def _embed_slice(images: list, draws: list, steps: list[Step], teachers: list[TeacherSpec]) -> pa.Array:
    """Vectors of all views of some images; the views do not outlive the slice."""
    views, owners = [], []
    for i, (image, params) in enumerate(zip(images, draws)):
        if image is not None:
            views.extend(view_of(image, steps, p) for p in params)
            owners.extend([i] * len(params))
    by_shape: dict[tuple, list[int]] = {}
    for position, view in enumerate(views):
        by_shape.setdefault(view.shape, []).append(position)
    vectors: list = [None] * len(views)
    for positions in by_shape.values():
        for position, vector in zip(positions, _embed_views([views[p] for p in positions], teachers)):
            vectors[position] = vector
    rows: list = [None if image is None else [] for image in images]
    for owner, vector in zip(owners, vectors):
        rows[owner].append(vector)
    return matrices_to_arrow([None if r is None else np.stack(r) if r else np.empty((0, 0)) for r in rows])


def embed_planned(
    df: DataFrame,
    image: str,
    params: str,
    steps: list[Step],
    teachers: list[TeacherSpec],
    out: str,
    batch_size: int = 256,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Add ``out``: one vector per planned draw of an image; views live only inside the batch."""

    def embed(images: pa.Array, _: pa.Array, drawn: pa.Array, __: pa.Array) -> pa.Array:
        tensors, draws = images_of(images), drawn.to_pylist()
        step = max(1, batch_size // max(1, max((len(d) for d in draws if d), default=1)))
        starts = range(0, len(tensors), step)
        return pa.concat_arrays([_embed_slice(tensors[k : k + step], draws[k : k + step], steps, teachers) for k in starts])

    return with_result(df, out, VECTORS, embed, pinned(image, params), batch_size, profile)


def add_image_embeddings(
    df: DataFrame,
    teachers: list[TeacherSpec],
    num_samples: int,
    aug_config: Mapping,
    seed: int,
    image: str = "image",
    uid: str = "uid",
    suffix: str = "",
    batch_size: int = 256,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Add ``image_emb<suffix>`` (one vector per draw) and ``params``, the drawn parameters."""
    steps = steps_from_config(aug_config)
    check_ensemble(teachers, steps)
    height, width = F.col(image)["h"], F.col(image)["w"]
    planned = plan_draws(df, aug_config, num_samples, seed, uid, height, width)
    if "_valid" in df.columns:
        planned = planned.withColumn("_usable", F.when(F.col("_valid"), F.col(image)))
    else:
        planned = planned.withColumn("_usable", F.col(image))
    embedded = embed_planned(planned, "_usable", "params", steps, teachers, f"image_emb{suffix}", batch_size, profile)
    return embedded.drop("_usable")


def add_captions(
    df: DataFrame,
    teacher: TeacherSpec,
    num_samples: int = 5,
    tag_suffix: str = "",
    seed: int = 0,
    uid: str = "uid",
    batch_size: int = 1024,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Add ``syn_text<tag_suffix>``: ``num_samples`` cleaned captions of each valid image.

    A teacher returns None for an image that it cannot decode; the record then gets no captions.
    """

    def caption(images: pa.Array, draws: pa.Array) -> pa.Array:
        model, raw, us = loaded(teacher), images.to_pylist(), draws.to_pylist()
        kept = [i for i, im in enumerate(raw) if im is not None]
        texts: list = [None] * len(raw)
        if kept:
            samples = [model.captions([raw[i] for i in kept], np.array([us[i][k] for i in kept])) for k in range(num_samples)]
            for position, i in enumerate(kept):
                found = [sample[position] for sample in samples]
                texts[i] = None if None in found else found
        return pa.array(texts, pa.list_(pa.string()))

    draws = F.transform(
        F.sequence(F.lit(0), F.lit(num_samples - 1)), lambda k: uniform(seed, F.col(uid), k, "caption")
    )
    out = f"syn_text{tag_suffix}"
    image = F.when(F.col("_valid"), F.col("_image"))
    raw = with_result(df, out, "ARRAY<STRING>", caption, [image, draws], batch_size, profile)
    return raw.withColumn(out, F.transform(out, clean_caption))


def resample(df: DataFrame, image: str, size: tuple[int, int], out: str, mode: str = "bicubic") -> DataFrame:
    """Add ``out``: the image resized to ``size`` by separable weights; equal shapes of a batch share one product."""

    @arrow_udf(TENSOR)
    def resize(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch, _ in batches:
            images = images_of(batch)
            by_shape: dict[tuple, list[int]] = {}
            for i, im in enumerate(images):
                if im is not None:
                    by_shape.setdefault(im.shape, []).append(i)
            out = [np.zeros((0, 0, 0), np.float32)] * len(images)
            for positions in by_shape.values():
                resized = kernels.resample(np.stack([images[i] for i in positions]), size, mode)
                for i, im in zip(positions, resized):
                    out[i] = im
            tensors = tensors_to_arrow(out)
            missing = pa.array([im is None for im in images], pa.bool_())
            yield pa.StructArray.from_arrays(
                [tensors.field(k) for k in ("h", "w", "c", "data")], ["h", "w", "c", "data"], mask=missing
            )

    return df.withColumn(out, once(resize)(F.col(image), F.col(image)["h"]))
