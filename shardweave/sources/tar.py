"""Tar shards whose members are named ``<record>.<kind>``: reading samples and rendering members."""

from __future__ import annotations

import io
import json
import re
import tarfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from shardweave.functions.packing import matrices_to_arrow, npz_arrays
from shardweave.operators.records import REST, as_struct, key_json, rest_of
from shardweave.sources.files import open_fs, packed, plan_ranges
from shardweave.sources.jsonl import field_of

SAMPLE = (
    "uid STRING, url STRING, text STRING, image BINARY, json STRING,"
    " arrays MAP<STRING, ARRAY<ARRAY<FLOAT>>>, _shard STRING, _pos STRUCT<block: BIGINT, line: BIGINT>"
)
_ARROW_SAMPLE = pa.schema(
    [
        ("uid", pa.string()),
        ("url", pa.string()),
        ("text", pa.string()),
        ("image", pa.binary()),
        ("json", pa.string()),
        ("arrays", pa.map_(pa.string(), pa.list_(pa.list_(pa.float32())))),
        ("_shard", pa.string()),
        ("_pos", pa.struct([("block", pa.int64()), ("line", pa.int64())])),
    ]
)
BATCH_ROWS, BATCH_BYTES = 1024, 8 << 20


def split_member(name: str) -> tuple[str, str]:
    """Record key (folder and text before the base name's first dot) and kind of a member."""
    folder, slash, base = name.rpartition("/")
    stem, _, kind = base.partition(".")
    return folder + slash + stem, kind


# Keys of members: what would end the key is escaped, a missing one has a name of its own, and a record whose
# key is that of the record before it gets a number, so that both stay apart.
NO_KEY, AGAIN = "%0", "%r"


def member_key(key: str | None) -> str:
    """A record's key as it stands in member names."""
    return NO_KEY if key is None else key.replace("%", "%25").replace(".", "%2E")


def record_key(name: str) -> str | None:
    """The key that :func:`member_key` has written, without the number of a repetition."""
    name = re.sub(f"{AGAIN}\\d+$", "", name)
    return None if name == NO_KEY else name.replace("%2E", ".").replace("%25", "%")


def sample_starts(file, size: int) -> Iterator[int]:
    """Offsets of the headers at which the record key changes."""
    previous = None
    with tarfile.open(fileobj=file, mode="r:") as archive:
        for member in archive:
            if member.isfile():
                key = split_member(member.name)[0]
                if key != previous:
                    yield member.offset
                previous = key


class _Window(io.RawIOBase):
    """A file cut off at ``stop``, for sequential reading."""

    def __init__(self, file, start: int, stop: int):
        self._file, self._left = file, stop - start
        file.seek(start)

    def read(self, n: int = -1) -> bytes:
        data = self._file.read(self._left if n < 0 else min(n, self._left))
        self._left -= len(data)
        return data


def _add_member(sample: dict, kind: str, content: bytes, name: str) -> None:
    """Put one member into the sample of its record."""
    if kind == "url.txt":
        sample["url"] = content.decode("utf-8")
    elif kind == "txt":
        sample["text"] = content.decode("utf-8")
    elif kind == "jpg":
        sample["image"] = content
    elif kind.endswith("json"):
        sample.setdefault("_json", []).append(content.decode("utf-8"))
    elif kind == "npz":
        sample.setdefault("arrays", {}).update(npz_arrays(content))
    elif kind == "npy":
        values = np.load(io.BytesIO(content), allow_pickle=False)
        sample.setdefault("arrays", {})["npy"] = np.atleast_2d(values.astype(np.float32))
    else:
        raise ValueError(f"unsupported member: {name}")


def _finished(sample: dict, path: str) -> dict:
    """The sample as a row; later JSON members win over earlier ones key by key."""
    texts = sample.pop("_json", [])
    merged = texts[0] if len(texts) == 1 else None
    if len(texts) > 1:
        keys: dict = {}
        for text in texts:
            keys.update(json.loads(text))
        merged = json.dumps(keys, ensure_ascii=False, separators=(",", ":"))
    arrays = sample.get("arrays")
    return {
        **{k: sample.get(k) for k in ("uid", "url", "text", "image")},
        "json": merged,
        "arrays": arrays or None,
        "_shard": path,
        "_pos": {"block": 0, "line": sample["_at"]},
    }


def _samples(path: str, start: int, stop: int) -> Iterator[dict]:
    """Samples of one range of a shard; members are streamed, one sample is held at a time."""
    fs, inner = open_fs(path)
    with fs.open_input_file(inner) as file:
        with tarfile.open(fileobj=_Window(file, start, stop), mode="r|") as archive:
            sample: dict = {}
            for member in archive:
                if not member.isfile():
                    continue
                key, kind = split_member(member.name)
                if sample and sample["_key"] != key:
                    yield _finished(sample, path)
                    sample = {}
                if not sample:
                    sample = {"_key": key, "uid": record_key(key), "_at": start + member.offset}
                _add_member(sample, kind, archive.extractfile(member).read(), member.name)
            if sample:
                yield _finished(sample, path)


def _row_bytes(row: dict) -> int:
    texts = sum(len(v) for v in row.values() if isinstance(v, (str, bytes)))
    return texts + sum(a.nbytes for a in (row["arrays"] or {}).values())


def _batch(rows: list[dict]) -> pa.RecordBatch:
    """Rows as an Arrow batch; the matrices go over without becoming Python lists."""
    plain = pa.schema([f for f in _ARROW_SAMPLE if f.name != "arrays"])
    columns = pa.RecordBatch.from_pylist([{k: r[k] for k in plain.names} for r in rows], schema=plain)
    named = [list((r["arrays"] or {}).items()) for r in rows]
    # A null offset marks a row without a map.
    ends = np.cumsum([0, *[len(n) for n in named]]).tolist()
    offsets = [None if r["arrays"] is None else end for r, end in zip(rows, ends)] + [ends[-1]]
    maps = pa.MapArray.from_arrays(
        pa.array(offsets, pa.int32()),
        pa.array([k for n in named for k, _ in n], pa.string()),
        matrices_to_arrow([m for n in named for _, m in n]),
    )
    arrays = [maps if f.name == "arrays" else columns.column(f.name) for f in _ARROW_SAMPLE]
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW_SAMPLE)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for work in batch.to_pylist():
            rows, size = [], 0
            for row in _samples(work["path"], work["start"], work["stop"]):
                rows.append(row)
                size += _row_bytes(row)
                if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)


def read_tar_samples(
    spark: SparkSession,
    paths: DataFrame | list[str],
    schema: T.StructType | str | None = None,
    split_bytes: int = 1 << 30,
    keys: str | None = None,
) -> DataFrame:
    """Samples of tar shards: consecutive members of one record make one row.

    The keys of the JSON members become columns when ``schema`` names them, otherwise they stay in
    ``json``. Vectors of npz members are in ``arrays``, or in the columns that ``schema`` names. With a
    schema, all that it does not name (of the keys that ``keys`` matches from their start) is in ``_rest``.
    """
    if not isinstance(paths, DataFrame):
        paths = spark.createDataFrame([(p,) for p in paths], "path STRING")
    ranges = packed(plan_ranges(paths, sample_starts, split_bytes))
    samples = ranges.mapInArrow(_read, SAMPLE)
    if schema is None:
        return samples
    known = ("uid", "url", "text", "image")
    parsed = samples.withColumn("_parsed", F.try_parse_json("json"))
    columns = {}
    for field in as_struct(schema).fields:
        value = field_of(F.col("_parsed"), field)
        if field.name in known:
            value = F.coalesce(F.col(field.name).cast(field.dataType), value)
        elif field.dataType == T.ArrayType(T.ArrayType(T.FloatType())):
            value = F.coalesce(F.try_element_at("arrays", F.lit(field.name)), value)
        columns[field.name] = value
    open_members = [n for n in known if n not in columns and (keys in (None, ".*") or re.match(keys, n))]
    typed = parsed.select(
        *[value.alias(name) for name, value in columns.items()],
        "_shard",
        "_pos",
        "_parsed",
        F.struct(*known, "arrays").alias("_members"),
    )
    here = {name: F.col(name) for name in columns} | {name: F.col(f"_members.{name}") for name in open_members}
    parts = [F.when(F.col(f"_members.{name}").isNotNull(), key_json(name, F.col(f"_members.{name}"))) for name in open_members]
    taken = F.array(F.lit(None).cast("string"), *[F.lit(name) for name in columns])
    vectors = F.map_filter("_members.arrays", lambda k, _: ~F.coalesce(F.array_contains(taken, k), F.lit(False)))
    if keys not in (None, ".*"):
        vectors = F.map_filter(vectors, lambda k, _: k.rlike(f"^(?:{keys})"))
    inner = [rest_of(F.col("_parsed"), here, keys), F.when(F.size(F.map_keys(vectors)) > 0, F.to_json(vectors))]
    text = F.concat_ws(",", *parts, *[F.substr(o, F.lit(2), F.length(o) - 2) for o in inner])
    rest = F.when(text != "", F.concat(F.lit("{"), text, F.lit("}")))
    return typed.withColumn(REST, rest).drop("_parsed", "_members")


def tar_entry(name: str, content: bytes) -> bytes:
    """Header and padded content of one member; fixed owner and time keep reruns identical."""
    info = tarfile.TarInfo(name)
    info.size, info.mode = len(content), 0o444
    header = info.tobuf(tarfile.PAX_FORMAT)
    return header + content + b"\0" * (-len(content) % tarfile.BLOCKSIZE)


# Two empty blocks end a tar file.
TAR_TRAILER = b"\0" * (2 * tarfile.BLOCKSIZE)


@arrow_udf(T.BinaryType())
def _render(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    before, times = "", 0
    for keys, members in batches:  # the rows of a shard come in order, so repetitions stand side by side
        chunks = []
        for key, entries in zip(keys.to_pylist(), members.to_pylist()):
            name = member_key(key)
            times = times + 1 if name == before else 0
            before = name
            if times:
                name = f"{name}{AGAIN}{times}"
            chunks.append(b"".join(tar_entry(f"{name}.{ext}", content) for ext, content in entries))
        yield pa.array(chunks, pa.binary())


def to_tar_chunk(key: Column, members: Column) -> Column:
    """All members of a sample as the bytes that go into the shard."""
    return _render(key, members)
