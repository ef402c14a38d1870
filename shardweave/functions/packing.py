"""Compact storage of embeddings: a described float32 block, gzipped, as base64 text or as npz."""

from __future__ import annotations

import base64
import gzip
import io
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

VECTORS = T.ArrayType(T.ArrayType(T.FloatType()))


def pack_matrix(vectors) -> str:
    """Header line (dtype, shape), little-endian values; gzip, base64."""
    block = np.asarray(vectors, dtype="<f4")
    header = json.dumps({"dtype": "<f4", "shape": list(block.shape)}) + "\n"
    return base64.b64encode(gzip.compress(header.encode() + block.tobytes(), mtime=0)).decode("ascii")


def unpack_matrix(text: str) -> np.ndarray:
    """Inverse of :func:`pack_matrix`."""
    raw = gzip.decompress(base64.b64decode(text, validate=True))
    header, values = raw.split(b"\n", 1)
    about = json.loads(header)
    return np.frombuffer(values, dtype=about["dtype"]).reshape(about["shape"])


def npz_bytes(arrays: dict[str, np.ndarray], bfloat16: bool = False) -> bytes:
    """Named matrices as an npz archive; bfloat16 ones are stored as their upper 16 bits, marked by
    the name suffix ``.bfloat16``."""
    out = io.BytesIO()
    if bfloat16:
        arrays = {
            f"{name}.bfloat16": (np.ascontiguousarray(a, "<f4").view("<u4") >> 16).astype("<u2")
            for name, a in arrays.items()
        }
    np.savez(out, **arrays)
    return out.getvalue()


def npz_arrays(raw: bytes) -> dict[str, np.ndarray]:
    """Inverse of :func:`npz_bytes`; object arrays are refused."""
    out = {}
    with np.load(io.BytesIO(raw), allow_pickle=False) as archive:
        for name in archive.files:
            values = archive[name]
            if name.endswith(".bfloat16"):
                name = name[: -len(".bfloat16")]
                values = (values.astype("<u4") << 16).view("<f4")
            out[name] = np.atleast_2d(np.asarray(values, dtype=np.float32))
    return out


def matrices_of(array: pa.Array) -> list[np.ndarray | None]:
    """Rows of an ARRAY<ARRAY<FLOAT>> column as matrices that share the column's memory."""
    rows = array.values
    ends, cuts = array.offsets.to_numpy(), rows.offsets.to_numpy()
    values = rows.values.to_numpy(zero_copy_only=False)
    out: list[np.ndarray | None] = []
    for i, present in enumerate(array.is_valid().to_pylist()):
        first, last = ends[i], ends[i + 1]
        if not present:
            out.append(None)
        elif first == last:
            out.append(np.empty((0, 0), np.float32))
        else:
            widths = np.diff(cuts[first : last + 1])
            if (widths != widths[0]).any():
                raise ValueError("the vectors of one record differ in length")
            out.append(values[cuts[first] : cuts[last]].reshape(last - first, widths[0]))
    return out


def matrices_to_arrow(matrices: list[np.ndarray | None]) -> pa.Array:
    """Inverse of :func:`matrices_of`."""
    present = [m for m in matrices if m is not None]
    widths = [np.full(len(m), m.shape[1]) for m in present]
    cuts = np.concatenate([[0], *widths]).cumsum()
    ends = np.cumsum([0, *[0 if m is None else len(m) for m in matrices]])
    flat = np.concatenate([m.ravel() for m in present]) if present else np.empty(0)
    rows = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat.astype(np.float32), pa.float32()))
    missing = pa.array([m is None for m in matrices], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows, mask=missing)


@arrow_udf(T.StringType())
def _pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([None if m is None else pack_matrix(m) for m in matrices_of(batch)], pa.string())


@arrow_udf(VECTORS)
def _unpack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield matrices_to_arrow([None if t is None else unpack_matrix(t) for t in batch.to_pylist()])


def pack_embedding(vectors: Column) -> Column:
    """ARRAY<ARRAY<FLOAT>> as text."""
    return _pack(vectors)


def unpack_embedding(packed: Column) -> Column:
    """Text back to ARRAY<ARRAY<FLOAT>>."""
    return _unpack(packed)


def pack_npz(named: dict[str, Column], bfloat16: bool = False) -> Column:
    """Named ARRAY<ARRAY<FLOAT>> columns as one npz member; null when a record has none of them."""
    names = list(named)

    @arrow_udf("BINARY")
    def archive(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            out = []
            for matrices in zip(*[matrices_of(c) for c in columns]):
                present = {n: m for n, m in zip(names, matrices) if m is not None}
                out.append(npz_bytes(present, bfloat16) if present else None)
            yield pa.array(out, pa.binary())

    # With one column alone the function would get arrays instead of tuples of them.
    columns = list(named.values())
    return archive(*columns) if len(columns) > 1 else archive(*columns, columns[0])
