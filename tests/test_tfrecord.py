"""Records decoded column by column, against a plain reading of the wire format one value after the other."""

import struct

import numpy as np
import pytest

from shardweave.sources import tfrecord


def varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = b""
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def sized(number: int, body: bytes) -> bytes:
    return varint(number << 3 | 2) + varint(len(body)) + body


def feature(kind: str, values: list, packed: bool) -> bytes:
    if kind == "bytes":
        return sized(1, b"".join(sized(1, v) for v in values))
    if kind == "floats":
        raw = [struct.pack("<f", v) for v in values]
        return sized(2, sized(1, b"".join(raw)) if packed else b"".join(varint(1 << 3 | 5) + v for v in raw))
    raw = [varint(v) for v in values]
    return sized(3, sized(1, b"".join(raw)) if packed else b"".join(varint(1 << 3) + v for v in raw))


def entry(name: str, body: bytes) -> bytes:
    return sized(1, sized(1, name.encode()) + sized(2, body))


def drawn(rng) -> tuple[list, bytes]:
    """A record's features as they should come out, and its bytes."""
    want, raw = {}, []
    for _ in range(rng.integers(0, 7)):
        name = str(rng.choice(["", "uid", "größe", "a", "b", "image" * 40]))
        kind = str(rng.choice(["bytes", "floats", "ints", "none"]))
        n = int(rng.integers(0, 5))
        if kind == "bytes":
            values = [rng.bytes(int(rng.choice([0, 1, 130, 20_000]))) for _ in range(n)]
        elif kind == "floats":
            values = rng.normal(size=n).astype(np.float32).tolist()
        else:
            values = [int(v) for v in rng.choice([0, 1, -1, 127, 128, 1 << 40, (1 << 63) - 1, -(1 << 63)], n)]
        out = {"bytes": None, "floats": None, "ints": None}
        if kind != "none":
            out[kind] = values
        want[name] = out
        body = b"" if kind == "none" else feature(kind, values, bool(rng.integers(2)))
        raw.append(entry(name, body))
    # Unknown fields of every width are passed over; the features may come in two parts.
    unknown = varint(9 << 3) + varint(1 << 50) + varint(9 << 3 | 1) + b"8 bytes." + varint(9 << 3 | 5) + b"four" + sized(9, b"x")
    cut = int(rng.integers(0, len(raw) + 1))
    return list(want.items()), sized(1, b"".join(raw[:cut])) + unknown + sized(1, b"".join(raw[cut:]) + unknown)


def test_decoding_in_columns():
    rng = np.random.default_rng(5)
    wanted, raw = zip(*[drawn(rng) for _ in range(300)])
    ends = np.cumsum([len(r) for r in raw])
    got = tfrecord.decode(np.frombuffer(b"".join(raw), np.uint8), ends - [len(r) for r in raw], ends)
    got.validate(full=True)
    assert got.to_pylist() == list(wanted)
    assert [tfrecord.parse_record(r) for r in raw] == list(wanted)


def test_nothing_to_decode():
    none = np.empty(0, np.int64)
    assert tfrecord.decode(np.empty(0, np.uint8), none, none).to_pylist() == []
    assert tfrecord.parse_record(b"") == [] and tfrecord.parse_record(sized(1, b"")) == []


@pytest.mark.parametrize(
    "data",
    [
        b"\x0a\x7f\x00",  # longer than the record
        b"\x0a\xff\xff\xff\xff\xff\xff\xff\xff\xff\xff\x01",  # a length of more than ten bytes
        b"\x0a",  # no length
        b"\x0b\x00",  # an unknown wire type
        sized(1, entry("n", sized(3, sized(1, b"\x80")))),  # a number that does not end
        sized(1, entry("n", sized(2, sized(1, b"abc")))),  # not a whole float
    ],
)
def test_malformed_records_are_errors(data):
    with pytest.raises(ValueError, match="malformed"):
        tfrecord.parse_record(data)


def test_records_larger_than_a_piece(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tfrecord, "BATCH_BYTES", 100)
    sizes = [0, 5, 300, 40, 41, 1000, 1]
    frames = [sized(1, entry("x", feature("bytes", [b"v" * n], True))) for n in sizes]
    data = b"".join(struct.pack("<Q", len(f)) + b"crc4" + f + b"crc4" for f in frames)
    (tmp_path / "a.tfrecord").write_bytes(data)
    seen = []
    for at, piece, begins, ends in tfrecord._frames(str(tmp_path / "a.tfrecord"), 0, len(data)):
        assert piece == data[at : at + len(piece)]
        found = tfrecord.decode(np.frombuffer(piece, np.uint8), np.array(begins), np.array(ends))
        seen += [len(row[0][1]["bytes"][0]) for row in found.to_pylist()]
    assert seen == sizes
