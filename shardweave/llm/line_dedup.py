"""Line deduplication that can be taken back: an index of lines to which documents are added and from which they go.

The index is a set of tables below one folder:

- ``refs``: which document holds which line key, a row for each, in the order of the documents;
- ``counts``: how many rows hold a key and the least document among them. A key that was met once has one row; one
  that was met again may have several, which add up;
- ``met``: the keys that have been met again, which alone need adding up;
- ``filters``: one cuckoo filter per shard of the keys, one fingerprint for each key that some document holds.

An insertion reduces the keys of every batch of documents to distinct ones and deals these to the shards of the
filters. There a key whose fingerprint is not in the filter is certainly new: its count is appended without a
look at any table. The others, true repetitions but for one in some thousands, are looked up exactly. A deletion
counts the keys of its documents anew, and takes the fingerprints of those that nobody holds any more out of the
filters, so that the index is what it would be had the documents never come.

A line that very many documents hold is one row per batch on its way to a shard; where documents are joined with
the repeated lines, the few such lines are broadcast, and only the others are shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardweave.llm.cuckoo import BUCKETS, SLOTS, Cuckoo
from shardweave.llm.store import claimed, stored
from shardweave.llm.words import give_back, utf8

# What is stripped at both ends of a line.
BLANKS = b" \t\n\r\x0b\x0c"
# A filter is planned for so many keys (half its slots); with half as many again, the keys are dealt to more shards.
SHARD_KEYS = BUCKETS * SLOTS // 2
# Keys with at least one in so many of all references are joined by broadcast: there can be no more of them.
HOT_KEYS = 10_000
LAST = (1 << 63) - 1
KEY = ["k1", "k2"]
COUNTS = "shard int, k1 bigint, k2 bigint, n bigint, owner bigint, met boolean, filter binary"


def line_key(line: bytes, least: int) -> bytes | None:
    """The key of a line, None if it has fewer than ``least`` code points. ``bytes.lower`` changes A-Z alone."""
    key = line.strip(BLANKS).lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return key


def refs_of(docs: DataFrame, least: int) -> DataFrame:
    """(doc, th, k1, k2): for every row of ``docs`` (doc, th, text) its distinct line keys, as 128-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            found = []
            for text in utf8(batch.column("text")):
                keys = {line_key(line, least) for line in text.split(b"\n")} - {None}
                found.append(b"".join(sorted(map(digest, keys))))
            row = np.repeat(np.arange(len(batch)), [len(f) // 16 for f in found])
            halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(row)), batch.column("th").take(pa.array(row)), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                names=["doc", "th", *KEY],
            )
        give_back()

    return docs.mapInArrow(run, "doc bigint, th bigint, k1 bigint, k2 bigint")


def merged(k1: np.ndarray, k2: np.ndarray, n: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of equal key as one: their numbers added up, the least owner."""
    order = np.lexsort((k2, k1))
    k1, k2, n, owner = k1[order], k2[order], n[order], owner[order]
    at = np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]) if len(k1) else np.empty(0, np.int64)
    if not len(at):
        return k1, k2, n, owner
    return k1[at], k2[at], np.add.reduceat(n, at), np.minimum.reduceat(owner, at)


def numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(name).to_numpy(zero_copy_only=False) for name in names]


def distinct_keys(refs: DataFrame, shards: int) -> DataFrame:
    """Every batch's keys once, with the number of rows and the least document, and the shard of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, doc = numbers(batch, *KEY, "doc")
            k1, k2, n, owner = merged(k1, k2, np.ones(len(k1), np.int64), doc)
            shard = ((k1.view(np.uint64) >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
            yield pa.RecordBatch.from_pydict({"shard": pa.array(shard.astype(np.int32)), "k1": k1, "k2": k2, "n": n, "owner": owner})

    return refs.select("doc", *KEY).mapInArrow(run, "shard int, k1 bigint, k2 bigint, n bigint, owner bigint")


def through_filters(keys: DataFrame, filters: DataFrame | None, action: str) -> DataFrame:
    """One pass of keys through the filters of their shards; gives the new filters, and for ``test`` the keys back.

    ``test`` adds keys whose fingerprint is absent and marks the others as met; ``add`` and ``remove`` change the
    filters without asking. A task has one filter and one batch of keys at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, cuckoo = None, None
        for batch in batches:
            of, k1, k2, n, owner = numbers(batch, "shard", *KEY, "n", "owner")
            stored = batch.column("filter")
            at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)
            for start, stop in zip(at, np.r_[at[1:], len(of)]):
                if of[start] != shard:
                    if cuckoo is not None:
                        yield _row(shard, cuckoo)
                    shard, cuckoo = int(of[start]), Cuckoo(stored[int(start)].as_py())
                    start += stored[int(start)].is_valid
                part = merged(*(a[start:stop].astype(np.int64) for a in (k1, k2, n, owner)))
                first, second = part[0].view(np.uint64), part[1].view(np.uint64)
                if action == "remove":
                    cuckoo.remove(first, second)
                    continue
                met = cuckoo.has(first, second) if action == "test" else np.zeros(len(first), bool)
                cuckoo.add(first[~met], second[~met])
                if action == "test":
                    yield _rows(shard, part, met)
        if cuckoo is not None:
            yield _row(shard, cuckoo)

    rows = keys.select("shard", *KEY, "n", "owner", F.lit(None).cast("binary").alias("filter"))
    if filters is not None:
        none = [F.lit(0).cast("long").alias(name) for name in (*KEY, "n", "owner")]
        rows = rows.unionAll(filters.select("shard", *none, "filter"))
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "shard").sortWithinPartitions("shard", F.col("filter").isNull())
    return dealt.mapInArrow(run, COUNTS)


def _rows(shard: int, part: tuple[np.ndarray, ...], met: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(met), shard, np.int32)), *map(pa.array, part), pa.array(met), pa.nulls(len(met), pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["shard", *KEY, "n", "owner", "met", "filter"])


def _row(shard: int, cuckoo: Cuckoo) -> pa.RecordBatch:
    zero = pa.array([0], pa.int64())
    columns = [pa.array([shard], pa.int32()), zero, zero, zero, zero, pa.array([False]), pa.array([cuckoo.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["shard", *KEY, "n", "owner", "met", "filter"])


class LineIndex:
    """Lines of at least ``least`` code points and the documents that hold them, below ``root``.

    A document is named by a whole number ``id``; rows of one id are one document, and so are all rows without
    an id, which comes after all others. Every change writes new tables and then one row that names those
    which count, so an index is always in the state before or after a change; opening ``root`` again goes on
    with the last state.
    """

    STATE = "number bigint, shards int, rows bigint, refs array<string>, counts array<string>, met array<string>, filters string"

    def __init__(self, spark: SparkSession, root: str | None = None, least: int = 10, id: str = "doc_id", text: str = "text"):
        self.spark, self.least, self.id, self.text = spark, least, id, text
        self.root = root or claimed(spark, "line-index")
        self.number, self.shards, self.rows = 0, 0, 0
        self.refs: list[str] = []
        self.counts: list[str] = []
        self.met: list[str] = []
        self.filters: str | None = None
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/state")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            last = spark.read.schema(self.STATE).parquet(f"{self.root}/state").orderBy(F.desc("number")).first()
            if last is not None:
                for name, value in last.asDict().items():
                    setattr(self, name, value)

    def insert(self, docs: DataFrame) -> None:
        """Add the rows of ``docs``; null and empty texts hold no line that counts. No rows change nothing."""
        refs = self._written(refs_of(self._named(docs), self.least), "refs")
        added = self._read([refs]).count()
        if not added:
            return
        self.rows += added
        old = self._counts()
        filters = self._filters()
        if self.rows > 3 * self.shards * SHARD_KEYS // 2:
            self.shards = -(-self.rows // SHARD_KEYS)
            if old is not None:
                again = distinct_keys(old.withColumnRenamed("owner", "doc"), self.shards).dropDuplicates(KEY)
                filters = self._read([self._written(through_filters(again, None, "add"), "filters")])
        path = self._written(through_filters(distinct_keys(self._read([refs]), self.shards), filters, "test"), "counts")
        fresh = self._read([path])
        met = self._written(fresh.where("met or n > 1").select("shard", *KEY).distinct(), "met")
        # Fingerprints of two keys may be the same: such a key needs one of its own, or it could not be removed alone.
        known = fresh.where("filter is null and not met")
        known = known if old is None else known.select(*KEY).unionAll(old.select(*KEY))
        alike = fresh.where("met").select("shard", *KEY).distinct().join(known, KEY, "left_anti")
        self.filters = self._changed_filters(fresh.where("filter is not null"), alike, "add") or path
        self.refs, self.counts, self.met = [*self.refs, refs], [*self.counts, path], [*self.met, met]
        self._commit()

    def delete(self, ids: DataFrame) -> None:
        """Take out all rows of the documents ``ids`` (one column, the ids); unknown ones change nothing."""
        if not self.refs:
            return
        ids = ids.select(F.coalesce(ids[0].cast("long"), F.lit(LAST)).alias("doc")).distinct()
        refs, counts = self._read(self.refs), self._counts()
        touched = self._read([self._written(refs.join(ids, "doc", "left_semi").select(*KEY).distinct(), "touched")])
        left = self._written(refs.join(ids, "doc", "left_anti"), "refs")
        held = self._read([left]).join(touched, KEY, "left_semi").groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("owner"))
        shard = F.shiftrightunsigned(F.shiftrightunsigned("k1", 32) * self.shards, 32).cast("int").alias("shard")
        anew = held.select(shard, *KEY, "n", "owner", F.lit(True).alias("met"), F.lit(None).cast("binary").alias("filter"))
        same = counts.join(touched, KEY, "left_anti").withColumn("filter", F.lit(None).cast("binary"))
        path = self._written(same.unionByName(anew), "counts")
        gone = touched.join(self._read([path]), KEY, "left_anti").select(shard, *KEY)
        met = self._written(self._read(self.met).distinct().join(gone, KEY, "left_anti"), "met")
        self.filters = self._changed_filters(self._filters(), gone, "remove") or self.filters
        self.rows = self._read([left]).count()
        self.refs, self.counts, self.met = [left], [path], [met]
        self._commit()

    def repeated(self) -> DataFrame:
        """(k1, k2, n, owner): the keys that several rows hold, their number, and the least document."""
        counts = self._counts()
        if counts is None:
            return self.spark.createDataFrame([], "k1 bigint, k2 bigint, n bigint, owner bigint")
        met = self._read(self.met).select(*KEY).distinct()
        exact = counts.join(met, KEY, "left_semi").groupBy(*KEY).agg(F.sum("n").alias("n"), F.min("owner").alias("owner"))
        return exact.where("n > 1")

    def kept(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``n_lines``, ``n_dropped``, ``kept_text`` in place of columns of these names.

        Lines go if their key is held by a document of smaller id; the others are joined by a line feed, unchanged.
        ``docs`` are rows that have been inserted; others keep all lines. A null text is one empty line. One row
        out for each row in, repeated ones too.
        """
        docs = docs.drop("n_lines", "n_dropped", "kept_text")
        names, text, least = docs.columns, self.text, self.least
        if self.refs:
            refs, shared = self._read(self.refs), stored(self.repeated(), "repeated-lines")
            often = F.col("n") * HOT_KEYS > self.rows
            hot, others = F.broadcast(shared.where(often)), shared.where(~often)
            lost = refs.join(hot, KEY).unionByName(refs.join(hot, KEY, "left_anti").join(others, KEY)).where("doc > owner")
            per = lost.groupBy("doc", "th").agg(F.collect_set(F.struct(*KEY)).alias("lost"))
        else:
            per = self.spark.createDataFrame([], "doc bigint, th bigint, lost array<struct<k1: bigint, k2: bigint>>")
        whole = docs.select(F.struct("*").alias("row"), self._doc(docs).alias("doc"), F.xxhash64(docs[text]).alias("th"))
        found = whole.join(per, ["doc", "th"], "left").select("row", "lost")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            digest = xxhash.xxh3_128_digest
            for batch in batches:
                rows = pa.RecordBatch.from_struct_array(batch.column("row"))
                lines, dropped, kept = [], [], []
                lost = batch.column("lost")
                halves = np.column_stack([lost.flatten().field(k).to_numpy(zero_copy_only=False) for k in KEY]).astype(np.int64).tobytes()
                at = 0
                for number, (whole, size) in enumerate(zip(utf8(rows.column(text)), pc.list_value_length(lost).to_pylist())):
                    parts = whole.split(b"\n")
                    lines.append(len(parts))
                    if size:
                        goes = {halves[k : k + 16] for k in range(at, at + 16 * size, 16)}
                        at += 16 * size
                        stays = [p for p in parts if (key := line_key(p, least)) is None or digest(key) not in goes]
                        dropped.append(len(parts) - len(stays))
                        kept.append(b"\n".join(stays))
                    else:
                        dropped.append(0)
                        kept.append(whole)
                made = [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in range(len(names))), *made], names=[*names, "n_lines", "n_dropped", "kept_text"])
            give_back()

        new = [F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.lit("").alias("kept_text")]
        return found.mapInArrow(run, docs.select("*", *new).schema)

    def tidy(self) -> None:
        """Delete the tables of earlier states, which this index no longer reads; results not yet written may."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.root)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        needed = {path.rpartition("/")[2] for path in (*self.refs, *self.counts, *self.met, self.filters or "")} | {"state"}
        for entry in files.listStatus(root) if files.exists(root) else []:
            if entry.getPath().getName() not in needed:
                files.delete(entry.getPath(), True)

    def _doc(self, docs: DataFrame):
        return F.coalesce(docs[self.id].cast("long"), F.lit(LAST))

    def _named(self, docs: DataFrame) -> DataFrame:
        return docs.select(self._doc(docs).alias("doc"), F.xxhash64(docs[self.text]).alias("th"), docs[self.text].alias("text"))

    def _written(self, df: DataFrame, label: str) -> str:
        path = f"{self.root}/{label}-{self.number + 1:06d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        return reduce(DataFrame.unionByName, (self.spark.read.parquet(path) for path in paths))

    def _counts(self) -> DataFrame | None:
        return self._read(self.counts).where("filter is null").drop("filter") if self.counts else None

    def _filters(self) -> DataFrame | None:
        return self.spark.read.parquet(self.filters).where("filter is not null") if self.filters else None

    def _changed_filters(self, filters: DataFrame, keys: DataFrame, action: str) -> str | None:
        """The path of the filters with ``keys`` added or removed; None if there are no such keys."""
        if keys.isEmpty():
            return None
        keys = keys.select("shard", *KEY, F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("owner"))
        return self._written(through_filters(keys, filters, action), "filters")

    def _commit(self) -> None:
        self.number += 1
        row = (self.number, self.shards, self.rows, self.refs, self.counts, self.met, self.filters)
        self.spark.createDataFrame([row], self.STATE).coalesce(1).write.mode("append").parquet(f"{self.root}/state")
