"""Exact Jaccard self-join of word shingle sets, with the classes that its links make.

Two sets that are similar enough share several of their first elements under any common order, so only
these prefixes are indexed. Three relations between sets keep the work from growing with the square of a
group of near copies:

- Equal sets are one node, however many texts have them.
- Elements that many prefixes hold come last in the order, so lists are long only for texts that consist
  of such elements. Within a list, entries are sorted by set size; those whose size or whose position in the
  prefix rules out a link are skipped in blocks.
- Nodes that share prefix elements with a leader form a cluster, with all that are joined to them so, and so do all nodes of a long
  list, as of a passage that makes up most of many short texts. Inside a cluster no pair is sent
  anywhere: one task has the members' inverted lists and derives a set's overlaps with all others from
  those of the set before it, by the elements in which the two differ. Pairs between clusters are sent and
  checked one by one; they meet in short lists only, so their number is bounded by the number of entries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardweave.llm.components import components
from shardweave.llm.store import everywhere, stored
from shardweave.llm.words import WordHashes, memo, mix, tidy, utf8, windows

# An element is frequent if more prefixes than this hold it; the least value, and the most frequent elements
# there can be (the value grows with the data so that their table, which is broadcast, stays below 8 MB).
FREQUENT, MOST_FREQUENT = 24, 1 << 20
# Prefix elements per task of the list stage; elements of the sets that one cluster task compares; rows of a batch.
LIST_ENTRIES, UNIT_ELEMENTS, BATCH = 1_000_000, 1_000_000, 100_000
SHARED = 4
# A list is long if it has more than this many times as many entries as an element needs to be frequent; so lists of
# elements that are not frequent hardly ever are.
LONG = 2
NO_ID = (1 << 63) - 1


class Rule:
    """Link if ``den`` x intersection >= ``num`` x union; sets of ``shingle`` words."""

    def __init__(self, shingle: int, num: int, den: int):
        if not 0 < num < den:
            raise ValueError("the similarity must lie between 0 and 1, both excluded")
        self.shingle, self.num, self.den = shingle, num, den
        # The least set that can link with a different one, and how many prefix elements links share.
        self.least = -(-num // (den - num))
        self.shared = min(SHARED, self.least)

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + self.shared

    def overlap(self, a, b):
        """The least intersection of linked sets of sizes a and b."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def elements(self, data: bytes, known: WordHashes) -> np.ndarray:
        """The set of a text: ascending hashes of its distinct shingles, or of all its words if they are fewer."""
        words = data.lower().split()
        if not words:
            return np.empty(0, np.uint64)
        return np.unique(windows(known.of(words), min(self.shingle, len(words))))


def node_of(elements: np.ndarray) -> int:
    """64-bit name of a set."""
    return int(mix(elements ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64))


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def joined(df: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(``id``, text_hash, n_shingles, component_id, n_links) for each row of ``df``.

    A text's set has its distinct runs of ``shingle`` words (A-Z lowered); with fewer words, the whole
    sequence; without words or for null, nothing. Texts link when ``den`` x intersection >= ``num`` x
    union; empty sets with nothing. ``component_id`` is the least id that links reach, ``n_links`` the number
    of other rows linked directly, ``text_hash`` Spark's xxhash64 of the text. Rows of equal id are different rows; a null id never is a component's
    name unless no other id is in it. Sets are told apart by 64-bit sums of 64-bit hashes.
    """
    spark, rule = df.sparkSession, Rule(shingle, num, den)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    table, entries, frequent = _prefixes(docs, rule)
    parts = max(least, -(-entries // LIST_ENTRIES))
    nodes = stored(
        table.where("n > 0").groupBy("node").agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n")),
        "join-nodes",
    )
    lists = _lists(table, parts, LONG * frequent)
    clusters = stored(_clusters(lists), "join-clusters")
    pairs = stored(_pairs(lists, clusters, rule, max(least, -(-entries // (4 * LIST_ENTRIES)))), "join-pairs")

    sizes = clusters.join(nodes, "node").groupBy("cluster").agg(F.sum("n").alias("elements"))
    units = sizes.select("cluster", F.ceil(F.col("elements") / UNIT_ELEMENTS).cast("int").alias("blocks"))
    members = clusters.join(units, "cluster")
    needed = clusters.select("node").unionAll(pairs.select(F.col("a").alias("node"))).unionAll(pairs.select(F.col("b").alias("node")))
    wanted = nodes.join(needed.distinct(), "node").select("node", F.coalesce("least_id", F.lit(NO_ID)).alias("id"), "n", "copies")
    sets = stored(_sets(docs, wanted, rule), "join-sets")

    inside = stored(_inside(sets, members, rule, least), "join-inside")
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("ea"), F.col("copies").alias("ca"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("eb"), F.col("copies").alias("cb"))
    both = F.size(F.array_intersect("ea", "eb"))
    union = F.size("ea") + F.size("eb") - both
    across = pairs.join(left, "a").join(right, "b").where(F.lit(den) * both >= F.lit(num) * union)
    across = stored(across.select("a", "b", "ca", "cb").distinct(), "join-across")

    edges = inside.select(F.col("node").alias("u"), F.col("label").alias("v")).unionAll(across.select(F.col("a").alias("u"), F.col("b").alias("v")))
    roots = components(edges)
    named = roots.join(nodes.select("node", "least_id"), "node")
    names = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.select("node", "root").join(names, "root").select("node", "component_id")
    links = inside.select("node", "links").unionAll(across.select(F.col("a").alias("node"), F.col("cb").alias("links")))
    links = links.unionAll(across.select(F.col("b").alias("node"), F.col("ca").alias("links")))
    links = links.groupBy("node").agg(F.sum("links").alias("links"))
    classes = nodes.join(named, "node", "left").join(links, "node", "left").select(
        "node",
        F.coalesce("component_id", "least_id").alias("component_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    rows = table.select("id", "text_hash", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
    return rows.join(classes, "node", "left").select(
        F.col("id").alias(id),
        "text_hash",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def _prefixes(docs: DataFrame, rule: Rule) -> tuple[DataFrame, int, int]:
    """(id, text_hash, node, n, prefix) of every row, the number of prefix elements, and how many prefixes a frequent
    element is in at least. Of copies within a batch only the first has its prefix, so that a group of copies does not
    fill the lists."""

    def early(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, seen = [], set()
            for data in utf8(batch.column("text")):
                elements = rule.elements(data, memo())
                name = node_of(elements)
                if len(elements) < rule.least or name in seen:
                    continue
                seen.add(name)
                parts.append(elements[: rule.prefix(len(elements)) * 5 // 4 + 8])
            if parts:
                element, times = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([signed(element), pa.array(times)], names=["element", "times"])

    counts = docs.select("text").mapInArrow(tidy(early), "element bigint, times bigint")
    counts = counts.groupBy("element").agg(F.sum("times").alias("times"))
    counts = stored(counts.where(F.col("times") > FREQUENT), "join-frequent")
    total = counts.agg(F.sum("times")).first()[0] or 0
    floor = max(FREQUENT, total // MOST_FREQUENT)
    frequent = counts.where(F.col("times") > floor).select("element").toPandas()["element"].to_numpy(np.int64).view(np.uint64)
    frequent = everywhere(docs.sparkSession, np.sort(frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = frequent.value
        for batch in batches:
            names, sizes, prefixes, seen = [], [], [], set()
            for data in utf8(batch.column("text")):
                elements = rule.elements(data, memo())
                name = node_of(elements)
                names.append(name)
                sizes.append(len(elements))
                if len(elements) < rule.least or name in seen:
                    prefixes.append(None)
                    continue
                seen.add(name)
                if len(late):
                    at = np.minimum(np.searchsorted(late, elements), len(late) - 1)
                    is_late = late[at] == elements
                    elements = np.r_[elements[~is_late], elements[is_late]]
                prefixes.append(elements[: rule.prefix(len(elements))].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=["id", "text_hash", "node", "n", "prefix"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    table = stored(docs.mapInArrow(tidy(run), f"id {kind}, text_hash bigint, node bigint, n bigint, prefix array<bigint>"), "join-prefixes")
    entries = table.agg(F.sum(F.greatest(F.size("prefix"), F.lit(0)))).first()[0] or 0
    return table, int(entries), floor


def _lists(table: DataFrame, parts: int, most: int) -> DataFrame:
    """(element, node, n, pos) of all elements that several nodes' prefixes hold, with the ``leader`` of each
    list, its least node, and whether it is ``long``: has more than ``most`` entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [[c.to_numpy() for c in batch.columns] for batch in batches]
        if not columns:
            return
        element, node, n, pos = (np.concatenate(c) for c in zip(*columns))
        order = np.lexsort((node, element))
        element, node, n, pos = element[order], node[order], n[order], pos[order]
        once = np.r_[True, (element[1:] != element[:-1]) | (node[1:] != node[:-1])] if len(node) else np.empty(0, bool)
        element, node, n, pos = element[once], node[once], n[once], pos[once]
        start = np.flatnonzero(np.r_[True, element[1:] != element[:-1]]) if len(node) else np.empty(0, np.int64)
        length = np.diff(np.r_[start, len(element)])
        leader = np.repeat(node[start], length)
        keep = np.repeat(length, length) > 1
        long = np.repeat(length > most, length)
        kept = [pa.array(c[keep]) for c in (element, node, n, pos, leader, long)]
        yield pa.RecordBatch.from_arrays(kept, names=["element", "node", "n", "pos", "leader", "long"])

    rows = table.where("prefix is not null").select("node", "n", F.posexplode("prefix").alias("pos", "element"))
    rows = rows.select("element", "node", "n", F.col("pos").cast("long").alias("pos")).repartition(parts, "element")
    return stored(rows.mapInArrow(tidy(run), "element bigint, node bigint, n bigint, pos bigint, leader bigint, long boolean"), "join-lists")


def _clusters(lists: DataFrame) -> DataFrame:
    """(node, cluster) of the nodes that share several prefix elements with a leader, or stand in its long list, or are so
    joined with one that does, and so on.

    Any division into clusters gives the same links; this one puts all copies of a text together, whichever of
    them leads their lists, so that hardly a pair of them is left to be sent, and all nodes of a long list, whose pairs
    would grow with the square of its length.
    """
    near = lists.where("node <> leader").groupBy("leader", "node").agg(F.count(F.lit(1)).alias("count"), F.max("long").alias("long"))
    near = near.where((F.col("count") >= SHARED) | F.col("long"))
    found = components(near.select(F.col("leader").alias("u"), F.col("node").alias("v")))
    return found.select("node", F.col("root").alias("cluster"))


def _pairs(lists: DataFrame, clusters: DataFrame, rule: Rule, parts: int) -> DataFrame:
    """(a, b) of nodes of different clusters that share enough prefix elements to be linked."""
    met = _met(lists, clusters, rule, parts)
    return met.groupBy("a", "b").count().where(F.col("count") >= rule.shared).select("a", "b")


def _met(lists: DataFrame, clusters: DataFrame, rule: Rule, parts: int) -> DataFrame:
    """(a, b) of nodes of different clusters that meet in a list, a row for each list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [[c.to_numpy() for c in batch.columns] for batch in batches]
        if not columns:
            return
        element, node, n, pos, cluster = (np.concatenate(c) for c in zip(*columns))
        order = np.lexsort((node, n, element))
        element, node, n, pos, cluster = element[order], node[order], n[order], pos[order], cluster[order]
        start = np.flatnonzero(np.r_[True, element[1:] != element[:-1]]) if len(node) else np.empty(0, np.int64)
        found, size = [], 0
        for at, end in zip(start, np.r_[start[1:], len(node)]):
            if (cluster[at:end] == cluster[at]).all():
                continue
            sizes, places, of, who = n[at:end], pos[at:end], cluster[at:end], node[at:end]
            # Sizes ascend: everything from ``stop`` on is too large to link with entry i.
            stops = np.searchsorted(sizes, sizes * rule.den // rule.num, side="right")
            for i in range(len(sizes) - 1):
                j = slice(i + 1, stops[i])
                # Before a shared element there are at most as many shared ones as the lesser position says.
                most = np.minimum(places[i], places[j]) + np.minimum(sizes[i] - places[i], sizes[j] - places[j])
                ok = (of[j] != of[i]) & (most >= rule.overlap(sizes[i], sizes[j]))
                if ok.any():
                    others = who[j][ok]
                    found.append((np.minimum(others, who[i]), np.maximum(others, who[i])))
                    size += len(others)
            if size >= BATCH:
                yield _batch(found)
                found, size = [], 0
        if found:
            yield _batch(found)

    own = lists.join(clusters, "node", "left").select("element", "node", "n", "pos", F.coalesce("cluster", "node").alias("cluster"))
    return own.repartition(parts, "element").mapInArrow(tidy(run), "a bigint, b bigint")


def _batch(found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["a", "b"])


def _sets(docs: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """(node, n, copies, elements) of the wanted nodes, from the text of the row with their least id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            elements = [rule.elements(data, memo()) for data in utf8(batch.column("text"))]
            mine = np.array([node_of(e) for e in elements], np.int64) == batch.column("node").to_numpy()
            at = np.flatnonzero(mine)
            columns = [batch.column(c).take(pa.array(at)) for c in ("node", "n", "copies")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([elements[i].view(np.int64) for i in at], pa.list_(pa.int64()))], names=["node", "n", "copies", "elements"]
            )

    texts = docs.select(F.coalesce(F.col("id").cast("long"), F.lit(NO_ID)).alias("id"), "text")
    found = texts.join(wanted, "id").select("text", "node", "n", "copies")
    return found.mapInArrow(tidy(run), "node bigint, n bigint, copies bigint, elements array<bigint>")


def _inside(sets: DataFrame, members: DataFrame, rule: Rule, parts: int) -> DataFrame:
    """(node, label, links): links within clusters; ``label`` is a node it is connected with. A cluster too
    large for a task is cut into blocks, and every two blocks meet in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, {}  # node: its row; repeated rows of a node count once
        for batch in batches:
            names = ("unit", "node", "side", "copies")
            lists = batch.column("elements")
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for k, (unit, node, side, copies) in enumerate(zip(*[batch.column(n).to_pylist() for n in names])):
                if unit != current and rows:
                    yield _compare(list(rows.values()), rule)
                    rows = {}
                current = unit
                rows[node] = (node, side, copies, flat[ends[k] : ends[k + 1]])
        if rows:
            yield _compare(list(rows.values()), rule)

    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = members.withColumn("block", block).join(sets, "node")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    rows = rows.select(
        F.concat_ws(" ", "cluster", low, high).alias("unit"),
        "node",
        # Of two blocks the pairs across are compared (sides 0 and 1), of one block all (side 2).
        F.when(low == high, 2).when(F.col("block") == low, 0).otherwise(1).alias("side"),
        "copies",
        "elements",
    )
    rows = rows.repartition(4 * parts, "unit").sortWithinPartitions("unit")
    return rows.mapInArrow(tidy(run), "node bigint, label bigint, links bigint")


def _compare(rows: list[tuple], rule: Rule) -> pa.RecordBatch:
    """(node, label, links) of one unit's rows (node, side, copies, elements)."""
    rows = sorted(rows, key=lambda r: (len(r[3]), r[0]))
    node = np.array([r[0] for r in rows], np.int64)
    side = np.array([r[1] for r in rows], np.int64)
    copies = np.array([r[2] for r in rows], np.int64)
    size = np.array([len(r[3]) for r in rows], np.int64)
    flat = np.concatenate([r[3] for r in rows])
    owner = np.repeat(np.arange(len(rows)), size)
    element, of = np.unique(flat, return_inverse=True)
    # Inverted lists of all elements, end to end.
    order = np.argsort(of, kind="stable")
    listed, starts = owner[order], np.searchsorted(of[order], np.arange(len(element) + 1))
    sets = np.split(of, np.cumsum(size)[:-1])

    def met(elements: np.ndarray) -> np.ndarray:
        """How many of the elements each set has."""
        length = starts[elements + 1] - starts[elements]
        at = np.repeat(starts[elements] - np.cumsum(length) + length, length) + np.arange(length.sum())
        return np.bincount(listed[at], minlength=len(rows))

    label, links = np.arange(len(rows)), np.zeros(len(rows), np.int64)
    before, overlap = np.empty(0, np.int64), np.zeros(len(rows), np.int64)
    for i, mine in enumerate(sets):
        gone, new = np.setdiff1d(before, mine, assume_unique=True), np.setdiff1d(mine, before, assume_unique=True)
        if len(gone) + len(new) < len(mine):  # close to the set before: derive its overlaps
            overlap = overlap - met(gone) + met(new)
        else:
            overlap = met(mine)
        before = mine
        union = size[i] + size - overlap
        linked = rule.den * overlap >= rule.num * union
        linked &= (side != side[i]) | (side == 2)
        linked[i] = False
        at = np.flatnonzero(linked)
        links[i] = copies[at].sum()
        if len(at):
            roots = np.unique(label[np.r_[i, at]])
            if len(roots) > 1:
                label[np.isin(label, roots)] = roots[0]
    return pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[label]), pa.array(links)], names=["node", "label", "links"])
