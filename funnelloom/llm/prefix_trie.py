"""Prefix trie of conversations by union-find over the common prefixes of sorted neighbours.

Conversations are sequences of turns; a node is a distinct sequence of first turns. In
sorted order the conversations of a node are neighbours, and two neighbours have as many
turns in common as their lowest common node is deep. So the trie is a forest that grows
from the deepest links to the shallowest:

1. Each turn becomes a digest of 16 bytes, a sequence the digests one after the other, and
   equal sequences one row (map-side combine), so that copies cost nothing further.
2. The distinct sequences are sorted over range partitions. In each, the links between
   neighbours are taken in descending depth; a union that joins components at some depth
   makes the branching node there, and the turns between two branching nodes are nodes
   with one child.
3. Only nodes that go on over a partition's first or last sequence stay open: prefixes no
   longer than what that sequence shares with the neighbour partition's. They are
   contracted to a row of sums each and merged by one grouping. The sums add up, because
   every node is counted as made only where its first sequence lies.
4. Members' ids go into the digest of a node in order: chunks of ids per range partition,
   then the chunks of a node one after the other, each held alone.

Held in a task: the sequences of one range partition. On the driver: the first and last
sequence of each partition. One conversation's digests (16 bytes a turn) are a row; its
texts are not, whatever their length.

Defined results: a null role or text is empty; a null turn comes first; turns with equal
numbers follow each other by digest, repeated rows are turns of their own; rows without a
``conv_id`` belong to no conversation; an empty table has no node, not even a root; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelloom.llm.common import stored

WIDTH = 16  # bytes of a turn's digest
CHUNK = 1 << 20  # bytes of member ids in a row
FAMILY = 100  # conversations that share the base whose first turns they take over
HEADS = 6  # a conversation takes over fewer turns than this

_EMPTY = hashlib.sha256(b"").hexdigest()
_FOREST = (
    "part int, open boolean, node string, parent string, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
_RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: a conversation's turns in order, as ``digest`` and ``chars``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct("turn", digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda x: F.struct(x.digest.alias("digest"), x.chars.alias("chars"))).alias("turns"))


def with_shared_heads(found: DataFrame) -> DataFrame:
    """Every conversation c again, its first h turns taken from conversation c - c % 100.

    h is the CRC32 of the decimal c modulo 6. At most a hundred conversations meet one base.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    own = found.select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), h.alias("h"), "turns")
    heads = found.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def _key() -> Column:
    return F.unhex(F.array_join("turns.digest", ""))


def _chunks(limit: int):
    """Sorted ``node, conv_id`` to comma-joined ids, at most about ``limit`` bytes a row."""

    def row(node: str, first: int, ids: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node]), pa.array([first]), pa.array([b",".join(ids)])], names=["node", "first", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, 0, [], 0
        for batch in batches:
            for name, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if name != node or size >= limit:
                    if ids:
                        yield row(node, first, ids)
                    node, first, ids, size = name, conv, [], 0
                ids.append(str(conv).encode())
                size += len(ids[-1]) + 1
        if ids:
            yield row(node, first, ids)

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to one SHA-256 per node; one chunk is held at a time."""
    node, state = None, None
    for batch in batches:
        names, made = [], []
        for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids")):
            if name != node:
                if state is not None:
                    names.append(node)
                    made.append(state.hexdigest())
                node, state = name, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(made, pa.string())], names=["node", "sha"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], names=["node", "sha"])


def member_digests(members: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``node, sha`` of ``node, conv_id``: SHA-256 of each node's ids, ascending and comma-joined.

    A node's ids are spread over range partitions; what one task must read in order is the
    joined text alone, some 100,000 ids a row.
    """
    ordered = members.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    chunks = stored(ordered.mapInArrow(_chunks(chunk), "node string, first long, ids binary"), "member-ids")
    return chunks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_digests, "node string, sha string")


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two sequences have in common from the start."""
    n = min(len(a), len(b))
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    at = int(differ.argmax()) if n else 0
    return (at if n and differ[at] else n) // WIDTH


class _Component:
    """Neighbouring sequences joined so far: their lowest common node and sums below it."""

    __slots__ = ("lo", "hi", "depth", "n", "conv", "children", "leaves", "saved", "sha", "waiting")

    def __init__(self, at: int, depth: int, n: int, conv: int, sha: str):
        self.lo = self.hi = at
        self.depth, self.n, self.conv, self.sha = depth, n, conv, sha
        self.children = self.leaves = self.saved = 0
        self.waiting: list[int] = []  # rows whose parent is this node


def local_forest(keys: list[bytes], counts: list[int], convs: list[int], chars: list[list[int]], shas: list[str], left: int, right: int) -> list[list]:
    """Nodes of sorted distinct sequences, deepest unions first.

    ``left`` and ``right``: turns shared with the sequences before and after these, -1
    where there are none. Rows as in ``_FOREST`` without ``part``; open rows have sums of
    these sequences alone.
    """
    last = len(keys) - 1
    rows: list[list] = []
    of = [_Component(i, len(k) // WIDTH, counts[i], convs[i], shas[i]) for i, k in enumerate(keys)]
    root = list(range(len(keys)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def close(c: _Component, above: int) -> tuple[int, int, int, list[int]]:
        """Writes the nodes from the component's own depth up to the one below ``above``.

        Returns what the node at ``above`` adds: children made here, leaves, saved tokens,
        and the rows that wait for its name.
        """
        key, own = keys[c.lo], chars[c.lo]
        name = lambda depth: hashlib.md5(key[: depth * WIDTH]).hexdigest()
        if not c.children and c.sha and not (c.hi == last and c.depth <= right):
            c.leaves = 1
        children, saved, waiting, sha, new = c.children, c.saved, c.waiting, c.sha, 0
        for depth in range(c.depth, above, -1):
            new = not (c.lo == 0 and depth <= left)
            shared = not new or (c.hi == last and depth <= right)
            saved += (c.n - new) * (own[depth - 1] if depth else 0)
            for row in waiting:
                rows[row][5] = None if shared else c.conv
                rows[row][2] = name(depth) if shared else None
            rows.append([shared, name(depth) if shared else None, None, c.conv, depth, None, c.n, children, c.leaves, saved, sha])
            waiting, children, sha = [len(rows) - 1], int(new), ""
        return int(new), c.leaves, saved, waiting

    def raised(c: _Component, depth: int) -> _Component:
        """The component as one whose lowest node lies at ``depth``."""
        if c.depth > depth:
            children, leaves, saved, waiting = close(c, depth)
            c.depth, c.sha = depth, ""
            c.children, c.leaves, c.saved, c.waiting = children, leaves, saved, waiting
        return c

    depths = [common_turns(a, b) for a, b in zip(keys, keys[1:])]
    for at in sorted(range(len(depths)), key=lambda i: -depths[i]):
        a, b = find(at), find(at + 1)
        x, y = raised(of[a], depths[at]), raised(of[b], depths[at])
        if x.hi - x.lo < y.hi - y.lo:
            a, b, x, y = b, a, y, x
        root[b] = a
        x.lo, x.hi = min(x.lo, y.lo), max(x.hi, y.hi)
        x.n, x.conv, x.sha = x.n + y.n, min(x.conv, y.conv), x.sha or y.sha
        x.children, x.leaves, x.saved = x.children + y.children, x.leaves + y.leaves, x.saved + y.saved
        x.waiting += y.waiting
        of[b] = None
    if keys:
        close(of[find(0)], -1)
    return rows


def _forests(shared: dict[int, tuple[int, int]]):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        columns = table.sort_by("key").to_pydict()
        rows = local_forest(columns["key"], columns["n"], columns["conv_id"], columns["chars"], columns["sha"], *shared[part])
        names = [x.split()[0] for x in _FOREST.split(", ")]
        types = [{"int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "long": pa.int64()}[x.split()[1]] for x in _FOREST.split(", ")]
        columns = [[part] * len(rows), *([row[i] for row in rows] for i in range(len(names) - 1))]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def nodes(found: DataFrame) -> DataFrame:
    """The trie of ``conv_id, turns``, a row per node.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's name; null at
    the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256`` (of the members that end here).
    """
    keyed = stored(found.select("conv_id", _key().alias("key"), F.col("turns.chars").alias("chars")), "sequences")
    digests = member_digests(keyed.select(F.md5("key").alias("node"), "conv_id"))
    distinct = keyed.groupBy("key", "chars").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    met = distinct.withColumn("node", F.md5("key")).join(digests, "node").drop("node")
    ranged = stored(met.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "sorted-sequences")
    ends = ranged.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high")).orderBy("part").collect()
    meet = [-1, *(common_turns(bytes(a.high), bytes(b.low)) for a, b in zip(ends, ends[1:])), -1]
    shared = {row.part: (meet[i], meet[i + 1]) for i, row in enumerate(ends)}
    made = stored(ranged.groupBy("part").applyInArrow(_forests(shared), _FOREST), "forests")

    parts = made.where("open")
    merged = stored(
        parts.groupBy("node", "depth").agg(
            F.max("parent").alias("parent"),
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.max("ends_sha256").alias("ends_sha256"),
        ),
        "merged-nodes",
    )
    # A parent that is open in many partitions is looked up per partition, so no key is hot.
    names = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("named"))
    per_part = parts.select("part", F.col("node").alias("parent")).join(names, "parent")
    closed = made.where(~F.col("open"))
    below = closed.where("parent IS NOT NULL").join(per_part, ["part", "parent"]).withColumn("parent_conv_id", F.col("named"))
    top = merged.join(names, "parent", "left").withColumn("parent_conv_id", F.col("named"))
    whole = closed.where("parent IS NULL").select(*_RESULT).unionByName(below.select(*_RESULT)).unionByName(top.select(*_RESULT))
    return whole.withColumn("ends_sha256", F.when(F.col("ends_sha256") == "", _EMPTY).otherwise(F.col("ends_sha256")))
