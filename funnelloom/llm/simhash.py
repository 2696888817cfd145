"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a fingerprint belongs to a non-zero vector of r + 1 bits. For each non-zero
vector v, table v keeps the bits whose vector has an odd product with v. The vectors of
at most r differing bits span at most r dimensions, so some v is orthogonal to all of
them: in that table the two keys are equal. 2 ** (r + 1) - 1 tables therefore meet every
pair within distance r, for certain.

Only distinct fingerprints enter the tables, so that exact copies are one row. A bucket
of two is its own pair; one of up to ``BUCKET`` fingerprints is linked inside a task (the
list is bounded by that count) and gives a spanning forest, never its pairs. Larger
buckets take an exact way whose rows grow with the bucket: each fingerprint also visits
all points within r / 2 flips of its free bits, and fingerprints that visit the same
point are within r of each other; each is linked to the smallest visitor.

Defined results: a text without words has fingerprint zero and is linked like any other;
a null text is an empty one; repeated rows share fingerprint and component; a null
``doc_id`` is never a component's name unless all its documents have none; very long
texts are hashed whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelloom.llm.common import stored, text_or_empty
from funnelloom.llm.words import as_text

BITS = 64
SEED = 42
BUCKET = 4096
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, size: int) -> int:
    """Majority bits of the shingles' XXH64, unsigned; zero where there is no word."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - size + 1)
    spans = zip(starts[:n].tolist(), (ends[-n:] - 1).tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n).astype("<u8")
    columns = hashes.view(np.uint8).reshape(n, 8)
    counts = np.concatenate([np.bincount(columns[:, k], minlength=256) @ _BITS_OF_BYTE for k in range(8)])
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_text(batch.column("text")).cast(pa.large_binary())
            made = np.fromiter((fingerprint(t.as_buffer().to_pybytes(), size) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made.view(np.int64))], names=["doc_id", "fp"]
            )

    return run


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """``doc_id, fp``: fingerprints as signed longs."""
    source = docs.select("doc_id", text_or_empty().alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_fingerprints(size), f"doc_id {id_type}, fp long")


def covering_masks(radius: int) -> list[int]:
    """The kept bits of each table, as signed longs."""
    vectors = (1 << radius + 1) - 1
    of_bit = [i % vectors + 1 for i in range(BITS)]
    masks = [sum(1 << i for i in range(BITS) if (of_bit[i] & v).bit_count() & 1) for v in range(1, vectors + 1)]
    return [m - (1 << BITS) if m >> BITS - 1 else m for m in masks]


def _links(radius: int):
    """Spanning forest of each bucket's links."""

    def forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        label = np.arange(len(fps))
        while True:
            low = label.copy()
            for at in range(0, len(fps), 256):
                near = np.bitwise_count(fps[at : at + 256, None] ^ fps[None, :]) <= radius
                low[at : at + 256] = np.where(near, label[None, :], len(fps)).min(axis=1)
            low = low[low]
            if (low == label).all():
                break
            label = low
        joined = label != np.arange(len(fps))
        return fps[joined], fps[label[joined]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [forest(np.sort(np.array(fps, np.int64))) for fps in batch.column("fps").to_pylist()]
            if pairs:
                a, b = (np.concatenate(side) for side in zip(*pairs))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _visited(fp: Column, mask: int, radius: int) -> Column:
    """Points within radius / 2 flips of the bits that the table leaves out."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    flips = [sum(1 << i for i in c) for k in range(radius // 2 + 1) for c in combinations(free, k)]
    signed = [f - (1 << BITS) if f >> BITS - 1 else f for f in flips]
    return F.transform(F.array(*[F.lit(f).cast("long") for f in signed]), lambda f: fp.bitwiseXOR(f))


def links(distinct: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links that connect whatever is connected within the radius.

    ``distinct`` has each fingerprint once, in column ``fp``, and is cheap to read again.
    """
    if radius % 2:
        raise ValueError("an even radius is needed to halve it")
    masks = covering_masks(radius)
    rows = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for t, m in enumerate(masks)]
    keys = distinct.select("fp", F.explode(F.array(*rows)).alias("k")).select("k.t", "k.key", "fp")
    counted = keys.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    shared = stored(counted.where("n > 1"), "buckets")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    found = shared.where("n = 2").where(near).select("b", "a").toDF("a", "b")
    members = keys.join(shared.where("n > 2").select("t", "key", "n"), ["t", "key"])
    lists = members.where(F.col("n") <= bucket).groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
    found = found.unionByName(lists.select("fps").mapInArrow(_links(radius), "a long, b long"))
    crowded = members.where(F.col("n") > bucket)
    if shared.where(F.col("n") > bucket).limit(1).count():
        for t, mask in enumerate(masks):
            visits = crowded.where(F.col("t") == t).select("key", "fp", F.explode(_visited(F.col("fp"), mask, radius)).alias("point"))
            low = F.min("fp").over(Window.partitionBy("key", "point"))
            found = found.unionByName(visits.select(F.col("fp").alias("a"), low.alias("b")).where("a <> b"))
    return found.distinct()


def labels(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that each linked node reaches.

    Every round takes the smallest label among neighbours and then that label's own
    label, which doubles the reach; each round's table is written to the shared folder.
    """
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    known = stored(
        both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")),
        "labels",
    )
    while True:
        of_neighbour = known.select(F.col("node").alias("b"), F.col("label").alias("seen"))
        low = both.join(of_neighbour, "b").groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen"))
        met = known.join(low, "node").select("node", "label", F.least("label", "seen").alias("next"))
        jump = known.select(F.col("node").alias("next"), F.col("label").alias("far"))
        step = stored(met.join(jump, "next", "left").select("node", F.coalesce("far", "next").alias("label"), F.col("label").alias("old")), "labels")
        known = step.select("node", "label")
        if not step.where("label <> old").limit(1).count():
            return known


def components(docs: DataFrame, size: int = 4, radius: int = 4, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, fp, component_id`` per row; the component is named by its smallest ``doc_id``."""
    marks = stored(fingerprints(docs, size), "fingerprints")
    distinct = stored(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    named = distinct.join(labels(links(distinct, radius, bucket)).withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    of_label = named.groupBy("label").agg(F.min("first").alias("component_id"))
    by_fp = stored(named.join(of_label, "label").select("fp", "component_id"), "components")
    return marks.join(by_fp, "fp", "left").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, size: int = 4, radius: int = 4) -> DataFrame:
    """One document of each component, with its columns as they came.

    The component's smallest ``doc_id`` stays; of repeated rows with that id, one.
    Documents without an id cannot be told apart by it and stay.
    """
    found = components(docs, size, radius)
    kept = stored(found.where("doc_id = component_id").select("doc_id").distinct(), "kept")
    return (
        docs.join(kept, "doc_id", "left_semi")
        .dropDuplicates(["doc_id"])
        .select(*docs.columns)
        .unionByName(docs.where(F.col("doc_id").isNull()))
    )


def as_hex(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
