"""Removal of repeated passages: every byte inside a run of ``LENGTH`` bytes seen before.

Column-wise suffix sorting of a collection needs a round per byte of its longest member.
Over whole documents these are as many rounds, each over all data, as the longest text has
bytes, so the collection here is made of short strings that provably hold every repeat:

1. Each window of ``LENGTH`` bytes has an anchor, the run of ``ANCHOR`` bytes in it with
   the smallest hash (the leftmost of equals). Equal windows have equal anchors at equal
   places. The windows of one anchor overlap; the bytes they span are a segment, at most
   2 * LENGTH - ANCHOR long. Anchors are counted by hash, and only segments whose anchor
   occurs again are kept (a bit table of fixed size thins them out before they are dealt;
   its mistakes keep segments too many, never too few).
2. Equal segments are grouped with map-side combine. All but the earliest repeat it; those
   with more than ``COPIES`` copies meet their copies by broadcast, not in one task.
3. Different segments of one anchor form small collections. There the suffixes are sorted
   column by column, from the last column to the first: each round inserts one symbol of
   every string, and the Burrows-Wheeler transform of the column before gives the new order
   by one stable counting pass. Equal windows stand in the same column when strings are laid
   on their anchors, so a round carries one suffix a string and not those of all columns.
   Neighbours with ``LENGTH`` common bytes are repeats; the earliest stays.
   Anchors with more than ``COLLECTION`` segments are split: windows with the anchor in their
   left half and those with it in their right half go apart, and what all windows of a half
   have in common, the anchor and some bytes beside it, is the longer anchor by which
   their (cut) segments start again at 2. After seven such steps it is the window itself.
4. Per document the covered runs are joined and cut out.

The order of occurrences is (``doc_id``, digest of the text, start). Defined results: a
null text is an empty one; texts below ``LENGTH`` bytes never lose any; rows that repeat
both id and text are one document and treated alike; a null ``doc_id`` comes first; very
long texts are read whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelloom.llm.common import stored, text_or_empty
from funnelloom.llm.tokens import slices
from funnelloom.llm.words import as_text, bytes_of

LENGTH = 100
ANCHOR = 32
SLACK = LENGTH - ANCHOR
COLLECTION = 2_000  # segments of one anchor that a task sorts together
COPIES = 5_000  # equal segments that a task finds together
BATCH = 12_000  # segments sorted at once
FILTER_BITS = 26
SLICE = 4 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first window's start, segment's length, anchor's hash, its place in the segment) of all segments."""
    lengths = np.diff(offsets)
    n_windows = np.maximum(lengths - LENGTH + 1, 0)
    if not n_windows.any():
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64))
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), dtype=np.uint64)))
    hashes = _mix((upto[ANCHOR:] - upto[:-ANCHOR]) * _powers(_INVERSE, len(data) - ANCHOR + 1))
    low = (hashes >> np.uint64(33) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    step = 1
    while 2 * step <= LENGTH - ANCHOR + 1:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if rest := LENGTH - ANCHOR + 1 - step:
        low = np.minimum(low[:-rest], low[rest:])
    doc = np.repeat(np.arange(len(lengths)), n_windows)
    starts = np.arange(len(doc)) + np.repeat(offsets[:-1] - (np.cumsum(n_windows) - n_windows), n_windows)
    at = (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(at)))
    return doc[first], starts[first], windows + LENGTH - 1, hashes[at[first]], at[first] - starts[first]


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE):
        data, offsets, _ = bytes_of(as_text(batch.column("text")))
        hashes = anchors(data, offsets)[3]
        if len(hashes):
            found, counts = np.unique(hashes.view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts)], names=["anchor", "n"])


def _segments(table):
    """Segments whose anchor the bit table marks, with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = table.value
        for batch in slices(batches, "text", SLICE):
            data, offsets, _ = bytes_of(as_text(batch.column("text")))
            doc, starts, lengths, hashes, places = anchors(data, offsets)
            bit = (hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
            wanted = np.flatnonzero(marks[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
            if not len(wanted):
                continue
            doc, starts, lengths, hashes, places = (x[wanted] for x in (doc, starts, lengths, hashes, places))
            ends = np.cumsum(lengths)
            taken = data[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])]
            made = pa.Array.from_buffers(
                pa.large_binary(), len(doc), [None, pa.py_buffer(np.concatenate(([0], ends))), pa.py_buffer(taken)]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(doc)),
                    batch.column("key").take(pa.array(doc)),
                    pa.array(starts - offsets[doc]),
                    pa.array(hashes.view(np.int64)),
                    pa.array(places.astype(np.int32)),
                    made,
                ],
                names=["doc_id", "key", "start", "anchor", "place", "bytes"],
            )

    return run


def sorted_suffixes(strings: list[bytes], places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(string, suffix length) of all suffixes of the collection in lexicographic order.

    One round per column, from the strings' ends: row i of the transform holds the symbol
    before the i-th suffix; a stable counting sort of these symbols is the order of the
    suffixes that are one symbol longer. Ends sort first, by string.

    With ``places`` the strings are laid side by side on these positions, and the suffixes
    come column by column, the last one first, each column in lexicographic order. Suffixes
    of different columns then never meet, and a round passes on those of its column only.
    """
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    flat = np.frombuffer(b"".join(strings), np.uint8)
    stops = np.cumsum(lengths)
    m = len(strings)
    if places is not None:
        tails = lengths - places
        by_tail = np.argsort(tails, kind="stable")
        sorted_tails = tails[by_tail]
        carried, found, sizes = np.zeros(0, np.int64), [by_tail[:0]], [by_tail[:0]]
        for column in range(int(tails.max(initial=0)), -int(places.max(initial=0)) - 1, -1):
            open_ = carried[places[carried] >= -column]
            transform = flat[stops[open_] - tails[open_] + column]
            a, b = np.searchsorted(sorted_tails, (column, column + 1))
            carried = np.concatenate((by_tail[a:b], open_[np.argsort(transform, kind="stable")]))
            found.append(carried)
            sizes.append(tails[carried] - column)
        return np.concatenate(found), np.concatenate(sizes)
    string, size = np.arange(m), np.zeros(m, np.int64)
    ends, zeros = np.arange(m), np.zeros(m, np.int64)
    for _ in range(int(lengths.max(initial=0))):
        open_ = np.flatnonzero(size < lengths[string])
        string, size = string[open_], size[open_]
        transform = flat[stops[string] - size - 1]
        order = np.argsort(transform, kind="stable")
        string, size = np.concatenate((ends, string[order])), np.concatenate((zeros, size[order] + 1))
    return string, size


def repeated_windows(
    strings: list[bytes], rank: np.ndarray, starts: np.ndarray, places: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, length) of the runs of windows that occur earlier, by (rank, start) of the strings.

    With ``places`` equal windows must stand in one column of the strings laid on these.
    """
    string, size = sorted_suffixes(strings, places)
    long = size >= LENGTH
    string, size = string[long], size[long]
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    flat = np.frombuffer(b"".join(strings), np.uint8)
    at = np.cumsum(lengths)[string] - size
    same = np.zeros(len(at), bool)
    windows = np.lib.stride_tricks.sliding_window_view(flat, LENGTH) if len(at) else flat
    for a in range(1, len(at), 1 << 14):
        b = min(a + (1 << 14), len(at))
        block = windows[at[a - 1 : b]].view(np.uint32)
        same[a:b] = (block[1:] == block[:-1]).all(axis=1)
    rows = np.flatnonzero(same | np.append(same[1:], False))
    group = np.cumsum(~same[rows])
    string = string[rows]
    offset = lengths[string] - size[rows]
    order = np.lexsort((starts[string] + offset, rank[string], group))
    later = order[1:][group[order[1:]] == group[order[:-1]]]
    string, offset = string[later], offset[later]
    order = np.lexsort((offset, string))
    string, offset = string[order], offset[order]
    new = np.ones(len(string), bool)
    new[1:] = (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(new)
    return string[first], offset[first], np.diff(np.append(first, len(string))) + LENGTH - 1


def _batches_of_collections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.StructArray]:
    """Members of whole collections, about ``BATCH`` at a time."""
    held, n = [], 0
    for batch in batches:
        members = batch.column("members")
        upto = np.cumsum(pc.list_value_length(members).to_numpy(zero_copy_only=False))
        a = 0
        while a < len(members):
            b = min(int(np.searchsorted(upto, (upto[a - 1] if a else 0) + BATCH - n)) + 1, len(members))
            held.append(members.slice(a, b - a).flatten())
            n += len(held[-1])
            a = b
            if n >= BATCH:
                yield pa.concat_arrays(held)
                held, n = [], 0
    if held:
        yield pa.concat_arrays(held)


def _sort_collections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Collections (one row per anchor, lists bounded by ``COLLECTION``) to covered spans."""
    for members in _batches_of_collections(batches):
        doc, key = members.field("doc_id"), members.field("key")
        by_doc = pc.rank(doc, null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
        by_key = pc.rank(key, tiebreaker="dense").to_numpy().astype(np.int64)
        rank = by_doc * (len(members) + 1) + by_key
        starts, places = (members.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "place"))
        string, offset, length = repeated_windows(members.field("bytes").to_pylist(), rank, starts, places)
        if len(string):
            taken = pa.array(string)
            yield pa.RecordBatch.from_arrays(
                [doc.take(taken), key.take(taken), pa.array(starts[string] + offset), pa.array(length)],
                names=["doc_id", "key", "start", "length"],
            )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE):
        out = []
        texts, spans = as_text(batch.column("text")).cast(pa.large_binary()), batch.column("spans")
        for text, covered in zip(texts.to_pylist(), spans.to_pylist()):
            kept, at, removed, runs, end = hashlib.sha256(), 0, 0, 0, -1
            for s in sorted(covered or (), key=lambda s: s["start"]):
                if s["start"] > end:
                    kept.update(text[at : s["start"]])
                    runs += 1
                    end = s["start"]
                removed += max(0, s["start"] + s["length"] - max(end, s["start"]))
                end = max(end, s["start"] + s["length"])
                at = end
            kept.update(text[at:])
            out.append((len(text), removed, runs, kept.hexdigest()))
        columns = [pa.array(c) for c in zip(*out)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        )


def _bit_table(hashes: DataFrame) -> np.ndarray:
    """``2 ** FILTER_BITS`` bits with those of the given hashes set; its size is fixed."""
    bit = F.col("anchor").bitwiseAND(F.lit((1 << FILTER_BITS) - 1).cast("long"))
    place = F.shiftright(bit, 6)
    one = F.expr("shiftleft(1L, CAST(anchor & 63 AS INT))")
    words = hashes.select(place.alias("place"), one.alias("bits")).groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << FILTER_BITS - 6, np.int64)
    table[words["place"].to_numpy()] = words["bits"].to_numpy()
    return table.view(np.uint8)


def _position() -> Column:
    return F.struct("doc_id", "key", "start")


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    """``stored``; the write's shuffle files go when it ends, not when the driver next collects garbage."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        return stored(df, purpose)
    finally:
        if before is None:
            conf.unset(name)
        else:
            conf.set(name, before)


def _halves(segments: DataFrame) -> DataFrame:
    """The segments' windows dealt to two longer anchors, by the bytes before the anchor in a window.

    These are ``low`` to ``high``; windows with ``l`` to ``h`` of them share the ``l`` bytes
    before the anchor and the ``SLACK - h`` bytes after it. A window is in one half only.
    """
    place, right = F.col("place"), F.length("bytes") - F.col("place") - ANCHOR
    middle = F.shiftright(F.col("low") + F.col("high"), 1)
    parts = []
    for low, high in ((F.col("low"), middle), (middle + 1, F.col("high"))):
        before, after = F.least(high, place), F.least(SLACK - low, right)
        common = F.substring("bytes", place - low + 1, LENGTH - (high - low))
        parts.append(
            segments.where(F.greatest(low, SLACK - right) <= before).select(
                "doc_id",
                "key",
                (F.col("start") + place - before).alias("start"),
                F.xxhash64(common, low, high).alias("anchor"),
                low.alias("low"),
                high.alias("high"),
                before.alias("place"),
                F.substring("bytes", place - before + 1, before + ANCHOR + after).alias("bytes"),
            )
        )
    return parts[0].unionByName(parts[1])


def _copies(segments: DataFrame, first: DataFrame, copies: int) -> DataFrame:
    """``doc_id, key, start, length`` of all equal segments but the earliest."""
    same = ("bytes", "anchor", "place")
    digest = [F.xxhash64(*same).alias("d1"), F.xxhash64(F.lit(1), *same).alias("d2")]
    repeats = _kept(first.where("n > 1").select("first", "n", *digest), "repeated-segments")
    dealt = segments.select("doc_id", "key", "start", F.length("bytes").cast("long").alias("length"), *digest)
    often = F.broadcast(repeats.where(F.col("n") > copies))  # of N segments at most N / copies
    found = dealt.join(often, ["d1", "d2"]).unionByName(
        dealt.join(often, ["d1", "d2"], "left_anti").join(repeats.where(F.col("n") <= copies), ["d1", "d2"])
    )
    return found.where(~_position().eqNullSafe(F.col("first"))).select("doc_id", "key", "start", "length")


def covered_spans(docs: DataFrame, collection: int = COLLECTION, copies: int = COPIES) -> DataFrame:
    """``doc_id, key, start, length``: spans (with overlaps) that occur earlier."""
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    counted = source.select("text").mapInArrow(_hashes, "anchor long, n long")
    again = counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    table = spark.sparkContext.broadcast(_bit_table(again))
    schema = f"doc_id {id_type}, key long, start long, anchor long, place int, bytes binary"
    segments = _kept(source.mapInArrow(_segments(table), schema), "segments")
    span = f"doc_id {id_type}, key long, start long, length long"
    found = None
    for halvings in range(SLACK.bit_length(), -1, -1):
        range_ = [c for c in ("low", "high") if c in segments.columns]
        first = _kept(
            segments.groupBy("anchor", *range_, "place", "bytes").agg(
                F.min(_position()).alias("first"), F.count(F.lit(1)).alias("n")
            ),
            "first-segments",
        )
        later = _copies(segments, first, copies)
        found = later if found is None else found.unionByName(later)
        mixed = _kept(first.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_segments")).where("n_segments > 1"), "mixed-anchors")
        large = mixed.where(F.col("n_segments") > collection).select("anchor") if halvings else mixed.limit(0).select("anchor")
        split = large.limit(1).count() > 0
        members = first.select("anchor", "first.*", *range_, "place", "bytes")
        rest = members.join(F.broadcast(large), "anchor", "left_anti") if split else members  # of N segments at most N / collection
        small = rest.join(mixed.select("anchor"), "anchor").groupBy("anchor").agg(
            F.collect_list(F.struct("doc_id", "key", "start", "place", "bytes")).alias("members")
        )
        found = found.unionByName(small.select("members").mapInArrow(_sort_collections, span))
        if not split:
            break
        hot = _kept(members.join(F.broadcast(large), "anchor"), "large-collections")
        if not range_:
            hot = hot.withColumns({"low": F.lit(0), "high": F.lit(SLACK)})
        segments = _kept(_halves(hot), "halved-segments")
    return found


def removed(docs: DataFrame, collection: int = COLLECTION, copies: int = COPIES) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", text_or_empty().alias("text"))
    spans = covered_spans(source, collection, copies).groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    spans = _kept(spans.withColumn("at", F.xxhash64("doc_id", "key")), "spans")
    texts = source.withColumn("key", F.xxhash64("text")).withColumn("at", F.xxhash64("doc_id", "key"))
    met = texts.alias("t").join(
        spans.alias("s"),
        (F.col("t.at") == F.col("s.at")) & (F.col("t.key") == F.col("s.key")) & F.col("t.doc_id").eqNullSafe(F.col("s.doc_id")),
        "left",
    )
    schema = f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return met.select("t.doc_id", "t.text", "s.spans").mapInArrow(_cut, schema)
