"""Benchmark decontamination by SimHash windows.

Words are lower-cased and freed of marks at their ends. A window as long as an item, in
words, gets a 64-bit SimHash of its five-word shingles. The fingerprint is cut into
``BLOCKS`` blocks; two fingerprints within ``RADIUS`` bits agree in some block up to
RADIUS // BLOCKS bits, and a table per block lists the items for every value within that
many bits: no fingerprint within the radius is missed. Each candidate then takes the
exact test: weighted Jaccard similarity of the shingles, counted with repeats, of at
least ``SIMILARITY``.

A window that shares no shingle with an item has similarity zero, so windows are only
formed where one is shared: around each shared shingle, at every start that could hold it.

The items go to every task. Their texts are measured first; above ``ITEM_BYTES`` the
items are dealt into as many passes over the documents as keep each within it.

Radius: at similarity 0.8 the shingle sums correlate by 0.89, each bit differs with
probability 0.15, so that 22 bits of 64 are 4 standard deviations above the mean.

Defined results: null and empty texts and items match nothing; an item of fewer than five
words is one shingle; repeated rows and items each give their own rows; of equally similar
windows of one item the first counts; very long texts are searched whole; an empty table, or
an empty benchmark, gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelloom.llm.tokens import slices
from funnelloom.llm.words import Coded, as_text, words

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 22
BLOCKS = 8
ITEM_BYTES = 16 << 20
CELLS = 4 << 20  # windows times items compared at once
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PARTS = np.array([0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0xABC98388FB8FAC03, 0x8CB92BA72F3D8DD7, 0xF1357AEA2E62A9C5], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _shingles(values: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit value per run of ``size`` words."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += values[k : k + n].astype(np.uint64) * _PARTS[k]
    return _mix(total)


def normal_words(texts: pa.Array) -> Coded:
    """Lower-cased words without marks at their ends; words of marks alone are left out."""
    raw = words(pc.utf8_lower(as_text(texts)) if len(texts) else as_text(texts))
    coded = pc.ascii_trim(raw.names, MARKS).dictionary_encode()
    codes = coded.indices.to_numpy()[raw.codes] if len(raw.codes) else raw.codes
    worded = pc.greater(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False)
    wanted = worded[codes] if len(codes) else np.zeros(0, bool)
    upto = np.concatenate(([0], np.cumsum(wanted)))
    return Coded(codes[wanted].astype(np.int64), upto[raw.bounds], coded.dictionary)


def simhash(shingles: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
    """Fingerprints of all windows of ``counts`` shingles (all of them where not given)."""
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    upto = np.concatenate((np.zeros((1, 64), np.int64), np.cumsum(bits, axis=0, dtype=np.int64)))
    m = len(shingles) if counts is None else int(counts)
    sums = upto[m:] - upto[:-m]
    return np.packbits(2 * sums > m, axis=1, bitorder="little").view("<u8")[:, 0].astype(np.uint64)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity."""
    shared = (a & b).total()
    return shared / (a.total() + b.total() - shared)


class Items:
    """Benchmark items, their shingles and their fingerprint blocks."""

    def __init__(self, ids: list, texts: list[str | None]):
        coded = normal_words(pa.array(texts, pa.large_string()))
        filled = np.flatnonzero(coded.counts)
        self.ids = [ids[i] for i in filled]
        self.vocabulary = coded.names
        self.words = [coded.codes[coded.bounds[i] : coded.bounds[i + 1]] for i in filled]
        self.sizes = [min(SHINGLE, len(w)) for w in self.words]
        self.bags = [self._bag(w, s) for w, s in zip(self.words, self.sizes)]
        places = defaultdict(list)
        prints = []
        for i, (w, s) in enumerate(zip(self.words, self.sizes)):
            values = _shingles(w, s)
            prints.append(simhash(values)[0])
            for at, v in enumerate(values.tolist()):
                places[s, v].append((i, at))
        self.places = dict(places)
        self.known = {s: np.array(sorted(v for k, v in places if k == s), np.uint64) for s in set(self.sizes)}
        self.prints = np.array(prints, np.uint64)
        # A window is compared with items of its own length alone, so the tables go by length.
        flips = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :]) <= RADIUS // BLOCKS
        blocks = self.prints.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
        lengths = np.array([len(w) for w in self.words], np.int64)
        self.of_length = {int(n): np.flatnonzero(lengths == n) for n in np.unique(lengths)}
        self.tables = {n: [flips[:, blocks[of, b]] for b in range(BLOCKS)] for n, of in self.of_length.items()}

    @staticmethod
    def _bag(w: np.ndarray, size: int) -> Counter:
        return Counter(zip(*(w[k : len(w) - size + 1 + k].tolist() for k in range(size))))

    def candidates(self, prints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of the pairs within the radius, found over the blocks; items of ``n`` words."""
        of, tables = self.of_length[n], self.tables[n]
        blocks = prints.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
        found = np.zeros((len(prints), len(of)), bool)
        for b, table in enumerate(tables):
            found |= table[blocks[:, b]]
        window, item = np.nonzero(found)
        near = np.bitwise_count(prints[window] ^ self.prints[of[item]]) <= RADIUS
        return window[near], of[item[near]]

    def matches(self, own: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, words) of a document's best window per item."""
        regions: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for s, known in self.known.items():
            inside = np.concatenate(([0], np.cumsum(own >= 0)))
            starts = np.flatnonzero(inside[s:] - inside[:-s] == s) if len(own) >= s else np.zeros(0, np.int64)
            if not len(starts):
                continue
            values = _shingles(own, s)[starts]
            at = np.minimum(np.searchsorted(known, values), len(known) - 1)
            for p, v in zip(starts[known[at] == values].tolist(), values[known[at] == values].tolist()):
                for n in {len(self.words[i]) for i, _ in self.places[s, v]}:
                    low, high = max(0, p + s - n), min(p, len(own) - n)
                    if low > high:
                        continue
                    spans = regions[s, n]
                    if spans and low <= spans[-1][1] + 1:
                        spans[-1] = (spans[-1][0], max(high, spans[-1][1]))
                    else:
                        spans.append((low, high))
        best: dict[int, tuple[float, int, int]] = {}
        for (s, n), spans in regions.items():
            step = max(1, min(4096, CELLS // len(self.of_length[n])))
            for low, high in spans:
                for at in range(low, high + 1, step):
                    part = own[at : min(high, at + step - 1) + n]
                    for k, i in zip(*self.candidates(simhash(_shingles(part, s), n - s + 1), n)):
                        value = similarity(self._bag(part[k : k + n], s), self.bags[i])
                        if value >= SIMILARITY and value > best.get(i, (0.0, 0, 0))[0]:
                            best[i] = (value, at + int(k), n)
        return [(int(i), *b) for i, b in sorted(best.items())]

    def search(self, texts: pa.Array) -> Iterator[tuple[int, list[tuple[int, float, int, int]]]]:
        """(text, matches) for the texts that have any."""
        coded = normal_words(texts)
        if not len(coded.codes) or not self.ids:
            return
        at = pc.index_in(coded.names, value_set=self.vocabulary)
        # Words of no item get negative numbers, each its own.
        number = np.where(pc.is_valid(at).to_numpy(zero_copy_only=False), pc.fill_null(at, 0).to_numpy(), -1 - np.arange(len(at)))
        own = number.astype(np.int64)[coded.codes]
        shared = np.zeros(len(own), bool)
        for s, known in self.known.items():
            inside = np.concatenate(([0], np.cumsum(own >= 0)))
            starts = np.flatnonzero(inside[s:] - inside[:-s] == s) if len(own) >= s else np.zeros(0, np.int64)
            if len(starts):
                total = np.zeros(len(starts), np.uint64)
                for k in range(s):
                    total += own[starts + k].astype(np.uint64) * _PARTS[k]
                values = _mix(total)
                place = np.minimum(np.searchsorted(known, values), len(known) - 1)
                shared[starts[known[place] == values]] = True
        hits = coded.sums(shared.astype(np.int64))
        for i in np.flatnonzero(hits):
            if found := self.matches(own[coded.bounds[i] : coded.bounds[i + 1]]):
                yield int(i), found


_BUILT: dict[str, Items] = {}  # of this worker: the parts of the benchmark met last


def _items(ids: list, texts: list[str | None], key: str) -> Items:
    """The same part is built once in a worker, not once in each of its tasks."""
    if key not in _BUILT:
        if len(_BUILT) > 1:
            _BUILT.clear()
        _BUILT[key] = Items(ids, texts)
    return _BUILT[key]


def _passes(benchmark: DataFrame) -> Iterator[tuple[list, list, str]]:
    """The items, in as many parts as the bound on what goes to every task asks for."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // ITEM_BYTES) or 1
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        yield [r.item_id for r in rows], [r.text for r in rows], hashlib.sha256(repr(rows).encode()).hexdigest()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, similarity, first_word, n_words``: the best window of each
    document and item that are alike."""
    id_type, item_type = (df.schema[c].dataType.simpleString() for df, c in ((docs, "doc_id"), (benchmark, "item_id")))
    found = None
    for part in _passes(benchmark):

        def run(batches: Iterator[pa.RecordBatch], part=part) -> Iterator[pa.RecordBatch]:
            items = _items(*part)
            for batch in slices(batches, "text"):
                rows = [(i, items.ids[m[0]], *m[1:]) for i, ms in items.search(batch.column("text")) for m in ms]
                if rows:
                    at, *columns = map(list, zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(at)), *map(pa.array, columns)],
                        names=["doc_id", "item_id", "similarity", "first_word", "n_words"],
                    )

        schema = f"doc_id {id_type}, item_id {item_type}, similarity double, first_word long, n_words long"
        one = docs.select("doc_id", "text").mapInArrow(run, schema)
        found = one if found is None else found.unionByName(one)
    return found


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns as they came."""
    for part in _passes(benchmark):

        def run(batches: Iterator[pa.RecordBatch], part=part) -> Iterator[pa.RecordBatch]:
            items = _items(*part)
            for batch in slices(batches, "text"):
                stays = np.ones(batch.num_rows, bool)
                stays[[i for i, _ in items.search(batch.column("text"))]] = False
                yield batch.filter(pa.array(stays))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
