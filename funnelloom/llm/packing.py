"""Order-preserving packing by dynamic programming.

The ids of a partition's documents, one after the other in the order of the input, are
cut into windows of at most ``size`` ids. A cut may stand at the end of a document (free),
of a sentence, or, where sentences are long, at evenly spaced ids (both at a penalty, in
ids). With p a cut's place, the least cost up to cut j is

    best(j) = penalty(j) + min over i, p(j) - p(i) <= size, of best(i) + size - (p(j) - p(i))

where the last window counts no padding. The part that depends on i is best(i) + p(i): a sliding minimum, kept in a monotone queue,
so the work is linear in the number of cuts. Sequences never reach across partitions, and
the rest at a partition's end becomes windows of powers of two, which need no padding. No
row is moved to another partition; memory holds ``BLOCK`` ids (or one document) per task.

Defined results: a null text is an empty document (its end id alone); repeated rows and
ids are packed as often as they occur; an empty table has no pieces; a very long text is
tokenised whole and cut like others; of equally good cuts the earliest counts; other columns
are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelloom.llm.common import text_or_empty
from funnelloom.llm.tokens import encoder, slices

BLOCK = 1 << 20
SENTENCE_PENALTY = 2.0
TOKEN_PENALTY = 8.0
SPACING = 16  # between cuts where no sentence ends
PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"
)


def sentence_ends(vocabulary: dict[str, int]) -> np.ndarray:
    """Marks the ids that end a sentence."""
    marks = np.zeros(max(vocabulary.values()) + 1, bool)
    marks[[i for token, i in vocabulary.items() if token.removesuffix("</w>")[-1:] in tuple(".!?")]] = True
    return marks


def best_cuts(places: np.ndarray, penalties: np.ndarray, size: int) -> list[int]:
    """Places of the cheapest cuts from place 0 to the last of ``places`` (ascending, gaps <= size).

    The last window counts no padding: it is cut into powers of two or, within a
    partition, opened again.
    """
    at, cost = [0, *places.tolist()], [0.0, *penalties.tolist()]
    came, best = [0] * len(at), [0.0] * len(at)
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # (best + place, place, index), ascending
    for j in range(1, len(at) - 1):
        p = at[j]
        while queue[0][1] < p - size:
            queue.popleft()
        low, _, came[j] = queue[0]
        key = cost[j] + size + low
        best[j] = key - p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, p, j))
    j = len(at) - 1
    came[j] = min(range(bisect_left(at, at[j] - size), j), key=best.__getitem__)
    cuts = []
    while j:
        cuts.append(at[j])
        j = came[j]
    return cuts[::-1]


def powers_of_two(length: int) -> list[int]:
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


class Packer:
    """Takes documents' ids in order, gives pieces; one per task."""

    def __init__(self, size: int, ends: np.ndarray, end_id: int, first_sequence: int):
        self.size, self.ends, self.end_id, self.sequence = size, ends, end_id, first_sequence
        self.ids = np.zeros(0, np.uint32)
        self.begins = np.zeros(0, np.int64)  # of each held document, relative to the held ids; may be negative
        self.totals = np.zeros(0, np.int64)
        self.rows = np.zeros(0, np.int64)

    def _cuts(self) -> np.ndarray:
        places = np.flatnonzero(self.ends[np.minimum(self.ids, len(self.ends) - 1)]) + 1
        penalties = np.full(len(places), SENTENCE_PENALTY)
        borders = (self.begins + self.totals)[self.begins + self.totals <= len(self.ids)]
        places, which = np.unique(np.concatenate((borders, places)), return_index=True)
        penalties = np.concatenate((np.zeros(len(borders)), penalties))[which]
        gaps = np.diff(np.concatenate(([0], places)))
        long = np.flatnonzero(gaps > SPACING)
        if len(long):
            more = np.concatenate([np.arange(places[k] - gaps[k] + SPACING, places[k], SPACING) for k in long])
            order = np.argsort(np.concatenate((places, more)), kind="stable")
            places = np.concatenate((places, more))[order]
            penalties = np.concatenate((penalties, np.full(len(more), TOKEN_PENALTY)))[order]
        return best_cuts(places, penalties, self.size)

    def add(self, ids: np.ndarray, counts: np.ndarray, rows: np.ndarray) -> dict[str, np.ndarray] | None:
        begins = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate((self.ids, ids))
        self.begins = np.concatenate((self.begins, begins))
        self.totals, self.rows = np.concatenate((self.totals, counts)), np.concatenate((self.rows, rows))
        return self._emit(self._cuts()[:-1]) if len(self.ids) >= BLOCK else None

    def finish(self) -> dict[str, np.ndarray] | None:
        if not len(self.ids):
            return None
        cuts = self._cuts()
        last = cuts[-2] if len(cuts) > 1 else 0
        return self._emit([*cuts[:-1], *(last + np.cumsum(powers_of_two(cuts[-1] - last)))])

    def _emit(self, cuts: list[int]) -> dict[str, np.ndarray] | None:
        """Pieces of the windows that end at ``cuts``; what follows the last stays held."""
        if not cuts:
            return None
        cuts = np.array(cuts, np.int64)
        windows = np.concatenate(([0], cuts[:-1]))
        end = int(cuts[-1])
        inside = self.begins[(self.begins > 0) & (self.begins < end)]
        starts = np.unique(np.concatenate((windows, inside)))
        stops = np.append(starts[1:], end)
        doc = np.searchsorted(self.begins, starts, side="right") - 1
        window = np.searchsorted(windows, starts, side="right") - 1
        view = memoryview(self.ids.astype("<u4")).cast("B")
        out = {
            "row": self.rows[doc],
            "start": starts - self.begins[doc],
            "length": stops - starts,
            "ids_crc32": np.array([zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts, stops)], np.int64),
            "doc_tokens": self.totals[doc],
            "sequence_id": self.sequence + window,
            "offset": starts - windows[window],
            "sequence_length": (cuts - windows)[window],
        }
        self.sequence += len(cuts)
        left = self.begins + self.totals > end
        self.ids, self.begins = self.ids[end:].copy(), self.begins[left] - end
        self.totals, self.rows = self.totals[left], self.rows[left]
        return out


def _pack(tokenizer_path: str, size: int, end_id: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path)
        packer = Packer(size, sentence_ends(own.tokenizer.get_vocab()), end_id, TaskContext.get().partitionId() << 33)
        held, base = [], 0  # document ids of rows that may still have pieces, and the first one's row

        def batch_of(out: dict[str, np.ndarray]) -> pa.RecordBatch:
            ids = pa.chunked_array(held).take(pa.array(out.pop("row") - base)).combine_chunks()
            return pa.RecordBatch.from_arrays([ids, *map(pa.array, out.values())], names=["doc_id", *out])

        for batch in slices(batches, "text"):
            held.append(batch.column("doc_id"))
            n = base + sum(map(len, held))
            ids, counts = own.encode(batch.column("text"))
            ids = np.insert(ids, np.cumsum(counts), end_id)
            if out := packer.add(ids, counts + 1, np.arange(n - batch.num_rows, n)):
                yield batch_of(out)
                first = int(packer.rows[0]) if len(packer.rows) else n
                rest = pa.chunked_array(held).slice(first - base).combine_chunks()
                held, base = [rest], first
        if out := packer.finish():
            yield batch_of(out)

    return pack


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: ``doc_id`` and ``PIECES``. Padding: ``size - sequence_length``, or
    none where ``sequence_length`` is a power of two."""
    source = docs.select("doc_id", text_or_empty().alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_pack(tokenizer_path, size, end_id), f"doc_id {id_type}, {PIECES}")


def padding(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """Ids, sequences and padding ids of a packing."""
    one = pieces.where(F.col("offset") == 0)
    pad = F.when(F.bit_count("sequence_length") == 1, 0).otherwise(size - F.col("sequence_length"))
    return one.agg(F.count(F.lit(1)).alias("n_sequences"), F.sum("sequence_length").alias("n_ids"), F.sum(pad).alias("n_padding"))
