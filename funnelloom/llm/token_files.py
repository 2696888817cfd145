"""Token ids as Arrow IPC files of fixed-size lists.

A shard is two files of Arrow's random-access format. ``*.sequences.arrow`` has one row
per sequence: ``ids`` and ``mask``, both lists of the same fixed size, so that sequence i
is a view at a known place of the mapped file and nothing is copied or decoded.
``*.documents.arrow`` has one row per document: its id, where its ids begin within the
shard, and how many there are. Shards are ranges of ``doc_id`` in ascending order; only a
shard's last sequence is padded (mask false).

Files are written below a shared folder under names with the task attempt; the manifest,
a table that Spark commits, lists those of the attempts that count. An executor lost
half-way leaves files that no manifest names. Any store that ``pyarrow.fs`` opens will do.

Defined results: a null text is an empty one and still has its end id; rows with equal
``doc_id`` follow each other in the order of their texts; null ids come first; an empty
table gives an empty manifest; a very long text is one document like others; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from funnelloom.llm.common import stored, text_or_empty
from funnelloom.llm.tokens import encoder, slices

MANIFEST = "shard long, sequences string, documents string, n_sequences long, n_documents long, n_ids long"
BATCH = 256  # sequences per record batch


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


class SequenceFile:
    """Random access to a shard: ``len(f)``, ``f[i]`` -> (ids, mask) as Arrow views."""

    def __init__(self, uri: str):
        store, path = _filesystem(uri)
        local = isinstance(store, pafs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else store.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.batches = self.reader.num_record_batches
        self.size = self.reader.schema.field("ids").type.list_size
        self.rows = 0
        if self.batches:
            self.rows = (self.batches - 1) * BATCH + self.reader.get_batch(self.batches - 1).num_rows

    def __len__(self) -> int:
        return self.rows

    def __getitem__(self, i: int) -> tuple[pa.Array, pa.Array]:
        batch = self.reader.get_batch(i // BATCH)
        at = i % BATCH
        return tuple(batch.column(c).slice(at, 1).flatten() for c in ("ids", "mask"))

    def ids(self) -> Iterator[np.ndarray]:
        """All real ids in order, a record batch at a time."""
        for i in range(self.batches):
            batch = self.reader.get_batch(i)
            flat = batch.column("ids").flatten().to_numpy()
            mask = batch.column("mask").flatten()
            yield flat if mask.true_count == len(mask) else flat[mask.to_numpy(zero_copy_only=False)]


class _Shard:
    """Writes ids as they come; keeps less than a record batch of them."""

    def __init__(self, store: pafs.FileSystem, path: str, size: int, kind: pa.DataType, pad: int):
        self.schema = pa.schema([("ids", pa.list_(kind, size)), ("mask", pa.list_(pa.bool_(), size))])
        self.sink = store.open_output_stream(path)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.size, self.kind, self.pad = size, kind, pad
        self.held: list[np.ndarray] = []
        self.n_held = self.n_sequences = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.kind.to_pandas_dtype()))
        self.n_held += len(ids)
        full = self.n_held // (self.size * BATCH) * self.size * BATCH
        if full:
            flat = np.concatenate(self.held)
            self._write(flat[:full], full)
            self.held, self.n_held = [flat[full:]], self.n_held - full

    def _write(self, flat: np.ndarray, real: int) -> None:
        mask = np.arange(len(flat)) < real
        for at in range(0, len(flat), self.size * BATCH):
            end = at + self.size * BATCH
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(values[at:end]), self.size) for values in (flat, mask)
            ]
            self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
            self.n_sequences += len(columns[0])

    def close(self) -> None:
        if self.n_held:
            flat = np.full(-(-self.n_held // self.size) * self.size, self.pad, self.kind.to_pandas_dtype())
            flat[: self.n_held] = np.concatenate(self.held)
            self._write(flat, self.n_held)
        self.writer.close()
        self.sink.close()


def _writer(tokenizer_path: str, folder: str, size: int, end_id: int, pad_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, attempt = context.partitionId(), context.taskAttemptId()
        out, index = None, None
        n_ids = n_documents = 0
        for batch in slices(batches, "text"):
            own = encoder(tokenizer_path)
            if out is None:
                store, root = _filesystem(folder)
                store.create_dir(root)
                names = [f"{shard:08d}-{attempt}.{part}.arrow" for part in ("sequences", "documents")]
                kind = pa.uint16() if own.tokenizer.get_vocab_size() <= 1 << 16 else pa.uint32()
                out = _Shard(store, f"{root}/{names[0]}", size, kind, pad_id)
                sink = store.open_output_stream(f"{root}/{names[1]}")
                schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("start", pa.int64()), ("n_ids", pa.int64())])
                index = pa.ipc.new_file(sink, schema)
            ids, counts = own.encode(batch.column("text"))
            ends = np.cumsum(counts)
            counts = counts + 1
            out.add(np.insert(ids, ends, end_id))
            starts = n_ids + np.cumsum(counts) - counts
            index.write_batch(
                pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(starts), pa.array(counts)], schema=schema)
            )
            n_ids += int(counts.sum())
            n_documents += len(counts)
        if out is not None:
            out.close()
            index.close()
            sink.close()
            row = [shard, *(f"{folder}/{n}" for n in names), out.n_sequences, n_documents, n_ids]
            columns = ("shard", "sequences", "documents", "n_sequences", "n_documents", "n_ids")
            yield pa.RecordBatch.from_pydict({c: [v] for c, v in zip(columns, row)})

    return write


def write_sequences(
    docs: DataFrame, tokenizer_path: str, folder: str, end_id: int, size: int = 2048, pad_id: int = 0
) -> DataFrame:
    """Write the documents in ascending ``doc_id`` order; the manifest, one row per shard.

    Ranges go by id and then by the text's beginning, so that an id (or its lack) that many
    documents share is dealt to as many shards as it fills.
    """
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.substring("text", 1, 128)).sortWithinPartitions("doc_id", "text")
    made = ordered.mapInArrow(_writer(tokenizer_path, folder, size, end_id, pad_id), MANIFEST)
    return stored(made, "manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            store, path = _filesystem(row["documents"])
            with store.open_input_file(path) as source:
                index = pa.ipc.open_file(source).read_all()
            counts = index["n_ids"].to_numpy()
            crcs = np.zeros(len(counts), np.int64)
            doc, left, crc = 0, int(counts[0]) if len(counts) else 0, 0
            for ids in SequenceFile(row["sequences"]).ids():
                ids, at = ids.astype("<u4"), 0
                while at < len(ids):
                    take = min(left, len(ids) - at)
                    crc = zlib.crc32(ids[at : at + take], crc)
                    at, left = at + take, left - take
                    if not left:
                        crcs[doc], crc, doc = crc, 0, doc + 1
                        left = int(counts[doc]) if doc < len(counts) else 0
            start = pa.array(index["start"].to_numpy() + row["before"])
            columns = [index["doc_id"].combine_chunks(), start, pa.array(counts), pa.array(crcs)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _id_type(manifest: DataFrame) -> str:
    """Type of the ids, as the first index file has it; long where there is no file."""
    row = manifest.select("documents").first()
    if row is None:
        return "long"
    store, path = _filesystem(row.documents)
    with store.open_input_file(path) as source:
        return from_arrow_type(pa.ipc.open_file(source).schema.field("doc_id").type).simpleString()


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    The running start over shards is a window over the manifest alone (a row per shard).
    """
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = manifest.withColumn("before", before).select("sequences", "documents", "before")
    width = manifest.sparkSession.sparkContext.defaultParallelism * 4
    return shards.repartition(width).mapInArrow(_read, f"doc_id {_id_type(manifest)}, start long, n_tokens long, ids_crc32 long")
