"""Token ids of whole Arrow text columns, identical to the library's, by distinct space-led chunks.

Both vocabularies used here split a text before every run of white space that follows a
visible character, and between an ASCII letter and an ASCII mark other than the
apostrophe; neither their normalisers nor their merges reach across such a place. A text is therefore cut there (one NumPy pass over the column's bytes), each
distinct chunk goes through the tokenizers library once, and the ids of the texts are
gathered from the chunks' ids. Texts in which that argument fails (other white space,
control characters, marks of special tokens) are given to the library whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from funnelloom.llm.words import bytes_of, pieces, space_led

# What keeps a text from being cut (control characters, white space outside
# ASCII, the angle-bar marks of special tokens), and the character between joined chunks.
UNCUT = "[\\x00-\\x08\\x0e-\\x1f\\x7f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]|<\\|"
BETWEEN = " \x01"

SLICE_BYTES = 12 << 20  # text handled at once
CACHE_CHUNKS = 1_200_000  # distinct chunks whose ids a worker keeps; later ones are encoded anew in each slice
JOINED = 4_000  # chunks given to the library as one string

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POINT = np.zeros(256, bool)
_POINT[[ord(c) for c in "!\"#$%&()*+,-./:;<=>?@[]^_{|}~"]] = True


class ChunkEncoder:
    """Tokenizer file -> ids of text columns. One object per Python worker.

    ``folds``: the tokenizer's own normaliser lower-cases and drops white space, so that
    chunks differing only in these share their ids.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives a task one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.between = self._whole(BETWEEN)
        self.folds = self._whole("A") == self._whole("\n a")
        self.glue = BETWEEN + " " * self.folds
        self.known: dict[str, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, chunks: list[str]) -> None:
        """Ids of new chunks: joined, encoded, parted again at the separator.

        A chunk that begins a text with punctuation would grow together with the
        separator before it and goes alone.
        """
        mark, lead = self.between[-1], len(self.between) - 1
        starts, lengths, pools, base = [self.starts], [self.lengths], [self.pool], len(self.pool)
        plain = lambda c: c[:1].isalpha() or "0" <= c[:1] <= "9"
        alone = [] if self.folds else [c for c in chunks if not (c[0].isspace() or plain(c))]
        if alone:
            apart = set(alone)
            chunks = alone + [c for c in chunks if c not in apart]
        for c in alone:
            ids = np.array(self._whole(c), np.uint32)
            starts.append([base])
            lengths.append([len(ids)])
            pools.append(ids)
            base += len(ids)
        for i in range(len(alone), len(chunks), JOINED):
            part = chunks[i : i + JOINED]
            ids = np.array(self._whole(self.glue.join(part) + BETWEEN), np.uint32)
            ends = np.flatnonzero(ids == mark)
            if len(ends) != len(part):
                raise ValueError("chunks and separators differ in number")
            first = np.concatenate(([0], ends[:-1] + 1))
            starts.append(first + base)
            lengths.append(ends - lead - first)
            pools.append(ids)
            base += len(ids)
        at = len(self.known)
        self.known.update(zip(chunks, range(at, at + len(chunks))))
        self.starts, self.lengths, self.pool = map(np.concatenate, (starts, lengths, pools))

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids one text after the other, and their number per text."""
        data, offsets, buffer = bytes_of(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if self.folds:
            data = _LOWER[data]
            buffer = pa.py_buffer(data)
        marks = space_led(data)
        marks[1:] |= _POINT[data[1:]] & _LETTER[data[:-1]]
        chunks, bounds = pieces(marks, offsets, buffer)
        coded = chunks.dictionary_encode()
        codes, names = coded.indices.to_numpy(), coded.dictionary.cast(pa.large_string())
        if self.folds:
            coded = pc.ascii_ltrim_whitespace(names).dictionary_encode()
            codes, names = coded.indices.to_numpy()[codes], coded.dictionary
        names = names.to_pylist()
        fresh = [c for c in names if c not in self.known]
        held = len(self.known), len(self.pool)
        self._learn(fresh)
        codes = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))[codes]
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        steps = np.repeat(self.starts[codes] - (ends - lengths), lengths)
        ids = self.pool[steps + np.arange(len(steps))]
        if len(self.known) > CACHE_CHUNKS:
            for c in fresh:
                del self.known[c]
            self.starts, self.lengths, self.pool = self.starts[: held[0]], self.lengths[: held[0]], self.pool[: held[1]]
        upto = np.concatenate(([0], ends))[bounds]
        return ids, np.diff(upto)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids per text); a null is an empty text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        uncut = pc.match_substring_regex(texts, UNCUT).to_numpy(zero_copy_only=False)
        if not uncut.any():
            return self._cut(texts)
        ids, lengths = self._cut(texts.filter(pa.array(~uncut)))
        whole = [np.array(self._whole(t), np.uint32) for t in texts.filter(pa.array(uncut)).to_pylist()]
        counts = np.zeros(len(texts), np.int64)
        counts[~uncut], counts[uncut] = lengths, [len(w) for w in whole]
        out, starts = np.empty(counts.sum(), np.uint32), np.cumsum(counts) - counts
        out[np.repeat(~uncut, counts)] = ids
        for at, w in zip(starts[uncut], whole):
            out[at : at + len(w)] = w
        return out, counts


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file; read once, used by all later tasks."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``limit`` bytes of text, and not many small ones."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]

    for batch in batches:
        ends = np.cumsum(np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))).astype(np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            take = max(1, int(np.searchsorted(ends, before + limit - size, side="right")) - at)
            if held and size + int(ends[at + take - 1]) - before > limit:
                yield joined()
                held, size = [], 0
                continue
            held.append(batch.slice(at, take))
            size += int(ends[at + take - 1]) - before
            at += take
            if size >= limit:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def public_tokenizer(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
