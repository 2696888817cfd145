"""Words and lines of Arrow text columns as integer codes, without a Python loop over words.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``. Codes number the distinct words of
the given column; they say nothing across columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def as_text(column: pa.Array) -> pa.Array:
    """Large strings without nulls: a null is an empty text."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Buffer]:
    """The column's bytes, the place where each text begins (and the end), the buffer behind them."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    if low == high:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64), pa.py_buffer(b"")
    buffer = texts.buffers()[2].slice(low, high - low)
    return np.frombuffer(buffer, np.uint8), offsets - low, buffer


def pieces(marks: np.ndarray, offsets: np.ndarray, buffer: pa.Buffer) -> tuple[pa.Array, np.ndarray]:
    """The bytes cut before every marked one and at the texts' ends; pieces before each text."""
    begins = np.append(marks, False)
    begins[offsets] = True
    cuts = np.flatnonzero(begins)
    made = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), buffer])
    return made, np.searchsorted(cuts, offsets)


def space_led(data: np.ndarray) -> np.ndarray:
    """Marks the first white space after a visible byte."""
    space = _SPACE[data]
    marks = np.zeros(len(data), bool)
    np.greater(space[1:], space[:-1], out=marks[1:])
    return marks


@dataclass
class Coded:
    """Items of all texts one after the other: codes, items before each text (and all), distinct items."""

    codes: np.ndarray
    bounds: np.ndarray
    names: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value per item over each text."""
        upto = np.concatenate(([0], np.cumsum(values)))
        return upto[self.bounds[1:]] - upto[self.bounds[:-1]]


def _coded(made: pa.Array, bounds: np.ndarray, strip, keep) -> Coded:
    first = made.dictionary_encode()
    second = strip(first.dictionary.cast(pa.large_string())).dictionary_encode()
    names = second.dictionary
    codes = second.indices.to_numpy()[first.indices.to_numpy()] if len(made) else np.zeros(0, np.int32)
    wanted = keep(names).to_numpy(zero_copy_only=False)[codes] if len(names) else np.zeros(0, bool)
    upto = np.concatenate(([0], np.cumsum(wanted)))
    return Coded(codes[wanted].astype(np.int64), upto[bounds], names)


def words(texts: pa.Array) -> Coded:
    data, offsets, buffer = bytes_of(texts)
    made, bounds = pieces(space_led(data), offsets, buffer)
    return _coded(made, bounds, pc.ascii_trim_whitespace, lambda names: pc.greater(pc.binary_length(names), 0))


def lines(texts: pa.Array) -> Coded:
    """Lines between line feeds that have a word."""
    data, offsets, buffer = bytes_of(texts)
    made, bounds = pieces(data == 10, offsets, buffer)
    worded = lambda names: pc.greater(pc.binary_length(pc.ascii_trim_whitespace(names)), 0)
    return _coded(made, bounds, lambda names: pc.ascii_ltrim(names, "\n"), worded)


def window_ranks(codes: np.ndarray, size: int) -> np.ndarray:
    """A number per run of ``size`` codes (a power of two), equal where the runs are equal."""
    ranks, step = codes, 1
    while step < size:
        if len(ranks) <= step:
            return np.zeros(0, np.int64)
        _, ranks = np.unique((ranks[:-step] << 32) | ranks[step:], return_inverse=True)
        step *= 2
    return ranks


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_UNDO = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))


def scrambled(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all others."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}  # per worker; as long as the longest text column asked for


def _powers(base: np.uint64, n: int) -> np.ndarray:
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        steps = np.full(n, base, np.uint64)
        steps[:1] = 1
        known = _POWERS[int(base)] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, alike wherever the bytes stand."""
    terms = (data.astype(np.uint64) + np.uint64(1)) * _powers(_MULTIPLIER, len(data))
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    return scrambled((upto[ends] - upto[starts]) * _powers(_UNDO, len(data) + 1)[starts])
