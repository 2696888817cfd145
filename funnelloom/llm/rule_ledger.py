"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and stores the measurements with one
bit per failed rule. A ``Policy`` is a versioned set of rules; applying it, or another
version of it, is bit arithmetic on the stored ledger and reads no text again.
``ablations`` first counts documents per distinct mask (at most 2 ** rules groups, with
map-side combine) and derives from these counts what each rule rejects, alone and with
others.

Defined results: a null text has no words and fails the short-text rule; repeated rows
and repeated ``doc_id`` each get a row of their own; a null ``doc_id`` stays null; an
empty table gives an empty ledger. Columns of the input other than the text are kept by
``judged`` and never read, so clashing names do no harm (see ``judged``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelloom.llm.tokens import slices
from funnelloom.llm.words import as_text, bytes_of, lines, window_ranks, words

SLICE_BYTES = 3 << 20  # text measured at once; word lists of a slice take many times that
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"  # fixed by the contract

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_letter_words",
    "n_shouted_words",
)


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: str  # SQL over the measurements; never null

    @property
    def mask(self) -> int:
        return 1 << self.bit


# Bits are never used again for another rule: stored ledgers stay readable.
RULES = (
    Rule(0, "short", "n_words < 20"),
    Rule(1, "repetitive", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 3 * n_words"),
    Rule(3, "repeated_lines", "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule(5, "few_letters", "10 * n_letter_words < 7 * n_words"),
    Rule(6, "shouted", "2 * n_shouted_words > n_words"),
)


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(r.mask for r in RULES if r.name in self.rules)


BASE = Policy("base", ("short", "repetitive"))
CURRENT = Policy("2026-12", tuple(r.name for r in RULES))


def measured(texts: pa.Array) -> list[np.ndarray]:
    """The measurements of one column of texts, in the order of ``MEASURES``."""
    texts = as_text(texts)
    word, line = words(texts), lines(texts)
    data, offsets, _ = bytes_of(texts)
    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in SYMBOLS[1:-1]]] = True
    upto = np.concatenate(([0], np.cumsum(symbol[data])))
    per_word = lambda values: word.sums(values[word.codes]) if len(word.codes) else np.zeros(len(texts), np.int64)
    lettered = pc.match_substring_regex(word.names, r"\pL").to_numpy(zero_copy_only=False).astype(np.int64)
    shouted = pc.match_substring_regex(word.names, r"^\PL*\p{Lu}\PL*\p{Lu}[^\p{Ll}]*$").to_numpy(zero_copy_only=False)
    lengths = pc.utf8_length(word.names).to_numpy(zero_copy_only=False)
    distinct = np.unique((line.owner << 32) | line.codes)
    n_distinct = np.bincount(distinct >> 32, minlength=len(texts))
    return [
        word.counts,
        per_word(lengths),
        upto[offsets[1:]] - upto[offsets[:-1]],
        line.counts,
        line.counts - n_distinct,
        _repeated(word.codes, word.bounds),
        per_word(lettered),
        per_word(shouted.astype(np.int64)),
    ]


def _repeated(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words per text inside windows of ``WINDOW`` words that the text has twice or more."""
    ranks = window_ranks(codes, WINDOW)
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    covered = np.zeros(len(codes) + 1, np.int64)
    if len(ranks):
        inside = np.flatnonzero(owner[: len(ranks)] == owner[WINDOW - 1 :])
        _, group, size = np.unique((owner[inside] << 32) | ranks[inside], return_inverse=True, return_counts=True)
        again = inside[size[group] > 1]
        covered[again] += 1
        np.subtract.at(covered, again + WINDOW, 1)
    upto = np.concatenate(([0], np.cumsum(np.cumsum(covered[:-1]) > 0)))
    return upto[bounds[1:]] - upto[bounds[:-1]]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE_BYTES):
        columns = [batch.column("row"), *(pa.array(m, pa.int64()) for m in measured(batch.column("text")))]
        yield pa.RecordBatch.from_arrays(columns, names=["row", *MEASURES])


def measurements(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``row`` (struct of the wanted input columns) and the measurements."""
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("text"))
    fields = [source.schema["row"], *(T.StructField(m, T.LongType()) for m in MEASURES)]
    return source.mapInArrow(_measure, T.StructType(fields))


def failed_bits(prefix: str = "") -> Column:
    """One bit per rule that the measurements in scope (under ``prefix``) fail."""
    bits = F.lit(0).cast("long")
    for rule in RULES:
        fails = F.expr(re.sub("[a-z]+(_[a-z]+)+", lambda m: prefix + m[0], rule.fails))
        bits = bits.bitwiseOR(F.when(fails, F.lit(rule.mask).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, measurements, ``failed`` (bits of the failed rules)."""
    found = measurements(docs, ["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), *MEASURES, failed_bits().alias("failed"))


def passes(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def judged(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The documents that pass, with all their columns as they came.

    The rows travel through Python once, in small slices. The measurements come back in
    one struct under a name that no input column has.
    """
    name = "measurements"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    fields = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            found = pa.StructArray.from_arrays([pa.array(m, pa.int64()) for m in measured(batch.column("text"))], list(MEASURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, name])

    book = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, fields)]))
    of_rules = failed_bits(prefix=f"{name}.")
    return book.where(of_rules.bitwiseAND(F.lit(policy.mask).cast("long")) == 0).drop(name)


def ablations(book: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Per rule of the policy: documents it fails, and those that only it rejects.

    Bitwise aggregation: documents are counted per mask first; the few counts are then
    met by the rules. ``kept_without`` counts what stays when the rule is left out.
    """
    masks = book.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")).alias("mask")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = [r for r in RULES if r.mask & policy.mask]
    per_rule = F.explode(
        F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("bit")) for r in rules])
    )
    return (
        masks.select("mask", "n", per_rule.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("mask").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("fails"),
            F.sum(F.when(F.col("mask") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("fails_alone"),
            F.sum(
                F.when(F.col("mask").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, F.col("n")).otherwise(0)
            ).alias("kept_without"),
        )
    )
