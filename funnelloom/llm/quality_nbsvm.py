"""Quality classifier: a linear hinge-loss model over naive-Bayes-scaled n-gram indicators.

Features are indicators: each word, and each run of one to three word shapes (case, kind
of ending, marks alone, same as the word before). Each is scaled by the log ratio of its
smoothed document counts in the two classes. The model is fitted by dual coordinate
descent. Counts and fit use about ``FIT_ROWS`` labelled rows chosen by a hash of the id,
a bound on what the driver holds, which may be raised; a fifth of them only sets the
slope and offset of the logistic score. Every document is scored.

Labels, language, source and id are no features. Rows held out never reach counts, fit or
calibration. Defined results: a null text is an empty one and gets the score of a text
without features; where labels of one class are missing, every score is the share of
label 1 (0.5 without any label); repeated rows each get a row; of texts that share an id
the smallest is fitted on, so that the fitted rows are never more than the chosen labels;
very long texts are read whole; an empty table gives no rows; other columns are not read,
whatever their names. The fit takes its rows in the order of a hash of their ids, so that
the same table gives the same scores however it is partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelloom.llm.common import text_or_empty
from funnelloom.llm.tokens import slices
from funnelloom.llm.words import as_text, words

WORD_BITS, SHAPE_BITS = 17, 16
SIZE = (1 << WORD_BITS) + (1 << SHAPE_BITS)
FIT_ROWS = 20_000
ROUNDS = 12
COST = 1.0
SMOOTHING = 1.0

# Kinds of words by distinct word: patterns and the number that each adds.
_SHAPES = (
    (r"^\P{L}*\p{Lu}", 1),
    (r"\p{Lu}\P{L}*\p{Lu}", 2),
    (r"\p{Ll}", 4),
    (r"[.,;:?]$", 8),
    (r"!$", 16),
    (r"[#*$%&|<>]", 32),
    (r"[0-9]", 64),
)


def _spread(values: np.ndarray, bits: int) -> np.ndarray:
    return (values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of all indicators, each once, in order."""
    coded = words(as_text(texts))
    if not len(coded.codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    digest = xxhash.xxh32_intdigest
    lower = pc.utf8_lower(coded.names).cast(pa.large_binary()).to_pylist()
    word = np.fromiter((digest(w) for w in lower), np.int64, len(lower)) & ((1 << WORD_BITS) - 1)
    shape = np.zeros(len(lower), np.int64)
    for pattern, number in _SHAPES:
        shape += number * pc.match_substring_regex(coded.names, pattern).to_numpy(zero_copy_only=False).astype(np.int64)
    owner, shapes = coded.owner, shape[coded.codes]
    shapes[1:] += 128 * ((coded.codes[1:] == coded.codes[:-1]) & (owner[1:] == owner[:-1]))
    keys = [owner << 32 | word[coded.codes]]
    run = np.ones(len(shapes), np.int64)
    for k in range(3):
        if len(shapes) > k:
            run = run[: len(shapes) - k] * 257 + shapes[k:] + 1
            inside = owner[: len(run)] == owner[k:]
            keys.append((owner[: len(run)] << 32 | (1 << WORD_BITS) + _spread(run, SHAPE_BITS))[inside])
    both = np.unique(np.concatenate(keys))
    return both >> 32, both & 0xFFFFFFFF


@dataclass
class Model:
    weights: np.ndarray  # of the scaled, normalised indicators, times their scale
    scales: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        owner, feature = features(texts)
        n = len(texts)
        norm = np.sqrt(np.bincount(owner, self.scales[feature] ** 2, n))
        margin = np.bincount(owner, self.weights[feature], n) / np.maximum(norm, 1e-9) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -40, 40)))


def constant(share: float) -> Model:
    zeros = np.zeros(SIZE)
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Model(zeros, zeros, 0.0, 0.0, float(np.log(share / (1 - share))))


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model; rows are (indices, values) of norm one.

    The bias is the weight of a constant feature, so every row has squared norm two.
    """
    weights, bias, alpha = np.zeros(SIZE), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(0)
    for _ in range(ROUNDS):
        for i in order.permutation(len(rows)):
            at, values = rows[i]
            norm = 1.0 + float(values @ values)
            gradient = signs[i] * (float(weights[at] @ values) + bias) - 1.0
            new = min(max(alpha[i] - gradient / norm, 0.0), cost[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                weights[at] += step * values
                bias += step
                alpha[i] = new
    return weights, bias


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with Platt's smoothed targets."""
    ones = labels.sum()
    targets = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x = np.stack((margins, np.ones_like(margins)), axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (targets - p))
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        owner, feature = features(batch.column("text"))
        bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(feature.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("quality"), lists], names=["place", "quality", "features"])


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learn from about ``fit_rows`` of the labelled rows that are not held out."""
    marked = labels.where(F.col("quality").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    fraction = min(1.0, fit_rows / max(1, marked.count()))
    chosen = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(fraction * (1 << 20)) + 1)
    # The chosen labels are bounded by ``fit_rows``, so they go to the texts, not the texts to them.
    train = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    one = train.groupBy("doc_id", "quality").agg(F.min("text").alias("text")).withColumn("place", F.xxhash64("doc_id"))
    rows_of = one.select("place", "quality", "text").mapInArrow(_rows, "place long, quality int, features array<int>")
    sample = rows_of.toArrow().sort_by("place")
    label = sample["quality"].to_numpy().astype(np.int64)
    totals = np.bincount(label, minlength=2)
    if not totals.all():
        return constant(totals[1] / totals.sum() if totals.any() else 0.5)
    lists = [np.array(x, np.int64) for x in sample["features"].to_pylist()]
    flat, of = np.concatenate(lists), np.repeat(label, [len(x) for x in lists])
    seen = np.stack([np.bincount(flat[of == k], minlength=SIZE) for k in (0, 1)])
    share = (seen + SMOOTHING) / (totals[:, None] + 2 * SMOOTHING)
    scales = np.log(share[1]) - np.log(share[0])
    rows = []
    for at in lists:
        values = scales[at]
        norm = np.sqrt(values @ values)
        rows.append((at, values / norm if norm else values))
    draw = sample["place"].to_numpy() % 5 == 0
    part = draw if len(set(label[draw])) == 2 and len(set(label[~draw])) == 2 else np.zeros(len(rows), bool)
    inner = np.flatnonzero(~part)
    balance = len(inner) / (2 * np.maximum(np.bincount(label[inner], minlength=2), 1))
    cost = COST * balance[label[inner]]
    weights, bias = dual_coordinate_descent([rows[i] for i in inner], 2.0 * label[inner] - 1, cost)
    outer = np.flatnonzero(part) if part.any() else inner
    margins = np.array([weights[rows[i][0]] @ rows[i][1] + bias for i in outer])
    slope, offset = logistic(margins, label[outer])
    return Model(weights * scales, scales, bias, slope, offset)


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = pa.array(shared.value.scores(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), made], names=["doc_id", "score"])

    source = docs.select("doc_id", text_or_empty().alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    scored = source.mapInArrow(run, f"doc_id {id_type}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
