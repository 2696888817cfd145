"""Phrase collocations on a weighted de Bruijn graph of words.

Nodes are runs of three words, edges runs of four; an edge leads from its first three
words to its last three and weighs as many occurrences as the corpus has of it. Only
edges are counted. All shorter counts follow from the flow: what leaves a node, plus the
pieces that end there, is its own count; the same step gives pairs from nodes and words
from pairs.

1. *Pieces cut where no phrase can pass.* A phrase cannot be frequent if one of its words
   or neighbouring pairs isn't. Two passes count words and pairs by 64-bit hash; those that
   are frequent enough set bits in a table, and pieces are cut at all others. A bit set by
   mistake keeps an edge too many and changes no count.
2. *Edges and ends.* Each piece gives its edges and, as corrections, its last three, two
   and one words; per language and text they are added up (map-side combine).
3. *Flow* from edges to nodes, pairs and words, each level one grouping of the one above.
4. *Unary paths.* A node whose frequent edge in and frequent edge out both weigh as much as
   the node lets everything through: the two edges join. Such links are followed by
   pointer doubling; a path is one row, however often its words occur. Inside a path all
   runs of three have the path's weight, so they need no look-up, and an edge covers them.
5. *Scores* of the remaining candidates by their cuts, the lowest first; per language the
   best by a two-step ranking, so that no language meets in one task unranked.

The bit table has 16 bits per frequent item and at most ``TABLE_BITS`` (32 MiB) at any
input; beyond that more infrequent items pass, and results stay the same. A path has at
most the words of one piece. Arithmetic is on decimals.

Defined results: a null text is empty, a null ``lang`` is ``und``; an empty table gives no
rows; repeated rows count each; texts are cut into words whole, whatever their length, and
their words never leave the text; ties go to the smaller cut and then to the phrase in
UTF-8 order; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelloom.llm.common import stored
from funnelloom.llm.tokens import slices
from funnelloom.llm.words import as_text, bytes_of, scrambled, span_hashes

LONGEST = 4
MIN_COUNT = 30
COVER = (80, 100)  # a longer phrase with this share of the count takes a candidate's place
SCALE = 2_000_000
TOP = 2_000
TABLE_BITS = 28
TALLY = 3 << 19  # hashes that a task counts before it hands them on
SLICE = 2 << 20

_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[ord(c) for c in ".,;:!?"] + [*range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Words:
    """The words of a slice of texts, in order: bytes, spans, hashes, and links to the next."""

    def __init__(self, batch: pa.RecordBatch):
        raw, offsets, _ = bytes_of(as_text(batch.column("text")))
        self.data = _LOWER[raw]
        kind = _CLASS[self.data]
        inside = np.concatenate(([False], kind == 0, [False]))
        edge = np.zeros(len(inside), bool)
        edge[offsets] = True  # a word ends with its text
        self.starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[: len(kind)]))
        self.ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1 : len(kind) + 1])) + 1
        text = np.searchsorted(offsets, self.starts, side="right") - 1
        stops = np.concatenate(([0], np.cumsum(kind == 2)))[self.starts]
        self.linked = np.zeros(len(self.starts), bool)
        self.linked[:-1] = (stops[1:] == stops[:-1]) & (text[1:] == text[:-1])
        coded = pc.fill_null(batch.column("lang").cast(pa.string()), "und").dictionary_encode()
        self.langs = coded.dictionary
        self.lang = coded.indices.to_numpy()[text]
        seeds = np.array([xxhash.xxh64_intdigest(x.encode()) for x in self.langs.to_pylist()], np.uint64)
        own = seeds[self.lang] if len(seeds) else np.zeros(0, np.uint64)
        self.hashes = scrambled(span_hashes(self.data, self.starts, self.ends) ^ own)

    def pairs(self) -> np.ndarray:
        """Hash of each word with the one after it; the last has none that counts."""
        after = np.roll(self.hashes, -1)
        return scrambled(self.hashes * np.uint64(3) + (after << np.uint64(17) | after >> np.uint64(47)))


def _marked(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes & np.uint64(len(table) * 8 - 1)).astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _tally(hashes_of: Callable[[_Words], np.ndarray]):
    """Hashes with counts, added up within a task as far as ``TALLY`` of them allow."""

    def row(found: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], names=["hash", "n"])

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        found, place = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        return found, np.bincount(place, np.concatenate([n for _, n in held]), len(found)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in slices(batches, "text", SLICE):
            held.append(np.unique(hashes_of(_Words(batch)), return_counts=True))
            if sum(len(h) for h, _ in held) > TALLY:
                held = [merged(held)]
                if len(held[0][0]) > TALLY // 2:
                    yield row(*held.pop())
        if held:
            yield row(*merged(held))

    return run


def _frequent(rows: DataFrame, hashes_of: Callable[[_Words], np.ndarray], min_count: int, purpose: str) -> np.ndarray:
    """Bit table of the hashes counted ``min_count`` times or more."""
    counted = rows.mapInArrow(_tally(hashes_of), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    kept = stored(counted.where(F.col("n") >= min_count).select("hash"), purpose)
    bits = min(TABLE_BITS, max(16, (16 * kept.count()).bit_length()))
    low = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    one = F.expr("shiftleft(1L, CAST(hash & 63 AS INT))")
    words = kept.select(F.shiftright(low, 6).alias("at"), one.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << bits - 6, np.int64)
    table[words["at"].to_numpy()] = words["bits"].to_numpy()
    return table.view(np.uint8)


def _runs(words_table, pairs_table):
    """Edges and piece ends of a slice, counted; size 0 stands for all words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, joined = words_table.value, pairs_table.value
        for batch in slices(batches, "text", SLICE):
            words = _Words(batch)
            if not len(words.starts):
                continue
            totals = np.bincount(words.lang, minlength=len(words.langs))
            yield _rows(words.langs, np.arange(len(totals)), 0, pa.array([""] * len(totals), pa.string()), totals)
            good = _marked(known, words.hashes)
            link = words.linked & good & np.roll(good, -1) & _marked(joined, words.pairs())
            kept = np.flatnonzero(good)
            if not len(kept):
                continue
            cuts = np.stack((words.starts[kept], words.ends[kept]), axis=1).ravel()
            spans = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(words.data)])
            coded = spans.take(pa.array(np.arange(0, len(cuts), 2))).dictionary_encode()
            code = np.full(len(good) + LONGEST, -1, np.int64)
            code[kept] = coded.indices.to_numpy()
            names = coded.dictionary.cast(pa.large_string())
            padded = np.concatenate((link, np.zeros(LONGEST, bool)))
            run_on = good  # runs of `size` words that begin here
            for size in range(1, LONGEST + 1):
                more = run_on & padded[size - 1 : len(good) + size - 1]
                at = np.flatnonzero(run_on if size == LONGEST else run_on & ~more)
                if len(at):
                    yield _counted(words, names, code, at, size)
                run_on = more

    return run


def _counted(words: _Words, names: pa.Array, code: np.ndarray, at: np.ndarray, size: int) -> pa.RecordBatch:
    columns = [code[at + k] for k in range(size)]
    order = np.lexsort([*reversed(columns), words.lang[at]])
    sorted_ = [words.lang[at][order], *(c[order] for c in columns)]
    new = np.ones(len(at), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in sorted_], axis=0)
    first = np.flatnonzero(new)
    parts = [names.take(pa.array(c[first])) for c in sorted_[1:]]
    gram = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if size > 1 else parts[0]
    return _rows(words.langs, sorted_[0][first], size, gram.cast(pa.string()), np.diff(np.append(first, len(at))))


def _rows(langs: pa.Array, lang: np.ndarray, size: int, gram: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [langs.take(pa.array(lang)), pa.array(np.full(len(lang), size, np.int32)), gram, pa.array(n.astype(np.int64))],
        names=["lang", "size", "gram", "n"],
    )


def _first(words: int, gram: str = "gram") -> Column:
    return F.substring_index(gram, " ", words)


def _last(words: int, gram: str = "gram") -> Column:
    return F.substring_index(gram, " ", -words)


class Graph:
    """Edges, ends, and the counts that the flow gives: ``nodes`` (3 words), ``pairs``, ``singles``."""

    def __init__(self, docs: DataFrame, min_count: int = MIN_COUNT):
        spark = docs.sparkSession
        rows = docs.select("lang", "text")
        self.min_count = min_count
        known = spark.sparkContext.broadcast(_frequent(rows, lambda w: w.hashes, min_count, "frequent-words"))
        linked = lambda w: w.pairs()[w.linked & _marked(known.value, w.hashes) & np.roll(_marked(known.value, w.hashes), -1)]
        joined = spark.sparkContext.broadcast(_frequent(rows, linked, min_count, "frequent-pairs"))
        counted = rows.mapInArrow(_runs(known, joined), "lang string, size int, gram string, n long")
        grams = stored(counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")), "edges-and-ends")
        self.totals = grams.where("size = 0").select("lang", "n")
        level = self.edges = self._of(grams, LONGEST)
        made = []
        for size in (3, 2, 1):
            flow = level.select("lang", _first(size).alias("gram"), "n").unionByName(self._of(grams, size))
            level = stored(flow.groupBy("lang", "gram").agg(F.sum("n").alias("n")), f"flow-{size}")
            made.append(level)
        self.nodes, self.pairs, self.singles = made

    @staticmethod
    def _of(grams: DataFrame, size: int) -> DataFrame:
        return grams.where(F.col("size") == size).select("lang", "gram", "n")

    def _often(self, rows: DataFrame) -> DataFrame:
        return rows.where(F.col("n") >= self.min_count)

    def compacted(self) -> tuple[DataFrame, DataFrame]:
        """Unary paths ``lang, words, n``, and the nodes ``lang, gram`` inside them."""
        edges = stored(self._often(self.edges), "frequent-edges")
        into = edges.select("lang", _last(3).alias("node"), "n", F.col("gram").alias("before"))
        out = edges.select("lang", _first(3).alias("node"), "n", "gram")
        nodes = self._often(self.nodes).select("lang", F.col("gram").alias("node"), "n")
        inner = stored(nodes.join(into, ["lang", "node", "n"]).join(out, ["lang", "node", "n"]), "unary-nodes")
        back = inner.select("lang", "gram", "before")
        far = stored(
            edges.join(back, ["lang", "gram"], "left").select(
                "lang", "gram", "n", F.coalesce("before", "gram").alias("head"), F.col("before").isNotNull().cast("long").alias("steps")
            ),
            "paths",
        )
        while True:  # each round doubles the reach; a path has no more edges than a piece has words
            jump = far.where("steps > 0").select("lang", F.col("gram").alias("head"), F.col("head").alias("on"), F.col("steps").alias("more"))
            far = stored(
                far.join(jump, ["lang", "head"], "left").select(
                    "lang", "gram", "n", F.coalesce("on", "head").alias("head"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                    F.col("on").isNotNull().alias("moved"),
                ),
                "paths",
            )
            if not far.where("moved").limit(1).count():
                break
        steps = F.sort_array(F.collect_list(F.struct("steps", "gram")))
        paths = far.groupBy("lang", "head").agg(steps.alias("steps"), F.max("n").alias("n"))
        later = F.transform(F.slice("steps", F.lit(2), F.size("steps")), lambda s: F.substring_index(s.gram, " ", -1))
        words = F.concat(F.split("head", " "), later)
        return stored(paths.select("lang", words.alias("words"), "n"), "unary-paths"), inner.select("lang", F.col("node").alias("gram"))

    def candidates(self) -> tuple[DataFrame, DataFrame]:
        """Cuts of all candidates that no longer phrase covers.

        The first table asks for both parts (``left``, ``right``), the second for one
        (``ask``) where the other part lies on a path or at its end (``known``).
        """
        paths, inner = self.compacted()
        ends = self._often(self.nodes).select("lang", F.col("gram").alias("at"), F.col("n").alias("end_n"))
        joined = lambda a, n: F.array_join(F.slice("words", a, n), " ")
        size = F.size("words") - LONGEST + 1
        whole = (
            paths.withColumn("at", joined(F.lit(1), 3)).join(ends, ["lang", "at"]).withColumnRenamed("end_n", "first_n").drop("at")
            .withColumn("at", joined(F.size("words") - 2, 3)).join(ends, ["lang", "at"]).withColumnRenamed("end_n", "last_n").drop("at")
        )
        quads = whole.withColumn("i", F.explode(F.sequence(F.lit(1), size))).select(
            "lang", joined(F.col("i"), LONGEST).alias("phrase"), F.col("n").alias("a"),
            F.when(F.col("i") == 1, F.col("first_n")).otherwise(F.col("n")).alias("head_n"),
            F.when(F.col("i") == size, F.col("last_n")).otherwise(F.col("n")).alias("tail_n"),
        )
        half = F.array(
            F.struct(F.lit(1).alias("k"), _first(1, "phrase").alias("ask"), F.col("tail_n").alias("known")),
            F.struct(F.lit(3).alias("k"), _last(1, "phrase").alias("ask"), F.col("head_n").alias("known")),
        )
        cut = lambda k, size: F.struct(F.lit(k).alias("k"), _first(k, "phrase").alias("left"), _last(size - k, "phrase").alias("right"))
        often = self._often
        triples = self._uncovered(often(self.nodes).join(inner, ["lang", "gram"], "left_anti"), often(self.edges), 3)
        pairs = self._uncovered(often(self.pairs), often(self.nodes), 2)
        both = [
            rows.select("lang", "phrase", "a", F.inline(F.array(*[cut(k, size) for k in ks])))
            for rows, size, ks in ((quads, 4, (2,)), (triples, 3, (1, 2)), (pairs, 2, (1,)))
        ]
        return both[0].unionByName(both[1]).unionByName(both[2]), quads.select("lang", "phrase", "a", F.inline(half))

    @staticmethod
    def _uncovered(rows: DataFrame, longer: DataFrame, size: int) -> DataFrame:
        """Without those that a run of one more word, itself frequent, occurs nearly as often as."""
        inside = longer.select("lang", F.inline(F.array(*[F.struct(part(size).alias("gram"), F.col("n").alias("m")) for part in (_first, _last)])))
        most = inside.groupBy("lang", "gram").agg(F.max("m").alias("m"))
        share, of = COVER
        covered = F.col("m").cast("decimal(20,0)") * of >= F.col("n").cast("decimal(20,0)") * share
        return rows.join(most, ["lang", "gram"], "left").where(F.col("m").isNull() | ~covered).select("lang", F.col("gram").alias("phrase"), F.col("n").alias("a"))

    def scored(self) -> DataFrame:
        """``lang, phrase, a, l, r, score`` of every candidate at its lowest-scoring cut."""
        both, half = self.candidates()
        # A part of a candidate occurs at least as often as the candidate.
        often = self._often
        counts = stored(often(self.nodes).unionByName(often(self.pairs)).unionByName(often(self.singles)), "counts")
        of = lambda part, n: counts.select("lang", F.col("gram").alias(part), F.col("n").alias(n))
        whole = both.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
        met = half.join(of("ask", "asked"), ["lang", "ask"])
        lone = met.withColumns(
            {"l": F.when(F.col("k") == 1, F.col("asked")).otherwise(F.col("known")), "r": F.when(F.col("k") == 1, F.col("known")).otherwise(F.col("asked"))}
        )
        columns = ["lang", "phrase", "a", "k", "l", "r"]
        score = F.expr(f"CAST(CAST(a AS DECIMAL(20,0)) * {SCALE} AS DECIMAL(38,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
        cuts = whole.select(*columns).unionByName(lone.select(*columns)).withColumn("score", score)
        best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("x"))
        return best.select("lang", "phrase", "x.a", "x.l", "x.r", "x.score")


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of each language."""
    graph = Graph(docs, min_count)
    scored = graph.scored()
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = scored.withColumn("salt", salt).withColumn("k", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    best = first.where(F.col("k") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    named = best.where(F.col("rank") <= top).join(graph.totals, "lang")
    return named.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
