"""A stored aggregate that streams add to: sorted runs of batches, merged as they grow.

Each batch leaves one run, its rows already grouped by key. Whenever a run is less than
twice as large as the ones after it, they are merged into one: per key the minimum of
minima or the sum of sums. Sizes so fall by half from run to run, and what is stored and
read stays within about twice the number of keys, however many batches there were; each
row is written again only as often as the table doubles.

A run's folder is named by the batches it holds, and counts only once Spark has marked it
as complete. A merged run therefore replaces its parts in one step: readers take, from the
newest batch backwards, the complete run that reaches back furthest. Parts that are covered
are removed by the next batch, so a reader that has just listed them finds them still.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

_RUN = re.compile(r"run-(\d+)-(\d+)$")


class MergedRuns:
    """``keys`` name a row; ``merge`` gives for each value column its combining aggregate."""

    def __init__(self, spark: SparkSession, folder: str, schema, keys: tuple[str, ...], merge: dict[str, Callable[[str], Column]]):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.keys, self.merge = keys, merge
        path = spark._jvm.org.apache.hadoop.fs.Path
        self._path = path
        self._fs = path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _complete(self) -> list[tuple[int, int]]:
        """(first, last) batch of all complete runs."""
        if not self._fs.exists(self._path(self.folder)):
            return []
        found = (_RUN.match(s.getPath().getName()) for s in self._fs.listStatus(self._path(self.folder)))
        spans = [(int(m[1]), int(m[2])) for m in found if m]
        return [s for s in spans if self._fs.exists(self._path(f"{self._name(s)}/_SUCCESS"))]

    def _name(self, span: tuple[int, int]) -> str:
        return f"{self.folder}/run-{span[0]}-{span[1]}"

    @staticmethod
    def _current(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The runs that count, oldest first: covered ones are left out."""
        kept: list[tuple[int, int]] = []
        for span in sorted(spans, key=lambda s: (-s[1], s[0])):
            if not kept or span[1] < kept[-1][0]:
                kept.append(span)
        return kept[::-1]

    def _rows(self, spans: list[tuple[int, int]]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*map(self._name, spans))

    def _grouped(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[how(c).alias(c) for c, how in self.merge.items()])

    def add(self, rows: DataFrame, batch: int) -> None:
        """The rows of a batch, one per key at most. A batch that comes again is not added twice."""
        spans = self._complete()
        runs = self._current(spans)
        if runs and batch <= runs[-1][1]:
            return
        for old in set(spans) - set(runs):
            self._fs.delete(self._path(self._name(old)), True)
        self._write(rows, (batch, batch))
        runs.append((batch, batch))
        if len(runs) == 1:
            return
        sizes = [self._rows([r]).count() for r in runs]  # from the files' footers
        merged, size = 1, sizes[-1]
        while merged < len(runs) and sizes[-merged - 1] < 2 * size:
            merged += 1
            size += sizes[-merged]
        if merged > 1:
            self._write(self._grouped(self._rows(runs[-merged:])), (runs[-merged][0], batch))

    def _write(self, rows: DataFrame, span: tuple[int, int]) -> None:
        rows.select(*[f.name for f in self.schema]).write.mode("overwrite").parquet(self._name(span))

    def stored_rows(self) -> int:
        runs = self._current(self._complete())
        return self._rows(runs).count() if runs else 0

    def read(self) -> DataFrame:
        """One row per key over all batches so far."""
        runs = self._current(self._complete())
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self._grouped(self._rows(runs)).select(*[f.name for f in self.schema])
