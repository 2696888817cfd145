"""Token counts through a digest cache.

The cache is a Parquet table (content digest, tokenizer digest, count) in a shared
folder. A run digests every text, keeps one text of each digest that the cache lacks for
this tokenizer, encodes those, appends their counts, and reads all counts back by a join.
Content is normalised only by taking a null as an empty text: anything more would change
the counts of the whole text. The tokenizer's version is the SHA-256 of its file.

Defined results: every input row gives one row, repeated rows too; an empty text has no
tokens; a null ``doc_id`` stays null; a very long text is encoded whole; an empty table gives
no rows; other columns are not read, whatever their names. A run that failed half-way
leaves no counts, since Spark commits the appended files at the end. Two runs that append
at once, or a run repeated after a lost commit, may store a digest twice: counts are
grouped by digest when they are read, so that each is met once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelloom.llm.common import text_or_empty
from funnelloom.llm.tokens import encoder, slices

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def cached_counts(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """Stored counts of one tokenizer version; makes the cache where there is none."""
    spark.createDataFrame([], CACHE_SCHEMA).coalesce(1).write.mode("ignore").parquet(cache)
    known = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    return known.where(F.col("tokenizer") == tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            _, counts = encoder(path).encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts)], names=["digest", "n_tokens"])

    return count


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row; misses are added to ``cache``."""
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    # One text per digest: Spark combines copies before it deals them out, so a text that
    # a third of the rows share is a row per map task here.
    distinct = texts.select("digest", "text").dropDuplicates(["digest"])
    misses = distinct.join(cached_counts(spark, cache, version), "digest", "left_anti")
    counted = misses.mapInArrow(_counter(tokenizer_path), "digest binary, n_tokens long")
    counted.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    lengths = texts.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return lengths.join(cached_counts(spark, cache, version), "digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
