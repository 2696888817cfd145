"""Exact distinct counts from bitmaps that add up over days.

A day's assets of a key are a set of bits, one bitmap of 32,768 bits for each block of
asset numbers that occurs. Bitmaps of days are united by OR, so a week, a quarter or a year
needs no look at the assets again: a new day costs the scan of that day, and any bucket
is an OR over stored days. Exact, unlike a sketch; asset numbers are whole numbers.

A bitmap takes 4 KiB before compression, however few bits it has. Days with few assets per
block are therefore better counted by ``rollup.cohort_by_grain``, which regroups all days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelloom.functions.dates import grain_label
from funnelloom.operators.rollup import explode_grains, latest_buckets


def day_bitmaps(rows: DataFrame, keys: Sequence[str], day: str = "created", asset: str = "asset_id") -> DataFrame:
    """``keys, day, block, bits, n``: the assets of each day as bitmaps, and its rows.

    Rows without an asset have no block; their bitmap is empty. Bits are set in each task
    before anything is shuffled, so a key with most of the rows is one bitmap per
    task and block.
    """
    block = F.bitmap_bucket_number(F.col(asset)).alias("block")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(asset)))
    return rows.groupBy(*keys, F.col(day).alias("day"), block).agg(bits.alias("bits"), F.count(F.lit(1)).alias("n"))


def distinct_by_grain(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``tr`` and distinct assets ``t`` per grain, bucket and keys, latest buckets only."""
    opened = explode_grains(bitmaps, "day", (*keys, "block", "bits", "n"))
    united = opened.groupBy("g", "start", *keys, "block").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("n").alias("n"))
    assets = F.when(F.col("block").isNotNull(), F.bitmap_count("bits")).otherwise(0)
    out = united.groupBy("g", "start", *keys).agg(F.sum("n").alias("tr"), F.sum(assets).alias("t"))
    return latest_buckets(out).withColumn("p", grain_label())


class DayStore:
    """Day bitmaps in a folder, a sub-folder per day. A day written again replaces itself."""

    def __init__(self, spark: SparkSession, folder: str, schema):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def put(self, bitmaps: DataFrame, day: dt.date) -> None:
        bitmaps.where(F.col("day") == F.lit(day)).drop("day").write.mode("overwrite").parquet(f"{self.folder}/day={day}")

    def put_all(self, bitmaps: DataFrame) -> None:
        bitmaps.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(self.folder)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).option("basePath", self.folder).parquet(self.folder)
