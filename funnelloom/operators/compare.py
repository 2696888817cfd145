"""Ordered analytics over aggregated rows: tails, trends, steps, tops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def tail_buckets(df: DataFrame, bucket: str, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of the last ``n`` distinct buckets, per ``keys``. For aggregated rows."""
    rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.desc(bucket)))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def linear_trend(df: DataFrame, keys: Sequence[str], bucket: str, value: str) -> DataFrame:
    """Least squares of a series over its bucket position. NULL values keep their
    position but take no part; fewer than two points give NULL."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(bucket)) - 1
    rows = df.withColumn("__x", F.when(F.col(value).isNotNull(), position.cast("double")))
    y = F.col(value).cast("double")
    return rows.groupBy(*keys).agg(
        F.regr_slope(y, F.col("__x")).alias("slope"),
        F.regr_intercept(y, F.col("__x")).alias("intercept"),
        F.min(F.col("__x")).cast("int").alias("first_idx"),
        F.max(F.col("__x")).cast("int").alias("last_idx"),
        F.count(F.col("__x")).alias("points"),
    ).select(
        *keys,
        *[F.when(F.col("points") >= 2, F.col(c)).alias(c) for c in ("slope", "intercept")],
        *[F.when(F.col("points") >= 2, F.col(c)).alias(c) for c in ("first_idx", "last_idx")],
    )


def step_conversion(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Each stage over the stage before; a NULL stage or a 0 before it gives NULL."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    rate = F.when(before > 0, F.col(value).cast("double") / before.cast("double"))
    return df.withColumn("step_rate", rate)


def week_vs_prev_and_avg(df: DataFrame, keys: Sequence[str], week: str, value: str, n: int = 7) -> DataFrame:
    """Value of a week, of the week before, and the mean of the n weeks before."""
    w = Window.partitionBy(*keys).orderBy(week)
    return df.withColumn("prev", F.lag(value).over(w)).withColumn(
        "avg_before", F.avg(value).over(w.rowsBetween(-n, -1))
    )


def top_with_other(df: DataFrame, keys: Sequence[str], name: str, value: str, n: int, other: str) -> DataFrame:
    """Sums per key and name, where names outside the top n by total become ``other``.

    Totals tie-break by name. The top is a table of at most n rows, which is what
    allows the broadcast.
    """
    total = df.groupBy(F.col(name).alias("__name")).agg(F.sum(value).alias("__total"))
    top = total.orderBy(F.desc("__total"), F.asc_nulls_last("__name")).limit(n)
    top = top.select("__name", F.lit(True).alias("__top"))
    joined = df.join(F.broadcast(top), F.col(name).eqNullSafe(F.col("__name")), "left")
    shown = F.when(F.col("__top"), F.col(name)).otherwise(F.lit(other))
    return joined.groupBy(*keys, shown.alias(name)).agg(F.sum(value).alias(value))


def period_summary(df: DataFrame, keys: Sequence[str], bucket: str, value: str) -> DataFrame:
    """Total, mean per period and the earliest best period, the latter above 0 only."""
    best = F.max(F.struct(F.col(value), -F.unix_date(bucket)))
    out = df.groupBy(*keys).agg(
        F.sum(value).alias("total"), F.avg(value).alias("mean"), best.alias("__best")
    )
    top = F.col(f"__best.{value}")
    day = F.date_from_unix_date(-F.col("__best").getField("col2"))
    return out.select(
        *keys,
        "total",
        "mean",
        F.when(top > 0, day).alias("best_period"),
        F.when(top > 0, top).alias("best_value"),
    )


def row_max_band(df: DataFrame, keys: Sequence[str], rate: str, band) -> DataFrame:
    """Rate relative to its own maximum over the shown periods, with its band."""
    top = F.max(rate).over(Window.partitionBy(*keys))
    ratio = F.when(top > 0, F.col(rate) / top).otherwise(F.lit(0.0))
    return df.withColumn("of_max", ratio).withColumn("band", band(ratio))


def change_latest(df: DataFrame, keys: Sequence[str], bucket: str, rate: str) -> DataFrame:
    """Latest value of a rate, the one before, and their difference; a single period
    is compared with itself."""
    w = Window.partitionBy(*keys).orderBy(bucket)
    last = Window.partitionBy(*keys).orderBy(F.desc(bucket))
    rows = df.withColumn("prev", F.coalesce(F.lag(rate).over(w), F.col(rate))).withColumn(
        "__r", F.row_number().over(last)
    )
    return rows.where(F.col("__r") == 1).select(
        *keys, bucket, F.col(rate), "prev", (F.col(rate) - F.col("prev")).alias("change")
    )
