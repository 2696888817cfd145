"""One engine for all boards that report the same counts at six grains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelloom.functions.dates import bucket_sql, grain_label
from funnelloom.spec import GRAINS, LATEST_BUCKETS


def explode_grains(
    df: DataFrame,
    day: str,
    keep: Sequence[str],
    per_grain: dict[str, str] | None = None,
    grains: Sequence[str] = GRAINS,
) -> DataFrame:
    """Each row once per grain, with the bucket's first day and the ``keep`` columns.

    ``per_grain`` maps an output column to a column prefix; the column
    ``<prefix>_<grain>`` of the row becomes that output.
    """
    structs = []
    for g in grains:
        extra = "".join(f", '{out}', {prefix}_{g}" for out, prefix in (per_grain or {}).items())
        structs.append(f"named_struct('g', '{g}', 'start', {bucket_sql(day, g)}{extra})")
    return df.selectExpr(*keep, f"inline(array({', '.join(structs)}))")


def latest_buckets(df: DataFrame, n: int = LATEST_BUCKETS, unlimited: Sequence[str] = ("Y",)) -> DataFrame:
    """Latest ``n`` buckets per grain over all countries and sources together.

    Runs on aggregated rows, whose number is bounded by the calendar.
    """
    rank = F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc("start")))
    return (
        df.withColumn("__rank", rank)
        .where(F.col("g").isin(*unlimited) | (F.col("__rank") <= n))
        .drop("__rank")
    )


def count_by_grain(df: DataFrame, keys: Sequence[str], day: str = "created") -> DataFrame:
    """Row counts per grain, bucket and keys, latest buckets only.

    Rows are counted per day first, so only the small daily table is exploded.
    """
    daily = df.groupBy(*keys, day).agg(F.count("*").alias("n"))
    out = (
        explode_grains(daily, day, (*keys, "n"))
        .groupBy("g", "start", *keys)
        .agg(F.sum("n").alias("n"))
    )
    return latest_buckets(out).withColumn("p", grain_label())


def cohort_by_grain(
    df: DataFrame,
    metrics: dict[str, str],
    keys: Sequence[str] = ("country", "source_id"),
    day: str = "created",
    asset: str = "asset_id",
    name: str | None = "source_name",
    asset_facts: DataFrame | None = None,
    asset_metrics: dict[str, str] | None = None,
) -> DataFrame:
    """Rows, distinct assets and conditional counts at six grains. ``metrics`` maps an
    output column to a condition in SQL text.

    ``asset_facts`` (country, asset and one row of facts each) are joined after the rows
    have been grouped by (keys, day, asset): a condition on them in ``asset_metrics``
    holds for all rows of such a group alike and counts them together. The join and the
    window below share one shuffle of the grouped rows; all rows without an asset are one
    row per day by then, so their NULL key needs no spreading.

    Distinct assets are not additive over days, yet exploding every lead by six
    grains before a distinct count would shuffle six times the table. Instead each
    (keys, asset) keeps its ordered days, and a day that opens a new bucket of some
    grain for that asset is flagged for that grain. The flags are additive: they
    are summed per day, and only the daily table is exploded.

    A very frequent asset, or the NULL one, shrinks to one row per day in the first
    partial aggregate.
    """
    names = [name] if name else []
    per_asset = df.groupBy(*keys, *names, day, asset).agg(
        F.count("*").alias("tr"),
        *[F.expr(f"count_if({test}) AS {m}") for m, test in metrics.items()],
    )
    late = asset_metrics or {}
    if asset_facts is not None:
        per_asset = per_asset.join(asset_facts, ["country", asset], "left")
        per_asset = per_asset.withColumns({m: F.expr(f"IF({test}, tr, 0L)") for m, test in late.items()})
    before = F.lag(day).over(Window.partitionBy(*keys, asset).orderBy(day))
    opens = {
        g: f"{asset} IS NOT NULL AND (__before IS NULL OR "
        f"{bucket_sql('__before', g)} != {bucket_sql(day, g)})"
        for g in GRAINS
    }
    sums = [F.expr(f"sum({m}) AS {m}") for m in ("tr", *metrics, *late)]
    daily = (
        per_asset.withColumn("__before", before)
        .groupBy(*keys, *names, day)
        .agg(*[F.expr(f"count_if({test}) AS __t_{g}") for g, test in opens.items()], *sums)
    )
    out = (
        explode_grains(daily, day, (*keys, *names, "tr", *metrics, *late), {"t": "__t"})
        .groupBy("g", "start", *keys)
        .agg(*[F.min(n).alias(n) for n in names], F.sum("t").alias("t"), *sums)
    )
    return latest_buckets(out).withColumn("p", grain_label())


def latest_periods(df: DataFrame, day: str = "created", n: int = LATEST_BUCKETS) -> DataFrame:
    """The latest ``n`` distinct buckets per grain; all of them for years. Distinct days
    come first, so the ranked table is never larger than the calendar."""
    days = df.select(day).where(F.col(day).isNotNull()).distinct()
    return latest_buckets(explode_grains(days, day, ()).distinct(), n)
