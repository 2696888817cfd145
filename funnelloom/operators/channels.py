"""Channel attribution. Counts are formed per campaign first and resolved afterwards,
so the dictionary meets a small table and a frequent campaign costs nothing extra."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelloom.functions.text import (
    channel_to_source,
    collapse_paid_direct,
    is_blank,
    resolve_channel,
    resolve_channel_tracked,
    source_from_channel_name,
)
from funnelloom.operators.events import dedup_first
from funnelloom.operators.joins import left_join_spread
from funnelloom.spec import COUNTRIES


def dictionary_by(dictionary: DataFrame, key: str) -> DataFrame:
    """One dictionary row per key: the earliest row, then the smallest remaining values."""
    rows = dictionary.where(F.col(key).isNotNull()).select(key, "row_no", "channel_medium", "platform")
    return dedup_first(rows, key, ("row_no",)).select(
        F.col(key).alias("campaign"), "channel_medium", "platform"
    )


def per_country(build) -> Column:
    """CASE over the country column; ``build`` maps a spec to a column."""
    out = None
    for spec in COUNTRIES:
        test = F.col("country") == spec.code
        out = F.when(test, build(spec)) if out is None else out.when(test, build(spec))
    return out


def attach_channel(counts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add ``channel`` to rows that carry ``source_name`` and ``campaign``."""
    known = dictionary_by(dictionary, "campaign_original")
    joined = left_join_spread(counts, known, on=("campaign",), nullable="campaign")
    channel = resolve_channel(F.col("source_name"), F.col("campaign"), F.col("channel_medium"))
    return joined.withColumn("channel", channel)


def attach_channel_tracked(counts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The same for tracked rows only: a dictionary row with a platform is required."""
    known = dictionary_by(dictionary, "campaign_original").where(~is_blank(F.col("platform")))
    channel = resolve_channel_tracked(
        F.col("source_name"), F.col("campaign"), F.col("channel_medium")
    )
    return counts.join(known, "campaign").withColumn("channel", channel)


def spend_by_channel(
    spend: DataFrame,
    dictionary: DataFrame,
    bucket: Column,
    name: str,
    sums: Sequence[str] = ("spend",),
    with_source: bool = False,
    with_platform: bool = False,
) -> DataFrame:
    """Rounded sums per bucket and channel; spend without a dictionary medium drops out."""
    per_campaign = (
        spend.where(F.col("campaign").isNotNull())
        .groupBy("country", bucket.alias(name), "campaign")
        .agg(*[F.sum(s).alias(s) for s in sums])
    )
    known = dictionary_by(dictionary, "campaign_name").where(F.col("channel_medium").isNotNull())
    if with_platform:
        known = known.where(~is_blank(F.col("platform")))
    medium = F.col("channel_medium")
    rows = per_campaign.join(known, "campaign").withColumn(
        "channel", per_country(lambda s: collapse_paid_direct(medium, s.lead_form_aliases))
    )
    keys = ["country", name, "channel"]
    if with_platform:
        keys.append("platform")
    if with_source:
        # The fixed lead-form pair of the prefix rule is the same in both countries.
        rows = rows.withColumn(
            "source",
            per_country(lambda s: channel_to_source(medium, s.spend_prefixes, s.lead_form_aliases[:2])),
        ).where(F.col("source").isNotNull())
        keys.append("source")
    return rows.groupBy(*keys).agg(*[F.round(F.sum(s), 0).cast("double").alias(s) for s in sums])


def spend_match_rate(spend: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Spend with and without a dictionary medium, and the unmatched share."""
    per_campaign = spend.groupBy("country", "campaign").agg(F.sum("spend").alias("spend"))
    known = dictionary_by(dictionary, "campaign_name")
    rows = per_campaign.join(known, "campaign", "left")
    unmatched = F.sum(F.when(F.col("channel_medium").isNull(), F.col("spend")).otherwise(0))
    out = rows.groupBy("country").agg(F.sum("spend").alias("total"), unmatched.alias("unmatched"))
    return out.select(
        "country",
        F.col("total").cast("double").alias("total"),
        F.col("unmatched").cast("double").alias("unmatched"),
        (F.lit(100.0) * F.col("unmatched").cast("double") / F.col("total").cast("double")).alias(
            "pct_unmatched"
        ),
    )


def merge_leads_spend(counts: DataFrame, spend: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Outer merge: missing counts are 0, missing spend stays NULL."""
    stacked = counts.unionByName(spend, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(
        F.coalesce(F.sum("reg"), F.lit(0)).alias("reg"),
        F.coalesce(F.sum("cal"), F.lit(0)).alias("cal"),
        F.sum("spend").cast("long").alias("spend"),
    )


def recollapse_channels(weekly: DataFrame) -> DataFrame:
    """One row per week and channel over all sources. The source comes from the
    channel's name, else it is the smallest of the merged ones."""
    sums = ("reg", "cal", "asg", "spend", "clicks", "impressions")
    merged = weekly.groupBy("country", "week_start", "channel").agg(
        *[F.sum(c).cast("long").alias(c) for c in sums], F.min("source").alias("__smallest")
    )
    source = F.coalesce(source_from_channel_name(F.col("channel")), F.col("__smallest"))
    return merged.withColumn("source", source).drop("__smallest")
