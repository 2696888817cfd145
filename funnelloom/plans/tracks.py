"""Daily cohort on two tracks, its buckets, ratios and trend."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelloom.functions.dates import bucket_start, lookback_start
from funnelloom.functions.ratios import safe_ratio
from funnelloom.functions.text import label_source
from funnelloom.operators.channels import per_country
from funnelloom.operators.compare import linear_trend, tail_buckets
from funnelloom.operators.events import DEAL, first_dates
from funnelloom.operators.scans import scan_leads
from funnelloom.spec import TAIL_BUCKETS

COUNTS = ("reg", "calif_inmo", "calif_mm", "calif_both")
GRAIN_NAMES = {"day": "D", "week": "W", "month": "M"}


def dual_track_daily(leads: DataFrame, log: DataFrame, as_of: dt.date, days: int = 364) -> DataFrame:
    """Registered leads per day and source, and how many qualified on each track."""
    base = scan_leads(leads, as_of, first=lookback_start(as_of, days), wide=True)
    label = per_country(lambda s: label_source(F.col("source_id"), s.labels_assigned))
    base = base.where(F.col("deal_id").isNotNull()).select(
        *DEAL, F.col("created").alias("d"), label.alias("source")
    )
    flags = first_dates(log)
    return (
        base.join(flags, list(DEAL), "left")
        .groupBy("country", "d", "source")
        .agg(
            F.count("inmo_date").alias("calif_inmo"),
            F.count("mm_date").alias("calif_mm"),
            F.expr("count_if(mm_date IS NOT NULL AND inmo_date IS NOT NULL) AS calif_both"),
            F.count("*").alias("reg"),
        )
    )


def qualified_buckets(daily: DataFrame, granularity: str) -> DataFrame:
    """All sources together per bucket, the shown tail only, with both target ratios
    and the conversion rates."""
    bucket = bucket_start(F.col("d"), GRAIN_NAMES[granularity]).alias("bucket")
    sums = daily.groupBy("country", bucket).agg(*[F.sum(c).alias(c) for c in COUNTS])
    tail = tail_buckets(sums, "bucket", TAIL_BUCKETS[granularity], ["country"])
    return tail.select(
        "country",
        F.lit(granularity).alias("granularity"),
        "bucket",
        *COUNTS,
        safe_ratio(F.col("calif_both"), F.col("calif_mm")).alias("both_of_mm"),
        safe_ratio(F.col("calif_inmo"), F.col("calif_mm")).alias("inmo_of_mm"),
        safe_ratio(F.col("calif_mm"), F.col("reg")).alias("cvr_mm"),
        safe_ratio(F.col("calif_inmo"), F.col("reg")).alias("cvr_inmo"),
    )


def qualified_two_tracks(leads: DataFrame, log: DataFrame, as_of: dt.date) -> DataFrame:
    daily = dual_track_daily(leads, log, as_of)
    out = None
    for granularity in GRAIN_NAMES:
        one = qualified_buckets(daily, granularity)
        out = one if out is None else out.unionByName(one)
    return out


def qualified_trend(leads: DataFrame, log: DataFrame, as_of: dt.date) -> DataFrame:
    weekly = qualified_buckets(dual_track_daily(leads, log, as_of), "week")
    return linear_trend(weekly, ["country"], "bucket", "cvr_mm")
